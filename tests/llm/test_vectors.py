import numpy as np
from pyspark.sql import functions as F

from siltstone.llm import multi_index, product_quantised

BAD = [
    (900, None, 1),
    (901, [0.0] * 8, 1),
    (902, [1.0] * 7 + [None], 1),
    (903, [1.0] * 7 + [float("nan")], 1),
    (904, [1.0] * 7 + [float("inf")], 1),
    (905, [], 1),
]
SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, n=400, d=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[n // 2 :] = x[rng.integers(0, n // 8, n - n // 2)] + rng.normal(0, 0.06, (n - n // 2, d))
    x[-30:] = x[0]
    return x.astype(np.float32) * rng.uniform(0.5, 2, (n, 1)).astype(np.float32)


def frame(spark, x, labels):
    rows = [(i, [float(v) for v in r], l) for i, (r, l) in enumerate(zip(x, labels, strict=True))]
    return spark.createDataFrame(rows + BAD, SCHEMA).withColumn("cls", F.lit("clash")).withColumn("n", F.lit("clash"))


def test_links_equal_brute_force(spark):
    x = vectors()
    labels = [None if i % 17 == 0 else i % 2 for i in range(len(x))]
    got = {r["id"]: r for r in product_quantised.near_links(frame(spark, x, labels), block_rows=50).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.98
    same = np.array([[a is not None and a == b for b in labels] for a in labels])
    near &= same
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    for _ in range(len(x)):
        low = np.where(near, root[None, :], len(x)).min(axis=1)
        after = np.minimum(root, low)
        if (after == root).all():
            break
        root = after
    assert [got[i]["n_links"] for i in range(len(x))] == near.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == root.tolist()
    assert all(got[b[0]]["n_links"] == 0 and got[b[0]]["component_id"] == b[0] for b in BAD)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert product_quantised.near_links(empty).count() == 0
    assert multi_index.search(empty, F.col("vec_id") % 20 == 0).count() == 0
    bad = spark.createDataFrame(BAD, SCHEMA)
    assert product_quantised.near_links(bad).count() == len(BAD)
    assert multi_index.search(bad, F.lit(True)).count() == 0


def test_search_recall(spark):
    x = vectors(3, 900)
    df = frame(spark, x, [0] * len(x))
    rows = multi_index.search(df, F.col("vec_id") % 20 == 0, block_rows=100).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    v = x.astype(np.float64)
    hit = 0
    queries = range(0, len(x), 20)
    assert set(got) == set(queries)
    for q in queries:
        score = v @ v[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:20]
        hit += len(set(order) & {i for i, _ in got[q]})
        assert len(got[q]) == 20
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
        assert all(abs(s - score[i]) < 1e-12 * max(1, abs(s)) + 1e-12 for i, s in got[q])
    assert hit / (20 * len(queries)) >= 0.9


def test_few_candidates_are_all_returned(spark):
    df = frame(spark, vectors(5, 16)[:12], [0] * 12)
    rows = multi_index.search(df, F.col("vec_id") % 5 == 0).collect()
    assert len(rows) == 3 * 11 and {r["rank"] for r in rows} == set(range(1, 12))


def test_repeated_ids_and_two_lengths(spark):
    """Rows of one id are queries and candidates of their own; each length is searched by itself."""
    rng = np.random.default_rng(9)
    rows = [(i if i % 3 else 5 * (i // 15), rng.normal(size=8 if i % 5 < 3 else 6).tolist()) for i in range(150)]
    rows += [rows[0], rows[0], rows[1]]
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in rows], "vec_id long, embedding array<double>, label int").repartition(4)
    found = multi_index.search(df, F.col("vec_id") % 5 == 0, reach=1.0).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], round(r["score"], 9)))
    want, exact = {}, 0
    for at, (q, v) in enumerate(rows):
        if q % 5 == 0:
            scored = [(-float(np.dot(v, w)), i) for n, (i, w) in enumerate(rows) if n != at and len(w) == len(v)]
            want.setdefault(q, []).extend((rank, i, round(-s, 9)) for rank, (s, i) in enumerate(sorted(scored)[:20], 1))
    assert {q: len(p) for q, p in got.items()} == {q: len(p) for q, p in want.items()}
    for q, pairs in want.items():
        left = list(got[q])
        exact += sum(p in left and not left.remove(p) for p in pairs)
    assert exact >= 0.9 * sum(map(len, want.values()))


def test_every_code_within_the_radius_is_met():
    rng = np.random.default_rng(6)
    code = rng.integers(0, 256, (500, 4)).astype(np.uint8)
    import pandas as pd

    for radius in (3, 6, 9):
        each = np.array([radius // 4 - (j > radius % 4) for j in range(4)])
        table = pd.DataFrame({"id": np.arange(500), "code": [c.tobytes() for c in code], "v": list(np.ones((500, 2))), "name": np.arange(500)})
        met = []
        for part in range(4):
            if each[part] >= 0:
                met.append(multi_index.cell_best(table.iloc[:20], table, part, each, radius, 500))
        met = pd.concat(met)
        apart = multi_index.POPCOUNT[code[:20, None] ^ code[None]].sum(axis=2)
        want = {(q, i) for q, i in zip(*np.nonzero(apart <= radius), strict=True) if q != i}
        pairs = list(zip(met["query_id"], met["id"], strict=True))
        assert len(pairs) == len(set(pairs)) and set(pairs) == want
