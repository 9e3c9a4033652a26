import numpy as np

from siltstone.llm import probminhash as pm
from tests.llm.helpers import no_rows, odd_rows


def sets_of(texts):
    out = []
    for t in texts:
        w = (t or "").split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_groups(texts, threshold=0.8):
    sets, root = sets_of(texts), list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            common = len(sets[i] & sets[j])
            if same or common and common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))]


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = list(rng.choice(words, 150))
        texts.append(" ".join(base))
        for _ in range(rng.integers(0, 6)):
            copy = list(base)
            for place in rng.integers(0, 150, rng.integers(0, 5)):
                copy[place] = "new" + str(rng.integers(1000))
            texts.append(" ".join(copy))
    # a crowd of near copies of which some are near few others
    base = list(rng.choice(words, 120))
    for _ in range(80):
        copy = list(base)
        for place in rng.integers(0, 120, rng.integers(0, 6)):
            copy[place] = "odd" + str(rng.integers(1000))
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in pm.near_duplicates(df).collect()}
    want = brute_groups(texts)
    assert sum(got[i] != w for i, w in enumerate(want)) <= 1  # banding is probabilistic


def test_passages_repeated_in_one_copy_only(spark):
    rng = np.random.default_rng(11)
    texts = []
    for times in [8, 64, 1000] * 20:
        fresh = [f"r{x}" for x in rng.integers(0, 10**9, 104)]
        rest, passage = fresh[:54], fresh[54:]
        for n, more in ((1, 0), (times, 0), (times, 5)):  # set similarity 1.0, and about 0.95
            texts.append(" ".join([*rest, *passage * n, *passage[:4], *(f"t{x}" for x in rng.integers(0, 10**9, more))]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in pm.near_duplicates(df).collect()}
    want = brute_groups(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert len(set(want)) == 60


def test_sketch_estimates_weighted_similarity():
    h = np.arange(1, 301, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    weight = np.where(np.arange(300) < 50, 4.0, 1.0)
    a, b = slice(0, 250), slice(30, 300)
    text = np.repeat([0, 1], [250, 270])
    both = pm.sketch(text, np.concatenate([h[a], h[b]]), np.concatenate([weight[a], weight[b]]), 2, 4000)
    x, y = np.zeros(300), np.zeros(300)
    x[a], y[b] = weight[a], weight[b]
    shared = (x > 0) & (y > 0)
    want = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in np.flatnonzero(shared))
    assert abs((both[0] == both[1]).mean() - want) < 0.03


def test_cells_return_a_spanning_set():
    sets = [np.sort(np.array(s, np.int64)) for s in ([1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6], [9, 10], [2, 3, 4, 5, 6])]
    ids = [b"a", b"b", b"c", b"d"]
    links = pm.cell_links(ids, sets, ids, sets, 0.8)
    assert {frozenset(r) for r in links.itertuples(index=False)} == {frozenset((b"a", b"b")), frozenset((b"b", b"d"))}


def test_odd_rows_and_no_rows(spark):
    rows = pm.near_duplicates(odd_rows(spark)).collect()
    assert len(rows) == 9
    got = {r["doc_id"]: r["component_id"] for r in rows}
    assert got[1] == got[2] == 1 and got[4] == got[5] == 4 and got[3] == 3 and got[7] == 7
    assert pm.near_duplicates(no_rows(spark)).count() == 0
