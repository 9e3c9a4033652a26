import numpy as np
import pytest

from siltstone.llm import ptolemaic_clusters as pc

FIELDS = "vec_id long, embedding array<float>, id string, cluster string, v string"


def plain(vectors, first, rounds):
    """Every distance of every round, one vector at a time."""
    vectors = [[int(np.floor(256 * float(x))) for x in v] for v in vectors]
    centroids = [list(vectors[i]) for i in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        owners = [nearest(v)[1] for v in vectors]
        for j in set(owners):
            mine = [v for v, o in zip(vectors, owners, strict=True) if o == j]
            centroids[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    return [nearest(v) for v in vectors], centroids


@pytest.mark.parametrize("spread", [0.01, 1.0, 1000.0])
def test_bounds_never_exceed_the_distance(spread):
    rng = np.random.default_rng(3)
    x = np.floor(256 * spread * rng.normal(size=(300, 16))).astype(np.int64)
    x[:40] = x[0]  # equal vectors, equal centroids
    centroids = x[::15].copy()
    pivots = pc.choose_pivots(centroids, 6)
    near = pc.pivot_distances(x, pivots)
    bound = pc.lower_bounds(near, pc.pivot_distances(centroids, pivots), pivots)
    exact = pc.squared(x[:, None, :], centroids[None, :, :])
    assert (bound**2 * (1 - pc.SLACK) <= exact).all()
    owner, best = pc.assign(x, near, centroids, pivots)
    assert (owner == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()


def test_bounds_leave_centroids_out():
    rng = np.random.default_rng(4)
    middle = 40 * rng.normal(size=(10, 16))
    x = np.floor(256 * (np.repeat(middle, 50, axis=0) + rng.normal(size=(500, 16)))).astype(np.int64)
    centroids = x[::50]
    pivots = pc.choose_pivots(centroids, 8)
    bound = pc.lower_bounds(pc.pivot_distances(x, pivots), pc.pivot_distances(centroids, pivots), pivots)
    exact = np.sqrt(pc.squared(x[:, None, :], centroids[None, :, :]).min(axis=1))
    assert (bound > exact[:, None]).mean() > 0.5


def test_clusters_by_brute_force(spark):
    import hashlib

    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=64))]) for i in range(200)]
    rows += [(i, rows[i % 7][1]) for i in range(200, 260)] + [(None, rows[3][1]), (5, rows[9][1])]
    odd = [(900, None), (901, [1.0] * 63), (902, [None] * 64), (903, [float("nan")] * 64), (904, [float("inf")] * 64)]
    odd += [(905, []), (906, [3e38] * 64)]
    table = [(i, v, "x", "y", "z") for i, v in rows + odd]
    out, centroids = pc.cluster_vectors(spark.createDataFrame(table, FIELDS).repartition(5), "vec_id", "embedding")
    got = sorted(tuple(r) for r in out.na.fill(-1, ["id"]).collect())
    whole = [[int(np.floor(256 * x)) for x in v] for _, v in rows]
    digest = [hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest() for i, _ in rows]
    first = sorted(range(len(rows)), key=lambda j: (digest[j], whole[j]))[:40]
    want, middle = plain([v for _, v in rows], first, 5)
    assert centroids.tolist() == middle
    inertia = {c: sum(d for d, e in want if e == c) for _, c in want}
    assert got == sorted(
        (-1 if i is None else i, c, d, inertia[c], sum(inertia.values()), pc.centroid_digest(np.array(middle[c])))
        for (i, _), (d, c) in zip(rows, want, strict=True)
    )


def test_few_equal_and_no_vectors(spark):
    few = spark.createDataFrame([(i, [1.0] * 64, "a", "b", "c") for i in range(5)], FIELDS)
    out, centroids = pc.cluster_vectors(few, "vec_id", "embedding")
    assert [(r["cluster"], r["distance"], r["inertia"]) for r in out.collect()] == [(0, 0, 0)] * 5
    assert len(centroids) == 5
    out, _ = pc.cluster_vectors(few.where("vec_id > 9"), "vec_id", "embedding")
    assert out.count() == 0 and out.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
