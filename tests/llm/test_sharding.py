import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import sharding
from siltstone.llm.common import one_row_each
from tests.llm.helpers import no_rows, odd_rows


def spread(sizes, shard, n):
    load = np.bincount(shard, sizes, minlength=n)
    return load.max() - load.min()


def test_differencing_is_near_the_best():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = rng.integers(1, 100, 9)
        got = spread(sizes, sharding.difference(sizes, 3, np.zeros(3)), 3)
        best = min(spread(sizes, np.array(s), 3) for s in itertools.product(range(3), repeat=9))
        greedy = np.zeros(3)
        for s in sorted(sizes, reverse=True):
            greedy[greedy.argmin()] += s
        assert got <= best + 30 and got <= max(best + 10, greedy.max() - greedy.min() + 10)
    many = rng.integers(10, 5000, 4000)
    assert spread(many, sharding.difference(many, 16, np.zeros(16)), 16) <= 20


def test_ballast_names_the_shards():
    ballast = np.array([100.0, 0, 50])
    sizes = np.array([10] * 15)
    shard = sharding.difference(sizes, 3, ballast)
    assert spread(np.concatenate([ballast, sizes]), np.concatenate([[0, 1, 2], shard]), 3) <= 10


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_GROUPS", 64)
    rng = np.random.default_rng(1)
    texts = ["x" * int(n) for n in rng.integers(0, 3000, 700)] + ["y" * 900] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard_by_bytes(df, shards=5).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(texts)))
    where = {}
    for r in rows:
        assert where.setdefault(texts[r["id"]], r["shard"]) == r["shard"]
        assert r["size"] == len(texts[r["id"]]) + 1
    for s in range(5):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    load = np.bincount([r["shard"] for r in rows], [r["size"] for r in rows])
    assert load.max() - load.min() < 0.005 * load.mean()


def test_odd_rows_and_no_rows(spark):
    rows = sharding.shard_by_bytes(odd_rows(spark)).collect()
    assert len(rows) == 9 and {r["size"] for r in rows if r["id"] in (1, 2)} == {1}
    assert len({r["shard"] for r in rows if r["id"] in (4, 5)}) == 1
    assert sharding.shard_by_bytes(no_rows(spark)).count() == 0


@pytest.fixture
def unmerged(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_rows_are_numbered_by_many_tasks(unmerged):
    spark = unmerged
    df = spark.range(200_000).selectExpr("cast(null as long) as doc_id", "'same' as text")
    df = df.unionByName(spark.range(1000).selectExpr("id as doc_id", "concat('t', id % 700) as text"))
    out = sharding.shard_by_bytes(df, shards=4)
    got = out.withColumn("task", F.spark_partition_id()).toPandas()
    assert len(got) == 201_000
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert got[got["id"].isna()]["task"].nunique() > 1


def test_rows_come_back_as_often_as_they_count(spark):
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 23)], "v string, n long")
    got = sorted((r["v"], r["nth"]) for r in one_row_each(df, "n", step=10).collect())
    assert got == [(v, k) for v, n in (("a", 1), ("b", 10), ("c", 23)) for k in range(n)]
