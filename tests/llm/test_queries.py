import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import queries
from tests.llm.helpers import ODD, odd_rows, no_rows
from tests.llm.test_probminhash import brute_groups
from tests.llm.test_repeats import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_gives_the_same_rows(spark, name):
    got = queries.queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.sql(queries.oracle_sql()[name]).df()[list(got.columns)]
    assert sorted(map(tuple, got.itertuples(index=False))) == sorted(map(tuple, want.itertuples(index=False)))


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14))


def test_repeats_and_groups_of_the_test_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs)
    texts = [docs[i] for i in ids]
    for name, unit, length in (("op2_superkmer", "word", 35), ("op3_suffix", "byte", 200)):
        rows = {r[0]: r for r in queries.queries()[name](spark, SF).collect()}
        for i, want in zip(ids, brute(texts, unit, length), strict=True):
            assert (rows[i][1], rows[i]["n_removed"], rows[i]["n_spans"], rows[i]["kept_sha256"]) == want
    groups = {r["doc_id"]: r["component_id"] for r in queries.queries()["op5_probminhash"](spark, SF).collect()}
    assert [groups[i] for i in ids] == [ids[g] for g in brute_groups(texts)]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_passages", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        before, after = {r["doc_id"]: r["text"] for r in docs.collect()}, out.collect()
        if name == "near_duplicates":
            ids = sorted(before)
            want = {ids[g] for g in brute_groups([before[i] for i in ids])}
            assert sorted(r["doc_id"] for r in after) == sorted(want)
        if name == "repeated_passages":
            ids = sorted(before)
            kept = {r["doc_id"]: r["text"] for r in after}
            for i, (_, removed, _, sha) in zip(ids, brute([before[i] for i in ids], "byte", 200), strict=True):
                if removed == 0:
                    assert kept[i] == before[i]
                elif before[i].isascii():
                    assert hashlib.sha256(kept[i].encode()).hexdigest() == sha
        docs = spark.createDataFrame(after, out.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in docs.collect()}


def test_stages_handle_odd_and_no_rows(spark):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_rows(spark), SF)
        assert name == "packing" or out.columns == odd_rows(spark).columns
        out.collect()
        assert stage(spark, no_rows(spark), SF).count() == 0
    kept = corpus_pipeline.STAGES[1][1](spark, odd_rows(spark), SF)
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.where("doc_id is not null").collect()) == [
        (False, i) for i in (1, 3, 4, 6, 7)
    ]
    assert len(ODD) == 9


def test_one_text_of_a_group_stays_whatever_its_ids(spark):
    words = [f"w{i}" for i in range(100)]
    versions = [" ".join([*words, *(f"v{k}" for _ in range(k))]) for k in range(3)]
    rows = [(5, v) for v in versions] + [(None, "n " + v.replace("w", "m")) for v in versions]
    rows += [(7, "x " + versions[0].replace("w", "k")), (None, versions[0].replace("w", "k"))]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"][0]) for r in out) == [(0, "n"), (5, "w"), (7, "x")]


def characters_left(texts, length=200):
    """Characters of which no byte is covered by a repeated string."""
    raws = [t.encode() for t in texts]
    places = {}
    for i, raw in enumerate(raws):
        for at in range(len(raw) - length + 1):
            places.setdefault(raw[at : at + length], []).append((i, at))
    gone = [bytearray(len(raw)) for raw in raws]
    for found in places.values():
        for i, at in found if len(found) > 1 else ():
            gone[i][at : at + length] = b"1" * length
    out = []
    for i, text in enumerate(texts):
        at, left = 0, []
        for c in text:
            size = len(c.encode())
            left += [c] if not any(gone[i][at : at + size]) else []
            at += size
        out.append("".join(left))
    return out


def test_only_characters_that_a_cut_halves_go(spark):
    passage = "é" * 3 + "".join(chr(0x4E00 + k) for k in range(90)) + "€"
    texts = [
        "x\uFFFDy " + passage + " tail\uFFFD",
        "\uFFFD" + passage + "😀",
        # bytes of another character next to a shared byte: cuts within characters
        "a" * 250 + "é" + "b" * 250,
        "a" * 250 + "è" + "b" * 250,
        "plain \uFFFD",
        passage * 3,
    ]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.repeated_passages(spark, df, SF).collect()}
    assert [got[i]["text"] for i in range(len(texts))] == characters_left(texts)
    assert got[0]["text"].startswith("x\uFFFDy") and got[0]["text"].endswith("tail\uFFFD")
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_columns_of_any_name_pass_through(spark):
    names = ["_score", "score", "_id", "_tid", "_kept", "_text_id", "_copies", "_copy", "text_id", "kept_id", "kept_tid", "cut_tid", "cut_text"]
    names += ["mixed_id", "mixed_tid", "copies", "copy", "rows", "taken", "spans", "digest", "label", "_h", "key", "component_id", "kept"]
    words = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(6)]
    rows = [(i, w, "a", i % 2) for i, w in enumerate([*words, words[0] + " more"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    for name in names:
        df = df.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        got = out.collect()
        assert len(got) > 0 or name == "quality"
        for r in got:
            assert [r[n] for n in names] == [f"{n}{r['doc_id']}" for n in names], name


def test_shuffles_follow_the_input(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(queries, "configure", lambda s, *paths, factor=1: asked.append((paths, factor)))
    monkeypatch.setattr(queries.sharding, "shard_by_bytes", lambda df: df.limit(0).selectExpr("doc_id as id", "0L as size", "0L as text_crc32", "0 as shard", "0L as slot"))
    queries.queries()["op7_sharding"](spark, SF)
    assert asked == [((f"{SF}/documents.parquet",), 1)]
    asked.clear()
    monkeypatch.setattr(queries.suffix_radix, "remove_repeated_bytes", lambda df: df.selectExpr("doc_id", "0L n_units", "0L n_removed", "0L n_spans", "'' sha"))
    queries.queries()["op3_suffix"](spark, SF)
    assert asked == [((f"{SF}/documents.parquet",), 5)]
