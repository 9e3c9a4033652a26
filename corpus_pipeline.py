"""The corpus pipeline: documents in, packed training sequences out.

Stages, each written as Parquet and read again as the next one's documents:

1. quality: a byte-level convolutional network, fitted on the labelled documents of its input
   (a bounded sample); documents below one half go.
2. near duplicates: ProbMinHash groups; the document with the smallest id of each group stays.
3. repeated passages: every byte covered by a 200-byte string that starts anywhere else goes.
   A character cut in two goes whole, all others stay; n_chars is counted anew. A document may
   end up empty.
4. mixing: sources to target weights; a document is dropped, kept, or repeated as it is taken.
5. packing: sequences of at most 1024 tokens; one row per piece, with its ids.

Nulls, empty texts and repeated rows are treated as each operator says; repeated rows fall to
one in stage 2. An empty table passes through. Further columns are kept up to stage 4, whatever
their names: columns that a stage adds for itself get names that the input does not have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import mixing, packing, probminhash, quality_cnn, suffix_radix
from siltstone.llm.common import read, staged
from siltstone.session import configure

ARROW_ROWS = "500"  # texts that travel to Python at a time
SHUFFLED = 5  # bytes that the widest shuffle writes for a byte of the documents


def text_id() -> F.Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def prepare(spark: SparkSession, sf_dir: str) -> None:
    configure(spark, f"{sf_dir}/documents.parquet", factor=SHUFFLED)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def free(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of `docs` has."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark, sf_dir)
    (score,) = free(docs, "score")
    network = quality_cnn.fit(docs, read(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, network, docs.columns, out_col=score).where(F.col(score) >= 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark, sf_dir)
    key, tid, text = free(docs, "kept_id", "kept_tid", "text_id")
    groups = probminhash.near_duplicates(docs)
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("tid") == F.col("kept_tid")))
    # equal texts have one identity, so the first id with its text names the row to keep
    first = first.select(F.col("doc_id").alias(key), F.col("tid").alias(tid)).distinct()
    rows = docs.withColumn(text, text_id())
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(text) == F.col(tid))
    return rows.join(first, same, "left_semi").dropDuplicates(["doc_id", text]).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark, sf_dir)
    tid, kept, text = free(docs, "cut_tid", "cut_text", "text_id")
    found = suffix_radix.remove_repeated_bytes(docs).where("kept is not null")
    cuts = found.groupBy(F.col("tid").alias(tid)).agg(F.first(F.struct("kept", "spans")).alias("cut"))
    cuts = cuts.select(tid, suffix_radix.whole_characters(F.col("cut.kept"), F.col("cut.spans")).alias(kept))
    out = docs.withColumn(text, text_id()).join(cuts, F.col(text) == F.col(tid), "left")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(kept).isNotNull(), F.length(kept).cast(kind)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.coalesce(kept, "text")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark, sf_dir)
    key, tid, text, times, copy = free(docs, "mixed_id", "mixed_tid", "text_id", "copies", "copy")
    taken, _ = mixing.mix(docs.withColumn(tid, text_id()), "doc_id", F.array("source"), keep=(tid,))
    copies = (
        taken.where("taken > 0")
        .groupBy(F.col("id").alias(key), tid)
        .agg(F.sum(F.expr("taken div size * rows")).alias(times))
    )
    rows = docs.withColumn(text, text_id())
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(text) == F.col(tid))
    chosen = rows.join(copies, same).dropDuplicates(["doc_id", text])
    return chosen.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark, sf_dir)
    return packing.pack_texts(docs).withColumnRenamed("row_id", "doc_id")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
