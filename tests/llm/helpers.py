"""Small tables that every operator has to handle."""

ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, None, 3),
    (4, "one two three", "en", "b", 13),
    (4, "one two three", "en", "b", 13),
    (5, "one two three", None, "b", 13),
    (None, "one two three four five six", "de", None, 27),
    (6, "straße été naïve " * 4, "de", "a", 60),
    (7, "word " * 30_000, "en", "c", 150_000),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows(spark):
    """Nulls, empty, repeated and long rows, with columns whose names operators use too."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    for name in ("id", "tid", "size", "score", "segments", "shard", "v", "n"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)
