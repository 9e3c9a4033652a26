"""Session settings, shuffle sizing and the shared work folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

# Settings the results or the plans rely on; all can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # jsonb keeps the last of two equal keys
    "spark.sql.variant.allowDuplicateKeys": "true",
    # a task writes its few months side by side: sorting wide rows by month first would hold them all
    # in memory; what goes beyond this many months is sorted
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}

# Only settable before the session starts: no capture of Python call sites, which costs
# more than the rest of building a plan.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def build_session(
    app_name: str = "siltstone", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession, *input_paths: str, factor: float = 1) -> SparkSession:
    """Apply the runtime settings and size the shuffles for the given inputs, of which the
    widest shuffle writes `factor` times the bytes."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if input_paths:
        size_shuffles(spark, *input_paths, factor=factor)
    return spark


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path object and its file system."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark._jsc.hadoopConfiguration())


def size_shuffles(spark: SparkSession, *paths: str, factor: float = 1) -> int:
    """Raise the shuffle partition count so that the inputs give 128 MiB partitions.

    Only ever raises it: adaptive execution merges partitions that turn out small, but
    cannot split more finely than the count it starts from.
    """
    total = 0
    for path in paths:
        hpath, fs = hadoop_path(spark, path)
        total += fs.getContentSummary(hpath).getLength()
    wanted = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        math.ceil(total * factor / SHUFFLE_PARTITION_BYTES),
    )
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def size_scans(spark: SparkSession) -> None:
    """Split scans at least as often as shuffles. Published files hold many rows a byte, so a split of
    Spark's usual size would be a task whose grouping or sorting holds millions of them."""
    spark.conf.set("spark.sql.files.minPartitionNum", spark.conf.get("spark.sql.shuffle.partitions"))


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a session in one process
    (tests) may leave it unset: on a cluster a local folder would lose rows."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = f"/tmp/checkpoints/siltstone-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def require_utc(spark: SparkSession) -> None:
    """Differences of timestamps without zone are exact only in a session without
    daylight saving."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"session time zone is {zone}, not UTC; call configure(spark) first")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/siltstone/{label}-{uuid.uuid4().hex}"
