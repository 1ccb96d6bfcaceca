"""Session helpers: sane defaults and a shared scratch location."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job wants; cluster-specific sizes (executors, shuffle
# partitions, memory) are left to the deployment.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a sort-merge join into a shuffled hash join only when every
    # build-side partition measured at runtime is below this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    # remove reliable checkpoint files once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "revgraph", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set to a shared file system, and an unset
    value is an error. Only a single-JVM session (``local`` or ``local[...]``,
    as in tests) gets a temporary folder of its own when none is set; it is
    removed when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder on the cluster's shared file system"
            )
        root = tempfile.mkdtemp(prefix="revgraph-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "revgraph", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a lineage cut that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Bytes per shuffle partition when the deployment sets no count; AQE then
# merges partitions that turn out small.
BYTES_PER_SHUFFLE_PARTITION = 512 * 1024 * 1024

# How much larger than its file the text of a compressed dump is, at a guess.
EXPANSION = {"bz2": 8, "gz": 5, "zst": 5, "xz": 9}


def input_bytes(spark: SparkSession, paths) -> int:
    """Size of files, folders or globs, compressed ones as large as their text may be (file-system metadata only)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([paths] if isinstance(paths, str) else list(paths))
    suffix = F.lower(F.substring_index("path", ".", -1))
    factor = F.lit(1)
    for name, n in EXPANSION.items():
        factor = F.when(suffix == name, n).otherwise(factor)
    return int(files.agg(F.coalesce(F.sum(F.col("length") * factor), F.lit(0)).alias("n")).first()["n"])


def size_shuffle_for(spark: SparkSession, moved_bytes: Callable[[], int]) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the bytes a job moves, unless the deployment set it.

    Spark's default of 200 would give partitions of hundreds of GB at 100 TB;
    one partition per ``BYTES_PER_SHUFFLE_PARTITION`` keeps each task's shuffle
    data within executor memory, and AQE coalesces those that end up small.
    """
    if spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(default, -(-int(moved_bytes()) // BYTES_PER_SHUFFLE_PARTITION))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def size_shuffle_partitions(spark: SparkSession, paths) -> int:
    """``size_shuffle_for`` a job that moves about its input once."""
    return size_shuffle_for(spark, lambda: input_bytes(spark, paths))
