"""Session settings and the shared folder for checkpoints and batch state."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Lines shrink to a tenth or less in Parquet, and tasks hold them as text.
SPLIT_BYTES = 16 << 20
_SPLITS = "spark.sql.files.maxPartitionBytes"


def build_session(
    app_name: str = "tidewater",
    time_zone: str = "Asia/Shanghai",
    master: str | None = None,
    input_bytes: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the settings the pipelines are tuned for.

    ``time_zone`` decides which calendar day a millisecond falls on. With
    ``input_bytes``, the size of what a batch reads, shuffles get partitions that
    fit a task; adaptive execution merges small ones and splits skewed joins.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A repeated JSON key is not an error: the last value counts.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        # Checkpoint files of dropped frames are removed with the frame.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(_SPLITS, SPLIT_BYTES)
        # Topics are few: keep one open file per topic instead of sorting rows by topic.
        .config("spark.sql.maxConcurrentOutputFileWriters", "16")
    )
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(input_bytes))
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, partition_bytes: int = 1 << 30) -> int:
    """How many partitions keep each near ``partition_bytes``: 200 at least.

    A gigabyte of text sorts within an executor's memory or spills once; at 100 TB
    smaller partitions would make for more shuffle blocks than the driver can track.
    """
    return max(200, -(-input_bytes // partition_bytes))


@contextmanager
def short_splits(spark: SparkSession, split_bytes: int = SPLIT_BYTES) -> Iterator[None]:
    """Tasks read that much of files at most, for sessions made elsewhere.

    Streams over files take it from the session they are defined in, batch by batch.
    """
    before = spark.conf.get(_SPLITS)
    spark.conf.set(_SPLITS, split_bytes)
    try:
        yield
    finally:
        spark.conf.set(_SPLITS, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidewater-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
