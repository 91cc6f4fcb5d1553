"""Helpers the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewater.operators.scale import lookup_side
from tidewater.session import new_folder
from tidewater.sinks.batches import file_system, hadoop_path

# What separates words: blank and the five ASCII controls from tab to carriage return.
# The set bytes.split() knows, so bytes.lower().split() gives the words of a text.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tuned(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker gets at once: long texts come in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: read many times, computed once.

    Lineage ends there, so a lost executor costs no more than the tasks it ran.
    """
    folder = new_folder(frame.sparkSession, f"llm-{name}")
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


class Scratch:
    """A ``written`` table that is deleted as soon as the next ones are made from it.

    Its rows may come in several rounds. The shuffle files of a round go as its write
    ends; else they stay until the driver happens to collect its garbage.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, new_folder(spark, f"llm-{name}")
        self.schema = None

    def add(self, frame: DataFrame) -> None:
        with _brief_shuffles(self.spark):
            frame.write.mode("append").parquet(self.folder)
        self.schema = frame.schema

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def delete(self) -> None:
        file_system(self.spark, self.folder).delete(hadoop_path(self.spark, self.folder), True)


_BRIEF_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _brief_shuffles(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_BRIEF_SHUFFLES, "false")
    spark.conf.set(_BRIEF_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_BRIEF_SHUFFLES, before)


def free_name(frame: DataFrame, name: str) -> str:
    """A column name the frame does not have, made of the given one."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def width(spark: SparkSession) -> int:
    """How many partitions a shuffle of the whole input has in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos`` and ``size``: a row's place in its ``tree`` along ``order``, and the tree's rows.

    Rows are range-partitioned, so a tree with a third of them is sorted in many tasks; only
    counts per tree and partition (at most trees + partitions of them) are summed up.
    ``order`` must be unique in a tree.
    """
    parts = width(rows.sparkSession)
    placed = written(
        rows.repartitionByRange(parts, "tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33).cast("int")),
        "ranked",
    )
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = written(
        placed.groupBy("tree", "_part")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .select(
            "tree",
            "_part",
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(whole).cast("bigint").alias("size"),
        ),
        "ranges",
    )
    return (
        placed.join(lookup_side(sums), ["tree", "_part"])
        .withColumn("pos", (F.col("_id") + F.col("_shift")).cast("bigint"))
        .drop("_id", "_part", "_shift")
    )


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for NULL."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANK_RUN)
    return F.filter(parts, lambda word: word != "")


def release() -> None:
    """Give memory that is free back to the system: Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def in_python(
    frame: DataFrame, work: Callable[[Iterator[dict]], Iterator[dict]], schema: str
) -> DataFrame:
    """``work`` on batches of columns (lists; texts as UTF-8 bytes), next to the data.

    It gets and gives dicts of column name to list or numpy array.
    """
    target = frame.sparkSession.createDataFrame([], schema).schema
    fields = pa.schema(
        [(field.name, _arrow_type(field.dataType.simpleString())) for field in target]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(_columns(batch) for batch in batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[field.name], field.type) for field in fields], schema=fields
            )
        release()

    return frame.mapInArrow(run, schema)


def filtered(docs: DataFrame, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows whose ``text`` is kept, each judged by itself, with all columns as they are.

    Every task makes the judge once; it gets lists of texts (UTF-8 bytes or None).
    """
    at = [name.lower() for name in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            texts = batch.column(at).cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
            yield batch.filter(pa.array(keep(texts), pa.bool_()))
        del keep
        release()

    return docs.mapInArrow(run, docs.schema)


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "float": pa.float32(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
}

# Columns of these types can go through in_python.
PLAIN_TYPES = frozenset(_ARROW)


def _arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(_arrow_type(name[6:-1]))
    return _ARROW[name]


def _columns(batch: pa.RecordBatch) -> dict:
    found = {}
    for name, column in zip(batch.schema.names, batch.columns):
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            column = column.cast(
                pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
            )
        found[name] = column.to_pylist()
    return found
