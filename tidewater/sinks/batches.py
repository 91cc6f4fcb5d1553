"""Folders written once per micro-batch, so that a replayed batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# Rows of a page of a keyed table: readers that ask for a few keys read their pages only.
PAGE_ROWS = 256
# A batch with more keys than this reads their buckets whole.
ASKED_KEYS = 1_000
_IN_PAGES = "spark.sql.parquet.pushdown.inFilterThreshold"


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder has finished."""
    return file_system(spark, path).exists(hadoop_path(spark, f"{path}/_SUCCESS"))


def write_once(
    frame: DataFrame, path: str, partition_by: Sequence[str] = (), **options: str | int
) -> None:
    """Write the folder, unless an earlier attempt at the same batch has finished it."""
    if not is_complete(frame.sparkSession, path):
        frame.write.mode("overwrite").partitionBy(*partition_by).options(**options).parquet(path)


class BatchTable:
    """State carried from batch to batch, in a folder all executors share.

    ``delta/batch_id=N`` holds what batch N added, ``full/batch_id=N`` everything
    up to and including batch N. Batch N reads what came before it and never what
    it wrote itself, so running it again has the same outcome.
    """

    def __init__(self, path: str, schema: str, partition_by: Sequence[str] = ()):
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = tuple(partition_by)

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/batch_id={batch_id}"

    def _versions(self, spark: SparkSession, kind: str) -> list[int]:
        parent = f"{self.path}/{kind}"
        files = file_system(spark, parent)
        if not files.exists(hadoop_path(spark, parent)):
            return []
        names = [status.getPath().getName() for status in files.listStatus(hadoop_path(spark, parent))]
        numbers = sorted(int(name.partition("=")[2]) for name in names if "=" in name)
        return [number for number in numbers if is_complete(spark, self._folder(kind, number))]

    def add(self, batch_id: int, frame: DataFrame) -> None:
        """Record what the batch adds."""
        write_once(frame, self._folder("delta", batch_id), self.partition_by)

    def replace(self, batch_id: int, frame: DataFrame) -> None:
        """Record the whole state after the batch, and drop what no replay can need."""
        spark = frame.sparkSession
        write_once(frame, self._folder("full", batch_id), self.partition_by)
        needed = [number for number in self._versions(spark, "full") if number < batch_id][-1:]
        for kind in ("delta", "full") if needed else ():
            for number in self._versions(spark, kind):
                if number < needed[0] or (kind == "delta" and number == needed[0]):
                    folder = self._folder(kind, number)
                    file_system(spark, folder).delete(hadoop_path(spark, folder), True)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The state before the batch, with the ``batch_id`` that wrote each row."""
        full = [n for n in self._versions(spark, "full") if n < batch_id][-1:]
        start = full[0] if full else -1
        deltas = [n for n in self._versions(spark, "delta") if start < n < batch_id]
        frames = [
            self._read(spark, kind, numbers)
            for kind, numbers in (("full", full), ("delta", deltas))
            if numbers
        ]
        if not frames:
            return spark.createDataFrame([], f"{self.schema}, batch_id bigint")
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def added(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What a batch has added, as its first complete attempt wrote it."""
        return self._read(spark, "delta", [batch_id])

    def _read(self, spark: SparkSession, kind: str, numbers: Sequence[int]) -> DataFrame:
        return (
            spark.read.schema(f"{self.schema}, batch_id bigint")
            .option("basePath", f"{self.path}/{kind}")
            .parquet(*[self._folder(kind, number) for number in numbers])
        )

    def latest(self, spark: SparkSession) -> DataFrame:
        return self.before(spark, 2**62)

    def due(self, batch_id: int, every: int) -> bool:
        """Whether the deltas should be merged after this batch."""
        return every > 0 and batch_id % every == every - 1


class KeyedTable(BatchTable):
    """A ``BatchTable`` cut into buckets by a key, each in folders of its own.

    A batch reads only the buckets its keys are in, and a merge writes only those that
    changed since the merge before; of each bucket, the newest merge counts. Files are
    sorted by the key, in short pages: a batch of few keys reads, by Parquet's page index,
    the pages these can be in. A large bucket is several files, each of a range of keys, so
    that a merge has as many tasks as its shuffle has partitions.
    """

    def __init__(self, path: str, schema: str, key: str, buckets: int = 64):
        super().__init__(path, f"{schema}, bucket int", ("bucket",))
        self.key, self.buckets = key, buckets

    def _write(self, frame: DataFrame, folder: str, ranges: bool) -> None:
        """Sorted by bucket and key; by ``ranges`` of these, which looks at the rows twice."""
        rows = frame.withColumn("bucket", self._bucket())
        spread = rows.repartitionByRange("bucket", self.key) if ranges else rows.repartition("bucket")
        pages = {"parquet.page.row.count.limit": PAGE_ROWS, f"parquet.enable.dictionary#{self.key}": "false"}
        write_once(spread.sortWithinPartitions("bucket", self.key), folder, self.partition_by, **pages)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def add(self, batch_id: int, frame: DataFrame) -> None:
        self._write(frame, self._folder("delta", batch_id), ranges=False)

    def _newest(self, spark: SparkSession, batch_id: int) -> dict[int, int]:
        """Of each merged bucket, the newest merge before the batch."""
        found: dict[int, int] = {}
        for number in self._versions(spark, "full"):
            if number < batch_id:
                found |= dict.fromkeys(self._buckets_in(spark, "full", number), number)
        return found

    def _buckets_in(self, spark: SparkSession, kind: str, number: int) -> list[int]:
        folder = self._folder(kind, number)
        listed = file_system(spark, folder).listStatus(hadoop_path(spark, folder))
        names = [status.getPath().getName() for status in listed]
        return [int(name.partition("=")[2]) for name in names if name.startswith("bucket=")]

    def before(
        self, spark: SparkSession, batch_id: int, keys: DataFrame | None = None
    ) -> DataFrame:
        """The state before the batch; with ``keys``, only of buckets these are in.

        With few keys, only their rows. The frame of keys is evaluated twice if it is large.
        """
        if keys is None:
            return self._rows(spark, batch_id, None)
        asked = keys.select(F.col(self.key).alias("key"), self._bucket().alias("bucket"))
        few = asked.limit(ASKED_KEYS + 1).collect()
        if len(few) > ASKED_KEYS:
            wanted = {row["bucket"] for row in asked.select("bucket").distinct().collect()}
            return self._rows(spark, batch_id, wanted)
        rows = self._rows(spark, batch_id, {row["bucket"] for row in few})
        if int(spark.conf.get(_IN_PAGES)) < ASKED_KEYS:  # beyond it, least and largest are all that is looked for
            spark.conf.set(_IN_PAGES, str(ASKED_KEYS))
        values = {row["key"] for row in few}
        found = F.col(self.key).isin(*(values - {None}))
        return rows.where(found | F.col(self.key).isNull() if None in values else found)

    def _rows(self, spark: SparkSession, batch_id: int, wanted: set[int] | None) -> DataFrame:
        newest = self._newest(spark, batch_id)
        start = max(newest.values(), default=-1)
        deltas = [n for n in self._versions(spark, "delta") if start < n < batch_id]
        frames = []
        for kind, numbers in (("full", sorted(set(newest.values()))), ("delta", deltas)):
            paths = [
                f"{self._folder(kind, number)}/bucket={bucket}"
                for number in numbers
                for bucket in self._buckets_in(spark, kind, number)
                if (wanted is None or bucket in wanted)
                and (kind == "delta" or newest[bucket] == number)
            ]
            if paths:
                frames.append(
                    spark.read.schema(f"{self.schema}, batch_id bigint")
                    .option("basePath", f"{self.path}/{kind}")
                    .parquet(*paths)
                )
        if not frames:
            return spark.createDataFrame([], f"{self.schema}, batch_id bigint").drop("bucket")
        rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
        return rows.drop("bucket")

    def merge(
        self,
        spark: SparkSession,
        batch_id: int,
        combine: Callable[[DataFrame], DataFrame],
        expired: Column | None = None,
    ) -> None:
        """Replace the rows of every bucket changed since the last merge by ``combine`` of them.

        A bucket of which ``combine`` leaves nothing keeps its older rows until the next merge,
        so what it drops (expired rows, say) must be dropped by readers as well. Buckets that
        did not change and of which every row is ``expired`` are deleted, and folders
        that neither this state nor a replay of the batch needs.
        """
        before = self._newest(spark, batch_id)
        start = max(before.values(), default=-1)
        deltas = [n for n in self._versions(spark, "delta") if start < n <= batch_id]
        changed = {bucket for n in deltas for bucket in self._buckets_in(spark, "delta", n)}
        if changed:
            rows = self._rows(spark, batch_id + 1, changed)
            self._write(combine(rows), self._folder("full", batch_id), ranges=True)
        over = set()
        idle = set(before) - changed
        if expired is not None and idle:
            # All of a bucket's rows, and only what tells their age.
            ages = self._rows(spark, batch_id + 1, idle).groupBy(self._bucket().alias("bucket"))
            found = ages.agg(F.every(expired).alias("over")).where("over").collect()
            over = {row["bucket"] for row in found}
        old = [number for number in self._versions(spark, "full") if number < batch_id]
        for number in old:
            for bucket in self._buckets_in(spark, "full", number):
                if before.get(bucket) != number or bucket in over:
                    self._delete(spark, f"{self._folder('full', number)}/bucket={bucket}")
        for number in self._versions(spark, "delta"):
            if number <= start:
                self._delete(spark, self._folder("delta", number))

    def _delete(self, spark: SparkSession, folder: str) -> None:
        file_system(spark, folder).delete(hadoop_path(spark, folder), True)


def last_per_key(frame: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key, the row of the newest batch."""
    newest = F.max_by(F.struct(*columns), "batch_id").alias("_row")
    return frame.groupBy(*keys).agg(newest).select(*keys, "_row.*")
