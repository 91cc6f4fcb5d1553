"""Lookup tables as a batch saw them, so that a batch that runs again sees the same."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.sinks.batches import file_system, hadoop_path, is_complete, write_once


class PinnedLookup:
    """Versions of a table that is read from elsewhere, and which one each batch used.

    A batch uses the newest version unless that was loaded longer than ``max_age_ms`` ago;
    then it loads another. What it uses is written down before anything is made of it.
    """

    def __init__(
        self,
        path: str,
        load: Callable[[SparkSession], DataFrame],
        max_age_ms: int = 3_600_000,
        clock: Callable[[], int] = lambda: int(time.time() * 1000),
    ):
        self.path, self.load, self.max_age_ms, self.clock = path.rstrip("/"), load, max_age_ms, clock

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The table as the batch sees it, whenever and how often it runs."""
        used = f"{self.path}/used/batch_id={batch_id}"
        if not is_complete(spark, used):
            version, loaded_ms = self._newest(spark, batch_id)
            now = self.clock()
            if version is None or now - loaded_ms > self.max_age_ms:
                version, loaded_ms = batch_id, now
                write_once(self.load(spark), self._version(version))
            pointer = spark.range(1).select(
                F.lit(version).cast("bigint").alias("version"), F.lit(loaded_ms).cast("bigint").alias("loaded_ms")
            )
            write_once(pointer, used)
            self._clean(spark, batch_id)
        return spark.read.parquet(self._version(self._pointer(spark, batch_id)[0]))

    def _version(self, version: int) -> str:
        return f"{self.path}/tables/version={version}"

    def _pointer(self, spark: SparkSession, batch_id: int) -> tuple[int, int]:
        schema = "version bigint, loaded_ms bigint"
        return tuple(spark.read.schema(schema).parquet(f"{self.path}/used/batch_id={batch_id}").first())

    def _numbers(self, spark: SparkSession, kind: str) -> list[int]:
        parent = f"{self.path}/{kind}"
        files = file_system(spark, parent)
        if not files.exists(hadoop_path(spark, parent)):
            return []
        names = [status.getPath().getName() for status in files.listStatus(hadoop_path(spark, parent))]
        return sorted(int(name.partition("=")[2]) for name in names if "=" in name)

    def _newest(self, spark: SparkSession, batch_id: int) -> tuple[int | None, int]:
        """The version the last batch before this one used, and when it was loaded."""
        for number in reversed(self._numbers(spark, "used")):
            if number < batch_id and is_complete(spark, f"{self.path}/used/batch_id={number}"):
                return self._pointer(spark, number)
        return None, 0

    def _clean(self, spark: SparkSession, batch_id: int) -> None:
        """Leave what this batch and the one before it use; no other can run again."""
        kept = [number for number in self._numbers(spark, "used") if number <= batch_id][-2:]
        versions = {self._pointer(spark, number)[0] for number in kept}
        for kind, name, needed in (("used", "batch_id", set(kept)), ("tables", "version", versions)):
            for number in self._numbers(spark, kind):
                if number < batch_id and number not in needed:
                    folder = f"{self.path}/{kind}/{name}={number}"
                    file_system(spark, folder).delete(hadoop_path(spark, folder), True)


Lookup = Callable[[SparkSession], DataFrame] | PinnedLookup


def looked_up(lookup: Lookup, spark: SparkSession, batch_id: int) -> DataFrame:
    """A table given as a function that loads it, or pinned."""
    return lookup.at(spark, batch_id) if isinstance(lookup, PinnedLookup) else lookup(spark)
