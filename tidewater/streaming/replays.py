"""Facts that stand in a topic twice, because the batch that made them was sent again.

A fact is known by where it comes from: partition and offset of its line, and its number
in the line, as the Kafka sink's headers say. What was read is kept as bitmaps, 32768
positions each: a bit per position, 4 kB per bitmap. Bitmaps of positions that no batch can
send again are dropped, and all up to there counts as read. So the state grows with what was
read in ``keep``, by one bit a fact, whatever gaps the positions have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.contract import ARRIVAL
from tidewater.operators.scale import lookup_side, order_key, stored
from tidewater.sinks.batches import BatchTable
from tidewater.sources.lines import ORIGIN_COLUMNS

_KEYS = ("source_partition", "_bucket")


class SeenFacts:
    """Positions read from one topic so far, by partition of the topic they come from.

    ``per_line`` is how many facts of the topic a line can give, counted by their numbers:
    1 says that their numbers do not matter. ``keep`` must cover the time from a batch's
    first attempt to the end of its last one, as read from the arrival times; what comes
    later than that at a position that is gone counts as sent again.
    """

    def __init__(self, path: str, keep: str = "7 days", per_line: int = 1, merge_every: int = 20):
        # ``bits`` NULL: this bucket and all before it are read.
        self.table = BatchTable(
            path, "source_partition int, _bucket bigint, bits binary, last timestamp"
        )
        self.keep, self.per_line, self.merge_every = keep, per_line, merge_every

    def _position(self) -> Column:
        nth = F.coalesce(F.col("source_nth"), F.lit(0))
        checked = F.when(nth < self.per_line, nth).otherwise(
            F.raise_error(F.lit("more facts in a line than per_line")).cast("int")
        )
        # From 1 on, where Spark's bitmap functions number buckets and bits alike.
        inside = F.lit(0) if self.per_line == 1 else checked
        return F.col("source_offset") * self.per_line + inside + 1

    def marked(
        self, rows: DataFrame, batch_id: int, arrival: Sequence[str] = ARRIVAL
    ) -> tuple[DataFrame, DataFrame]:
        """The rows with ``_again``, whether they were read before, and what to ``record``.

        Of rows that stand in the batch twice, the first to arrive counts. Rows without an
        origin are never taken for repeats. Only rows in buckets in which something repeats
        are looked at one by one; a batch without repeats costs one sum per bucket.
        """
        spark = rows.sparkSession
        if not set(ORIGIN_COLUMNS) <= set(rows.columns):
            empty = spark.createDataFrame([], self.table.schema)
            return rows.withColumn("_again", F.lit(False)), empty
        known = F.col("source_partition").isNotNull() & F.col("source_offset").isNotNull()
        position = F.when(known, self._position())
        placed = rows.withColumns(
            {"_bucket": F.bitmap_bucket_number(position), "_bit": F.bitmap_bit_position(position)}
        )
        here = stored(
            placed.where("_bucket is not null")
            .groupBy(*_KEYS)
            .agg(
                F.count("*").alias("n"),
                F.bitmap_construct_agg("_bit").alias("bits"),
                F.max(arrival[0] if arrival[0] == "timestamp" else F.lit(None)).cast("timestamp").alias("last"),
            )
        )
        new = here.select(*_KEYS, "bits", "last")
        before = self.table.before(spark, batch_id)
        read_up_to = F.broadcast(  # one row per partition of the source topic
            before.where("bits is null").groupBy("source_partition").agg(F.max("_bucket").alias("_settled"))
        )
        met = before.join(lookup_side(here.select(*_KEYS)), list(_KEYS), "left_semi")
        old = met.where("bits is not null").groupBy(*_KEYS).agg(F.bitmap_or_agg("bits").alias("_old"))
        both = here.join(old, list(_KEYS), "left").join(read_up_to, "source_partition", "left")
        settled = F.coalesce(F.col("_bucket") <= F.col("_settled"), F.lit(False))
        either = old.select(*_KEYS, F.col("_old").alias("bits")).unionByName(here.select(*_KEYS, "bits"))
        joint = either.groupBy(*_KEYS).agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_joint"))
        old_count = F.coalesce(F.bitmap_count("_old"), F.lit(0))
        suspects = stored(
            both.join(joint, list(_KEYS))
            .withColumn("_settled", settled)
            .withColumn("_within", F.col("n") > F.bitmap_count("bits"))
            .where(F.col("_settled") | F.col("_within") | (F.col("_joint") < old_count + F.bitmap_count("bits")))
            .select(*_KEYS, "_old", "_settled", "_within")
        )
        if suspects.isEmpty():
            return rows.withColumn("_again", F.lit(False)), new
        looked = placed.join(lookup_side(suspects), list(_KEYS), "left")
        byte = F.conv(F.hex(F.substring("_old", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10)
        was_read = F.getbit(byte.cast("int"), (F.col("_bit") % 8).cast("int")) == 1
        # Positions that stand in the batch more than once, with the first arrival of each.
        twice = (
            looked.where("_within")
            .groupBy(*_KEYS, "_bit")
            .agg(F.count("*").alias("n"), F.min(order_key(arrival)).alias("_first"))
            .where("n > 1")
            .drop("n")
        )
        found = looked.join(lookup_side(stored(twice)), [*_KEYS, "_bit"], "left")
        later = F.col("_first").isNotNull() & (order_key(arrival) > F.col("_first"))
        again = F.coalesce(F.col("_settled"), F.lit(False)) | F.coalesce(was_read, F.lit(False)) | later
        return found.withColumn("_again", again).select(*rows.columns, "_again"), new

    def record(self, spark: SparkSession, batch_id: int, new: DataFrame) -> None:
        """Add what the batch has read; every few batches, drop what is older than ``keep``."""
        self.table.add(batch_id, new)
        if not self.table.due(batch_id, self.merge_every):
            return
        rows = self.table.before(spark, batch_id + 1)
        buckets = rows.groupBy(*_KEYS).agg(
            # Bits of a bucket that is settled stay away, should more of it have come.
            F.when(F.count_if(F.col("bits").isNull()) == 0, F.bitmap_or_agg(F.coalesce("bits", F.unhex(F.lit("00"))))).alias("bits"),
            F.max("last").alias("last"),
        )
        newest = F.broadcast(buckets.agg(F.max("last").alias("newest")))
        old = F.col("last") < F.col("newest") - F.expr(f"interval {self.keep}")
        aged = stored(buckets.crossJoin(newest).withColumn("_old", F.coalesce(old, F.lit(False))))
        # A bucket is settled together with all before it, so only if those are old too.
        live = aged.where("not _old and bits is not null").groupBy("source_partition").agg(F.min("_bucket").alias("_least"))
        sides = aged.join(F.broadcast(live), "source_partition", "left")
        gone = F.col("bits").isNull() | (F.col("_old") & (F.col("_least").isNull() | (F.col("_bucket") < F.col("_least"))))
        judged = sides.withColumn("_gone", gone)
        upto = judged.where("_gone").groupBy("source_partition").agg(F.max("_bucket").alias("_bucket"), F.max("last").alias("last"))
        kept = judged.where("not _gone").select(*_KEYS, "bits", "last")
        none = F.lit(None).cast("binary").alias("bits")
        self.table.replace(
            batch_id, kept.unionByName(upto.select("source_partition", "_bucket", none, "last"))
        )
