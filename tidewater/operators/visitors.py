"""New-visitor flag repair and daily unique visitors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.contract import ARRIVAL
from tidewater.functions.json_rows import member, object_of, other_members
from tidewater.functions.times import to_day, to_previous_day
from tidewater.operators.logs import clean_logs, is_clean, parse_visits
from tidewater.operators.scale import (
    BROADCAST_ROWS,
    HOT_ROWS,
    arrival_key,
    is_small,
    lookup_side,
    order_key,
    stored,
    with_neighbour,
    with_texts,
)


def visit_anchors(parsed: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """One row per visitor: ``mid, anchor, first_new_day, last_new_day, lines``.

    The anchor is the day of the visitor's first-arrived line, or the day before
    if that line says the visitor is not new. The next two bound the days on which
    lines call the visitor new; ``lines`` is how many there are. Aggregated before the shuffle, so a visitor
    with very many lines costs no more than one row per task.
    """
    new = F.col("is_new").eqNullSafe("1")
    day = F.when(new, F.col("_day"))
    return (
        clean_logs(parsed)
        .select("mid", "is_new", "ts", *arrival, to_day("ts").alias("_day"))
        .groupBy("mid")
        .agg(
            F.min_by(F.coalesce(day, to_previous_day("ts")), arrival_key(arrival)).alias("anchor"),
            F.min(day).alias("first_new_day"),
            F.max(day).alias("last_new_day"),
            F.count("*").alias("lines"),
        )
    )


def wrong_flags(anchors: DataFrame) -> DataFrame:
    """``mid, anchor, lines`` of the visitors with at least one flag to repair."""
    return anchors.where(
        (F.col("first_new_day") != F.col("anchor")) | (F.col("last_new_day") != F.col("anchor"))
    ).select("mid", "anchor", "lines")


def apply_anchors(
    parsed: DataFrame,
    wrong: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Set ``is_new`` to "0", also inside ``common``, on lines of another day than the anchor.

    Adds ``repaired``. With few visitors to repair, no line is shuffled. Beyond
    that only the lines that call the visitor new are: the others, dirty ones
    among them, cannot change and go round the join. Visitors with more than
    ``hot_rows`` lines are still broadcast (there are at most total / hot_rows of
    them), and their lines are shuffled by their text, not to one task.
    """
    new = F.coalesce((F.col("is_new") == "1") & is_clean(), F.lit(False))
    anchors = wrong.select("mid", "anchor")
    if is_small(wrong, max_rows):
        return _repaired(parsed.join(F.broadcast(anchors), "mid", "left"), new, parsed.columns)
    hot, cold = wrong.where(F.col("lines") > hot_rows), wrong.where(F.col("lines") <= hot_rows)
    found = parsed.where(new).join(
        lookup_side(hot.select("mid", F.col("anchor").alias("_hot"))), "mid", "left"
    )
    spread = F.concat(F.lit("\0"), F.xxhash64("value").cast("string"))
    joined = (
        found.withColumn("_key", F.when(F.col("_hot").isNull(), F.col("mid")).otherwise(spread))
        .join(cold.select(F.col("mid").alias("_key"), "anchor"), "_key", "left")
        .withColumn("anchor", F.coalesce("_hot", "anchor"))
    )
    settled = parsed.where(~new).withColumn("repaired", F.lit(False))
    return _repaired(joined, new, parsed.columns).unionByName(settled)


def _repaired(joined: DataFrame, new: Column, columns: Sequence[str]) -> DataFrame:
    repair = new & F.col("anchor").isNotNull() & (to_day("ts") != F.col("anchor"))
    common = object_of(
        other_members(F.col("common"), F.array(F.lit("is_new"))), member("is_new", F.lit('"0"'))
    )
    flagged = joined.withColumn("repaired", F.coalesce(repair, F.lit(False)))
    return flagged.withColumns(
        {
            "is_new": F.when(F.col("repaired"), "0").otherwise(F.col("is_new")),
            "common": F.when(F.col("repaired"), common).otherwise(F.col("common")),
        }
    ).select(*columns, "repaired")


def repair_new_flag(
    parsed: DataFrame,
    arrival: Sequence[str] = ARRIVAL,
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Parsed lines with the new-visitor flag corrected; see the functions above.

    With ``lines``, the text the lines were parsed from, the pass that looks for anchors
    reads three fields of it and not all of the parsed ones.
    """
    visits = parsed if lines is None else parse_visits(lines)
    wrong = stored(wrong_flags(visit_anchors(visits, arrival)))
    return apply_anchors(parsed, wrong, max_rows, hot_rows)


def first_entries(
    entries: DataFrame,
    arrival: Sequence[str] = ARRIVAL,
    last_visit: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``mid, dt`` and arrival of the entry pages on another day than the visitor's entry page
    that arrived before. Nothing else is shuffled and sorted.

    ``last_visit`` (``mid, last_day``) tells the day before the first of ``entries``.
    """
    narrow = entries.select("mid", "dt", *arrival)
    seen = with_neighbour(narrow, "mid", arrival, {"_previous": "dt"}, -1, hot_rows)
    if last_visit is not None:
        # A visitor may have very many entries but only the first one needs the join.
        first = F.col("_previous").isNull()
        spread = F.concat(F.lit("\0"), F.xxhash64(*arrival).cast("string"))
        seen = (
            seen.withColumn("_key", F.when(first, F.col("mid")).otherwise(spread))
            .join(
                lookup_side(last_visit.select(F.col("mid").alias("_key"), "last_day")),
                "_key",
                "left",
            )
            .withColumn("_previous", F.coalesce("_previous", F.when(first, F.col("last_day"))))
        )
    changed = F.col("_previous").isNull() | (F.col("_previous") != F.col("dt"))
    return seen.where(changed).select("mid", "dt", *arrival)


def unique_visitors(
    entries: DataFrame,
    arrival: Sequence[str] = ARRIVAL,
    last_visit: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
    lines: DataFrame | None = None,
) -> DataFrame:
    """The entries of ``first_entries`` with their text: ``mid, dt, value`` and arrival.

    The text is fetched last: from the entries, or from ``lines``, what these were read from,
    so that they are not parsed again. Then no two lines may have the same arrival;
    otherwise no two entries of one visitor.
    """
    found = stored(first_entries(entries, arrival, last_visit, hot_rows))
    if lines is None:
        return with_texts(found, entries, ("mid", *arrival))
    return with_texts(found, lines, arrival)


def unique_visitors_per_day(
    entries: DataFrame, arrival: Sequence[str] = ARRIVAL
) -> DataFrame:
    """The first-arrived entry page of each visitor and day: ``mid, dt, value``.

    Differs from ``unique_visitors`` when days interleave in the arrival order.
    """
    return entries.groupBy("mid", "dt").agg(F.min_by("value", order_key(arrival)).alias("value"))
