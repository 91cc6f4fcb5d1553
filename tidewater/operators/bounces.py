"""Bounces: visits that entered on one page and went no further."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewater.contract import ARRIVAL, BOUNCE_WITHIN_MS
from tidewater.operators.scale import HOT_ROWS, stored, with_neighbour, with_texts


def with_next_page(
    pages: DataFrame, arrival: Sequence[str] = ARRIVAL, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """``mid, ts, is_entry`` and arrival of pages, and of the same visitor's next page in event
    time: ``next_ts, next_is_entry``. Nothing else is shuffled and sorted."""
    return with_neighbour(
        pages.select("mid", "ts", "is_entry", *arrival),
        "mid",
        ("ts", *arrival),
        {"next_ts": "ts", "next_is_entry": "is_entry"},
        1,
        hot_rows,
    )


def bounce_kind(within_ms: int = BOUNCE_WITHIN_MS):
    """"match" or "timeout" for an entry page that is a bounce, otherwise NULL.

    The visitor came in again within the window (match), or did nothing more
    inside it (timeout). A second page inside the window means no bounce.
    """
    after_window = F.col("next_ts").isNull() | (F.col("next_ts") - F.col("ts") >= within_ms)
    return (
        F.when(~F.col("is_entry"), None)
        .when(after_window, "timeout")
        .when(F.col("next_is_entry"), "match")
    )


def bounces(
    pages: DataFrame,
    within_ms: int = BOUNCE_WITHIN_MS,
    arrival: Sequence[str] = ARRIVAL,
    hot_rows: int | None = HOT_ROWS,
    lines: DataFrame | None = None,
) -> DataFrame:
    """The bounced entry pages with their ``kind``, matches and timeouts in one pass.

    ``mid, ts, value, kind`` and arrival. The text is fetched last: from the pages, or from
    ``lines``, what these were read from, so that they are not parsed again. Then no two lines
    may have the same arrival; otherwise no two pages of one visitor and time.
    """
    found = (
        with_next_page(pages, arrival, hot_rows)
        .withColumn("kind", bounce_kind(within_ms))
        .where(F.col("kind").isNotNull())
        .drop("next_ts", "next_is_entry", "is_entry")
    )
    if lines is None:
        return with_texts(stored(found), pages, ("mid", "ts", *arrival))
    return with_texts(stored(found), lines, arrival)


def matched(found: DataFrame) -> DataFrame:
    return found.where("kind = 'match'").drop("kind")


def timed_out(found: DataFrame) -> DataFrame:
    return found.where("kind = 'timeout'").drop("kind")
