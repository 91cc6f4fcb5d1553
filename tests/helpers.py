"""Rows for the tests, and row-at-a-time rules the relational forms must agree with."""

import json
import random
from datetime import date, datetime, timedelta, timezone

LINE = "value string, timestamp timestamp, partition int, offset bigint"
START_MS = 1_700_000_000_000


def day_of(ms):
    return datetime.fromtimestamp(ms / 1000, timezone.utc).date()


def line(mid="m", ts=START_MS, is_new="1", last=None, page="home", **more):
    """A log line as text."""
    body = {"common": {"mid": mid, "is_new": is_new}, "ts": ts}
    if page is not None:
        body["page"] = {"page_id": page, "last_page_id": last}
    return json.dumps({**body, **more})


def frame(spark, values, slices=4):
    """Lines in the order given, as records of a topic with two partitions."""
    rows = [
        (value, datetime(2024, 1, 1) + timedelta(seconds=i // 3), i // 2 % 2, i)
        for i, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, LINE).repartition(slices)


def arrival_order(rows):
    return sorted(rows, key=lambda row: (row["timestamp"], row["partition"], row["offset"]))


def random_visits(count, seed, mids=6, spread_ms=3 * 86_400_000, hot=0.4):
    """Visits with disordered times; one visitor has much of all rows."""
    rng = random.Random(seed)
    return [
        {
            "id": i,
            "mid": "hot" if rng.random() < hot else f"m{rng.randrange(mids)}",
            "ts": START_MS + rng.randrange(spread_ms),
            "is_new": rng.choice(["1", "1", "0", None]),
            "last": rng.choice([None, None, "home"]),
        }
        for i in range(count)
    ]


def as_lines(visits):
    return [
        line(v["mid"], v["ts"], v["is_new"], v["last"], id=v["id"]) for v in visits
    ]


def repaired_flags(visits):
    """``id -> is_new`` by a state per visitor, in arrival order."""
    first, flags = {}, {}
    for visit in visits:
        day = day_of(visit["ts"])
        flag = visit["is_new"]
        known = first.get(visit["mid"])
        if flag == "1" and known not in (None, day):
            flag = "0"
        if known is None:
            first[visit["mid"]] = day if visit["is_new"] == "1" else day - timedelta(days=1)
        flags[visit["id"]] = flag
    return flags


def counted_visits(visits):
    """Ids of the unique visits, by a state per visitor, in arrival order."""
    last, ids = {}, []
    for visit in visits:
        if visit["last"] is None and last.get(visit["mid"]) != day_of(visit["ts"]):
            last[visit["mid"]] = day_of(visit["ts"])
            ids.append(visit["id"])
    return sorted(ids)


def bounced_visits(visits, within_ms):
    """``(id, kind)`` of the bounces: each visitor's pages in event time, two at a time."""
    by_mid = {}
    for visit in visits:
        by_mid.setdefault(visit["mid"], []).append(visit)
    found = []
    for pages in by_mid.values():
        pages.sort(key=lambda v: v["ts"])  # stable: ties stay in arrival order
        for page, following in zip(pages, pages[1:] + [None]):
            if page["last"] is not None:
                continue
            if following is None or following["ts"] - page["ts"] >= within_ms:
                found.append((page["id"], "timeout"))
            elif following["last"] is None:
                found.append((page["id"], "match"))
    return sorted(found)


def ids(rows):
    return sorted(json.loads(row["value"])["id"] for row in rows)
