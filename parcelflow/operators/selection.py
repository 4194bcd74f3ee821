"""The rows at given positions of a time order, found without sorting the table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from parcelflow.operators.prefix import global_rank

_ALL_TIME = datetime(1, 1, 1)


@dataclass(frozen=True)
class _Search:
    """The row ``position`` is the ``rank``-th of the ``rows`` in the interval ``start``."""

    position: int
    start: datetime
    rank: int
    rows: int = 0


def rows_at_positions(
    df: DataFrame, timestamp: str, tie_breaker: str, positions: Sequence[int]
) -> dict[int, Row]:
    """Rows (timestamp, tie_breaker) at 0-based ``positions`` of the ascending order.

    Narrows from all time to days, to seconds, to rows. The histograms have at most
    one row per calendar day and 86,400 rows per chosen day, and only chosen rows
    reach the driver; the table itself is scanned, never shuffled.
    """
    if not positions:
        return {}
    keys = df.select(timestamp, tie_breaker)
    when = F.col(timestamp)
    day = F.to_date(when).cast("timestamp_ntz")
    second = day + F.make_dt_interval(F.lit(0), F.hour(when), F.minute(when), F.second(when))

    searches = [_Search(p, _ALL_TIME, p) for p in sorted(set(positions))]
    searches = _narrow(keys, _instant(_ALL_TIME), day, searches)
    in_days = _within(keys, when, {s.start for s in searches}, timedelta(days=1))
    searches = _narrow(in_days, day, second, searches)

    found: dict[int, Row] = {}
    for start in sorted({s.start for s in searches}):
        here = [s for s in searches if s.start == start]
        rows = _within(keys, when, {start}, timedelta(seconds=1))
        ranked = global_rank(rows, [timestamp, tie_breaker])
        picked = ranked.where(F.col("position").isin([s.rank for s in here])).collect()
        by_rank = {row["position"]: row for row in picked}
        found.update({s.position: by_rank[s.rank] for s in here})
    return found


def _instant(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _within(
    df: DataFrame, when: Column, starts: Iterable[datetime], width: timedelta
) -> DataFrame:
    """Rows inside any of the intervals, as range filters that reach the scan."""
    inside = [(when >= _instant(s)) & (when < _instant(s + width)) for s in sorted(starts)]
    return df.where(reduce(lambda a, b: a | b, inside))


def _narrow(
    df: DataFrame, interval: Column, bucket: Column, searches: list[_Search]
) -> list[_Search]:
    """Move every search from its interval into the bucket that holds its rank."""
    counted = df.groupBy(interval.alias("start"), bucket.alias("bucket")).agg(
        F.count("*").alias("n")
    )
    earlier = W.partitionBy("start").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    running = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    hits = [
        (F.col("start") == _instant(s.start))
        & (F.col("before") <= s.rank)
        & (F.col("before") + F.col("n") > s.rank)
        for s in searches
    ]
    rows = running.where(reduce(lambda a, b: a | b, hits)).collect()
    return [
        _Search(s.position, r["bucket"], s.rank - r["before"], r["n"])
        for s in searches
        for r in rows
        if r["start"] == s.start and r["before"] <= s.rank < r["before"] + r["n"]
    ]
