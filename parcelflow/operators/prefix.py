"""Exact global positions and running totals without a one-task window.

``orderBy`` range-partitions by sampled bounds of the whole sort key, so a hot key
or a hot timestamp is spread over many slices as long as the rows differ in any
sort column. The sorted rows are written once to the shared checkpoint folder with
the id Spark gives them (slice number above 33 bits, row number in the slice
below), so every later read sees the same slices even after an executor is lost.
What remains are totals of whole slices: one row per slice, or per slice and key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from parcelflow.session import materialize

_SEQ = "_sequence"
_SLICE = "_slice"
# Layout of monotonically_increasing_id: the low 33 bits count rows in a partition.
_ROW_BITS = 33


def _sorted_slices(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    ordered = df.orderBy(*order).withColumn(_SEQ, F.monotonically_increasing_id())
    return materialize(ordered).withColumn(_SLICE, F.shiftright(_SEQ, _ROW_BITS))


def global_rank(
    df: DataFrame, order: Sequence[str | Column], name: str = "position"
) -> DataFrame:
    """Add the 0-based position of each row in the total order ``order``."""
    rows = _sorted_slices(df, order)
    sizes = rows.groupBy(_SLICE).agg(F.count("*").alias("_rows"))
    earlier = W.orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        _SLICE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    # One offset per sorted slice: bounded by the number of shuffle partitions.
    placed = rows.join(F.broadcast(offsets), _SLICE)
    row_in_slice = F.col(_SEQ).bitwiseAND((1 << _ROW_BITS) - 1)
    return placed.select(*df.columns, (F.col("_offset") + row_in_slice).alias(name))


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    values: Sequence[str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add ``<value>_before``: the sum of ``value`` over the rows of the same key that
    come earlier in ``order``; zero for the first row of a key."""
    rows = _sorted_slices(df, [*keys, *order])
    totals = rows.groupBy(_SLICE, *keys).agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    by_key = W.partitionBy(*keys).orderBy(_SLICE)
    earlier_slices = by_key.rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(
        F.col(_SLICE).alias("_into"),
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.lag(_SLICE).over(by_key).alias("_continues"),
        *[
            F.coalesce(F.sum(f"_sum_{v}").over(earlier_slices), F.lit(0)).alias(f"_carry_{v}")
            for v in values
        ],
    ).where(F.col("_continues").isNotNull())
    match = F.col(_SLICE) == F.col("_into")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    # The rows are sorted by key, so at most one key continues into each slice and
    # ``carried`` never holds more rows than there are slices.
    joined = rows.join(F.broadcast(carried), match, "left")
    earlier_rows = (
        W.partitionBy(_SLICE, *keys).orderBy(_SEQ).rowsBetween(W.unboundedPreceding, -1)
    )
    return joined.select(
        *df.columns,
        *[
            (
                F.coalesce(F.sum(v).over(earlier_rows), F.lit(0))
                + F.coalesce(F.col(f"_carry_{v}"), F.lit(0))
            ).alias(f"{v}_before")
            for v in values
        ],
    )
