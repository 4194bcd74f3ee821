"""Groups too large for one buffer, found before an aggregation is chosen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.session import materialize

#: Rows of a group that an aggregation buffer may hold.
MOST_ROWS = 100_000


def hot_keys(df: DataFrame, keys: Sequence[str], most: int | None = None) -> DataFrame | None:
    """The keys (null is one) with more than ``most`` rows, or None where there are none.

    Counts are combined before the shuffle and only the keys are read. At most one key for each
    ``most`` rows of the table is found.
    """
    most = MOST_ROWS if most is None else most
    hot = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*keys)
    return None if hot.isEmpty() else materialize(hot)


def split_by_keys(
    df: DataFrame, hot: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows outside the hot groups, and rows of the hot groups."""
    renamed = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    )
    return df.join(renamed, match, "left_anti"), df.join(renamed, match, "left_semi")
