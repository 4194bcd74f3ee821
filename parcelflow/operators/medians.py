"""Exact medians per key, by two plans for two sizes of group.

A group of at most ``MOST_ROWS`` rows fits an aggregation buffer: one shuffle, Spark's exact
percentile. Larger groups are counted first; their values, as order-preserving 64-bit keys, are
counted before a shuffle, and the middle ranks of all groups and columns are narrowed down at
once, sixteen bits a pass. No pass sorts rows, none holds the rows of a group in one task, and a
pass keeps at most 65,536 counts for each rank that is looked for.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from parcelflow.operators.hot_keys import hot_keys, split_by_keys
from parcelflow.session import materialize

_DIGIT = 16


def _ordered_bits(value):
    """Doubles as 64 bits that, read without a sign, are in the order of the values."""

    @F.pandas_udf("long")
    def bits(values: pd.Series) -> pd.Series:
        raw = (values.to_numpy() + 0.0).view(np.int64)
        return pd.Series(np.where(raw < 0, ~raw, raw ^ np.int64(-(2**63))))

    return bits(value)


def _small_groups(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.median(F.col(v).cast("double")).alias(v) for v in values])


def _large_groups(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    pairs = [
        F.struct(F.lit(v).alias("_column"), F.col(v).cast("double").alias("_value")) for v in values
    ]
    rows = df.select(F.col(key).alias("_key"), F.inline(F.array(*pairs)))
    counts = materialize(
        rows.where("_value IS NOT NULL")
        .groupBy("_key", "_column", "_value")
        .agg(F.count("*").alias("n"))
        .withColumn("_bits", _ordered_bits(F.col("_value")))
    )
    totals = counts.groupBy("_key", "_column").agg(F.sum("n").alias("size"))
    # Ranks of the lower and the upper middle, from 0; the same for an odd size.
    middle = F.array_distinct(F.array(F.expr("(size - 1) div 2"), F.expr("size div 2")))
    wanted = totals.select("_key", "_column", F.explode(middle).alias("rank")).withColumn(
        "prefix", F.lit(0).cast("long")
    )
    for shift in range(64 - _DIGIT, -1, -_DIGIT):
        prefix = F.shiftrightunsigned("_bits", shift + _DIGIT) if shift + _DIGIT < 64 else F.lit(0)
        digit = F.shiftrightunsigned("_bits", shift).bitwiseAND((1 << _DIGIT) - 1)
        parts = counts.select(
            "_key", "_column", "_value", "n", prefix.cast("long").alias("prefix"), digit.alias("digit")
        )
        here = W.partitionBy("_key", "_column", "prefix").orderBy("digit")
        here = here.rowsBetween(W.unboundedPreceding, -1)
        # The first pass looks at all values, the later ones below the prefixes found so far.
        looked = parts if shift + _DIGIT == 64 else _inside(parts, wanted)
        found = (
            looked.groupBy("_key", "_column", "prefix", "digit")
            .agg(F.sum("n").alias("n"), F.max("_value").alias("_value"))
            .withColumn("before", F.coalesce(F.sum("n").over(here), F.lit(0)))
        )
        wanted = materialize(_narrowed(wanted, found))
    return (
        wanted.groupBy("_key")
        .pivot("_column", list(values))
        .agg(F.sum("_value") / F.count("_value"))
        .withColumnRenamed("_key", key)
    )


def _on(left: str, right: str):
    same = F.col(f"{left}._key").eqNullSafe(F.col(f"{right}._key"))
    return (
        same
        & (F.col(f"{left}._column") == F.col(f"{right}._column"))
        & (F.col(f"{left}.prefix") == F.col(f"{right}.prefix"))
    )


def _inside(parts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Values below a prefix that is still looked into."""
    open_ = wanted.select("_key", "_column", "prefix").distinct().alias("w")
    return parts.alias("p").join(open_, _on("p", "w"), "left_semi")


def _narrowed(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """Every rank with the digit that holds it, counted from the digit's first value."""
    holds = (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n"))
    joined = wanted.alias("w").join(found.alias("f"), _on("w", "f")).where(holds)
    return joined.select(
        F.col("w._key").alias("_key"),
        F.col("w._column").alias("_column"),
        (F.col("rank") - F.col("before")).alias("rank"),
        F.shiftleft("w.prefix", _DIGIT).bitwiseOR(F.col("digit")).alias("prefix"),
        F.col("f._value").alias("_value"),
    )


def exact_group_medians(
    df: DataFrame, key: str, values: Sequence[str], most: int | None = None
) -> DataFrame:
    """One row per key with the median of each column in ``values`` as a double.

    Nulls are ignored (a group of nulls has a null median), an even count gives the mean of
    the two middle values, infinities are values and NaN is the largest. Groups of more than
    ``most`` rows go the second way.
    """
    hot = hot_keys(df, [key], most)
    if hot is None:
        return _small_groups(df, key, values)
    small, large = split_by_keys(df, hot, [key])
    every = large.select(key).distinct().alias("k")
    medians = _large_groups(large, key, values).alias("m")
    # A hot group of nulls has no counted value and keeps its row.
    filled = every.join(
        medians, F.col(f"k.{key}").eqNullSafe(F.col(f"m.{key}")), "left"
    ).select(F.col(f"k.{key}").alias(key), *[F.col(f"m.{v}").alias(v) for v in values])
    return _small_groups(small, key, values).unionByName(filled)
