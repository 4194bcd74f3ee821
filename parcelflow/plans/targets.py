"""Labels per order and the model datasets built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import late_delivery_label, non_delivery_label
from parcelflow.schemas import (
    CATEGORICAL_INPUTS,
    FEATURE_COLUMNS,
    NUMERIC_INPUTS,
    TASK_LABELS,
)


def order_labels(orders: DataFrame) -> DataFrame:
    """Both nullable labels of every approved order, straight from the orders."""
    return orders.where(F.col("order_approved_at").isNotNull()).select(
        "order_id",
        non_delivery_label().alias("non_delivery_label"),
        late_delivery_label().alias("late_delivery_label"),
    )


def order_targets(features: DataFrame, orders: DataFrame) -> DataFrame:
    """Both nullable labels of every order that has a feature row."""
    return features.select("order_id").join(order_labels(orders), "order_id")


def labelled_orders(orders: DataFrame, task: str) -> DataFrame:
    """(order_id, order_approved_at, target) of the orders a task can learn from: all
    that a split needs, without building the features."""
    target = {"non_delivery": non_delivery_label(), "late_delivery": late_delivery_label()}[task]
    return (
        orders.where(F.col("order_approved_at").isNotNull())
        .select("order_id", "order_approved_at", target.alias("target"))
        .where(F.col("target").isNotNull())
    )


def model_dataset(features: DataFrame, targets: DataFrame, task: str) -> DataFrame:
    """Feature rows of one task whose label is known, with the label as ``target``."""
    label = TASK_LABELS[task]
    known = targets.where(F.col(label).isNotNull()).select(
        "order_id", F.col(label).alias("target")
    )
    return features.join(known, "order_id").select(*FEATURE_COLUMNS, "target")


def in_time_order(dataset: DataFrame) -> DataFrame:
    """Ascending by approval time, then order id."""
    return dataset.orderBy(
        F.col("order_approved_at").asc_nulls_last(), F.col("order_id").asc_nulls_last()
    )


def model_inputs(dataset: DataFrame, keep: tuple[str, ...] = ("order_id",)) -> DataFrame:
    """The 32 model inputs: two categories as text, thirty numbers as doubles.

    Identifiers, raw timestamps and the target are dropped; ``keep`` names columns
    that callers still need next to the inputs.
    """
    return dataset.select(
        *keep,
        *CATEGORICAL_INPUTS,
        *[F.col(c).cast("double").alias(c) for c in NUMERIC_INPUTS],
    )
