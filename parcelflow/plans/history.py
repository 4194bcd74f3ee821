"""Point-in-time history: what was known about earlier orders when one was approved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import late_delivery_label
from parcelflow.operators.prefix import running_totals


def _known_before(
    decisions: DataFrame,
    facts: DataFrame,
    key: str,
    measures: dict[str, Column],
) -> DataFrame:
    """Sums of ``measures`` over the facts of the same key strictly before each decision.

    ``decisions`` has order_id, ``key`` and ``at``; ``facts`` has ``key``, ``at`` and
    the measure inputs. At the same instant a decision comes first, so a fact never
    counts for a decision made at its own time. A state or customer with a large
    share of all orders is spread over many sorted slices.
    """
    asked = decisions.select(
        key, "at", F.lit(0).alias("kind"), "order_id", *[F.lit(0).alias(m) for m in measures]
    )
    known = facts.select(
        key,
        "at",
        F.lit(1).alias("kind"),
        "order_id",
        *[expr.cast("int").alias(m) for m, expr in measures.items()],
    )
    timeline = running_totals(
        asked.unionByName(known), ["at", "kind", "order_id"], list(measures), keys=[key]
    )
    return timeline.where(F.col("kind") == 0).select(
        "order_id", key, F.col("at").alias("order_approved_at"), *[f"{m}_before" for m in measures]
    )


def _decisions(orders_with_key: DataFrame, key: str) -> DataFrame:
    approved = orders_with_key.where(F.col("order_approved_at").isNotNull())
    return approved.select("order_id", key, F.col("order_approved_at").alias("at"))


def delivery_history(orders: DataFrame, customers: DataFrame, key: str) -> DataFrame:
    """Earlier orders of the same customer attribute whose delivery was already known."""
    keyed = orders.join(customers.select("customer_id", key), "customer_id")
    outcomes = keyed.select(
        "order_id",
        key,
        F.col("order_delivered_customer_date").alias("at"),
        late_delivery_label().alias("late"),
    ).where(F.col("late").isNotNull())
    return _known_before(
        _decisions(keyed, key),
        outcomes,
        key,
        {"known_deliveries": F.lit(1), "known_late_deliveries": F.col("late")},
    )


def review_history(
    orders: DataFrame, customers: DataFrame, order_reviews: DataFrame, key: str
) -> DataFrame:
    """Reviews of the same customer attribute that were written before the approval."""
    keyed = orders.join(customers.select("customer_id", key), "customer_id")
    written = order_reviews.select(
        "order_id", F.col("review_creation_date").alias("at"), "review_score"
    ).join(keyed.select("order_id", key), "order_id")
    return _known_before(
        _decisions(keyed, key),
        written,
        key,
        {"known_reviews": F.lit(1), "known_score_sum": F.col("review_score")},
    )
