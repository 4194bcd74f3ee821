"""Durations of the steps of an order, from timestamps that do not contradict the step before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import days_between, hours_between


def consistent_after(later: Column, earlier: Column) -> Column:
    """``later``, or null where it is before ``earlier``; an unknown ``earlier`` contradicts nothing."""
    return F.when(~F.coalesce(later < earlier, F.lit(False)), later)


def step_durations(orders: DataFrame) -> DataFrame:
    """One row per order: hours or days of each step, null where an end is missing or inconsistent.

    A timestamp before that of the step it follows (the timeline checks), or before the purchase, is
    inconsistent and feeds no duration, neither that of its own step nor that of the next one. The
    order itself stays, and no duration is negative.
    """
    purchase = F.col("order_purchase_timestamp")
    raw_approved, raw_carrier = F.col("order_approved_at"), F.col("order_delivered_carrier_date")
    approved = consistent_after(raw_approved, purchase)
    carrier = consistent_after(raw_carrier, F.greatest(purchase, raw_approved))
    delivered = consistent_after(
        F.col("order_delivered_customer_date"), F.greatest(purchase, raw_carrier)
    )
    estimated = consistent_after(F.col("order_estimated_delivery_date"), purchase)
    return orders.select(
        "order_id",
        hours_between(approved, purchase).alias("approval_hours"),
        hours_between(carrier, approved).alias("handling_hours"),
        hours_between(delivered, carrier).alias("transit_hours"),
        days_between(delivered, purchase).alias("delivery_days"),
        days_between(estimated, purchase).alias("promised_days"),
    )
