"""Diagnostic reports over the staging tables; each scans its table once."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import observed_late_flag, outcome_group
from parcelflow.operators.quality import one_pass_counts


def order_status_profile(orders: DataFrame) -> DataFrame:
    """Orders per status, how many were approved and how many delivered."""
    return (
        orders.groupBy("order_status")
        .agg(
            F.count("*").alias("order_count_by_status"),
            F.count("order_approved_at").alias("approved_order_count"),
            F.count("order_delivered_customer_date").alias("delivered_order_count"),
        )
        .orderBy(F.desc("order_count_by_status"))
    )


def outcome_profile(orders: DataFrame) -> DataFrame:
    """Orders per outcome class."""
    return (
        orders.groupBy(outcome_group().alias("outcome_group"))
        .agg(F.count("*").alias("order_count"))
        .orderBy("outcome_group")
    )


def late_target_profile(orders: DataFrame) -> DataFrame:
    """Balance of the late flag over approved, delivered orders with both dates."""
    population = (
        F.col("order_approved_at").isNotNull()
        & (F.col("order_status") == "delivered")
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )
    return (
        orders.where(population)
        .groupBy(observed_late_flag().alias("late_delivery_label"))
        .agg(F.count("*").alias("order_count"))
        .orderBy("late_delivery_label")
    )


def timeline_profile(orders: DataFrame) -> DataFrame:
    """Orders whose timestamps contradict each other."""
    purchase, approved, carrier, delivered, estimated = (
        F.col(c)
        for c in (
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        )
    )
    return one_pass_counts(
        orders,
        {
            "approval_before_purchase": approved < purchase,
            "carrier_before_approval": carrier < approved,
            "customer_delivery_before_carrier": delivered < carrier,
            "estimated_delivery_before_purchase": estimated < purchase,
            "delivered_status_without_delivery_date": (F.col("order_status") == "delivered")
            & delivered.isNull(),
        },
    )


def fan_out(df: DataFrame, source_table: str, key: str = "order_id") -> DataFrame:
    """How many keys a child table covers and how many rows a key has at most."""
    per_key = df.groupBy(key).agg(F.count("*").alias("records"))
    return per_key.agg(
        F.count("*").alias("represented_orders"),
        F.count_if(F.col("records") > 1).alias("orders_with_multiple_records"),
        F.max("records").alias("maximum_records_per_order"),
    ).select(
        F.lit(source_table).alias("source_table"),
        "represented_orders",
        "orders_with_multiple_records",
        "maximum_records_per_order",
    )


def fan_out_profile(children: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [fan_out(df, name) for name, df in children.items()]
    )


def numeric_range_profile(
    order_items: DataFrame, order_payments: DataFrame, order_reviews: DataFrame
) -> DataFrame:
    """Values outside their allowed range."""
    return (
        one_pass_counts(
            order_items,
            {
                "negative_item_price": F.col("price") < 0,
                "negative_freight_value": F.col("freight_value") < 0,
            },
        )
        .unionByName(
            one_pass_counts(
                order_payments,
                {
                    "negative_payment_value": F.col("payment_value") < 0,
                    "negative_payment_installments": F.col("payment_installments") < 0,
                },
            )
        )
        .unionByName(
            one_pass_counts(
                order_reviews,
                {"invalid_review_score": ~F.col("review_score").between(1, 5)},
            )
        )
    )


def zip_ambiguity_profile(geolocation: DataFrame) -> DataFrame:
    """Zip prefixes with several records, cities or states.

    Rows collapse to distinct places first, so neither a hot zip nor the
    distinct-count expansion meets the full table.
    """
    places = geolocation.groupBy(
        "geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"
    ).agg(F.count("*").alias("records"))
    per_zip = places.groupBy("geolocation_zip_code_prefix").agg(
        F.sum("records").alias("location_count"),
        F.countDistinct("geolocation_city").alias("city_count"),
        F.countDistinct("geolocation_state").alias("state_count"),
    )
    return per_zip.agg(
        F.count("*").alias("unique_zip_code_prefixes"),
        F.count_if(F.col("location_count") > 1).alias("zip_code_prefixes_with_multiple_records"),
        F.count_if(F.col("city_count") > 1).alias("zip_code_prefixes_with_multiple_cities"),
        F.count_if(F.col("state_count") > 1).alias("zip_code_prefixes_with_multiple_states"),
        F.max("location_count").alias("maximum_locations_per_zip"),
    )
