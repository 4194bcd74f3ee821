"""One feature row per approved order, from child tables aggregated before the joins."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import (
    day_of_week,
    days_between,
    great_circle_km,
    hours_between,
    kilometres,
)
from parcelflow.operators.hot_keys import hot_keys, split_by_keys
from parcelflow.operators.medians import exact_group_medians
from parcelflow.schemas import FEATURE_COLUMNS, MONEY

PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """Median latitude and longitude per zip prefix, taken independently.

    Adaptive execution decides whether the result is small enough to broadcast.
    """
    zips = geolocation.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").cast("double").alias("latitude"),
        F.col("geolocation_lng").cast("double").alias("longitude"),
    )
    return exact_group_medians(zips, "zip_code_prefix", ["latitude", "longitude"])


def _located(df: DataFrame, zip_column: str, centroids: DataFrame, prefix: str) -> DataFrame:
    place = centroids.select(
        F.col("zip_code_prefix").alias(zip_column),
        F.col("latitude").alias(f"{prefix}_latitude"),
        F.col("longitude").alias(f"{prefix}_longitude"),
    )
    return df.join(place, zip_column, "left")


def located_orders(orders: DataFrame, customers: DataFrame, centroids: DataFrame) -> DataFrame:
    """Orders with their customer's identity, state and zip centroid."""
    people = customers.select(
        "customer_id", "customer_unique_id", "customer_state", "customer_zip_code_prefix"
    )
    located = _located(people, "customer_zip_code_prefix", centroids, "customer")
    return orders.join(located, "customer_id")


def item_details(
    order_items: DataFrame,
    located: DataFrame,
    sellers: DataFrame,
    products: DataFrame,
    centroids: DataFrame,
) -> DataFrame:
    """Items with product, seller and customer attributes and the seller distance.

    ``located`` comes from ``located_orders`` and has one row per order.
    """
    seller = _located(
        sellers.select("seller_id", "seller_state", "seller_zip_code_prefix"),
        "seller_zip_code_prefix",
        centroids,
        "seller",
    ).drop("seller_zip_code_prefix")
    product = products.select("product_id", "product_category_name", "product_weight_g")
    customer = located.select(
        "order_id", "customer_state", "customer_latitude", "customer_longitude"
    )
    described = (
        order_items.drop("shipping_limit_date")
        .join(seller, "seller_id")
        .join(product, "product_id")
    )
    return described.join(customer, "order_id").select(
        "order_id",
        "order_item_id",
        "product_id",
        "product_category_name",
        "seller_id",
        "seller_state",
        "customer_state",
        "price",
        "freight_value",
        "product_weight_g",
        great_circle_km(
            F.col("customer_latitude"),
            F.col("customer_longitude"),
            F.col("seller_latitude"),
            F.col("seller_longitude"),
        ).alias("seller_distance_km"),
    )


def _cents(column: str) -> Column:
    # A two-decimal amount as a whole number: sums stay exact and in machine words.
    return (F.col(column) * 100).cast("bigint")


def _total(column: str) -> Column:
    return (F.sum(_cents(column)) * F.lit(Decimal("0.01"))).cast(MONEY)


def _average(column: str) -> Column:
    # avg() of a decimal rounds to six places first; this quotient rounds once.
    mean = F.sum(_cents(column)).cast("decimal(20,0)") / F.count(column)
    return (F.round(mean, 0) * F.lit(Decimal("0.01"))).cast(MONEY)


def _in_buffer(column: str) -> Column:
    """Number of different values of a group that fits an aggregation buffer."""
    return F.size(F.collect_set(column))


def item_features(details: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Twelve aggregates per order; distinct counts ignore nulls.

    Orders of a bounded number of items count different values in the buffer of one
    aggregation. Larger orders, found in ``items`` (any table with their order ids), go through
    Spark's distinct aggregation, which spreads the values of an order at the price of copying
    every row once for each distinct count.
    """
    hot = hot_keys(details if items is None else items, ["order_id"])
    if hot is None:
        return _item_aggregates(details, _in_buffer)
    small, large = split_by_keys(details, hot, ["order_id"])
    return _item_aggregates(small, _in_buffer).unionByName(
        _item_aggregates(large, F.countDistinct)
    )


def _item_aggregates(details: DataFrame, distinct: Callable[[str], Column]) -> DataFrame:
    return details.groupBy("order_id").agg(
        F.count("*").cast("int").alias("item_count"),
        distinct("product_id").cast("int").alias("distinct_product_count"),
        distinct("product_category_name").cast("int").alias("distinct_category_count"),
        distinct("seller_id").cast("int").alias("seller_count"),
        distinct("seller_state").cast("int").alias("distinct_seller_state_count"),
        F.bool_or(F.col("seller_state") != F.col("customer_state")).alias(
            "has_cross_state_seller"
        ),
        _total("price").alias("total_item_value"),
        _total("freight_value").alias("total_freight_value"),
        _average("price").alias("average_item_price"),
        F.sum("product_weight_g").cast(MONEY).alias("total_product_weight_g"),
        kilometres(F.avg("seller_distance_km")).alias("average_seller_distance_km"),
        kilometres(F.max("seller_distance_km")).alias("maximum_seller_distance_km"),
    )


def order_item_features(
    order_items: DataFrame,
    located: DataFrame,
    sellers: DataFrame,
    products: DataFrame,
    centroids: DataFrame,
) -> DataFrame:
    """``item_features`` of the located orders."""
    details = item_details(order_items, located, sellers, products, centroids)
    return item_features(details, order_items)


def payment_features(order_payments: DataFrame) -> DataFrame:
    """Eight aggregates per order."""
    return order_payments.groupBy("order_id").agg(
        F.count("*").cast("int").alias("payment_count"),
        F.countDistinct("payment_type").cast("int").alias("payment_type_count"),
        _total("payment_value").alias("total_payment_value"),
        F.max("payment_installments").cast("int").alias("maximum_payment_installments"),
        *[
            F.bool_or(F.col("payment_type") == kind).alias(f"has_{kind}_payment")
            for kind in PAYMENT_TYPES
        ],
    )


def _calendar(timestamp: str, prefix: str) -> list[Column]:
    column = F.col(timestamp)
    return [
        F.hour(column).cast("smallint").alias(f"{prefix}_hour"),
        day_of_week(column).cast("smallint").alias(f"{prefix}_day_of_week"),
        F.month(column).cast("smallint").alias(f"{prefix}_month"),
    ]


def calendar_parts(orders: DataFrame) -> DataFrame:
    """Hour, day of week (Sunday 0) and month of purchase and approval."""
    return orders.select(
        "order_id",
        *_calendar("order_purchase_timestamp", "purchase"),
        *_calendar("order_approved_at", "approval"),
    )


def lifecycle_durations(orders: DataFrame) -> DataFrame:
    """Hours from purchase to approval and days from approval to the promised date."""
    return orders.select(
        "order_id",
        hours_between(F.col("order_approved_at"), F.col("order_purchase_timestamp")).alias(
            "approval_delay_hours"
        ),
        days_between(F.col("order_estimated_delivery_date"), F.col("order_approved_at")).alias(
            "promised_delivery_days"
        ),
    )


def order_features(
    orders: DataFrame,
    customers: DataFrame,
    order_items: DataFrame,
    order_payments: DataFrame,
    sellers: DataFrame,
    products: DataFrame,
    geolocation: DataFrame,
) -> DataFrame:
    """The 36 feature columns of every approved order.

    Orders without items or payments keep null aggregates. Items of orders that were
    never approved drop out in the join with the approved orders.
    """
    centroids = zip_centroids(geolocation)
    approved = orders.where(F.col("order_approved_at").isNotNull())
    located = located_orders(approved, customers, centroids)
    items = order_item_features(order_items, located, sellers, products, centroids)
    payments = payment_features(order_payments)
    purchase, approval, estimate = (
        F.col("order_purchase_timestamp"),
        F.col("order_approved_at"),
        F.col("order_estimated_delivery_date"),
    )
    base = located.select(
        "order_id",
        "customer_unique_id",
        "order_purchase_timestamp",
        "order_approved_at",
        "customer_state",
        "customer_zip_code_prefix",
        "customer_latitude",
        "customer_longitude",
        *_calendar("order_purchase_timestamp", "purchase"),
        hours_between(approval, purchase).alias("approval_delay_hours"),
        *_calendar("order_approved_at", "approval"),
        days_between(estimate, approval).alias("promised_delivery_days"),
    )
    return (
        base.join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .select(*FEATURE_COLUMNS)
    )
