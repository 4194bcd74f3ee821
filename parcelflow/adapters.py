"""The order-fulfilment tables derived from the TPC-H-like Parquet tables of a folder.

Ids keep their integer type: no operator depends on the type of an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.schemas import MONEY


# Declared, so that building a plan never opens a file to infer a schema.
TABLE_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _interval(days=0, hours=0, seconds=0) -> Column:
    def whole(value):
        return (value if isinstance(value, Column) else F.lit(value)).cast("int")

    return F.make_dt_interval(whole(days), whole(hours), F.lit(0), whole(seconds))


def _state_names(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "nation").select("n_nationkey", "n_name")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    shipped = (
        read_table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    return (
        read_table(spark, folder, "orders")
        .join(shipped, "o_orderkey", "left")
        .select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(status == "F", "delivered")
            .when((status == "P") & (key % 2 == 0), "canceled")
            .when(status == "P", "unavailable")
            .otherwise("shipped")
            .alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.when(
                key % 37 != 0, F.col("o_orderdate") + _interval(hours=key % 72, seconds=key % 50)
            ).alias("order_approved_at"),
            F.col("first_ship").alias("order_delivered_carrier_date"),
            F.when(
                (status == "F") & (key % 41 != 0), F.col("last_ship") + _interval(hours=key % 48)
            ).alias("order_delivered_customer_date"),
            (F.col("o_orderdate") + _interval(days=key % 40 + 10)).alias(
                "order_estimated_delivery_date"
            ),
        )
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast(MONEY).alias("freight_value"),
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_type")
    return read_table(spark, folder, "events").select(
        F.expr("event_id div 3").alias("order_id"),
        (F.col("event_id") % 3 + 1).cast("int").alias("payment_sequential"),
        F.when(event == "purchase", "credit_card")
        .when(event == "click", "boleto")
        .when(event == "view", "voucher")
        .when(event == "signup", "debit_card")
        .otherwise("not_defined")
        .alias("payment_type"),
        F.get_json_object("props", "$.k").cast("int").alias("payment_installments"),
        F.col("value").cast(MONEY).alias("payment_value"),
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    labelled = read_table(spark, folder, "labels").join(
        read_table(spark, folder, "documents"), "doc_id"
    )
    written = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz") + _interval(
        days=F.col("doc_id") * 13 % 2000
    )
    return labelled.select(
        F.col("doc_id").alias("review_id"),
        F.expr("doc_id div 2").alias("order_id"),
        (F.col("quality") + 5 * F.col("toxic")).alias("review_score"),
        F.col("lang").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        written.alias("review_creation_date"),
        (written + _interval(days=1)).alias("review_answer_timestamp"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    people = read_table(spark, folder, "customer")
    states = _state_names(spark, folder)
    return people.join(states, people["c_nationkey"] == states["n_nationkey"]).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        (F.col("c_custkey") % 12).cast("string").alias("customer_zip_code_prefix"),
        F.concat(F.lit("city "), (F.col("c_custkey") % 7).cast("string")).alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    shops = read_table(spark, folder, "supplier")
    states = _state_names(spark, folder)
    return shops.join(states, shops["s_nationkey"] == states["n_nationkey"]).select(
        F.col("s_suppkey").alias("seller_id"),
        (F.col("s_suppkey") % 11).cast("string").alias("seller_zip_code_prefix"),
        F.concat(F.lit("city "), (F.col("s_suppkey") % 7).cast("string")).alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 19 != 0, F.col("p_type")).alias("product_category_name"),
        F.col("p_size").alias("product_weight_g"),
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    border = F.when(F.col("vec_id") % 25 == 0, 1).otherwise(0)
    return read_table(spark, folder, "embeddings").select(
        F.col("label").cast("string").alias("geolocation_zip_code_prefix"),
        (F.col("embedding")[0].cast("double") * 90).alias("geolocation_lat"),
        (F.col("embedding")[1].cast("double") * 180).alias("geolocation_lng"),
        F.concat(F.lit("city"), (F.col("vec_id") % 7).cast("string")).alias("geolocation_city"),
        F.concat(F.lit("S"), (F.col("label") % 4 + border).cast("string")).alias(
            "geolocation_state"
        ),
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Labels with a made-up score that has ties: (doc_id, target, probability)."""
    labels = read_table(spark, folder, "labels")
    documents = read_table(spark, folder, "documents").select("doc_id", "n_chars")
    return labels.join(documents, "doc_id").select(
        "doc_id",
        F.col("quality").alias("target"),
        (F.col("n_chars") % 997 / F.lit(997.0)).alias("probability"),
    )


def raw_order_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Payments as dirty text: padded, blank, fractional and non-numeric instalments."""
    text = F.get_json_object("props", "$.k")
    event = F.col("event_id")
    return read_table(spark, folder, "events").select(
        F.expr("event_id div 3").cast("string").alias("order_id"),
        (event % 3 + 1).cast("string").alias("payment_sequential"),
        F.when(event % 13 == 0, "   ").otherwise(F.concat(F.lit(" "), "event_type")).alias(
            "payment_type"
        ),
        F.when(event % 7 == 0, "")
        .when(event % 11 == 0, F.concat(text, F.lit(".0")))
        .when(event % 17 == 0, "abc")
        .otherwise(F.concat(F.lit("  "), text, F.lit(" ")))
        .alias("payment_installments"),
        F.when(event % 23 == 0, "n/a")
        .otherwise(F.col("value").cast(MONEY).cast("string"))
        .alias("payment_value"),
    )


def raw_order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews as text, with padded and blank titles and whole multi-line messages."""
    typed = order_reviews(spark, folder)
    return typed.select(
        F.col("review_id").cast("string").alias("review_id"),
        F.col("order_id").cast("string").alias("order_id"),
        F.concat(F.lit(" "), F.col("review_score").cast("string")).alias("review_score"),
        F.when(F.col("review_id") % 5 == 0, "  ")
        .otherwise(F.concat(F.lit(" "), "review_comment_title", F.lit("  ")))
        .alias("review_comment_title"),
        F.concat(F.lit("  "), "review_comment_message", F.lit(" ")).alias(
            "review_comment_message"
        ),
        F.col("review_creation_date").cast("string").alias("review_creation_date"),
        F.col("review_answer_timestamp").cast("string").alias("review_answer_timestamp"),
    )
