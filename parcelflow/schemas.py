"""The table contract of the three layers: columns, types, keys and references.

Raw tables hold text only. Staging tables hold the same columns trimmed, renamed
where the source misspells them, and typed. Curated tables are the feature and
target tables that the models read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT = T.StringType()
INTEGER = T.IntegerType()
SMALLINT = T.ShortType()
DOUBLE = T.DoubleType()
BOOLEAN = T.BooleanType()
TIMESTAMP = T.TimestampNTZType()
MONEY = T.DecimalType(12, 2)
COORDINATE = T.DecimalType(38, 18)


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType = TEXT
    required: bool = True
    raw_name: str | None = None

    @property
    def source(self) -> str:
        return self.raw_name or self.name


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    binary_flags: tuple[str, ...] = field(default=())

    @property
    def required_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.source, TEXT) for c in self.columns])

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])


def _refers(column: str, parent: str) -> Reference:
    return Reference((column,), parent, (column,))


CUSTOMERS = Table(
    "customers",
    (
        Column("customer_id"),
        Column("customer_unique_id"),
        Column("customer_zip_code_prefix"),
        Column("customer_city"),
        Column("customer_state"),
    ),
    key=("customer_id",),
)

SELLERS = Table(
    "sellers",
    (
        Column("seller_id"),
        Column("seller_zip_code_prefix"),
        Column("seller_city"),
        Column("seller_state"),
    ),
    key=("seller_id",),
)

TRANSLATIONS = Table(
    "translations",
    (
        Column("product_category_name"),
        Column("product_category_name_english"),
    ),
    key=("product_category_name",),
)

PRODUCTS = Table(
    "products",
    (
        Column("product_id"),
        Column("product_category_name", required=False),
        Column("product_name_length", INTEGER, False, raw_name="product_name_lenght"),
        Column(
            "product_description_length", INTEGER, False, raw_name="product_description_lenght"
        ),
        Column("product_photos_qty", INTEGER, False),
        Column("product_weight_g", INTEGER, False),
        Column("product_length_cm", INTEGER, False),
        Column("product_height_cm", INTEGER, False),
        Column("product_width_cm", INTEGER, False),
    ),
    key=("product_id",),
)

GEOLOCATION = Table(
    "geolocation",
    (
        Column("geolocation_zip_code_prefix"),
        Column("geolocation_lat", COORDINATE),
        Column("geolocation_lng", COORDINATE),
        Column("geolocation_city"),
        Column("geolocation_state"),
    ),
)

ORDERS = Table(
    "orders",
    (
        Column("order_id"),
        Column("customer_id"),
        Column("order_status"),
        Column("order_purchase_timestamp", TIMESTAMP),
        Column("order_approved_at", TIMESTAMP, False),
        Column("order_delivered_carrier_date", TIMESTAMP, False),
        Column("order_delivered_customer_date", TIMESTAMP, False),
        Column("order_estimated_delivery_date", TIMESTAMP),
    ),
    key=("order_id",),
    references=(_refers("customer_id", "customers"),),
)

ORDER_ITEMS = Table(
    "order_items",
    (
        Column("order_id"),
        Column("order_item_id", INTEGER),
        Column("product_id"),
        Column("seller_id"),
        Column("shipping_limit_date", TIMESTAMP),
        Column("price", MONEY),
        Column("freight_value", MONEY),
    ),
    key=("order_id", "order_item_id"),
    references=(
        _refers("order_id", "orders"),
        _refers("product_id", "products"),
        _refers("seller_id", "sellers"),
    ),
)

ORDER_PAYMENTS = Table(
    "order_payments",
    (
        Column("order_id"),
        Column("payment_sequential", INTEGER),
        Column("payment_type"),
        Column("payment_installments", INTEGER),
        Column("payment_value", MONEY),
    ),
    key=("order_id", "payment_sequential"),
    references=(_refers("order_id", "orders"),),
)

ORDER_REVIEWS = Table(
    "order_reviews",
    (
        Column("review_id"),
        Column("order_id"),
        Column("review_score", INTEGER),
        Column("review_comment_title", required=False),
        Column("review_comment_message", required=False),
        Column("review_creation_date", TIMESTAMP),
        Column("review_answer_timestamp", TIMESTAMP),
    ),
    references=(_refers("order_id", "orders"),),
)

STAGING: dict[str, Table] = {
    table.name: table
    for table in (
        CUSTOMERS,
        GEOLOCATION,
        ORDER_ITEMS,
        ORDER_PAYMENTS,
        ORDER_REVIEWS,
        ORDERS,
        PRODUCTS,
        SELLERS,
        TRANSLATIONS,
    )
}

# The file names of the published nine-file dataset.
DATASET_FILES: dict[str, str] = {
    "customers": "olist_customers_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "order_payments": "olist_order_payments_dataset.csv",
    "order_reviews": "olist_order_reviews_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "translations": "product_category_name_translation.csv",
}

ORDER_FEATURES = Table(
    "order_features",
    (
        Column("order_id"),
        Column("customer_unique_id"),
        Column("order_purchase_timestamp", TIMESTAMP),
        Column("order_approved_at", TIMESTAMP),
        Column("customer_state"),
        Column("customer_zip_code_prefix"),
        Column("customer_latitude", DOUBLE, False),
        Column("customer_longitude", DOUBLE, False),
        Column("purchase_hour", SMALLINT),
        Column("purchase_day_of_week", SMALLINT),
        Column("purchase_month", SMALLINT),
        Column("approval_delay_hours", MONEY),
        Column("approval_hour", SMALLINT),
        Column("approval_day_of_week", SMALLINT),
        Column("approval_month", SMALLINT),
        Column("promised_delivery_days", MONEY),
        Column("item_count", INTEGER, False),
        Column("distinct_product_count", INTEGER, False),
        Column("distinct_category_count", INTEGER, False),
        Column("seller_count", INTEGER, False),
        Column("distinct_seller_state_count", INTEGER, False),
        Column("has_cross_state_seller", BOOLEAN, False),
        Column("average_seller_distance_km", MONEY, False),
        Column("maximum_seller_distance_km", MONEY, False),
        Column("total_item_value", MONEY, False),
        Column("total_freight_value", MONEY, False),
        Column("average_item_price", MONEY, False),
        Column("total_product_weight_g", MONEY, False),
        Column("payment_count", INTEGER, False),
        Column("payment_type_count", INTEGER, False),
        Column("total_payment_value", MONEY, False),
        Column("maximum_payment_installments", INTEGER, False),
        Column("has_credit_card_payment", BOOLEAN, False),
        Column("has_boleto_payment", BOOLEAN, False),
        Column("has_voucher_payment", BOOLEAN, False),
        Column("has_debit_card_payment", BOOLEAN, False),
    ),
    key=("order_id",),
)

ORDER_TARGETS = Table(
    "order_targets",
    (
        Column("order_id"),
        Column("non_delivery_label", SMALLINT, False),
        Column("late_delivery_label", SMALLINT, False),
    ),
    key=("order_id",),
    references=(_refers("order_id", "order_features"),),
    binary_flags=("non_delivery_label", "late_delivery_label"),
)

CURATED: dict[str, Table] = {t.name: t for t in (ORDER_FEATURES, ORDER_TARGETS)}

FEATURE_COLUMNS: list[str] = [c.name for c in ORDER_FEATURES.columns]

# Not model inputs: identifiers and raw timestamps.
IDENTIFIER_COLUMNS = [
    "order_id",
    "customer_unique_id",
    "order_purchase_timestamp",
    "order_approved_at",
]
CATEGORICAL_INPUTS = ["customer_state", "customer_zip_code_prefix"]
NUMERIC_INPUTS = [
    c for c in FEATURE_COLUMNS if c not in IDENTIFIER_COLUMNS and c not in CATEGORICAL_INPUTS
]

TASK_LABELS = {
    "non_delivery": "non_delivery_label",
    "late_delivery": "late_delivery_label",
}
