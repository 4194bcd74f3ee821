"""One valid row per raw table, written as the nine CSV files."""

from parcelflow.schemas import DATASET_FILES, STAGING

ROWS = {
    "customers": ["customer-1", "unique-1", "12345", "sao paulo", "SP"],
    "geolocation": ["12345", "-23.5", "-46.6", "sao paulo", "SP"],
    "order_items": [
        "order-1", "1", "product-1", "seller-1", "2018-01-02 12:00:00", "10.50", "2.00",
    ],
    "order_payments": ["order-1", "1", "credit_card", "1", "12.50"],
    "order_reviews": [
        "review-1", "order-1", "5", "great", "excellent",
        "2018-01-04 10:00:00", "2018-01-05 10:00:00",
    ],
    "orders": [
        "order-1", "customer-1", "delivered", "2018-01-01 09:00:00", "2018-01-01 10:00:00",
        "2018-01-02 10:00:00", "2018-01-03 10:00:00", "2018-01-04 10:00:00",
    ],
    "products": ["product-1", "category-1", "10", "20", "1", "500", "10", "5", "8"],
    "sellers": ["seller-1", "12345", "sao paulo", "SP"],
    "translations": ["category-1", "category one"],
}


def write_tables(folder, rows=None, extra=None):
    """Write all files; ``rows`` replaces the row of a table, ``extra`` adds lines."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, table in STAGING.items():
        lines = [",".join(table.raw_schema.names), ",".join((rows or {}).get(name, ROWS[name]))]
        lines += (extra or {}).get(name, [])
        (folder / DATASET_FILES[name]).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)
