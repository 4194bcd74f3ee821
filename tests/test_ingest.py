from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixture_tables import ROWS, write_tables
from parcelflow.operators.quality import ConstraintError
from parcelflow.plans.ingest import RowCountError, published_model_dataset, run_ingestion
from parcelflow.schemas import CURATED, FEATURE_COLUMNS, STAGING
from parcelflow.sources.lake import Lake
from parcelflow.sources.raw_csv import read_raw, write_raw


def expected(spark, **counts):
    rows = [(name, counts.get(name, 1)) for name in STAGING]
    return spark.createDataFrame(rows, "table_name string, row_count bigint")


def test_ingestion_can_run_twice(spark, tmp_path):
    folder = write_tables(tmp_path / "raw")
    root = str(tmp_path / "lake")
    first = run_ingestion(spark, folder, root, expected(spark))
    second = run_ingestion(spark, folder, root, expected(spark))
    lake = Lake(spark, root)
    assert lake.current_run() == second != first
    for layer in ("raw", "staging"):
        for name in STAGING:
            assert lake.read(layer, name).count() == 1
    for name, table in {**STAGING, **CURATED}.items():
        layer = "staging" if name in STAGING else "curated"
        # The types in the files themselves, not those that readers declare.
        stored = spark.read.parquet(lake.path(second, layer, name)).schema
        assert [(f.name, f.dataType) for f in stored] == [(c.name, c.type) for c in table.columns]
    check_curated(lake)


def check_curated(lake):
    row = lake.read("curated", "order_features").first()
    assert list(row.asDict()) == FEATURE_COLUMNS
    assert row["approval_delay_hours"] == Decimal("1.00")
    assert row["promised_delivery_days"] == Decimal("3.00")
    assert (row["purchase_hour"], row["purchase_day_of_week"], row["purchase_month"]) == (9, 1, 1)
    assert row["item_count"] == 1 and row["average_seller_distance_km"] == 0
    assert row["has_cross_state_seller"] is False
    assert row["total_payment_value"] == Decimal("12.50")
    assert row["has_credit_card_payment"] is True and row["has_boleto_payment"] is False
    target = lake.read("curated", "order_targets").first()
    assert (target["non_delivery_label"], target["late_delivery_label"]) == (0, 0)
    assert published_model_dataset(lake, "late_delivery").columns == [*FEATURE_COLUMNS, "target"]


def test_order_without_children_keeps_nulls(spark, tmp_path):
    extra = {
        "orders": [
            "order-2,customer-1,canceled,2018-02-01 09:00:00,2018-02-01 10:00:00,,,2018-02-09 "
            "00:00:00",
            "order-3,customer-1,created,2018-02-01 09:00:00,,,,2018-02-09 00:00:00",
        ]
    }
    root = str(tmp_path / "lake")
    run_ingestion(spark, write_tables(tmp_path / "raw", extra=extra), root)
    lake = Lake(spark, root)
    features = lake.read("curated", "order_features")
    assert {r["order_id"] for r in features.collect()} == {"order-1", "order-2"}
    row = features.where(F.col("order_id") == "order-2").first()
    for column in ("item_count", "distinct_category_count", "payment_count"):
        assert row[column] is None
    assert row["has_credit_card_payment"] is None and row["total_item_value"] is None


def test_joins_by_order_read_buckets_in_place(spark, tmp_path):
    """No shuffle below the joins of the published tables, also for a session that did not
    write them; a table that was begun before is replaced."""
    from parcelflow.plans.features import payment_features
    from parcelflow.plans.targets import order_targets
    from parcelflow.sources.csv_ranges import read_raw_ranges

    extra = {
        "orders": [
            f"order-{i},customer-1,{'canceled' if i % 3 else 'delivered'},2018-02-01 09:00:00,"
            f"2018-02-01 10:00:00,,{'' if i % 3 else '2018-02-05 00:00:00'},2018-02-09 00:00:00"
            for i in range(2, 60)
        ],
        "order_payments": [f"order-{i},1,boleto,1,{i}.50" for i in range(2, 60)],
    }
    root, run = str(tmp_path / "lake"), "r-1"
    lake = Lake(spark, root, buckets=7)
    lake.write(spark.range(3).selectExpr("'x' AS order_id"), run, "staging", "orders")
    folder = write_tables(tmp_path / "raw", extra=extra)
    run_ingestion(spark, folder, root, run_id=run, reader=read_raw_ranges)
    for r in spark.sql("SHOW TABLES").where("tableName LIKE 'lake_%'").collect():
        spark.sql(f"DROP TABLE {r.tableName}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lake = Lake(spark, root)
        dataset = published_model_dataset(lake, "non_delivery")
        targets = order_targets(lake.read("curated", "order_features"), lake.read("staging", "orders"))
        payments = payment_features(lake.read("staging", "order_payments").select(
            "order_id", "payment_value", "payment_installments", "payment_type"))
        for df, n in ((dataset, 59), (targets, 59)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
            assert df.count() == n
        assert payments.count() == 59
        assert spark.read.parquet(lake.path(run, "staging", "orders")).count() == 59
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_failed_run_leaves_the_published_one(spark, tmp_path):
    root = str(tmp_path / "lake")
    good = run_ingestion(spark, write_tables(tmp_path / "good"), root)
    item = list(ROWS["order_items"])
    item[2] = "missing-product"
    bad = write_tables(tmp_path / "bad", rows={"order_items": item})
    with pytest.raises(ConstraintError, match="foreign_key:product_id->products: 1"):
        run_ingestion(spark, bad, root)
    lake = Lake(spark, root)
    assert lake.current_run() == good
    assert lake.read("staging", "order_items").first()["product_id"] == "product-1"
    assert lake.read("raw", "order_items").first()["product_id"] == "product-1"


def test_duplicate_key_and_blank_required_value(spark, tmp_path):
    extra = {"sellers": ["seller-1,12345,sao paulo,SP", "seller-2,  ,sao paulo,SP"]}
    with pytest.raises(ConstraintError) as error:
        run_ingestion(
            spark, write_tables(tmp_path / "raw", extra=extra), str(tmp_path / "lake")
        )
    assert "sellers primary_key:seller_id: 1" in str(error.value)
    assert "sellers not_null:seller_zip_code_prefix: 1" in str(error.value)


def test_row_count_must_match(spark, tmp_path):
    folder = write_tables(tmp_path / "raw")
    with pytest.raises(RowCountError, match="orders has 1 rows, expected 2"):
        run_ingestion(spark, folder, str(tmp_path / "lake"), expected(spark, orders=2))


def test_missing_csv(spark, tmp_path):
    folder = write_tables(tmp_path / "raw")
    next((tmp_path / "raw").glob("*sellers*")).rename(tmp_path / "elsewhere.csv")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_ingestion(spark, folder, str(tmp_path / "lake"))


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Lake(spark, str(tmp_path / "none")).read("staging", "orders")


def test_csv_line_breaks_quotes_and_blanks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    header = ",".join(STAGING["order_reviews"].raw_schema.names)
    path.write_text(
        header
        + '\n"r1","o1","5","","say ""hi""\nsecond line","2018-01-01 00:00:00","2018-01-02 '
        + '00:00:00"\n\nr2,o2,4,,,2018-01-01 00:00:00,2018-01-02 00:00:00\n',
        encoding="utf-8",
    )
    rows = {r["review_id"]: r for r in read_raw(spark, str(path), "order_reviews").collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"]["review_comment_message"] == 'say "hi"\nsecond line'
    assert not rows["r1"]["review_comment_title"] and not rows["r2"]["review_comment_title"]


def test_csv_round_trip(spark, tmp_path):
    text = 'a "quoted"\n\n, line\\ with \'marks\' \t'
    row = ("r", "o", "5", None, text, "2018-01-01 00:00:00", "2018-01-02 00:00:00")
    df = spark.createDataFrame([row], STAGING["order_reviews"].raw_schema)
    write_raw(df, str(tmp_path / "out"))
    assert read_raw(spark, str(tmp_path / "out"), "order_reviews").first()[4] == text


def test_wrong_header_and_broken_lines_fail(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,zip,seller_city,seller_state\na,b,c,d\n")
    with pytest.raises(Exception):
        read_raw(spark, str(path), "sellers").collect()
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\na,b\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_raw(spark, str(path), "sellers").collect()
