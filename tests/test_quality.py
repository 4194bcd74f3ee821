import pytest
from pyspark.sql import functions as F

from parcelflow.operators import quality
from parcelflow.plans.staging import stage, stage_or_quarantine
from parcelflow.schemas import ORDER_PAYMENTS, STAGING


def counts(report):
    return {r["check_name"]: r["invalid_row_count"] for r in report.collect()}


def test_not_null_key_and_flags(spark):
    df = spark.createDataFrame(
        [(1, 0), (1, 1), (2, None), (None, 5)], "id int, flag int"
    )
    assert counts(quality.not_null_violations(df, "t", ["id", "flag"])) == {
        "not_null:id": 1,
        "not_null:flag": 1,
    }
    assert counts(quality.key_violations(df, "t", ["id"])) == {"primary_key:id": 1}
    assert counts(quality.key_violations(df, "t", ["id", "flag"])) == {"primary_key:id,flag": 0}
    assert counts(quality.flag_violations(df, "t", ["flag"])) == {"zero_or_one:flag": 1}


def test_checks_of_an_empty_table_count_zero(spark):
    df = spark.createDataFrame([], "id int")
    assert counts(quality.not_null_violations(df, "t", ["id"])) == {"not_null:id": 0}
    assert counts(quality.reference_violations(df, "t", ["id"], df, ["id"], "p")) == {
        "foreign_key:id->p": 0
    }


def test_reference_counts_rows_and_passes_null(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "parent_id int")
    parent = spark.createDataFrame([(1,)], "id int")
    report = quality.reference_violations(child, "c", ["parent_id"], parent, ["id"], "p")
    assert counts(report) == {"foreign_key:parent_id->p": 2}


def test_row_counts_against_expected(spark):
    loaded = quality.table_row_counts({"a": spark.range(3), "b": spark.range(2)})
    expected = spark.createDataFrame([("a", 3), ("b", 5), ("c", 1)], "table_name string, row_count bigint")
    wrong = quality.row_count_mismatches(loaded, expected).orderBy("table_name").collect()
    assert [tuple(r) for r in wrong] == [("b", 5, 2), ("c", 1, None)]


def raw_payments(spark, installments, value="10.005"):
    return spark.createDataFrame(
        [(" o1 ", "1", "card", installments, value)], ORDER_PAYMENTS.raw_schema
    )


def test_stage_types_and_rounding(spark):
    row = stage(raw_payments(spark, " 7 "), "order_payments").first()
    assert row["order_id"] == "o1"
    assert row["payment_installments"] == 7
    assert str(row["payment_value"]) == "10.01"


@pytest.mark.parametrize("text", ["10.0", "abc", "1e3x"])
def test_stage_rejects_bad_text(spark, text):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(raw_payments(spark, text), "order_payments").collect()


def test_stage_rejects_overflowing_amounts(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        stage(raw_payments(spark, "1", "99999999999.99"), "order_payments").collect()


def test_strict_staging_needs_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            stage(raw_payments(spark, "1"), "order_payments")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_quarantine_names_bad_columns(spark):
    row = stage_or_quarantine(raw_payments(spark, "10.0", "x"), "order_payments").first()
    assert row["payment_installments"] is None
    assert row["quarantined_columns"] == ["payment_installments", "payment_value"]
    clean = stage_or_quarantine(raw_payments(spark, "  "), "order_payments").first()
    assert clean["payment_installments"] is None and clean["quarantined_columns"] == []


def test_cast_violations_count_bad_text(spark):
    raw = raw_payments(spark, "abc").unionByName(raw_payments(spark, " "))
    assert counts(quality.cast_violations(raw, ORDER_PAYMENTS)) == {
        "castable:payment_sequential": 0,
        "castable:payment_installments": 1,
        "castable:payment_value": 0,
    }


def test_misspelt_source_columns_are_renamed(spark):
    table = STAGING["products"]
    assert "product_name_lenght" in table.raw_schema.names
    raw = spark.createDataFrame([("p", "", "10", "20", "1", "500", "10", "5", "8")], table.raw_schema)
    row = stage(raw, table).first()
    assert row["product_name_length"] == 10 and row["product_category_name"] is None


def test_one_scan_for_all_checks_of_a_table(spark, capsys):
    df = spark.range(5).select(F.col("id").alias("a"), F.col("id").alias("b"))
    quality.one_pass_counts(df, {"x": F.col("a") > 2, "y": F.col("b") > 3}).explain()
    assert capsys.readouterr().out.count("Range (") == 1
