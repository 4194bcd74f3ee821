import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """Documents with nulls, empty and repeated rows, ties and columns with clashing names."""
    long = " ".join(f"w{i % 700}x{i}" for i in range(3000))
    shared = " ".join(f"common{i}" for i in range(60))
    data = [
        (1, f"start here {shared} end one", "s1"),
        (2, f"other words {shared} and more", "s1"),
        (3, f"other words {shared} and more", None),
        (3, f"other words {shared} and more", "s2"),
        (4, None, "s2"),
        (5, "", "s3"),
        (6, " \t\n ", "s1"),
        (None, "no id here at all", "s1"),
        (7, "No ID here at\nall", None),
        (8, long, "s1"),
        (9, "é ü 漢字 " * 200, "s3"),
        (10, "one two", "s2"),
        (11, "ONE two", "s2"),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    from pyspark.sql import functions as F

    return df.select(
        "*",
        F.lit("x").alias("body"),
        F.lit(1).alias("id"),
        F.lit("en").alias("lang"),
        F.lit(2).alias("score"),
        F.lit(3).alias("row_key"),
    )
