"""Empty tables, clashing column names and other ids, for every stage of the pipeline."""

import pytest
from pyspark.sql import functions as F

from parcelflow.llm import exact, leaks, mixing, near, quality, radix

NAMES = ["_sha", "_size", "_kept_id", "_kept_sha", "_leak", "_mix_row", "_quality_score",
         "mix_times", "mix_words", "row_key", "body", "id", "_SHA2"]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")


@pytest.fixture(scope="module")
def stages(benchmark):
    network = quality.fitted(["good words here"] * 4 + ["bad bad bad bad"] * 4, [1] * 4 + [0] * 4)
    return {
        "quality": lambda df: quality.keep_good(df, network),
        "exact": exact.drop_exact_copies,
        "near": lambda df: near.drop_near_copies(df, words=5, share=(80, 100)),
        "leaks": lambda df: leaks.without_leaks(df, benchmark),
        "mix": mixing.mix,
    }


@pytest.mark.parametrize("name", ["quality", "exact", "near", "leaks", "mix"])
def test_stage_with_clashing_names_and_no_rows(spark, stages, name):
    rows = [(i, f"text number {i} has words of its own {i * i}", "s", "en") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    plain = stages[name](df).select("doc_id").collect()
    marked = df.select("*", *[F.concat(F.lit(f"{c}="), "doc_id").alias(c) for c in NAMES])
    found = stages[name](marked)
    assert sorted(r.doc_id for r in found.collect()) == sorted(r.doc_id for r in plain)
    kept = [c for c in NAMES if name != "mix" or not c.startswith("mix_")]
    for r in found.select("doc_id", *kept).collect():
        assert list(r)[1:] == [f"{c}={r.doc_id}" for c in kept]
    assert len(found.columns) == len(set(found.columns)) == len(marked.columns)
    assert stages[name](df.limit(0)).collect() == [] == stages[name](marked.limit(0)).collect()


def test_exact_groups_of_text_ids(spark):
    rows = [("b", "x y"), ("a", "xy"), ("c", "x  y"), (None, "x  y"), ("d", "x  y"), ("e", None)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(df).collect()}
    assert found == {
        "a": ("c", 5, False), "b": ("c", 5, False), "c": ("c", 5, True), None: ("c", 5, False),
        "d": ("c", 5, False), "e": ("e", 1, True),
    }
    least = spark.createDataFrame([(-(2**63), "x"), (2**63 - 1, "x")], "doc_id long, text string")
    assert {r.keep_id for r in exact.exact_groups(least).collect()} == {-(2**63)}


def test_leaks_of_empty_sides(spark, benchmark):
    df = spark.createDataFrame([(1, "one two three four five six seven")], "doc_id long, text string")
    assert leaks.leaks(df.limit(0), benchmark).collect() == []
    assert leaks.leaks(df, benchmark.limit(0)).collect() == []
    assert leaks.without_leaks(df, benchmark.limit(0)).count() == 1


def test_one_run_shared_by_very_many_texts(spark):
    """Each text but the head of the group gets its answer without a task that holds all."""
    shared = "the very same passage " * 30
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit(shared), F.sha2(F.lit("z"), 512)).alias("text"),
    )
    found = radix.remove_repeats(df)
    texts = df.first().text
    tail = len(shared) + 128
    assert {(r.n_bytes, r.n_spans) for r in found.collect()} == {(len(texts), 1)}
    assert all(tail <= r.n_removed <= tail + 8 for r in found.collect())
