"""Publishing and recording by several writers at once."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from parcelflow.sources.commits import put_if_absent, records
from parcelflow.sources.lake import Lake
from parcelflow.sources.runs import read_runs, record_run, run_exists


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_only_the_first_creates_a_file(spark, tmp_path, scheme):
    folder = f"{scheme}{tmp_path}/some folder"
    assert records(spark, folder, "writer int") is None
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, folder, "x", {"writer": i}), range(8)))
    assert won.count(True) == 1
    assert [r.writer for r in records(spark, folder, "writer int").collect()] == [won.index(True)]
    assert put_if_absent(spark, folder, "y", {"writer": 9})


def test_publishers_at_once_lose_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.current_run() is None
    with ThreadPoolExecutor(6) as pool:
        numbers = dict(zip("abcdef", pool.map(lake.publish, "abcdef")))
    assert sorted(numbers.values()) == [1, 2, 3, 4, 5, 6]
    assert numbers[lake.current_run()] == 6
    assert all(lake.is_published(run) for run in "abcdef") and not lake.is_published("g")


def test_one_of_two_writers_of_a_run_is_refused(spark, tmp_path, monkeypatch):
    """Both pass the first look; the commit decides, and no rows of the other are seen."""
    root, run_id = str(tmp_path / "runs"), "1e5/ä"
    monkeypatch.setattr("parcelflow.sources.runs.refuse_recorded", lambda *a: None)

    def write(writer):
        predictions = spark.range(5).select(F.col("id").alias("order_id"), F.lit(writer).alias("by"))
        metrics = spark.range(1).select(F.lit("loss").alias("metric"), F.lit(0.5).alias("value"))
        curve = spark.range(3).select(F.col("id").alias("tree"), F.lit(0.1).alias("loss"))
        try:
            record_run(root, run_id, {"by": writer}, metrics, predictions, {"x": "int"}, curve)
            return writer
        except ValueError:
            return None

    assert not run_exists(spark, root, run_id)
    with ThreadPoolExecutor(3) as pool:
        won = [w for w in pool.map(write, range(3)) if w is not None]
    assert len(won) == 1 and run_exists(spark, root, run_id)
    rows = read_runs(spark, root, "predictions").collect()
    assert len(rows) == 5 and {(r.run_id, r.by) for r in rows} == {(run_id, won[0])}
    assert [r.value for r in read_runs(spark, root, "runs").collect()] == [str(won[0])]
    assert read_runs(spark, root, "curves").count() == 3


def test_rows_of_a_crash_are_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "runs")
    args = ({}, spark.range(1).selectExpr("'m' AS metric", "1.0 AS value"), spark.range(2), {"x": "int"})
    args = ({"a": 1}, *args[1:])
    with monkeypatch.context() as patch:
        patch.setattr("parcelflow.sources.runs.put_if_absent", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            record_run(root, "r", *args)
    assert read_runs(spark, root, "predictions").count() == 0
    record_run(root, "r", *args)
    assert read_runs(spark, root, "predictions").count() == 2
    with pytest.raises(ValueError):
        record_run(root, "r", *args)
