"""Every named query against its SQL, and the plans of the large ones."""

import pytest

from checker import compare, connect
from parcelflow.catalog import QUERIES
from parcelflow.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
WITHOUT_SQL = {
    "gbt_predictions", "newton_predictions", "newton_curve", "file_hashes", "table_fingerprint"
}


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_only_these_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    assert compare(QUERIES[name](spark, FOLDER), database, ORACLES[name]) is None


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_the_feature_plan(spark):
    text = plan(QUERIES["order_features"](spark, FOLDER))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoop"):
        assert word not in text


def test_items_are_not_expanded(spark):
    assert "Expand" not in plan(QUERIES["item_features"](spark, FOLDER))
    assert "Expand" not in plan(QUERIES["order_features"](spark, FOLDER))


def test_reports_read_only_their_columns(spark):
    from parcelflow import adapters
    from parcelflow.operators.profiling import outcome_profile, zip_ambiguity_profile

    text = plan(zip_ambiguity_profile(adapters.geolocation(spark, FOLDER)))
    assert "ReadSchema: struct<vec_id:bigint,label:int>" in text
    text = plan(outcome_profile(adapters.orders(spark, FOLDER)))
    assert "o_totalprice" not in text


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert len(df.columns) == 36 and df.count() > 0
    assert entry.queries().keys() >= entry.oracle_sql().keys()


def test_everything_else_works_without_the_text_operators(tmp_path):
    """A copy of the repository without both folders and the pipeline."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(__file__).resolve().parents[1]
    shutil.copytree(top / "parcelflow", tmp_path / "parcelflow",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    code = (
        "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql();"
        "from parcelflow.catalog import QUERIES; assert q.keys() == QUERIES.keys() >= o.keys()"
    )
    for with_pipeline in (False, True):
        if with_pipeline and (top / "corpus_pipeline.py").exists():
            shutil.copy(top / "corpus_pipeline.py", tmp_path)
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
