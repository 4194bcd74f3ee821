import pytest
from pyspark.sql import functions as F

from parcelflow.plans.boosting import NewtonConfig, NewtonModel
from parcelflow.plans.experiment import create_split, optimization_run
from parcelflow.plans.ingest import published_model_dataset
from parcelflow.plans.metrics import ranking_metrics
from parcelflow.plans.model import BoostingConfig, CategoryRates, DeliveryRiskModel, with_fold
from parcelflow.plans.split import optimization_split
from parcelflow.plans.targets import model_inputs
from parcelflow.schemas import NUMERIC_INPUTS, ORDER_FEATURES, ORDER_TARGETS
from parcelflow.sources.lake import CURATED_LAYER, Lake
from parcelflow.sources.runs import model_path, read_runs

SMALL = BoostingConfig(n_estimators=5)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Published features with a planted signal: late approvals of state B fail."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    ids = spark.range(600)
    i = F.col("id")
    values = {
        "order_id": F.format_string("o%05d", i),
        "customer_unique_id": F.format_string("u%d", i),
        "order_purchase_timestamp": F.expr("timestamp_ntz'2018-01-01 00:00:00'"),
        "order_approved_at": F.expr(
            "timestamp_ntz'2018-01-01 00:00:00' + make_dt_interval(0, cast(id as int))"
        ),
        "customer_state": F.when(i % 3 == 0, "B").otherwise("A"),
        "customer_zip_code_prefix": (i % 50).cast("string"),
        "approval_delay_hours": (i * 7 % 100).cast("decimal(12,2)"),
        "item_count": F.when(i % 5 != 0, (i % 4).cast("int")),
    }
    features = ids.select(
        *[
            values.get(c.name, F.lit(None if not c.required else 1)).cast(c.type).alias(c.name)
            for c in ORDER_FEATURES.columns
        ]
    )
    failed = (F.col("customer_state") == "B") & (F.col("approval_delay_hours") > 50)
    targets = features.select(
        "order_id",
        failed.cast("smallint").alias("non_delivery_label"),
        F.lit(None).cast("smallint").alias("late_delivery_label"),
    )
    lake.write(features, "r1", CURATED_LAYER, ORDER_FEATURES.name)
    lake.write(targets, "r1", CURATED_LAYER, ORDER_TARGETS.name)
    lake.publish("r1")
    return lake


def test_inputs_have_no_identifiers(lake):
    inputs = model_inputs(published_model_dataset(lake, "non_delivery"), keep=())
    assert len(inputs.columns) == 32
    assert {t for c, t in inputs.dtypes if c in NUMERIC_INPUTS} == {"double"}
    assert "order_id" not in inputs.columns and "order_approved_at" not in inputs.columns


def test_planted_signal_is_found(lake):
    rows = model_inputs(published_model_dataset(lake, "non_delivery"), ("order_id", "target"))
    model = DeliveryRiskModel.fit(rows, SMALL)
    predictions = model.predict(rows, keep=("order_id", "target"))
    assert predictions.columns == ["order_id", "target", "probability", "predicted"]
    assert ranking_metrics(predictions).first()["roc_auc"] > 0.95


def test_validation_rows_may_stop_the_boosting(lake):
    rows = model_inputs(published_model_dataset(lake, "non_delivery"), ("order_id", "target"))
    model = DeliveryRiskModel.fit(rows, SMALL, validation=rows.limit(100))
    assert 1 <= model.trees.getNumTrees <= 5


def test_unseen_category_gets_the_overall_rate(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0)], "s string, target int")
    rates = CategoryRates.fit(train, "s")
    rows = spark.createDataFrame([("a",), ("new",), (None,)], "s string")
    got = {r["s"]: r["s_rate"] for r in rates.apply(rows).collect()}
    assert got["new"] == got[None] == pytest.approx(1 / 3)
    assert got["a"] == pytest.approx((1 + 20 / 3) / 22)


def test_training_rates_do_not_hold_the_own_label(spark):
    i = F.col("id")
    noise = (F.xxhash64("id") % 2 != 0).cast("int")
    train = with_fold(spark.range(4000).select(i, (i % 1500).alias("zip"), noise.alias("target")))
    rates = CategoryRates.fit(train, "zip")
    assert rates.apply(train).corr("zip_rate", "target") > 0.4
    assert rates.apply(train, training=True).corr("zip_rate", "target") < 0.1
    # The other folds' share, from the rows themselves.
    rows = train.collect()
    for r in rates.apply(train, training=True).where("zip < 5").collect():
        rest = [x.target for x in rows if x.fold != r.fold]
        own = [x.target for x in rows if x.fold != r.fold and x.zip == r.zip]
        wanted = (sum(own) + 20 * sum(rest) / len(rest)) / (len(own) + 20)
        assert r.zip_rate == pytest.approx(wanted)


def test_run_of_second_order_trees(spark, lake, tmp_path):
    splits, runs = str(tmp_path / "splits"), str(tmp_path / "runs")
    create_split(lake, splits, "non_delivery", optimization_split("non_delivery"))
    config = NewtonConfig(n_estimators=3, min_child_weight=1.0)
    optimization_run(lake, splits, runs, config=config, run_id="n")
    metrics = {r["metric"]: r["value"] for r in read_runs(spark, runs, "metrics").collect()}
    curve = {r["tree"]: r["loss"] for r in read_runs(spark, runs, "curves").collect()}
    assert sorted(curve) == [0, 1, 2, 3]
    assert curve[3] == pytest.approx(metrics["validation_loss"], rel=1e-12) and curve[3] < curve[0]
    assert metrics["validation_roc_auc"] > 0.95
    dataset = published_model_dataset(lake, "non_delivery")
    again = NewtonModel.load(spark, model_path(runs, "n")).predict(model_inputs(dataset))
    both = read_runs(spark, runs, "predictions").join(
        again.select("order_id", F.col("probability").alias("p")), "order_id"
    )
    assert both.count() == 60 and both.where("probability <> p").count() == 0


def test_optimization_run_is_recorded_once(spark, lake, tmp_path):
    splits, runs = str(tmp_path / "splits"), str(tmp_path / "runs")
    assert create_split(lake, splits, "non_delivery", optimization_split("non_delivery"))
    assert not create_split(lake, splits, "non_delivery", optimization_split("non_delivery"))
    for run_id in ("a", "b"):
        assert optimization_run(lake, splits, runs, config=SMALL, run_id=run_id) == run_id
    with pytest.raises(ValueError, match="already recorded"):
        optimization_run(lake, splits, runs, config=SMALL, run_id="a")
    predictions = read_runs(spark, runs, "predictions")
    assert predictions.groupBy("run_id").count().collect()[0]["count"] == 60
    assert {r["run_id"] for r in read_runs(spark, runs, "metrics").collect()} == {"a", "b"}
    params = {
        r["name"]: r["value"]
        for r in read_runs(spark, runs, "runs").where("run_id = 'a'").collect()
    }
    assert params["training_rows"] == "480"
    assert params["split_id"] == "non_delivery_chronological_v1"
    # The stored model gives the recorded probabilities again.
    dataset = published_model_dataset(lake, "non_delivery")
    model = DeliveryRiskModel.load(spark, model_path(runs, "a"))
    again = model.predict(model_inputs(dataset, keep=("order_id",)))
    both = predictions.where("run_id = 'a'").join(
        again.select("order_id", F.col("probability").alias("p")), "order_id"
    )
    assert both.count() == 60 and both.where("abs(probability - p) > 1e-12").count() == 0
    # The newest tenth is the test split and stays out.
    assert predictions.agg(F.max("order_id")).first()[0] == "o00539"
