"""Split creation and the optimisation run over the published model datasets."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import functions as F

from parcelflow.plans.ingest import published_model_dataset
from parcelflow.plans.boosting import NewtonConfig, NewtonModel
from parcelflow.plans.metrics import metric_report
from parcelflow.plans.model import BoostingConfig, DeliveryRiskModel
from parcelflow.plans.split import (
    TRAIN,
    VALIDATION,
    SplitConfig,
    chronological_split,
    optimization_split,
)
from parcelflow.plans.targets import model_inputs
from parcelflow.session import materialize
from parcelflow.sources.lake import Lake, new_run_id
from parcelflow.sources.runs import model_path, record_run, refuse_recorded
from parcelflow.sources.splits import load_split, save_split


def create_split(lake: Lake, split_root: str, task: str, config: SplitConfig) -> bool:
    """Split the published dataset of ``task`` and store it; False if the id exists."""
    # Split, checks and counts scan these rows many times: run the join behind them once.
    dataset = materialize(
        published_model_dataset(lake, task).select("order_id", "order_approved_at", "target")
    )
    assignment = chronological_split(dataset, config).select("order_id", "split")
    return save_split(split_root, dataset, assignment, config)


def optimization_run(
    lake: Lake,
    split_root: str,
    run_root: str,
    task: str = "non_delivery",
    config: NewtonConfig | BoostingConfig = NewtonConfig(),
    run_id: str | None = None,
) -> str:
    """Train on the train split, score the validation split, record the run and its model.

    The kind of ``config`` picks the learner; second-order trees also record their loss on the
    validation rows after each tree. Test rows are never read into the model or the metrics.
    """
    run_id = run_id or new_run_id()
    refuse_recorded(lake.spark, run_root, run_id)
    split_config = optimization_split(task)
    if not split_config.validation_fraction:
        raise ValueError("The optimisation run needs validation rows.")
    dataset = published_model_dataset(lake, task)
    # The checks of the split scan these rows many times.
    labelled = materialize(dataset.select("order_id", "target"))
    members = load_split(split_root, labelled, split_config)
    rows = materialize(
        model_inputs(dataset, keep=("order_id", "target"))
        .join(members, "order_id")
        .where(F.col("split").isin(TRAIN, VALIDATION))
    )
    train = rows.where(F.col("split") == TRAIN)
    validation = rows.where(F.col("split") == VALIDATION)
    learner = NewtonModel if isinstance(config, NewtonConfig) else DeliveryRiskModel
    model = learner.fit(train, config)
    predictions = materialize(model.predict(validation, keep=("order_id", "target")))
    model.save(model_path(run_root, run_id))
    record_run(
        run_root,
        run_id,
        {
            "task": task,
            "split_id": split_config.split_id,
            "lake_run": lake.current_run(),
            "decision_threshold": config.threshold,
            "training_rows": train.count(),
            **asdict(config),
        },
        metric_report(predictions, config.threshold),
        predictions,
        {f.name: f.dataType.simpleString() for f in train.schema.fields},
        model.evaluation_curve(validation) if learner is NewtonModel else None,
    )
    return run_id
