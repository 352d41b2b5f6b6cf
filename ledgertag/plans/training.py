"""The job that fits the model, measures it per country group and decides if it is good enough."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertag.domain import COUNTRY_GROUPS, TRAINING_LABELS, TRANSACTION_LABELS
from ledgertag.operators.evaluate import (
    golden_check,
    label_report,
    metric_sums_by_group,
    missing_labels,
    missing_multi_hot_labels,
    performance_gate,
    prepare_test_set,
    report_averages,
    report_summary,
)
from ledgertag.operators.assemble import trainable_rows
from ledgertag.operators.scoring import triplet_loss
from ledgertag.plans.model import LabelModel
from ledgertag.session import materialize, scratch_scope
from ledgertag.sources.sinks import read_split


def evaluation_sums(model: LabelModel, test: DataFrame) -> DataFrame:
    """Metric sums per country group, of a prepared test set."""
    return metric_sums_by_group(model.indicators(test), TRANSACTION_LABELS)


def run(
    spark: SparkSession, sets_path: str, output: str, golden: DataFrame | None = None
) -> bool:
    """Fit, evaluate, save model and metadata; True if the model is performant.

    ``golden`` holds model inputs and the expected label set in ``expected``. The model is
    saved in any case; the result tells whether it may be used. Intermediate tables are dropped
    once all is written.
    """
    with scratch_scope(spark, "training"):
        return _run(spark, sets_path, output, golden)


def _run(spark: SparkSession, sets_path: str, output: str, golden: DataFrame | None) -> bool:
    base = output.rstrip("/")
    started = time.time()
    train, validation, test = (
        read_split(spark, sets_path, split) for split in ("train", "validation", "test")
    )
    model = LabelModel.fit(train)
    fit_time = time.strftime("%H:%M:%S", time.gmtime(time.time() - started))
    model.save(spark, f"{base}/model")

    evaluating = time.time()
    prepared = prepare_test_set(test)
    sums = materialize(evaluation_sums(model, prepared))
    report = label_report(sums, TRANSACTION_LABELS, ["group"])
    report.write.mode("overwrite").parquet(f"{base}/report")
    report_averages(sums, TRANSACTION_LABELS, ["group"]).write.mode("overwrite").parquet(
        f"{base}/averages"
    )
    report_summary(sums, TRANSACTION_LABELS, ["group"]).write.mode("overwrite").parquet(
        f"{base}/summary"
    )
    evaluate_time = time.time() - evaluating

    label_ids = trainable_rows(validation).where(F.col("target_label_int") < len(TRAINING_LABELS))
    loss = triplet_loss(model.similarities(label_ids), "target_label_int").first()[0]
    performant = report_gate(report)
    if golden is not None:
        reloaded = LabelModel.load(spark, f"{base}/model")
        predicted = reloaded.predict(golden, keep=["expected"])
        performant = performant and golden_check(predicted, "expected").first()["passed"]

    missing = {
        "train": names(missing_labels(trainable_rows(train))),
        "validation": names(missing_labels(trainable_rows(validation))),
        "test": names(missing_multi_hot_labels(prepared)),
    }
    metadata = {
        "labels": TRANSACTION_LABELS,
        "groups": list(COUNTRY_GROUPS),
        "fit_time": fit_time,
        "evaluate_time": evaluate_time,
        "validation_triplet_loss": loss,
        "missing_labels": missing,
        "is_performant": performant,
    }
    spark.createDataFrame([(json.dumps(metadata),)], "metadata string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{base}/metadata")
    return performant


def report_gate(report: DataFrame) -> bool:
    return bool(performance_gate(report).first()["performant"])


def names(labels: DataFrame) -> list[str]:
    """At most as many names as the label domain has."""
    return sorted(row["label"] for row in labels.collect())
