"""Labels + feature snapshots -> training set -> model -> metrics -> scores."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..context import Workspace, materialize
from ..operators import ml
from ..operators.asof import asof_join
from ..operators.asof_ranges import asof_join_ranges
from ..operators.features import lookup_features
from ..sources.labels import write_metrics


def pit_join(
    entities: DataFrame,
    features: DataFrame,
    key: str = S.KEY,
    entity_time: str = S.LABEL_TIME,
    feature_time: str = S.EVENT_TIME,
    feature_names=S.FEATURES,
    ttl_seconds: float | None = None,
    bucket_seconds: int = 86400,
    by_ranges: bool = False,
) -> DataFrame:
    """Point-in-time features: for each entity row, the latest feature row of
    its key at or before the entity time (left: no match keeps nulls).

    Every entity column (the label too) is carried through, so duplicate
    (key, time) rows stay one output row each. ``ttl_seconds`` (0 or None:
    no limit) drops matches older than the TTL. ``bucket_seconds`` is the
    width of the time buckets that split a key's window (narrower for keys
    with many labels per day); ``by_ranges`` cuts by the rows instead
    (``asof_join_ranges``), for keys with many labels within a minute.
    """
    join, cut = (asof_join_ranges, {}) if by_ranges else (asof_join, {"bucket_seconds": bucket_seconds})
    return join(
        entities,
        features.select(key, feature_time, *feature_names),
        by=[key],
        left_time=entity_time,
        right_time=feature_time,
        direction="backward",
        how="left",
        payload=list(feature_names),
        tolerance_seconds=ttl_seconds,
        **cut,
    )


def training_set(labels: DataFrame, snapshots: DataFrame, ttl_seconds: float | None = None) -> DataFrame:
    """T7: labels with point-in-time features; rows with a null label dropped."""
    return ml.drop_null_labels(pit_join(labels, snapshots, ttl_seconds=ttl_seconds))


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: DataFrame
    importances: DataFrame
    split: DataFrame

    def test_metrics(self) -> dict[str, float]:
        """``{accuracy, precision, recall, f1}`` on the test split (four
        numbers from the one-row evaluation aggregate)."""
        names = ("accuracy", "precision", "recall", "f1")
        rows = self.metrics.where(F.col("metric").isin([f"test_{n}" for n in names])).collect()
        return {r["metric"].removeprefix("test_"): r["value"] for r in rows}


def train_model_pipeline(
    spark: SparkSession,
    labels: DataFrame,
    snapshots: DataFrame,
    model_path: str | None = None,
    params: dict | None = None,
    test_size: float = S.TEST_SIZE,
    val_size: float = S.VAL_SIZE,
    seed: int = S.SEED,
    run_id: str | None = None,
    metrics_path: str | None = None,
    work: Workspace | None = None,
    paths: dict[str, str] | None = None,
) -> TrainResult:
    """Training set -> stratified split -> boosted trees -> test metrics.

    The metrics table is long: ``(run_id, metric, value, text)``, with the
    run's parameters and paths, sizes, label statistics, split sizes, test
    accuracy / precision / recall / F1, test log loss, trees kept, train /
    valid log loss at the best round and the ten largest importances. It is
    appended to ``metrics_path`` where one is given. The split is
    materialized (in ``work``, whose owner releases it), so training
    iterations and the evaluation reread one fixed split instead of its
    lineage.
    """
    run_id = run_id or uuid.uuid4().hex
    data = training_set(labels, snapshots)
    split = materialize(ml.stratified_split(data, seed=seed, test_size=test_size, val_size=val_size), work)
    fit_rows = split.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    model = ml.train_gbt(fit_rows, params=params, seed=seed)
    test = ml.predict(model, split.where(F.col("split") == "test"))
    metrics_wide = ml.evaluate(test)
    stats = ml.label_stats(split)  # same rows as the training set, already materialized
    sizes = split.groupBy().pivot("split", ["train", "val", "test"]).count()
    importances = ml.topk_importance(model)
    ran = {**S.GBT_DEFAULTS, **(params or {})}
    record = [(f"param_{k}", float(v) if isinstance(v, (int, float)) else None, None if isinstance(v, (int, float)) else str(v)) for k, v in sorted(ran.items())]
    record += [("seed", float(seed), None), ("test_size", test_size, None), ("val_size", val_size, None), ("patience", float(S.PATIENCE), None), ("num_features", float(len(S.FEATURES)), None)]
    record += [(f"path_{k}", None, v) for k, v in {**(paths or {}), **({"model": model_path} if model_path else {})}.items()]
    text = F.lit(None).cast("string").alias("text")
    long = (
        to_long(metrics_wide, "test_")
        .unionByName(to_long(stats, ""))
        .unionByName(to_long(stats.select(F.col("total").alias("total_samples")), ""))
        .unionByName(to_long(sizes, "samples_"))
        .unionByName(_round_metrics(spark, model, fit_rows))
        .unionByName(importances.select(F.concat(F.lit("importance_"), "feature").alias("metric"), F.col("importance").alias("value")))
        .select("metric", "value", text)
        .unionByName(spark.createDataFrame(record, "metric string, value double, text string"))
    )
    metrics = long.select(F.lit(run_id).alias("run_id"), "metric", "value", "text")
    if model_path:
        ml.save_model(model, model_path)
    if metrics_path:
        write_metrics(metrics, metrics_path)
    return TrainResult(model, metrics, importances, split)


def _round_metrics(spark: SparkSession, model: PipelineModel, fit_rows: DataFrame) -> DataFrame:
    """Trees kept, and train / valid log loss at the best round (the round
    with the lowest validation loss)."""
    train_loss = ml.iteration_log_loss(model, fit_rows.where(~F.col("is_val")))
    valid_rows = fit_rows.where(F.col("is_val"))
    valid_loss = ml.iteration_log_loss(model, valid_rows) if not valid_rows.isEmpty() else train_loss
    best = min(range(len(valid_loss)), key=valid_loss.__getitem__)
    rows = [
        ("num_trees", float(len(valid_loss))),
        ("best_iteration", float(best + 1)),
        ("train_binary_logloss", float(train_loss[best])),
        ("valid_binary_logloss", float(valid_loss[best])),
    ]
    return spark.createDataFrame(rows, "metric string, value double")


def to_long(one_row: DataFrame, prefix: str) -> DataFrame:
    """A one-row table as ``(metric, value)`` rows."""
    cols = one_row.columns
    pairs = ", ".join(f"'{prefix}{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return one_row.selectExpr(f"stack({len(cols)}, {pairs}) AS (metric, value)")


def score_accounts(
    model: PipelineModel, ids: DataFrame, online: DataFrame, key: str = S.KEY
) -> DataFrame:
    """Batch scoring: look the ids up in the online view, then score."""
    return ml.batch_score(model, lookup_features(ids, online, key))


def score_account(model: PipelineModel, account_id: str, online: DataFrame) -> dict:
    """One account's score as plain values: ``{actor_account_id, will_churn,
    churn_probability}``. It is ``score_accounts`` on a one-row id frame;
    only that one result row reaches the driver."""
    spark = online.sparkSession
    ids = spark.createDataFrame([(str(account_id),)], f"{S.KEY} string")
    row = score_accounts(model, ids, online).first()
    return {
        S.KEY: row[S.KEY],
        "will_churn": bool(row["churn_prediction"]),
        "churn_probability": float(row["churn_probability"]),
    }
