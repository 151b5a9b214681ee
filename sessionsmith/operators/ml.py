"""Training-set preparation, boosted trees, metrics and batch scoring.

Everything that can be a SQL aggregate is one (split quotas, confusion
counts, log loss, label statistics); the model is Spark ML's
``GBTClassifier``. Only model metadata (29 importances) and one-row
metric tables are small enough to reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.expressions import epoch_micros, micros_between



# --------------------------------------------------------------------------
# Labels
# --------------------------------------------------------------------------


def label_distribution(labels: DataFrame, label: str = S.LABEL) -> DataFrame:
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def label_stats(labels: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Churn rate (mean), churned (sum), retained (sum of 1 - y), totals."""
    y = F.col(label)
    return labels.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(y.isNull()).alias("null_labels"),
        F.avg(y.cast("double")).alias("churn_rate"),
        F.sum(y).cast("bigint").alias("num_churned"),
        F.sum(F.lit(1) - y).cast("bigint").alias("num_retained"),
    )


def drop_null_labels(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    return df.where(F.col(label).isNotNull())


def project_features(df: DataFrame, exclude: Sequence[str] = (S.KEY, S.LABEL_TIME, S.LABEL)) -> DataFrame:
    """X: every column but the id, the time and the label."""
    return df.drop(*[c for c in exclude if c in df.columns])


# --------------------------------------------------------------------------
# Stratified split without a per-label hot task
# --------------------------------------------------------------------------


def _id_text(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, (T.TimestampNTZType, T.TimestampType)):
        return epoch_micros(F.col(c).cast("timestamp_ntz")).cast("string")
    return F.col(c).cast("string")


def _allocate(classes: DataFrame, label: str, count: str, total: str, target: str, out: str) -> DataFrame:
    """Split ``target`` rows over the classes in proportion to ``count``:
    whole parts first, then one more for the largest remainders (ties: class
    order). Products are decimals: counts of some billions would overflow a
    long. ``classes`` has one row per label class, so the unpartitioned
    windows here run over that handful of rows only."""
    every = Window.partitionBy()
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    product = wide(target) * wide(count)
    c = classes.withColumn("__rest", product % wide(total)).withColumn("__fl", ((product - product % wide(total)) / wide(total)).cast("bigint"))
    order = Window.orderBy(F.col("__rest").desc(), F.col(label))
    c = c.withColumn("__rk", F.row_number().over(order)).withColumn(
        "__left", F.col(target) - F.sum("__fl").over(every)
    )
    return c.withColumn(out, F.col("__fl") + (F.col("__rk") <= F.col("__left")).cast("long")).drop(
        "__rest", "__fl", "__rk", "__left"
    )


def split_quotas(
    counts: DataFrame, label: str = S.LABEL, test_size: float = S.TEST_SIZE, val_size: float = S.VAL_SIZE
) -> DataFrame:
    """Per class ``(label, __qt, __qv)``: test and validation row counts.

    ``counts`` is ``(label, n)``, one row per class. Test takes
    ``ceil(test_size * n)`` rows overall; validation takes
    ``ceil(val_size * rest)`` of the rest, as two nested stratified splits.
    """
    every = Window.partitionBy()
    c = counts.where(F.col(label).isNotNull()).withColumn("__N", F.sum("n").over(every))
    c = c.withColumn("__ntr", F.col("__N") - F.ceil(F.lit(test_size) * F.col("__N")))
    c = _allocate(c, label, "n", "__N", "__ntr", "__train")
    c = c.withColumn("__N2", F.sum("__train").over(every))
    c = c.withColumn("__ntr2", F.col("__N2") - F.ceil(F.lit(val_size) * F.col("__N2")))
    c = _allocate(c, label, "__train", "__N2", "__ntr2", "__train2")
    return c.select(
        label,
        (F.col("n") - F.col("__train")).alias("__qt"),
        (F.col("__train") - F.col("__train2")).alias("__qv"),
    )


def stratified_split(
    df: DataFrame,
    label: str = S.LABEL,
    id_cols: Sequence[str] = (S.KEY, S.LABEL_TIME),
    seed: int = S.SEED,
    test_size: float = S.TEST_SIZE,
    val_size: float = S.VAL_SIZE,
    buckets_bits: int = 16,
) -> DataFrame:
    """Add ``split`` in {train, val, test}: stratified by label, reproducible.

    Rows of a class are ordered by ``md5('<seed>:' || ids)``; the first
    ``test`` rows are test, the next ``val`` rows validation, the rest train.
    The rank is the row count of lower hash buckets (a per-class histogram
    of at most 2^bits rows) plus the rank inside the bucket, so no window
    ever holds a whole class. The class counts are sums over the histogram,
    so the input is read twice: for the histogram and for the ranks. Nothing
    is collected to the driver. A row without a label has no split (null).
    """
    if buckets_bits % 4 or not 4 <= buckets_bits <= 28:
        raise ValueError("buckets_bits must be a multiple of 4 from 4 to 28")
    ids = [_id_text(df, c) for c in id_cols]
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *ids))
    nb = buckets_bits // 4
    hashed = df.withColumn("__h", h).withColumn(
        "__bk", F.conv(F.substring("__h", 1, nb), 16, 10).cast("int")
    )
    hist = hashed.where(F.col(label).isNotNull()).groupBy(label, "__bk").agg(F.count(F.lit(1)).alias("__nb"))
    quotas = split_quotas(hist.groupBy(label).agg(F.sum("__nb").alias("n")), label, test_size, val_size)
    wc = Window.partitionBy(label).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    before = hist.select(label, "__bk", F.coalesce(F.sum("__nb").over(wc), F.lit(0)).alias("__before"))
    # Both are small, so the rows meet one table keyed by class and bucket, which spreads a class.
    places = before.join(quotas, label)
    w = Window.partitionBy(label, "__bk").orderBy("__h", *id_cols)
    ranked = hashed.withColumn("__rn", F.row_number().over(w)).join(places, [label, "__bk"], "left")
    rank = F.col("__before") + F.col("__rn")
    split = (
        F.when(F.col(label).isNull(), F.lit(None).cast("string"))
        .when(rank <= F.col("__qt"), F.lit("test"))
        .when(rank <= F.col("__qt") + F.col("__qv"), F.lit("val"))
        .otherwise(F.lit("train"))
    )
    return ranked.withColumn("split", split).drop("__h", "__bk", "__rn", "__before", "__qt", "__qv").select(*df.columns, "split")


# --------------------------------------------------------------------------
# Metrics
# --------------------------------------------------------------------------


def _confusion_aggs(label: str, pred: str) -> list[Column]:
    y, p = F.col(label), F.col(pred)
    return [
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    ]


def _logloss_agg(label: str, prob: str, eps: float) -> Column:
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    return F.avg(-(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))).alias("log_loss")


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def _metric_cols() -> list[Column]:
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return [
        _safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1"),
    ]


def binary_metrics(df: DataFrame, label: str = S.LABEL, pred: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 (0 where a denominator is 0), one row."""
    return df.agg(*_confusion_aggs(label, pred)).select(*_metric_cols())


def log_loss(df: DataFrame, label: str = S.LABEL, prob: str = "p", eps: float = 1e-15) -> DataFrame:
    """Mean binary cross-entropy with the probability clipped to [eps, 1-eps]."""
    return df.agg(_logloss_agg(label, prob, eps), F.count(F.lit(1)).alias("n"))


def evaluate(
    df: DataFrame, label: str = S.LABEL, prob: str = "p", pred: str = "prediction", eps: float = 1e-15
) -> DataFrame:
    """The four metrics and the log loss in ONE aggregate (one row)."""
    return df.agg(*_confusion_aggs(label, pred), _logloss_agg(label, prob, eps)).select(
        *_metric_cols(), "log_loss"
    )


def threshold(prob: str | Column, cut: float = S.THRESHOLD) -> Column:
    """Strict ``p > cut`` as an int."""
    p = F.col(prob) if isinstance(prob, str) else prob
    return (p > F.lit(cut)).cast("int")


# --------------------------------------------------------------------------
# Model
# --------------------------------------------------------------------------

def fill_features(df: DataFrame, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """Null policy for rows without features: counts 0, other values -1,
    and ``has_features`` = 0 (1 when the row had a feature match).
    One projection (``withColumns``), not one plan step per feature."""
    zero = set(S.ACCOUNT_EVENT_LABELS) | {"total_sessions", "total_playtime_minutes"}
    filled = {
        f: F.coalesce(F.col(f).cast("double"), F.lit(0.0 if f in zero else -1.0)) for f in features
    }
    return df.withColumns({"has_features": F.col(features[0]).isNotNull().cast("double"), **filled})


def assembler(features: Sequence[str] = S.FEATURES) -> VectorAssembler:
    return VectorAssembler(
        inputCols=[*features, "has_features"], outputCol="features", handleInvalid="keep"
    )


def stopping_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The best round (from 1) when training stops after ``patience`` rounds without gain, and whether that came to pass."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def train_gbt(
    data: DataFrame,
    label: str = S.LABEL,
    features: Sequence[str] = S.FEATURES,
    params: dict | None = None,
    val_col: str | None = "is_val",
    seed: int = S.SEED,
    patience: int = S.PATIENCE,
) -> PipelineModel:
    """Boosted trees on the training rows; ``params`` replace defaults.

    Rows with ``val_col`` true are the validation set. Boosting stops after
    ``patience`` rounds without a lower validation loss, and the model keeps
    the rounds up to the best one. Trees depend on the rounds before them and
    on the seed only, so the model with fewer rounds is the beginning of the
    one with more: rounds are fitted in growing numbers until the stop shows,
    then once more up to the best round.
    """
    p = {**S.GBT_DEFAULTS, **(params or {})}
    rounds = p.pop("maxIter")
    prepared = fill_features(data, features).withColumn(label, F.col(label).cast("double"))

    def fit(rows: DataFrame, n: int) -> PipelineModel:
        gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, maxIter=n, **p)
        return Pipeline(stages=[assembler(features), gbt]).fit(rows)

    if val_col is None or val_col not in data.columns:
        return fit(prepared, rounds)
    train, valid = prepared.where(~F.col(val_col)).cache(), prepared.where(F.col(val_col)).cache()
    try:
        if valid.isEmpty():
            return fit(train, rounds)
        tried = min(rounds, max(2 * patience, 1))
        while True:
            model = fit(train, tried)
            losses = model.stages[-1].evaluateEachIteration(model.stages[0].transform(valid))
            best, stopped = stopping_round(losses, patience)
            if stopped or tried >= rounds:
                return model if best == tried else fit(train, best)
            tried = min(rounds, 2 * tried)
    finally:
        train.unpersist()
        valid.unpersist()


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """Adds ``p`` (probability of class 1) and ``prediction`` (p > 0.5)."""
    out = model.transform(fill_features(df, features))
    p = vector_to_array(F.col("probability")).getItem(1)
    cols = [c for c in df.columns if c not in ("prediction",)]
    return out.select(*cols, p.alias("p")).withColumn("prediction", threshold("p"))


def iteration_log_loss(model: PipelineModel, df: DataFrame, label: str = S.LABEL) -> list[float]:
    """Binary log loss after each boosting round on ``df``, computed by Spark
    ML in one distributed pass. Spark's logistic loss is
    ``2 log(1 + exp(-2yF))``, twice the binary log loss, hence the halving."""
    gbt = model.stages[-1]
    assembled = model.stages[0].transform(fill_features(df).withColumn(label, F.col(label).cast("double")))
    return [x / 2.0 for x in gbt.evaluateEachIteration(assembled)]


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest ``by``, ties by ``tie``: one partial top-k per task."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie)).limit(k)


def topk_importance(model: PipelineModel, features: Sequence[str] = S.FEATURES, k: int = 10) -> DataFrame:
    """The k largest feature importances, descending."""
    spark = SparkSession.getActiveSession()
    gbt = model.stages[-1]
    names = [*features, "has_features"]
    rows = [(n, float(v)) for n, v in zip(names, gbt.featureImportances.toArray())]
    return top_k(spark.createDataFrame(rows, "feature string, importance double"), "importance", k, "feature")


def batch_score(
    model: PipelineModel, features_for_ids: DataFrame, features: Sequence[str] = S.FEATURES
) -> DataFrame:
    """T9: ``(actor_account_id, churn_prediction, churn_probability)``."""
    scored = predict(model, features_for_ids, features)
    return scored.select(
        S.KEY,
        F.col("prediction").alias("churn_prediction"),
        F.col("p").alias("churn_probability"),
    )


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
