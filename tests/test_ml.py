"""Training frame, split, boosted trees, metrics, scoring (FIXTURES F10)."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from sessionsmith import schema as S
from sessionsmith.operators import ml
from sessionsmith.plans.train_pipeline import pit_join, score_account, score_accounts, train_model_pipeline


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(42)
    rows = []
    for i in range(100):
        feats = [float(rnd.randint(1, 50)) if f in S.DOUBLE_FEATURES else rnd.randint(0, 20) for f in S.FEATURES]
        y = 1 if rnd.random() < 0.3 else 0
        rows.append((f"p{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), *feats, y))
    cols = [f"{S.KEY} string", f"{S.LABEL_TIME} timestamp_ntz"]
    cols += [f"{f} {'double' if f in S.DOUBLE_FEATURES else 'bigint'}" for f in S.FEATURES]
    cols += [f"{S.LABEL} int"]
    return spark.createDataFrame(rows, ", ".join(cols))


def test_project_features(frame):
    x = ml.project_features(frame)
    assert not {S.KEY, S.LABEL_TIME, S.LABEL} & set(x.columns)
    assert len(x.columns) == 29 and x.count() == 100


def test_split_sizes_disjoint_and_stratified(frame):
    sp = ml.stratified_split(frame)
    n = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}
    assert sum(n.values()) == 100
    assert n["test"] == math.ceil(0.2 * 100)
    assert n["val"] == math.ceil(0.1 * 80)
    assert sp.select(S.KEY).distinct().count() == 100
    rate = {r["split"]: r["r"] for r in sp.groupBy("split").agg(F.avg(S.LABEL).alias("r")).collect()}
    overall = frame.agg(F.avg(S.LABEL)).collect()[0][0]
    assert abs(rate["test"] - overall) < 0.05
    # reproducible
    again = ml.stratified_split(frame).select(S.KEY, "split")
    assert again.exceptAll(sp.select(S.KEY, "split")).count() == 0


def test_split_quotas_largest_remainder(spark):
    counts = spark.createDataFrame([(0, 70), (1, 30)], f"{S.LABEL} int, n long")
    q = {r[S.LABEL]: (r["__qt"], r["__qv"]) for r in ml.split_quotas(counts).collect()}
    assert sum(t for t, _ in q.values()) == 20 and sum(v for _, v in q.values()) == 8
    assert q[1][0] == 6 and q[0][0] == 14
    odd = spark.createDataFrame([(0, 7), (1, 4), (2, 2)], f"{S.LABEL} int, n long")
    q = {r[S.LABEL]: (r["__qt"], r["__qv"]) for r in ml.split_quotas(odd).collect()}
    assert sum(t for t, _ in q.values()) == 3  # ceil(0.2 * 13)
    assert sum(v for _, v in q.values()) == 1  # ceil(0.1 * 10)


def test_train_predict_and_custom_params(frame):
    sp = frame.withColumn("is_val", F.col(S.LABEL_TIME) > F.lit("2024-01-04").cast("timestamp_ntz"))
    model = ml.train_gbt(sp, params={"maxIter": 5, "minInstancesPerNode": 1})
    assert model.stages[-1].getNumTrees == 5 or model.stages[-1].getNumTrees <= 5
    pred = ml.predict(model, frame)
    ps = [r["p"] for r in pred.select("p").collect()]
    assert all(0.0 <= p <= 1.0 for p in ps)
    assert set(r[0] for r in pred.select("prediction").distinct().collect()) <= {0, 1}
    m = ml.evaluate(pred).collect()[0]
    for k in ("accuracy", "precision", "recall", "f1"):
        assert 0.0 <= m[k] <= 1.0
    imp = ml.topk_importance(model).collect()
    assert len(imp) == 10 and imp[0]["importance"] >= imp[-1]["importance"]


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], f"{S.LABEL} int, prediction int")
    m = ml.binary_metrics(df).collect()[0]
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0
    assert m["accuracy"] == pytest.approx(2 / 3)


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 1.0)], f"{S.LABEL} int, p double")
    got = ml.log_loss(df).collect()[0]["log_loss"]
    want = -(math.log(0.9) + math.log(0.8) + math.log(1 - 1e-15)) / 3
    assert got == pytest.approx(want)


def test_pit_carries_duplicate_labels(spark):
    # D13: two label rows with the same key and time stay two rows
    feats = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), *([1] * 29))],
        ", ".join([f"{S.KEY} string", f"{S.EVENT_TIME} timestamp_ntz"] + [f"{f} bigint" for f in S.FEATURES]),
    )
    labels = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 2), 1), ("a", dt.datetime(2024, 1, 2), 0), ("a", dt.datetime(2023, 12, 1), 1)],
        f"{S.KEY} string, {S.LABEL_TIME} timestamp_ntz, {S.LABEL} int",
    )
    out = pit_join(labels, feats).collect()
    assert len(out) == 3
    assert sorted((r[S.LABEL], r["total_sessions"]) for r in out if r[S.LABEL_TIME].year == 2024) == [(0, 1), (1, 1)]
    assert [r["total_sessions"] for r in out if r[S.LABEL_TIME].year == 2023] == [None]
    ttl = pit_join(labels, feats, ttl_seconds=3600).collect()
    assert all(r["total_sessions"] is None for r in ttl)


def test_train_pipeline_and_scoring(spark, frame, tmp_path):
    snaps = frame.select(
        S.KEY, F.col(S.LABEL_TIME).alias(S.EVENT_TIME), *S.FEATURES
    )
    labels = frame.select(S.KEY, (F.col(S.LABEL_TIME) + F.expr("INTERVAL 1 HOUR")).alias(S.LABEL_TIME), S.LABEL)
    res = train_model_pipeline(spark, labels, snaps, model_path=str(tmp_path / "m"), params={"maxIter": 5})
    metrics = {r["metric"]: r["value"] for r in res.metrics.collect()}
    assert metrics["samples_test"] == 20 and metrics["total"] == 100
    assert 0 <= metrics["test_f1"] <= 1
    assert 1 <= metrics["best_iteration"] <= metrics["num_trees"] <= 5
    assert metrics["train_binary_logloss"] > 0
    tm = res.test_metrics()
    assert set(tm) == {"accuracy", "precision", "recall", "f1"} and all(0 <= v <= 1 for v in tm.values())
    ids = spark.createDataFrame([("p1",), ("unknown",)], f"{S.KEY} string")
    scores = score_accounts(ml.load_model(str(tmp_path / "m")), ids, snaps)
    assert scores.columns == [S.KEY, "churn_prediction", "churn_probability"]
    got = {r[S.KEY]: r for r in scores.collect()}
    assert set(got) == {"p1", "unknown"}
    assert 0 <= got["unknown"]["churn_probability"] <= 1
    one = score_account(ml.load_model(str(tmp_path / "m")), "p1", snaps)
    assert one[S.KEY] == "p1" and isinstance(one["will_churn"], bool)
    assert one["churn_probability"] == pytest.approx(got["p1"]["churn_probability"])


def test_scan_labels_csv_and_parquet(spark, tmp_path):
    from sessionsmith.sources.labels import scan_labels

    csv = tmp_path / "labels.csv"
    csv.write_text("actor_account_id,event_timestamp,churn_yn\n17,2024-01-05 10:00:00,1\n18,2024-01-06T11:30:00.5,0\n")
    got = scan_labels(spark, str(csv))
    assert dict(got.dtypes) == {S.KEY: "string", S.LABEL_TIME: "timestamp_ntz", S.LABEL: "int"}
    rows = sorted(got.collect())
    assert rows[0][S.LABEL_TIME] == dt.datetime(2024, 1, 5, 10) and rows[1][S.LABEL_TIME].microsecond == 500000
    pq = str(tmp_path / "labels.parquet")
    got.write.parquet(pq)
    assert sorted(scan_labels(spark, pq).collect()) == rows


def test_iteration_log_loss_is_binary_log_loss(frame):
    model = ml.train_gbt(frame, params={"maxIter": 4, "minInstancesPerNode": 1})
    per_round = ml.iteration_log_loss(model, frame)
    direct = ml.log_loss(ml.predict(model, frame)).collect()[0]["log_loss"]
    assert per_round[-1] == pytest.approx(direct, rel=1e-6)


def test_quotas_of_billions(spark):
    counts = spark.createDataFrame([(0, 4_000_000_000), (1, 2_000_000_000)], f"{S.LABEL} int, n long")
    q = {r[S.LABEL]: (r["__qt"], r["__qv"]) for r in ml.split_quotas(counts).collect()}
    assert q == {0: (800_000_000, 320_000_000), 1: (400_000_000, 160_000_000)}


def test_rows_without_a_label_have_no_split(frame):
    rows = frame.withColumn(S.LABEL, F.when(F.col(S.KEY) != "p7", F.col(S.LABEL)))
    sp = ml.stratified_split(rows)
    assert [r[S.KEY] for r in sp.where("split IS NULL").collect()] == ["p7"] and sp.count() == 100
    with pytest.raises(ValueError, match="multiple of 4"):
        ml.stratified_split(frame, buckets_bits=10)


def test_stopping_round():
    assert ml.stopping_round([3, 2, 2.5, 1, 4, 4, 4], 3) == (4, True)
    assert ml.stopping_round([3, 2, 2.5, 1, 4, 4], 3) == (4, False)
    assert ml.stopping_round([3, 4, 5], 2) == (1, True)
    assert ml.stopping_round([1], 10) == (1, False)


def test_training_goes_on_after_a_worse_round(spark):
    """The best round is kept, and it may lie after rounds that got worse."""
    rnd = random.Random(3)
    rows = []
    for i in range(240):
        x = [rnd.random() for _ in S.FEATURES]
        rows.append((*x, int(x[0] + 0.5 * x[1] + 0.3 * rnd.random() > 0.9), i % 4 == 0))
    df = spark.createDataFrame(rows, ", ".join([f"{f} double" for f in S.FEATURES] + [f"{S.LABEL} int", "is_val boolean"]))
    params = {"maxIter": 30, "stepSize": 0.1, "maxDepth": 3, "minInstancesPerNode": 2, "subsamplingRate": 0.3}
    model = ml.train_gbt(df, params=params, patience=6)
    full = ml.train_gbt(df.where("not is_val"), params=params, val_col=None)
    losses = ml.iteration_log_loss(full, df.where("is_val"))
    best, _ = ml.stopping_round(losses, 6)
    assert model.stages[-1].getNumTrees == best
    first_worse = next(i for i in range(1, len(losses)) if losses[i] >= losses[i - 1])
    assert best > first_worse, losses
    kept = ml.iteration_log_loss(model, df.where("is_val"))
    assert kept == pytest.approx(losses[:best])


def test_run_record(spark, frame, tmp_path):
    snaps = frame.select(S.KEY, F.col(S.LABEL_TIME).alias(S.EVENT_TIME), *S.FEATURES)
    labels = frame.select(S.KEY, (F.col(S.LABEL_TIME) + F.expr("INTERVAL 1 HOUR")).alias(S.LABEL_TIME), S.LABEL)
    path = str(tmp_path / "metrics")
    for run in ("r1", "r2"):
        train_model_pipeline(spark, labels, snaps, params={"maxIter": 2}, run_id=run, metrics_path=path, paths={"labels": "x.csv"})
    got = {(r.run_id, r.metric): (r.value, r.text) for r in spark.read.parquet(path).collect()}
    assert got["r1", "total_samples"][0] == 100 and got["r2", "num_features"][0] == 29
    assert got["r1", "param_maxIter"][0] == 2 and got["r1", "param_featureSubsetStrategy"][1] == "0.9"
    assert got["r1", "path_labels"][1] == "x.csv" and got["r1", "seed"][0] == S.SEED
    assert sum(m.startswith("importance_") for r, m in got if r == "r1") == 10


def test_replayed_run_is_there_once(spark, tmp_path):
    from sessionsmith.sources.labels import write_metrics

    path = str(tmp_path / "metrics")
    for run, values in (("a", [1.0, 2.0]), ("b", [3.0]), ("a", [4.0])):
        rows = [(run, f"m{i}", v, None) for i, v in enumerate(values)]
        write_metrics(spark.createDataFrame(rows, "run_id string, metric string, value double, text string"), path)
    got = spark.read.parquet(path).select("run_id", "metric", "value").collect()
    assert sorted(map(tuple, got)) == [("a", "m0", 4.0), ("b", "m0", 3.0)]


def test_labels_by_name(spark, tmp_path):
    """Columns in any order, floats, bad values counted, compressed files and folders."""
    import gzip

    from sessionsmith.sources.labels import label_issues, read_raw_labels, scan_labels

    text = "churn_yn,note,actor_account_id,event_timestamp\n1.0,a,17,2024-01-05 10:00:00\n,b,18,never\nx,c,19,2024-01-06T11:30:00.5\n0,d,20,\n"
    folder = tmp_path / "labels"
    folder.mkdir()
    (folder / "part-0.csv").write_text(text)
    zipped = tmp_path / "labels.csv.gz"
    zipped.write_bytes(gzip.compress(text.encode()))
    for path in (str(folder), str(zipped)):
        got = {r[S.KEY]: (r[S.LABEL_TIME], r[S.LABEL]) for r in scan_labels(spark, path).collect()}
        assert got == {"17": (dt.datetime(2024, 1, 5, 10), 1), "18": (None, None), "19": (dt.datetime(2024, 1, 6, 11, 30, 0, 500000), None), "20": (None, 0)}
        issues = label_issues(read_raw_labels(spark, path)).first().asDict()
        assert issues == {"rows": 4, "bad_times": 1, "bad_labels": 1, "null_labels": 1}
    (tmp_path / "lacking.csv").write_text("actor_account_id,churn_yn\n1,1\n")
    with pytest.raises(ValueError, match="event_timestamp"):
        scan_labels(spark, str(tmp_path / "lacking.csv"))


def test_broken_label_rows_go_to_a_rejects_table(spark, tmp_path):
    """Too few and too many fields, bad times and labels, with file and text; the others are as scan_labels gives them, whichever columns are asked for."""
    from sessionsmith.sources.labels import accepted, checked_labels, rejects, scan_labels

    folder = tmp_path / "labels"
    (folder / "day 2").mkdir(parents=True)
    header = "churn_yn,a.note,actor_account_id,event_timestamp\n"
    (folder / "one.csv").write_text(header + "1.0,a,17,2024-01-05 10:00:00\n1,b,18\n0,c,19,2024-01-05 10:00:00,d\n1,e,20,never\n,f,21,\n")
    (folder / "day 2" / "two.csv").write_text(header + 'x,"g,h",22,2024-01-06\n0.5,,23,2024-01-06\nx,i,24,never\n0,j,25,2024-01-06\n')
    checked = checked_labels(spark, str(folder))
    got = sorted((r[S.FILE].rsplit("/", 1)[1], r.reason, r.record) for r in rejects(checked).collect())
    assert got == [
        ("one.csv", "fields", "0,c,19,2024-01-05 10:00:00,d"), ("one.csv", "fields", "1,b,18"), ("one.csv", "time", "1,e,20,never"),
        ("two.csv", "label", "0.5,,23,2024-01-06"), ("two.csv", "label", 'x,"g,h",22,2024-01-06'), ("two.csv", "time", "x,i,24,never"),
    ]
    good = accepted(checked)
    assert sorted(r[S.KEY] for r in good.select(S.KEY).collect()) == ["17", "21", "25"]
    assert {r[S.KEY]: (r[S.LABEL_TIME], r[S.LABEL]) for r in good.collect()} == {
        "17": (dt.datetime(2024, 1, 5, 10), 1), "21": (None, None), "25": (dt.datetime(2024, 1, 6), 0)}
    assert good.schema == scan_labels(spark, str(folder / "one.csv")).schema
    assert rejects(checked).select("reason").where("reason = 'fields'").count() == 2 and checked.count() == 9
    (tmp_path / "empty.csv").write_text(header)
    assert checked_labels(spark, str(tmp_path / "empty.csv")).count() == 0
    (tmp_path / "lacking.csv").write_text("actor_account_id,churn_yn\n1,1\n")
    with pytest.raises(ValueError, match="event_timestamp"):
        checked_labels(spark, str(tmp_path / "lacking.csv"))


@pytest.mark.parametrize("name", ["write_model", "batch_score_facts"])
def test_model_queries_run_the_full_training(spark, monkeypatch, name):
    """Default rounds, with a validation set, so that patience and the best round are run."""
    from sessionsmith.plans.catalog import QUERIES

    train, calls = ml.train_gbt, []

    def recorded(data, **options):
        calls.append((options.get("params"), data.columns))
        return train(data, **options)

    monkeypatch.setattr(ml, "train_gbt", recorded)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == 1
    assert calls and all(not params and "is_val" in columns for params, columns in calls)
