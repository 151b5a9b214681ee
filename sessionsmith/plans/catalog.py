"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per build id.

All of them read the driver's tables (``events``, ``labels``,
``documents``) through the derived views in ``sources.logs`` and run the
library operators over the whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..context import _filesystem, ensure_checkpoint_dir, materialize
from ..functions.expressions import level_from_key
from ..operators import boosting
from ..operators import features as feat
from ..operators import ml
from ..operators import quality as q
from ..operators import sessions as sess
from ..sources.labels import accepted, checked_labels, rejects, scan_labels, write_metrics
from ..sources.logs import read_label_view, read_log_view, read_table, write_log_files
from . import train_pipeline as tp
from .feature_pipeline import materialize_online, preprocess, preprocess_files, run_feature_pipeline

TTL_SECONDS = 3 * 86400


def _pre(spark: SparkSession, sf: str):
    return preprocess(read_log_view(spark, sf))


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """The offline feature store: daily snapshots, written once (checkpoint)
    and then read by the point-in-time join, lookups and training."""
    return materialize(feat.feature_snapshots(_pre(spark, sf).sessions))


def q_scan_logs(spark, sf):
    return read_log_view(spark, sf)


def q_file_lineage(spark, sf):
    """Per input file: rows, accounts and time span carried with the file identity."""
    logs = sess.parse_times(read_log_view(spark, sf))
    return logs.groupBy(S.FILE).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(S.KEY).alias("n_accounts"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )


def q_filter_codes(spark, sf):
    return sess.filter_codes(read_log_view(spark, sf))


def q_parse_times(spark, sf):
    return sess.parse_times(read_log_view(spark, sf))


def q_validate_logs(spark, sf):
    return _pre(spark, sf).status


def q_validate_filtered(spark, sf):
    rules = q.file_rules(sess.session_grain(read_log_view(spark, sf)))
    return rules.select(
        S.FILE,
        F.col("n_tracked_pos").cast("bigint").alias("n_tracked_pos"),
        (F.col("n_tracked_pos") > 0).alias("passes"),
    )


#: Log files written in this process, by application and table folder: they are the input of queries over files, not a part of them.
_WRITTEN: dict[tuple[str, str], str] = {}


def _log_files(spark, sf) -> str:
    """The log view written as one Parquet file per account, in the shared folder; once for each application and table folder, again if somebody has deleted it."""
    place = (spark.sparkContext.applicationId, sf)
    if place in _WRITTEN:
        folder, fs = _filesystem(spark, _WRITTEN[place])
        if not fs.exists(folder):
            del _WRITTEN[place]
    if place not in _WRITTEN:
        path = f"{ensure_checkpoint_dir(spark)}/raw-{uuid.uuid4().hex}"
        write_log_files(read_log_view(spark, sf), path)
        _WRITTEN[place] = path
    return _WRITTEN[place]


def q_file_status(spark, sf):
    """Files by status, of a run over real files."""
    return q.file_status_counts(preprocess_files(spark, _log_files(spark, sf)).status)


def q_feature_pipeline(spark, sf):
    """Files in, feature table out: listing, footers, scan, validation, sessions, contract check, write."""
    out = f"{ensure_checkpoint_dir(spark)}/features-{uuid.uuid4().hex}"
    return run_feature_pipeline(spark, _log_files(spark, sf), out)


def q_materialize(spark, sf):
    """The online view as it is written and read back."""
    return materialize_online(_snapshots(spark, sf), f"{ensure_checkpoint_dir(spark)}/online-{uuid.uuid4().hex}")


def q_materialize_upsert(spark, sf):
    """The online view after three updates by range: the newer half of the time, the older half, the newer half again."""
    snapshots = _snapshots(spark, sf)
    r = feat.feature_time_range(snapshots).first()
    if r.total_records == 0:
        return feat.latest_in_range(snapshots)
    middle = r.min_time + (r.max_time - r.min_time) / 2
    path = f"{ensure_checkpoint_dir(spark)}/online-{uuid.uuid4().hex}"
    for start, end in ((middle, None), (None, middle), (middle, None)):
        view = materialize_online(snapshots, path, start=start, end=end)
    return view


def q_scan_labels(spark, sf):
    """Labels from CSV files with another column order, one more column, labels such as ``1.0`` and some missing."""
    path = f"{ensure_checkpoint_dir(spark)}/labels-{uuid.uuid4().hex}"
    events = read_table(spark, sf, "events").where("event_type = 'purchase'")
    text = F.when(F.pmod("event_id", F.lit(13)) == 0, F.lit(None)).when(F.col("value") < 20, "1.0").otherwise("0.0")
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    events.select(text.alias(S.LABEL), F.lit("x").alias("note"), F.col("user_id").alias(S.KEY), time.alias(S.LABEL_TIME)).write.option("header", True).csv(path)
    return scan_labels(spark, path)


def _ragged_labels(spark, sf) -> str:
    """Label files in four folders, in which five rows of 17 are broken, each in its own way."""
    path = f"{ensure_checkpoint_dir(spark)}/labels-{uuid.uuid4().hex}"
    kind = F.pmod("event_id", F.lit(17))
    time = F.when(kind == 2, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    label = F.when(kind == 3, "maybe").when(kind == 4, "0.5").when(kind == 5, "").when(F.col("value") < 20, "1").otherwise("0")
    line = F.concat_ws(",", F.col("user_id").cast("string"), time, label)
    line = F.when(kind == 0, line).when(kind == 1, F.concat(line, F.lit(",a,b"))).otherwise(F.concat(line, F.lit(",a")))
    header = f"{S.KEY},{S.LABEL_TIME},{S.LABEL},note"
    rows = read_table(spark, sf, "events").where("event_type = 'purchase'").select(line.alias(header), F.pmod("event_id", F.lit(4)).alias("batch"))
    # A whole line is one value: its commas are not the separator of this write.
    rows.write.partitionBy("batch").option("header", True).option("sep", "\u0001").csv(path)
    return path


def q_label_rejects(spark, sf):
    """Broken rows of label files, with their folder and the reason."""
    found = rejects(checked_labels(spark, _ragged_labels(spark, sf)))
    return found.select(F.regexp_extract(S.FILE, "batch=([0-9]+)", 1).alias("batch"), "reason", "record")


def q_labels_accepted(spark, sf):
    """The labels of the other rows of those files."""
    return accepted(checked_labels(spark, _ragged_labels(spark, sf)))


def q_drop_null_labels(spark, sf):
    return ml.drop_null_labels(q_scan_labels(spark, sf))


def q_quarantine(spark, sf):
    logs = read_log_view(spark, sf)
    ok = q.validate_logs(_pre(spark, sf).grain, with_reasons=False)  # status only, no message text
    return q.quarantine(logs, ok)


def q_session_boundaries(spark, sf):
    return sess.session_boundaries(sess.session_grain(read_log_view(spark, sf)))


def q_session_starts(spark, sf):
    return sess.session_starts(sess.session_grain(read_log_view(spark, sf)))


def q_asof_forward(spark, sf):
    grain = _pre(spark, sf).grain
    attached = sess.attach_orphans(sess.orphan_events(grain), sess.session_starts(grain))
    return attached.withColumn("actor_level", level_from_key("level_key")).drop("level_key")


def q_session_event_counts(spark, sf):
    return _pre(spark, sf).sessions.select(S.FILE, S.KEY, "session", "session_date", *S.EVENT_LABELS)


def q_session_stats(spark, sf):
    return _pre(spark, sf).sessions


def q_player_features(spark, sf):
    return _pre(spark, sf).players


def q_feature_snapshots(spark, sf):
    return _snapshots(spark, sf)


def q_feature_time_range(spark, sf):
    return feat.feature_time_range(_pre(spark, sf).players)


def q_latest_per_key(spark, sf):
    return feat.latest_in_range(_snapshots(spark, sf))


def q_lookup_features(spark, sf):
    ids = read_label_view(spark, sf).select(S.KEY).distinct()
    return feat.lookup_features(ids, feat.latest_per_key(_snapshots(spark, sf)))


def q_pit_join(spark, sf):
    return tp.pit_join(read_label_view(spark, sf), _snapshots(spark, sf))


def q_pit_join_ttl(spark, sf):
    return tp.pit_join(read_label_view(spark, sf), _snapshots(spark, sf), ttl_seconds=TTL_SECONDS)


def q_pit_join_ranges(spark, sf):
    """The point-in-time join as a prefix scan over ranges that the rows themselves cut."""
    return tp.pit_join(read_label_view(spark, sf), _snapshots(spark, sf), by_ranges=True)


def q_label_join(spark, sf):
    return tp.training_set(read_label_view(spark, sf), _snapshots(spark, sf))


def q_project_entity(spark, sf):
    """The entity frame of the point-in-time join: key and time of each label."""
    return read_label_view(spark, sf).select(S.KEY, S.LABEL_TIME)


def q_label_distribution(spark, sf):
    return ml.label_distribution(read_label_view(spark, sf))


def q_label_stats(spark, sf):
    return ml.label_stats(read_label_view(spark, sf))


def q_project_features(spark, sf):
    return ml.project_features(tp.training_set(read_label_view(spark, sf), _snapshots(spark, sf)))


def q_stratified_split(spark, sf):
    labels = read_label_view(spark, sf)
    return ml.stratified_split(labels)


def _doc_scores(spark, sf) -> DataFrame:
    """Stand-in classifier on the given tables: quality label of a document
    against a length score ``n_chars / (n_chars + 2000)``."""
    labels = read_table(spark, sf, "labels").select("doc_id", F.col("quality").alias(S.LABEL))
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    p = F.col("n_chars").cast("double") / (F.col("n_chars").cast("double") + F.lit(2000.0))
    return labels.join(docs, "doc_id").select(S.LABEL, p.alias("p"), ml.threshold(p).alias("prediction"))


def q_binary_metrics(spark, sf):
    return ml.binary_metrics(_doc_scores(spark, sf))


def q_log_loss(spark, sf):
    return ml.log_loss(_doc_scores(spark, sf))


def q_evaluate(spark, sf):
    return ml.evaluate(_doc_scores(spark, sf))


def q_topk(spark, sf):
    """The ten documents with the highest score."""
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    return ml.top_k(docs, "n_chars", 10, "doc_id")


def q_head_sample(spark, sf):
    """The first rows of the feature table, as a run logs them."""
    return _pre(spark, sf).players.orderBy(S.KEY).limit(5)


def q_write_metrics(spark, sf):
    """Label statistics of two runs, appended to the metrics table and read back."""
    path = f"{ensure_checkpoint_dir(spark)}/metrics-{uuid.uuid4().hex}"
    stats = ml.label_stats(read_label_view(spark, sf))
    for run in ("a", "b"):
        write_metrics(tp.to_long(stats, "").select(F.lit(run).alias("run_id"), "metric", "value", F.lit(None).cast("string").alias("text")), path)
    return spark.read.parquet(path).select("run_id", "metric", "value")


def q_row_counts(spark, sf):
    """Rows of each stage. Raw and tracked rows are sums of the grain; sessions are counted by account, so that one pass counts both and nothing is written for it."""
    pre = _pre(spark, sf)
    rows = pre.grain.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("raw_rows"), F.coalesce(F.sum("n_tracked"), F.lit(0)).alias("tracked_rows"))
    out = rows.selectExpr("stack(2, 'raw_rows', raw_rows, 'tracked_rows', tracked_rows) AS (table_name, n_rows)")
    by_account = pre.sessions.groupBy(S.KEY).agg(F.count(F.lit(1)).alias("n"))
    both = by_account.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("sessions"), F.count(F.lit(1)).alias("accounts"))
    labels = read_label_view(spark, sf).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("labels").alias("table_name"), "n_rows")
    return out.unionByName(both.selectExpr("stack(2, 'sessions', sessions, 'accounts', accounts) AS (table_name, n_rows)")).unionByName(labels)


def _trained(spark, sf, snapshots=None):
    snapshots = _snapshots(spark, sf) if snapshots is None else snapshots
    return tp.train_model_pipeline(spark, read_label_view(spark, sf), snapshots, run_id="bench")


def q_train_gbt(spark, sf):
    return _trained(spark, sf).metrics


def q_topk_importance(spark, sf):
    return _trained(spark, sf).importances


def q_batch_score(spark, sf):
    """Train on the snapshot store, then score every labelled account from
    the online view (newest snapshot per account)."""
    snapshots = _snapshots(spark, sf)
    res = _trained(spark, sf, snapshots)
    online = feat.latest_per_key(snapshots)
    ids = read_label_view(spark, sf).select(S.KEY).distinct()
    return tp.score_accounts(res.model, ids, online)


def q_write_model(spark, sf):
    """The trained model written and read back scores every row of all splits alike."""
    res = _trained(spark, sf)
    model, data = res.model, res.split
    path = ml.save_model(model, f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}")
    both = ml.predict(ml.load_model(path), ml.predict(model, data).withColumnsRenamed({"p": "p_before", "prediction": "prediction_before"}))
    alike = (F.col("p") == F.col("p_before")) & (F.col("prediction") == F.col("prediction_before"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~alike).alias("n_different"))


#: Cut points of the query ``grow_tree``, so that SQL can bin alike.
TREE_CUTS = {"n_chars": [250.0 * k for k in range(1, 24)], "n_lines": [0.0, 1.0, 2.0, 4.0, 8.0, 16.0], "n_spaces": [40.0 * k for k in range(1, 24)]}


def q_grow_tree(spark, sf):
    """The best split of a leaf-wise tree over the labelled documents, as the table of its nodes. Every seventh document lacks its length."""
    docs = read_table(spark, sf, "documents").select(
        "doc_id", F.when(F.pmod("doc_id", F.lit(7)) != 0, F.col("n_chars")).alias("n_chars"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).alias("n_lines"), (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("n_spaces"))
    data = read_table(spark, sf, "labels").select("doc_id", F.col("quality").alias(S.LABEL)).join(docs, "doc_id")
    params = {"num_boost_round": 1, "num_leaves": 2, "bagging_fraction": 1.0, "feature_fraction": 1.0}
    model = boosting.train(data, list(TREE_CUTS), S.LABEL, params=params, edges=list(TREE_CUTS.values()))
    return model.node_table(spark).select("node", "feature", "threshold", "missing_left", "left", "right", F.round("gain", 6).alias("gain"), F.round("value", 9).alias("value"), "n_rows")


def q_assemble(spark, sf):
    """Facts of the model's input vectors: one per row, of one length, without nulls; rows without features are marked."""
    data = tp.training_set(read_label_view(spark, sf), _snapshots(spark, sf))
    vector = vector_to_array("features")
    rows = ml.assembler().transform(ml.fill_features(data))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.size(vector)).cast("bigint").alias("shortest"),
        F.max(F.size(vector)).cast("bigint").alias("longest"),
        F.count_if(F.exists(vector, F.isnan)).alias("n_undefined"),
        F.count_if(F.element_at(vector, -1) == 0).alias("n_without_features"),
    )


def q_batch_score_facts(spark, sf):
    """What must hold for scores of the trained model, as of any: one per id, probabilities, and the threshold's decision."""
    snapshots = _snapshots(spark, sf)
    model = _trained(spark, sf, snapshots).model
    ids = read_label_view(spark, sf).select(S.KEY).distinct()
    scores = tp.score_accounts(model, ids, feat.latest_per_key(snapshots))
    p = F.col("churn_probability")
    return scores.agg(
        F.count(F.lit(1)).alias("n_scores"),
        F.countDistinct(S.KEY).alias("n_ids"),
        F.count_if(p.between(0, 1)).alias("n_probabilities"),
        F.count_if((F.col("churn_prediction") == 1) == (p > S.THRESHOLD)).alias("n_decided"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_logs": q_scan_logs,
    "file_lineage": q_file_lineage,
    "filter_codes": q_filter_codes,
    "parse_times": q_parse_times,
    "validate_logs": q_validate_logs,
    "validate_filtered": q_validate_filtered,
    "file_status": q_file_status,
    "quarantine": q_quarantine,
    "feature_pipeline": q_feature_pipeline,
    "materialize": q_materialize,
    "materialize_upsert": q_materialize_upsert,
    "scan_labels": q_scan_labels,
    "label_rejects": q_label_rejects,
    "labels_accepted": q_labels_accepted,
    "drop_null_labels": q_drop_null_labels,
    "session_boundaries": q_session_boundaries,
    "session_starts": q_session_starts,
    "asof_forward": q_asof_forward,
    "session_event_counts": q_session_event_counts,
    "session_stats": q_session_stats,
    "player_features": q_player_features,
    "feature_snapshots": q_feature_snapshots,
    "feature_time_range": q_feature_time_range,
    "latest_per_key": q_latest_per_key,
    "lookup_features": q_lookup_features,
    "pit_join": q_pit_join,
    "pit_join_ttl": q_pit_join_ttl,
    "pit_join_ranges": q_pit_join_ranges,
    "label_join": q_label_join,
    "project_entity": q_project_entity,
    "label_distribution": q_label_distribution,
    "label_stats": q_label_stats,
    "project_features": q_project_features,
    "stratified_split": q_stratified_split,
    "binary_metrics": q_binary_metrics,
    "log_loss": q_log_loss,
    "evaluate": q_evaluate,
    "topk": q_topk,
    "head_sample": q_head_sample,
    "write_metrics": q_write_metrics,
    "write_model": q_write_model,
    "assemble": q_assemble,
    "grow_tree": q_grow_tree,
    "batch_score_facts": q_batch_score_facts,
    "row_counts": q_row_counts,
    "train_gbt": q_train_gbt,
    "topk_importance": q_topk_importance,
    "batch_score": q_batch_score,
}
