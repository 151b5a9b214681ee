"""Plan-shape guards for the scale properties the README claims."""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import raw_logs

from sessionsmith import schema as S
from sessionsmith.operators import features as feat
from sessionsmith.operators import ml
from sessionsmith.operators import sessions as sess
from sessionsmith.sources.logs import read_label_view, scan_logs

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("rawplan")
    t = pa.table(
        {
            "time": ["2024-01-15 10:30:45.123"] * 4,
            "logid": pa.array([1013, 1012, 1101, 9999], pa.int32()),
            "session": pa.array([1, 0, 1, 1], pa.int64()),
            "log_detail_code": pa.array([0, 1, 0, 0], pa.int32()),
            "actor_account_id": ["a"] * 4,
            "actor_level": pa.array([1, 2, 3, 4], pa.int32()),
        }
    )
    pq.write_table(t, str(d / "a.parquet"))
    return str(d)


def test_raw_aggregate_is_one_hash_aggregate(spark, raw_dir):
    p = plan(sess.session_grain(scan_logs(spark, raw_dir)))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p
    assert len(re.findall(r"HashAggregate", p)) == 2  # partial + final
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert len(re.findall(r"FileScan parquet", p)) == 1


def test_asof_windows_are_bucketed(spark):
    grain = sess.session_grain(raw_logs(spark, [("2024-01-15 10:00:00.000", 1013, 1, 0, "p", 1)]))
    p = plan(sess.attach_orphans(sess.orphan_events(grain), sess.session_starts(grain)))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", p)
    assert windows, p
    # the row-level window is keyed by (file, account, fine bucket); the carry windows run over per-bucket
    # aggregates: those of one coarse bucket, and the coarse buckets of a key
    rows = [w for w in windows if "__asof_b" in w.split("windowspecdefinition")[0] or "__asof_b" in w]
    assert rows
    assert sum("__asof_b" not in w and "__asof_d" not in w for w in windows) <= 1


def test_snapshot_window_runs_over_daily_rows(spark):
    sessions = spark.createDataFrame(
        [("a", "2024-01-01 10:00:00", 3)], f"{S.KEY} string, last_timestamp string, session_duration_minutes bigint"
    ).selectExpr(S.KEY, "cast(last_timestamp as timestamp_ntz) last_timestamp", "session_duration_minutes")
    p = plan(feat.feature_snapshots(sessions))
    win = p.index("Window [")
    agg = p.index("HashAggregate", win)
    assert agg > win  # the aggregate to (account, day) sits below the window


def test_split_has_no_window_over_a_whole_class(spark):
    p = plan(ml.stratified_split(read_label_view(spark, SF)))
    lines = [ln for ln in p.splitlines() if "Window [" in ln]
    assert lines
    kinds = {"rank": 0, "histogram": 0, "class_table": 0}
    for ln in lines:
        if "row_number" in ln and "__h#" in ln:
            # the row-level rank is per (label, hash bucket)
            assert "__bk#" in ln.split("windowspecdefinition(")[1].split("__h#")[0]
            kinds["rank"] += 1
        elif "__nb#" in ln:
            kinds["histogram"] += 1  # per label, over at most 2^16 bucket rows
        else:
            # unpartitioned windows only over the one-row-per-class quota table
            assert re.search(r"\b(n#|__rest#|__fl#|__train#|_w0#)", ln), ln
            kinds["class_table"] += 1
    assert kinds["rank"] == 1 and kinds["histogram"] == 1


def test_split_reads_its_input_twice(spark):
    p = plan(ml.stratified_split(read_label_view(spark, SF)))
    assert len(re.findall(r"FileScan parquet", p)) <= 3  # the histogram's second use is a reused exchange when it runs


def test_lookup_does_not_shuffle_the_online_table(spark):
    online = spark.range(100_000).selectExpr("cast(id as string) as k", "id as v")
    ids = spark.createDataFrame([("5",), ("nobody",), ("5",)], "k string")
    got = feat.lookup_features(ids, online, key="k")
    assert sorted((r.k, r.v) for r in got.collect() if r.v is not None) == [("5", 5), ("5", 5)] and got.count() == 3
    p = plan(got)
    semi = p[p.index("LeftSemi") :]
    # the semi join takes the table as it is scanned: what is shuffled is the id list
    side = semi[semi.index("Range") - 400 : semi.index("Range")]
    assert "BroadcastHashJoin" in p and "Exchange hashpartitioning" not in side.split("Project")[-1]


def test_latest_per_key_pre_aggregates(spark):
    df = spark.createDataFrame([("a", 1, 2)], "k string, t int, v int")
    p = plan(feat.latest_per_key(df, key="k", ts="t"))
    assert "Window" not in p
    assert re.search(r"(Hash|Sort|ObjectHash)Aggregate.*partial", p.replace("\n", " "))


def test_cluster_settings_scale_with_input():
    from sessionsmith.context import cluster_settings

    big = cluster_settings(100 * 2**40)  # 100 TiB of raw logs
    # sized by the combined shuffle (5 % of input), not by raw input
    assert int(big["spark.sql.shuffle.partitions"]) == 20480
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_settings(10**6)["spark.sql.shuffle.partitions"]) == 200
