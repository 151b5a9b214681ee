"""Whole-table properties on the sf0.01 derived game logs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sessionsmith import schema as S
from sessionsmith.operators import sessions as sess
from sessionsmith.operators.asof import asof_join
from sessionsmith.operators.features import feature_snapshots
from sessionsmith.plans.feature_pipeline import preprocess
from sessionsmith.sources.logs import read_label_view, read_log_view

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pre(spark):
    return preprocess(read_log_view(spark, SF))


def test_counts_cover_every_tracked_row(spark, pre):
    logs = read_log_view(spark, SF)
    tracked = sess.filter_codes(logs)
    kept_files = pre.status.where("status = 'success'").select(S.FILE)
    tracked = tracked.join(kept_files, S.FILE, "left_semi")
    positive = tracked.where("session > 0").count()
    orphans = tracked.where(f"session = 0 AND logid = {S.ORPHAN_CODE}").count()
    attached = sess.attach_orphans(sess.orphan_events(pre.grain), sess.session_starts(pre.grain))
    attached = attached.join(kept_files, S.FILE, "left_semi").agg(F.sum("n_events")).collect()[0][0]
    total = pre.sessions.agg(F.sum(sum(F.col(c) for c in S.EVENT_LABELS))).collect()[0][0]
    # every tracked row of a positive session is counted once, plus the
    # orphans that found a later session; the other orphans are dropped
    assert 0 < attached <= orphans
    assert total == positive + attached


def test_point_in_time_never_looks_ahead(spark, pre):
    snaps = feature_snapshots(pre.sessions)
    labels = read_label_view(spark, SF)
    out = asof_join(
        labels, snaps.select(S.KEY, S.EVENT_TIME, "total_sessions"), by=[S.KEY],
        left_time=S.LABEL_TIME, right_time=S.EVENT_TIME, direction="backward", how="left",
        payload=["total_sessions"], matched_time="feature_time",
    )
    assert out.count() == labels.count()
    assert out.where(f"feature_time > {S.LABEL_TIME}").count() == 0
    # the match is the latest snapshot: none lies strictly between it and the label
    later = out.alias("o").join(
        snaps.alias("s"),
        (F.col(f"o.{S.KEY}") == F.col(f"s.{S.KEY}"))
        & (F.col(f"s.{S.EVENT_TIME}") <= F.col(f"o.{S.LABEL_TIME}"))
        & (F.col("o.feature_time").isNull() | (F.col(f"s.{S.EVENT_TIME}") > F.col("o.feature_time"))),
    )
    assert later.count() == 0


def test_sessions_are_unique_per_key(pre):
    keys = [S.FILE, S.KEY, "session", "session_date"]
    assert pre.sessions.groupBy(*keys).count().where("count > 1").count() == 0
    assert pre.players.groupBy(S.KEY).count().where("count > 1").count() == 0


def test_pit_join_bucket_width_does_not_change_result(spark, pre):
    from sessionsmith.plans.train_pipeline import pit_join

    snaps = feature_snapshots(pre.sessions)
    labels = read_label_view(spark, SF)
    day = pit_join(labels, snaps)
    hour = pit_join(labels, snaps, bucket_seconds=3600)
    assert day.exceptAll(hour).count() == 0 and hour.exceptAll(day).count() == 0
