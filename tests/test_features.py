"""Account features, snapshots, online view, lookups (FIXTURES F9)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sessionsmith import schema as S
from sessionsmith.operators import features as feat
from sessionsmith.plans.feature_pipeline import check_feature_contract


def sessions(spark, rows, dur_type="bigint", events=("pc_level_up", "die")):
    cols = f"{S.KEY} string, last_timestamp timestamp_ntz, session_duration_minutes {dur_type}"
    cols += "".join(f", {e} bigint" for e in events)
    return spark.createDataFrame(rows, cols)


def D(day, hour):
    return dt.datetime(2024, 1, day, hour)


class TestPlayerFeatures:
    def test_three_sessions(self, spark):
        df = sessions(spark, [("p", D(1, 10), 30, 1, 5), ("p", D(5, 11), 45, 2, 3), ("p", D(11, 12), 60, 0, 10)])
        r = feat.player_features(df).collect()[0]
        assert r["total_sessions"] == 3
        assert r["total_playtime_minutes"] == 135
        assert r["avg_session_duration_minutes"] == 45.0
        assert r["level_ups_across_all_characters"] == 3
        assert r["die"] == 18
        assert r["account_lifespan_days"] == pytest.approx(10.0, abs=0.1)
        assert r["average_sessions_per_day"] == pytest.approx(0.3, abs=0.01)
        assert r["std_session_duration_minutes"] == 15.0
        assert r[S.EVENT_TIME] == D(11, 12)

    def test_two_players(self, spark):
        df = sessions(spark, [("player1", D(1, 10), 30, 1, 0), ("player1", D(2, 10), 30, 2, 0), ("player2", D(3, 10), 30, 5, 0)])
        got = {r[S.KEY]: (r["total_sessions"], r["level_ups_across_all_characters"]) for r in feat.player_features(df).collect()}
        assert got == {"player1": (2, 3), "player2": (1, 5)}

    def test_single_session(self, spark):
        r = feat.player_features(sessions(spark, [("p", D(1, 10), 30, 0, 0)])).collect()[0]
        assert r["account_lifespan_days"] == 0.0
        assert r["average_sessions_per_day"] == 1.0
        assert r["std_session_duration_minutes"] == 0.0

    def test_fractional_durations_round_to_two_places(self, spark):
        rows = [("p", D(1, 10), 30.123456), ("p", D(2, 10), 45.789012), ("p", D(3, 10), 60.111111)]
        df = sessions(spark, rows, "double", events=())
        r = feat.player_features(df).collect()[0]
        assert r["avg_session_duration_minutes"] == round((30.123456 + 45.789012 + 60.111111) / 3, 2)
        assert all(r[c] == 0 for c in S.ACCOUNT_EVENT_LABELS)

    def test_contract_schema(self, spark):
        df = sessions(spark, [("p", D(1, 10), 30)], events=())
        assert check_feature_contract(feat.player_features(df)) == []
        assert check_feature_contract(df) != []

    def test_half_even_rounding_of_doubles(self, spark):
        # D7: 8.575 is stored as 8.57499..., so the double rounds to 8.57
        r = spark.range(1).select(F.rint(F.lit(8.575) * 100) / 100).collect()[0][0]
        assert r == 8.57

    def test_as_of(self, spark):
        df = sessions(spark, [("p", D(1, 10), 30, 1, 0), ("p", D(5, 10), 40, 1, 0)])
        r = feat.player_features(df, as_of="2024-01-03 00:00:00").collect()[0]
        assert r["total_sessions"] == 1


class TestSnapshots:
    def test_cumulative_rows_match_player_features(self, spark):
        rows = [("p", D(d, h), 10 * d + h, d % 2, h % 3) for d in (1, 2, 4) for h in (9, 13)]
        df = sessions(spark, rows)
        snaps = feat.feature_snapshots(df)
        assert snaps.count() == 3
        last = snaps.orderBy(F.col(S.EVENT_TIME).desc()).limit(1).collect()[0].asDict()
        whole = feat.player_features(df).collect()[0].asDict()
        assert last == whole
        for s in snaps.collect():
            # a snapshot never uses a session that ended after it
            upto = feat.player_features(df, as_of=s[S.EVENT_TIME]).collect()[0].asDict()
            assert s.asDict() == upto


class TestOnlineView:
    def test_latest_and_lookup(self, spark):
        rows = [("a", D(1, 10), 10, 1, 0), ("a", D(3, 10), 20, 1, 0), ("b", D(2, 10), 30, 0, 1)]
        snaps = feat.feature_snapshots(sessions(spark, rows))
        online = feat.latest_per_key(snaps)
        got = {r[S.KEY]: r["total_sessions"] for r in online.collect()}
        assert got == {"a": 2, "b": 1}
        assert feat.latest_in_range(snaps).count() == 2
        ids = spark.createDataFrame([("a",), ("zzz",)], f"{S.KEY} string")
        out = {r[S.KEY]: r["total_sessions"] for r in feat.lookup_features(ids, online).collect()}
        assert out == {"a": 2, "zzz": None}
        # the large-list path (no broadcast) gives the same rows
        limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
        for limit in limits:
            spark.conf.set(limit, "-1")
        try:
            out2 = {r[S.KEY]: r["total_sessions"] for r in feat.lookup_features(ids, online).collect()}
        finally:
            for limit in limits:
                spark.conf.unset(limit)
        assert out2 == out

    def test_time_range(self, spark):
        df = feat.player_features(sessions(spark, [("a", D(1, 10), 10, 0, 0), ("b", D(9, 10), 10, 0, 0)]))
        r = feat.feature_time_range(df).collect()[0]
        assert r["start_time"] == D(1, 10) - dt.timedelta(days=1)
        assert r["end_time"] == D(9, 10) + dt.timedelta(days=1)
        assert r["total_records"] == 2


def test_latest_in_window_and_online_sink(spark, tmp_path):
    from sessionsmith.plans.feature_pipeline import materialize_online

    rows = [("a", D(1, 10), 10, 1, 0), ("a", D(5, 10), 20, 1, 0), ("b", D(2, 10), 30, 0, 1)]
    snaps = feat.feature_snapshots(sessions(spark, rows))
    # only rows inside [start, end] count: a's newest is then its day-1 snapshot
    got = {
        r[S.KEY]: r["total_sessions"]
        for r in feat.latest_per_key(snaps, start="2024-01-01 00:00:00", end="2024-01-03 00:00:00").collect()
    }
    assert got == {"a": 1, "b": 1}
    online = materialize_online(snaps, str(tmp_path / "online"))
    assert {r[S.KEY]: r["total_sessions"] for r in online.collect()} == {"a": 2, "b": 1}
