"""Parsing, boundaries, orphan events, session statistics, event counts."""

from __future__ import annotations

import datetime as dt

from conftest import raw_logs, ts
from pyspark.sql import functions as F

from sessionsmith import schema as S
from sessionsmith.operators import sessions as sess
from sessionsmith.plans.feature_pipeline import preprocess


def T(hm, day=15):
    return f"2024-01-{day:02d} {hm}:00.000"


def sessions_of(spark, rows):
    return preprocess(raw_logs(spark, rows)).sessions


class TestParse:
    def test_types_and_date(self, spark):
        df = sess.parse_times(spark.createDataFrame([("2024-01-15 10:30:45.123", 7)], "time string, other_col int"))
        r = df.collect()[0]
        assert dict(df.dtypes)["timestamp"] == "timestamp_ntz"
        assert dict(df.dtypes)["session_date"] == "date"
        assert r["timestamp"] == dt.datetime(2024, 1, 15, 10, 30, 45, 123000)
        assert r["session_date"] == dt.date(2024, 1, 15)
        assert r["other_col"] == 7

    def test_bad_text_is_null(self, spark):
        df = sess.parse_times(spark.createDataFrame([("2024-01-15 10:30:45",)], "time string"))
        assert df.collect()[0]["timestamp"] is None


class TestBoundaries:
    def test_two_sessions(self, spark):
        rows = [
            (T("10:00"), 1013, 1, 0, "player1", 1),
            (T("10:30"), 9999, 1, 0, "player1", 1),
            (T("10:45"), 1101, 1, 0, "player1", 1),
            (T("11:00"), 1013, 2, 0, "player1", 1),
            (T("11:30"), 9999, 2, 0, "player1", 1),
        ]
        b = sess.session_boundaries(sess.session_grain(raw_logs(spark, rows)))
        got = {r["session"]: (r["first_ts"], r["last_ts"], r["actor_id"]) for r in b.collect()}
        assert got[1] == (ts("2024-01-15 10:00"), ts("2024-01-15 10:45"), "player1")
        assert got[2] == (ts("2024-01-15 11:00"), ts("2024-01-15 11:30"), "player1")

    def test_boundary_wins_over_tracked_rows(self, spark):
        # tracked events 10:10-10:20, untracked rows widen the session to 10:00-10:25
        rows = [
            (T("10:00"), 9999, 1, 0, "p", 10),
            (T("10:10"), 1013, 1, 0, "p", 10),
            (T("10:20"), 1013, 1, 0, "p", 10),
            (T("10:25"), 9999, 1, 0, "p", 10),
        ]
        out = sessions_of(spark, rows).collect()
        assert len(out) == 1
        assert out[0]["first_timestamp"] == ts("2024-01-15 10:00")
        assert out[0]["session_duration_minutes"] == 25


class TestOrphans:
    def _attached(self, spark, rows):
        grain = sess.session_grain(raw_logs(spark, rows))
        return sess.attach_orphans(sess.orphan_events(grain), sess.session_starts(grain))

    def test_no_orphans(self, spark):
        rows = [(T("10:00"), 1013, 1, 0, "p", 1), (T("11:00"), 1101, 2, 0, "p", 1), (T("12:00"), 1202, 3, 0, "p", 1)]
        assert self._attached(spark, rows).count() == 0
        assert sessions_of(spark, rows).count() == 3

    def test_matched_to_next_session(self, spark):
        rows = [(T("10:00"), 1012, 0, 1, "p", 1), (T("10:30"), 1013, 1, 0, "p", 1), (T("11:00"), 1101, 2, 0, "p", 1)]
        a = self._attached(spark, rows).collect()
        assert [(r["session"], r["timestamp"]) for r in a] == [(1, ts("2024-01-15 10:00"))]
        s1 = [r for r in sessions_of(spark, rows).collect() if r["session"] == 1][0]
        assert s1["delete_pc"] == 1 and s1["pc_level_up"] == 1
        # the boundary (raw rows of session 1) still wins: 10:30-10:30
        assert s1["first_timestamp"] == ts("2024-01-15 10:30")

    def test_no_later_session_drops(self, spark):
        rows = [(T("10:00"), 1013, 1, 0, "p", 1), (T("11:00"), 1012, 0, 1, "p", 1)]
        assert self._attached(spark, rows).count() == 0
        out = sessions_of(spark, rows).collect()
        assert len(out) == 1 and out[0]["delete_pc"] == 0

    def test_each_orphan_gets_its_own_next_session(self, spark):
        # D1: matched by position in time, not by row label
        rows = [
            (T("10:00"), 1013, 1, 0, "p", 1),
            (T("10:30"), 1012, 0, 1, "p", 1),
            (T("11:00"), 1013, 2, 0, "p", 1),
            (T("11:30"), 1012, 0, 1, "p", 1),
            (T("12:00"), 1013, 3, 0, "p", 1),
        ]
        got = sorted((r["timestamp"], r["session"]) for r in self._attached(spark, rows).collect())
        assert got == [(ts("2024-01-15 10:30"), 2), (ts("2024-01-15 11:30"), 3)]

    def test_other_session_zero_rows_are_dropped(self, spark):
        # D2: a tracked session-0 row that is not an orphan delete is dropped
        rows = [
            (T("10:00"), 1012, 0, 1, "p", 1),
            (T("10:10"), 1013, 0, 0, "p", 1),
            (T("10:30"), 1013, 1, 0, "p", 1),
        ]
        out = sessions_of(spark, rows).collect()
        assert len(out) == 1
        assert out[0]["pc_level_up"] == 1 and out[0]["delete_pc"] == 1

    def test_orphan_across_midnight_forms_own_row(self, spark):
        # D5: the orphan keeps its own date, so it forms a zero-length row
        rows = [(T("23:50", 15), 1012, 0, 1, "p", 1), (T("00:10", 16), 1013, 1, 0, "p", 1)]
        out = sorted(sessions_of(spark, rows).collect(), key=lambda r: r["first_timestamp"])
        assert len(out) == 2
        assert out[0]["session_date"] == dt.date(2024, 1, 15)
        assert out[0]["session_duration_minutes"] == 0 and out[0]["delete_pc"] == 1
        assert out[1]["pc_level_up"] == 1

    def test_matches_many_buckets_later(self, spark):
        # next session starts days later: found through the bucket carry
        rows = [(T("10:00", 1), 1012, 0, 1, "p", 1), (T("10:00", 20), 1013, 7, 0, "p", 1)]
        a = self._attached(spark, rows).collect()
        assert [r["session"] for r in a] == [7]

    def test_equal_start_prefers_smaller_session(self, spark):
        rows = [(T("10:00"), 1012, 0, 1, "p", 1), (T("10:00"), 1013, 5, 0, "p", 1), (T("10:00"), 1013, 4, 0, "p", 1)]
        assert [r["session"] for r in self._attached(spark, rows).collect()] == [4]


class TestSessionStats:
    def test_two_sessions(self, spark):
        rows = [
            (T("10:00"), 1013, 1, 0, "player1", 10),
            (T("10:30"), 1013, 1, 0, "player1", 11),
            (T("11:00"), 1101, 2, 0, "player1", 11),
            (T("11:45"), 1101, 2, 0, "player1", 11),
        ]
        out = sessions_of(spark, rows)
        assert out.columns[:8] == [S.FILE, "session", "session_date", "first_timestamp", "last_timestamp",
                                   S.KEY, "session_duration_minutes", "actor_level"]
        got = {r["session"]: (r["session_duration_minutes"], r["actor_level"]) for r in out.collect()}
        assert got == {1: (30, 11), 2: (45, 11)}

    def test_latest_non_null_level(self, spark):
        # D3: the level of the latest tracked row with a level
        rows = [(T("10:00"), 1013, 1, 0, "p", 10), (T("10:05"), 1013, 1, 0, "p", 12), (T("10:10"), 1013, 1, 0, "p", None)]
        assert sessions_of(spark, rows).collect()[0]["actor_level"] == 12

    def test_duration_rounds_half_to_even(self, spark):
        # 30 s = 0.5 min -> 0; 90 s = 1.5 min -> 2
        rows = [
            ("2024-01-15 10:00:00.000", 1013, 1, 0, "p", 1), ("2024-01-15 10:00:30.000", 1013, 1, 0, "p", 1),
            ("2024-01-15 11:00:00.000", 1013, 2, 0, "p", 1), ("2024-01-15 11:01:30.000", 1013, 2, 0, "p", 1),
        ]
        got = {r["session"]: r["session_duration_minutes"] for r in sessions_of(spark, rows).collect()}
        assert got == {1: 0, 2: 2}


class TestEventCounts:
    def test_counts(self, spark):
        rows = [
            (T("10:00"), 1013, 1, 0, "p", 1), (T("10:01"), 1013, 1, 0, "p", 1), (T("10:02"), 1101, 1, 0, "p", 1),
            (T("11:00"), 1013, 2, 0, "p", 1), (T("11:01"), 1202, 2, 0, "p", 1),
        ]
        got = {r["session"]: r for r in sessions_of(spark, rows).collect()}
        assert got[1]["pc_level_up"] == 2 and got[1]["invite_party"] == 1
        assert got[2]["die"] == 1

    def test_all_columns_zero_filled(self, spark):
        out = sessions_of(spark, [(T("10:00"), 1013, 1, 0, "p", 1)])
        r = out.collect()[0]
        assert all(c in out.columns for c in S.EVENT_LABELS)
        assert sum(r[c] for c in S.EVENT_LABELS if c != "pc_level_up") == 0
        assert all(t == "bigint" for c, t in out.dtypes if c in S.EVENT_LABELS)

    def test_count_sum_property(self, spark):
        rows = [(T(f"10:{i:02d}"), [1013, 1101, 1202, 9999][i % 4], 1 + i % 3, 0, "p", 1) for i in range(40)]
        out = sessions_of(spark, rows)
        total = out.agg(F.sum(sum(F.col(c) for c in S.EVENT_LABELS))).collect()[0][0]
        assert total == 30  # every tracked row is counted once
