"""Validation rules, code filter, filtered-data check, quarantine, file status."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import raw_logs
from pyspark.sql import functions as F

from sessionsmith import schema as S
from sessionsmith.operators import quality as q
from sessionsmith.operators import sessions as sess
from sessionsmith.plans.feature_pipeline import preprocess_files, check_feature_contract, preprocess, run_feature_pipeline
from sessionsmith.sources.logs import footer_listing, scan_logs

OK = "2024-01-15 10:30:45.123"


def status_of(spark, rows):
    logs = raw_logs(spark, rows)
    st = q.validate_logs(sess.session_grain(logs), None, logs).collect()
    assert len(st) == 1
    return st[0]["status"], st[0]["reason"]


VALID = [
    (OK, 1013, 1, 0, "player1", 10),
    ("2024-01-15 10:31:45.123", 1101, 2, 0, "player1", 11),
    ("2024-01-15 10:32:45.123", 1202, 3, 0, "player1", 12),
]


class TestValidateRaw:
    def test_valid(self, spark):
        assert status_of(spark, VALID) == ("success", "")

    def test_null_time(self, spark):
        rows = [VALID[0], (None,) + VALID[1][1:], VALID[2]]
        status, reason = status_of(spark, rows)
        assert status == "skipped" and "Null" in reason and "time" in reason

    def test_null_account_checked_on_raw_column(self, spark):
        # D6: a null account is not turned into the text "None"
        rows = [VALID[0], VALID[1][:4] + (None, 11), VALID[2]]
        status, reason = status_of(spark, rows)
        assert reason == "Null values found in critical columns: ['actor_account_id']"

    def test_bad_time_format(self, spark):
        rows = [("2024-01-15 10:30:45",) + VALID[0][1:], VALID[1], VALID[2]]
        status, reason = status_of(spark, rows)
        assert "timestamp format" in reason and "2024-01-15 10:30:45" in reason

    def test_bad_time_in_later_row(self, spark):
        # D8: every row is checked, not only the first
        rows = [VALID[0], VALID[1], ("2024/01/15 10:32:45.123",) + VALID[2][1:]]
        assert "timestamp format" in status_of(spark, rows)[1]

    def test_negative_session(self, spark):
        rows = [VALID[0], VALID[1][:2] + (-1,) + VALID[1][3:], VALID[2]]
        status, reason = status_of(spark, rows)
        assert "session" in reason and "negative" in reason

    def test_negative_level(self, spark):
        rows = [VALID[0], VALID[1][:5] + (-5,), VALID[2]]
        reason = status_of(spark, rows)[1]
        assert "actor_level" in reason and "negative" in reason

    def test_high_level(self, spark):
        rows = [VALID[0], VALID[1][:5] + (150,), VALID[2]]
        assert "55" in status_of(spark, rows)[1]

    def test_rule_order_nulls_before_levels(self, spark):
        rows = [VALID[0][:5] + (150,), (None,) + VALID[1][1:], VALID[2]]
        assert "Null" in status_of(spark, rows)[1]

    def test_no_tracked_positive_session(self, spark):
        rows = [(OK, 1013, 0, 0, "p", 1), (OK, 9999, 1, 0, "p", 1)]
        assert status_of(spark, rows) == ("skipped", S.MSG_NO_SESSIONS)


class TestFilterCodes:
    def _kept(self, spark, pairs):
        rows = [(OK, lid, 1, det, "p", 1) for lid, det in pairs]
        return sess.filter_codes(raw_logs(spark, rows)).count() if rows else 0

    def test_simple_codes(self, spark):
        assert self._kept(spark, [(1013, 0), (9999, 0), (1101, 0), (8888, 0), (1202, 0)]) == 3

    def test_detail_pairs(self, spark):
        assert self._kept(spark, [(1012, 1), (1012, 2), (1102, 1), (1102, 2), (9999, 1)]) == 2

    def test_empty(self, spark):
        df = raw_logs(spark, [])
        assert sess.filter_codes(df).count() == 0

    def test_none_match(self, spark):
        assert self._kept(spark, [(9999, 0), (8888, 0), (7777, 0)]) == 0

    def test_predicate_is_pushed_to_parquet(self, spark, tmp_path):
        path = str(tmp_path / "logs")
        raw_logs(spark, VALID).drop(S.FILE).write.parquet(path)
        plan = sess.filter_codes(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters" in plan and "In(logid" in plan


class TestValidateFiltered:
    def _passes(self, spark, sessions):
        rows = [(OK, 1013, s_, 0, "p", 1) for s_ in sessions]
        rules = q.file_rules(sess.session_grain(raw_logs(spark, rows))).collect()
        return bool(rules and rules[0]["n_tracked_pos"] > 0)

    def test_positive(self, spark):
        assert self._passes(spark, [1, 2, 3])

    def test_empty(self, spark):
        assert not self._passes(spark, [])

    def test_no_positive(self, spark):
        assert not self._passes(spark, [0, 0, -1])


def _write(path, table):
    pq.write_table(table, path)


def _good_table(n=3, account="a1"):
    return pa.table(
        {
            "time": [f"2024-01-15 10:3{i}:45.123" for i in range(n)],
            "logid": pa.array([1013] * n, pa.int32()),
            "session": pa.array([1] * n, pa.int64()),
            "log_detail_code": pa.array([0] * n, pa.int32()),
            "actor_account_id": [account] * n,
            "actor_level": pa.array([10] * n, pa.int32()),
        }
    )


class TestFiles:
    def test_missing_dir_and_no_files(self, spark, tmp_path):
        assert scan_logs(spark, str(tmp_path / "nope")) is None
        (tmp_path / "empty").mkdir()
        (tmp_path / "empty" / "readme.txt").write_text("x")
        assert scan_logs(spark, str(tmp_path / "empty")) is None

    def test_file_status_and_pipeline(self, spark, tmp_path):
        raw = tmp_path / "raw"
        raw.mkdir()
        _write(str(raw / "good.parquet"), _good_table(account="a1"))
        _write(str(raw / "good2.parquet"), _good_table(account="a2"))
        _write(str(raw / "empty.parquet"), _good_table(0))
        missing = _good_table().drop(["log_detail_code"])
        _write(str(raw / "missing.parquet"), missing)
        typed = _good_table().set_column(1, "logid", pa.array(["a", "b", "c"]))
        _write(str(raw / "typed.parquet"), typed)
        (raw / "broken.parquet").write_bytes(b"not a parquet file")
        logs = scan_logs(spark, str(raw))
        footers = q.footer_facts(footer_listing(spark, str(raw)))
        pre = preprocess(logs, footers)
        st = {r[S.FILE].rsplit("/", 1)[-1]: (r["status"], r["reason"]) for r in pre.status.collect()}
        assert st["good.parquet"] == ("success", "")
        assert st["good2.parquet"] == ("success", "")
        assert st["empty.parquet"] == ("skipped", S.MSG_EMPTY)
        assert st["missing.parquet"][0] == "skipped" and "log_detail_code" in st["missing.parquet"][1]
        assert st["typed.parquet"] == ("skipped", "Column 'logid' must be numeric")
        assert st["broken.parquet"][0] == "failed"
        counts = {r["status"]: r["files"] for r in q.file_status_counts(pre.status).collect()}
        assert counts == {"success": 2, "skipped": 3, "failed": 1}
        # only the two good files reach the feature table
        out = run_feature_pipeline(spark, str(raw), str(tmp_path / "features"))
        assert sorted(r[S.KEY] for r in out.collect()) == ["a1", "a2"]
        assert check_feature_contract(out) == []

    def test_lineage_column(self, spark, tmp_path):
        raw = tmp_path / "raw2"
        raw.mkdir()
        _write(str(raw / "x.parquet"), _good_table())
        logs = scan_logs(spark, str(raw))
        files = [r[0] for r in logs.select(S.FILE).distinct().collect()]
        assert len(files) == 1 and files[0].endswith("x.parquet")


def test_quarantine_keeps_only_valid_files(spark):
    good = [(OK, 1013, 1, 0, "a", 1, "good")]
    bad = [(OK, 1013, -1, 0, "b", 1, "bad")]
    logs = raw_logs(spark, good + bad)
    status = q.validate_logs(sess.session_grain(logs), None, logs)
    kept = q.quarantine(logs, status).select(S.FILE).distinct().collect()
    assert [r[0] for r in kept] == ["good"]


def test_pipeline_releases_intermediate_tables(spark, tmp_path):
    import os

    from sessionsmith.context import ensure_checkpoint_dir

    raw = tmp_path / "raw3"
    raw.mkdir()
    _write(str(raw / "g.parquet"), _good_table())
    tables = os.path.join(ensure_checkpoint_dir(spark), "tables")
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    out = run_feature_pipeline(spark, str(raw), str(tmp_path / "feat"))
    assert out.count() == 1
    after = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    assert after <= before


def test_bad_time_example_from_bad_files_only(spark, tmp_path):
    raw = tmp_path / "raw4"
    raw.mkdir()
    _write(str(raw / "ok.parquet"), _good_table(account="a"))
    bad = _good_table(account="b").set_column(0, "time", pa.array(["2024-01-15 10:30:45", "2024-01-15 10:31:45.1", "x"]))
    _write(str(raw / "bad.parquet"), bad)
    st = {r[S.FILE].rsplit("/", 1)[-1]: r["reason"] for r in preprocess_files(spark, str(raw)).status.collect()}
    assert st == {"ok.parquet": "", "bad.parquet": "Invalid timestamp format: 2024-01-15 10:30:45"}


def test_footer_reader_degrades_on_unknown_store(spark):
    listing = spark.createDataFrame([("nosuchscheme://bucket/x.parquet", "nosuchscheme://bucket/x.parquet")], f"{S.FILE} string, path string")
    row = q.footer_facts(listing).collect()[0]
    assert row["read_error"] is None and row["footer_rows"] is None
    # a file of which nothing is known is not taken for an empty one
    grain = sess.session_grain(raw_logs(spark, []))
    assert q.validate_logs(grain, q.footer_facts(listing)).first()["status"] == "failed"


def _with(table, column, values):
    return table.set_column(table.schema.get_field_index(column), column, values)


def _status(pre):
    from urllib.parse import unquote

    return {unquote(r[S.FILE]).rsplit("/", 1)[-1]: (r["status"], r["reason"]) for r in pre.status.collect()}


def test_stored_types(spark, tmp_path):
    """Integers of any width, floats, unsigned and numeric account ids are read and cast."""
    raw = tmp_path / "types"
    raw.mkdir()
    files = {
        "logid": _with(_good_table(account="a1"), "logid", pa.array([1013] * 3, pa.int64())),
        "detail": _with(_good_table(account="a2"), "log_detail_code", pa.array([0] * 3, pa.int64())),
        "level": _with(_good_table(account="a3"), "actor_level", pa.array([10.0, None, 11.0])),
        "int_account": _with(_good_table(), "actor_account_id", pa.array([7] * 3, pa.int64())),
        "float_account": _with(_good_table(), "actor_account_id", pa.array([8.0] * 3)),
        "small": _with(_good_table(account="a4"), "session", pa.array([1] * 3, pa.int16())),
        "unsigned": _with(_good_table(account="a5"), "session", pa.array([1] * 3, pa.uint64())),
    }
    for name, table in files.items():
        _write(str(raw / f"{name}.parquet"), table)
    _write(str(raw / "stamped.parquet"), _with(_good_table(), "time", pa.array([0] * 3, pa.timestamp("us"))))
    pre = preprocess_files(spark, str(raw))
    status = _status(pre)
    assert status.pop("stamped.parquet")[0] == "failed"
    assert set(status.values()) == {("success", "")}
    assert sorted(r[S.KEY] for r in pre.players.collect()) == ["7", "8", "a1", "a2", "a3", "a4", "a5"]
    level = {r[S.KEY]: r.actor_level for r in pre.sessions.collect()}
    assert level["a3"] == 11


def test_names_with_special_characters(spark, tmp_path):
    raw = tmp_path / "names"
    (raw / "sub").mkdir(parents=True)
    names = ["with space", "a#b", "p%20q", "x[1]", "q?", "é", "{c}", "sub/deep"]
    for n in names:
        _write(str(raw / f"{n}.parquet"), _good_table(account=n))
    _write(str(raw / "bad[2].parquet"), _with(_good_table(account="no"), "time", pa.array(["2024-01-15 10:30:45"] * 3)))
    pre = preprocess_files(spark, str(raw))
    assert sorted(r[S.KEY] for r in pre.players.collect()) == sorted(names)
    assert _status(pre)["bad[2].parquet"] == ("skipped", "Invalid timestamp format: 2024-01-15 10:30:45")


def test_partly_read_file_fails_whole(spark, tmp_path):
    raw = tmp_path / "half"
    raw.mkdir()
    rows = _good_table().to_pandas().sample(4000, replace=True, random_state=1)
    path = str(raw / "half.parquet")
    pq.write_table(pa.Table.from_pandas(rows, schema=_good_table().schema, preserve_index=False), path, row_group_size=2000, compression="none", use_dictionary=False)
    at = pq.ParquetFile(path).metadata.row_group(1).column(0).data_page_offset
    with open(path, "r+b") as f:
        f.seek(at)
        f.write(b"\xff" * 400)
    _write(str(raw / "good.parquet"), _good_table(account="g"))
    pre = preprocess_files(spark, str(raw))
    assert _status(pre)["half.parquet"] == ("failed", "Read only 2000 of 4000 rows")
    assert [r[S.KEY] for r in pre.players.collect()] == ["g"]


def test_pipeline_outputs(spark, tmp_path):
    """Status and sessions are written; without a good file an earlier output stays."""
    raw, bad = tmp_path / "in", tmp_path / "bad"
    raw.mkdir()
    bad.mkdir()
    _write(str(raw / "g.parquet"), _good_table(account="g"))
    (raw / "x.parquet").write_bytes(b"no")
    (bad / "x.parquet").write_bytes(b"no")
    out = str(tmp_path / "out")
    got = run_feature_pipeline(spark, str(raw), out, write_sessions=str(tmp_path / "s"), write_status=str(tmp_path / "st"))
    assert [r[S.KEY] for r in got.collect()] == ["g"]
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1
    assert {r["status"]: r["files"] for r in q.file_status_counts(spark.read.parquet(str(tmp_path / "st"))).collect()} == {"success": 1, "failed": 1}
    assert run_feature_pipeline(spark, str(bad), out, write_status=str(tmp_path / "st2")) is None
    assert spark.read.parquet(out).count() == 1
    assert spark.read.parquet(str(tmp_path / "st2")).first()["status"] == "failed"


def test_workspaces_are_apart(spark, tmp_path):
    """A run that ends, well or not, takes only its own tables with it."""
    from sessionsmith.context import Workspace

    mine = Workspace(spark)
    kept = mine.materialize(spark.range(5))
    with pytest.raises(ZeroDivisionError), Workspace(spark) as other:
        other.materialize(spark.range(3))
        paths = list(other.paths)
        1 / 0  # noqa: B018
    import os

    assert kept.count() == 5 and not any(os.path.exists(p.removeprefix("file:")) for p in paths)
    mine.release()


def test_local_checkpoint_folder_is_refused_on_a_cluster(spark, monkeypatch):
    from sessionsmith import context

    class Context:
        master = "yarn"
        _jvm, _jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

        def __init__(self, conf):
            self.conf = {"spark.checkpoint.dir": "file:///tmp/x", **conf}

        def getCheckpointDir(self):  # noqa: N802
            return self.conf["spark.checkpoint.dir"]

        def getConf(self):  # noqa: N802
            return self.conf

    class Session:
        def __init__(self, conf):
            self.sparkContext = Context(conf)

    with pytest.raises(RuntimeError, match="local folder"):
        context.ensure_checkpoint_dir(Session({}))
    assert context.ensure_checkpoint_dir(Session({context.SHARED_FILES: "true"})) == "file:///tmp/x"
