"""On a cluster a ``file:`` checkpoint folder is used where a probe finds it shared; the queries that write there run and give their SQL's rows."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from compare import norm  # noqa: E402

from sessionsmith import context  # noqa: E402

EVENTS = """SELECT range AS event_id, range % 12 * 7 AS user_id, TIMESTAMP '2024-01-02 03:04:05.678' + to_minutes(range * 61) AS ts,
    CASE WHEN range % 3 = 0 THEN 'purchase' ELSE 'view' END AS event_type, (range * 37 % 101) * 0.5 AS value FROM range(900)"""
DOCUMENTS = """SELECT range AS doc_id, repeat('some words' || chr(10), (range * 7 % 40 + 1)::INT) AS text, 'en' AS lang, 's' AS source,
    (range * 7 % 40 + 1) * 11 AS n_chars FROM range(200)"""
LABELS = "SELECT range AS doc_id, (range * 7 % 40 > 15)::INT AS quality, 0 AS toxic FROM range(200)"
NAMES = """asof_forward assemble batch_score batch_score_facts drop_null_labels feature_pipeline feature_snapshots feature_time_range
    file_status grow_tree head_sample label_join label_rejects labels_accepted latest_per_key lookup_features materialize
    materialize_upsert pit_join pit_join_ranges pit_join_ttl player_features project_features row_counts""".split()


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    con = duckdb.connect()
    for name, sql in (("events", EVENTS), ("documents", DOCUMENTS), ("labels", LABELS)):
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return str(folder), con


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session as on a standalone cluster, whose checkpoint folder is a mount."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    monkeypatch.setattr(context, "_SHARED", set(), raising=False)
    return spark


@pytest.mark.parametrize("name", NAMES)
def test_query_runs_on_a_shared_mount(cluster, tables, name):
    folder, con = tables
    got = queries()[name](cluster, folder).toPandas()
    assert len(got) > 0 or name == "asof_forward"
    if name in oracle_sql():
        assert norm(got) == norm(con.execute(oracle_sql()[name]).df())


def test_probe_is_made_once_and_leaves_nothing(cluster, monkeypatch):
    folder = context.ensure_checkpoint_dir(cluster)
    assert not [x for x in os.listdir(folder.removeprefix("file:")) if x.startswith("probe-")]
    assert context._SHARED == {(cluster.sparkContext.applicationId, folder)}
    monkeypatch.setattr(type(cluster), "range", lambda *_: pytest.fail("a second probe"))
    assert context.ensure_checkpoint_dir(cluster) == folder


def test_folder_that_spark_makes_is_not_probed_again(cluster, monkeypatch, tmp_path):
    """The first query of an application finds the setting, the others the folder that Spark made below it."""
    sc, made, probes, whole = cluster.sparkContext, [], [], type(cluster).range
    conf = sc.getConf().set("spark.checkpoint.dir", str(tmp_path))
    monkeypatch.setattr(sc, "getConf", lambda: conf)
    monkeypatch.setattr(sc, "getCheckpointDir", lambda: made[0] if made else None)
    monkeypatch.setattr(sc, "setCheckpointDir", lambda path: made.append(f"file:{path}/own"))
    monkeypatch.setattr(type(cluster), "range", lambda *args: probes.append(args) or whole(*args))
    assert [context.ensure_checkpoint_dir(cluster) for _ in range(3)] == [str(tmp_path), made[0], made[0]]
    assert len(probes) == 1


@pytest.mark.parametrize("lost", ["rows", "all"])
def test_folder_of_one_machine_is_refused(cluster, monkeypatch, lost):
    from pyspark.sql.readwriter import DataFrameWriter

    whole = DataFrameWriter.parquet

    def write(self, path):
        """What the driver finds of files on several machines: its own, or none."""
        if lost == "rows":
            whole(cluster.range(1).write, path)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    with pytest.raises(RuntimeError, match="local folder"):
        context.ensure_checkpoint_dir(cluster)
    assert not context._SHARED
