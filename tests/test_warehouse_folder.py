"""On a cluster whose ``spark.checkpoint.dir`` is missing, or is a disk of each machine, intermediate tables go to the warehouse."""

from __future__ import annotations

import os
import shutil
import warnings

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from __spark_entry__ import queries
from sessionsmith import context
from sessionsmith.plans import catalog
from tests.test_shared_folder import tables  # noqa: F401

NAMES = """batch_score_facts feature_pipeline drop_null_labels feature_snapshots feature_time_range file_status grow_tree head_sample
    label_join label_rejects labels_accepted latest_per_key materialize lookup_features materialize_upsert pit_join
    pit_join_ranges pit_join_ttl player_features project_features""".split()


@pytest.fixture
def cluster(spark, monkeypatch, tmp_path):
    """A session of a standalone cluster without the setting, with a shared warehouse. Gives the session, its settings and the folders it was told to use."""
    sc, made = spark.sparkContext, []
    conf = {}
    monkeypatch.setattr(sc, "master", "spark://driver:7077")
    monkeypatch.setattr(sc, "getConf", lambda: conf)
    monkeypatch.setattr(sc, "getCheckpointDir", lambda: f"file:{made[-1]}/own" if made else None)
    monkeypatch.setattr(sc, "setCheckpointDir", made.append)
    monkeypatch.setattr(context, "_SHARED", set())
    monkeypatch.setattr(context, "_warehouse", lambda _: str(tmp_path / "warehouse"), raising=False)
    monkeypatch.setattr(catalog, "_WRITTEN", {})
    return spark, conf, made


@pytest.mark.parametrize("name", NAMES)
def test_query_runs_without_the_setting(cluster, tables, name):  # noqa: F811
    spark, _, made = cluster
    with pytest.warns(UserWarning, match="warehouse"):
        assert queries()[name](spark, tables[0]).count() > 0
    assert len(made) == 1


def test_a_folder_of_one_machine_is_replaced_by_the_warehouse(cluster, monkeypatch, tmp_path):
    spark, conf, made = cluster
    conf["spark.checkpoint.dir"] = f"file:{tmp_path}/disk"
    whole = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: None if "/disk/" in path else whole(self, path))
    with pytest.warns(UserWarning, match="local folder .*/disk; name a shared one"):
        assert context.ensure_checkpoint_dir(spark) == f"{tmp_path}/warehouse/sessionsmith-checkpoint" == made[0]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert context.ensure_checkpoint_dir(spark) == f"file:{made[0]}/own"
    assert len(made) == 1 and not [x for x in os.listdir(made[0]) if x.startswith("probe-")]


def test_without_any_shared_folder_the_setting_is_asked_for(cluster, monkeypatch):
    spark, _, made = cluster
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *_: None)
    with pytest.raises(RuntimeError, match="must name a shared folder"):
        context.ensure_checkpoint_dir(spark)
    assert not made


def test_deleted_log_files_are_written_again(spark, tables):  # noqa: F811
    first = catalog._log_files(spark, tables[0])
    assert catalog._log_files(spark, tables[0]) == first
    shutil.rmtree(first.removeprefix("file:"))
    assert {r.status for r in queries()["file_status"](spark, tables[0]).collect()} >= {"success"}
