"""A folder of very many small files is listed once, and its listing and footers take a number of tasks that depends on the cores, not on the files."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sessionsmith.context import Workspace
from sessionsmith.operators import quality as q
from sessionsmith.plans import feature_pipeline as fp
from sessionsmith.sources import logs as L

FILES = 300


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """One file in a folder of its own for each account."""
    folder = tmp_path_factory.mktemp("raw")
    for k in range(FILES):
        (folder / f"file=account-{k}").mkdir()
        cols = {"time": ["2024-01-15 10:30:00.000"], "logid": [1013], "session": [1], "log_detail_code": [0], "actor_account_id": [f"a{k}"], "actor_level": [k % 7]}
        pq.write_table(pa.table(cols), str(folder / f"file=account-{k}" / "part-0.parquet"))
    return str(folder)


@pytest.fixture
def narrow(spark, monkeypatch):
    """Two cores, and scans of a file or two a task; gives the number of tasks of each job by what ran."""
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda _: 2))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def tasks_of(spark, group, run):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return out, [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]


def test_listing_takes_few_tasks_and_leaves_the_setting(narrow, raw):
    before = narrow.conf.get(L._LISTING)
    found, tasks = tasks_of(narrow, "listing", lambda: L.list_files(narrow, raw))
    assert tasks and max(tasks) <= 16
    assert narrow.conf.get(L._LISTING) == before
    assert found.count() == FILES


def test_a_lower_setting_is_kept(narrow, raw):
    before = narrow.conf.get(L._LISTING)
    narrow.conf.set(L._LISTING, "3")
    try:
        _, tasks = tasks_of(narrow, "lower", lambda: L.list_files(narrow, raw))
        assert max(tasks) <= 3 and narrow.conf.get(L._LISTING) == "3"
    finally:
        narrow.conf.set(L._LISTING, before)


def test_the_first_file_is_enough(narrow, raw):
    found, tasks = tasks_of(narrow, "first", lambda: L.has_files(narrow, raw))
    assert found and sum(tasks) <= 16 + 1


def test_footers_take_few_tasks(narrow, raw):
    listing = L.footer_listing(narrow, raw)
    assert listing.rdd.getNumPartitions() > 16
    footers = q.footer_facts(listing)
    assert footers.rdd.getNumPartitions() <= 16
    assert footers.where("footer_rows = 1 AND signature IS NOT NULL").count() == FILES


def test_a_run_lists_the_folder_once(narrow, raw, monkeypatch):
    made, whole = [], L.list_files
    monkeypatch.setattr(L, "list_files", lambda *args: made.append(args) or whole(*args))
    with Workspace(narrow) as work:
        out = fp.preprocess_files(narrow, raw, work)
        assert out.status.where("status = 'success'").count() == FILES
        assert out.grain.count() == FILES
    assert len(made) == 1


def test_without_files_there_is_no_result(narrow, tmp_path):
    with Workspace(narrow) as work:
        assert fp.preprocess_files(narrow, str(tmp_path / "nope"), work) is None
        assert fp.preprocess_files(narrow, str(tmp_path), work) is None
