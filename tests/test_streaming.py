"""File-arrival ingest equals the batch pipeline over the same files."""

from __future__ import annotations

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sessionsmith import schema as S
from sessionsmith.plans.feature_pipeline import preprocess
from sessionsmith.sources.logs import footer_listing, log_view, scan_logs
from sessionsmith.streaming.file_ingest import features_from_ingest, start_ingest

SF = "/root/testdata/sf0.001"


def _split_into_files(spark, raw_dir, accounts):
    """One raw Parquet file per account, from the derived game-log view."""
    logs = log_view(spark.read.parquet(f"{SF}/events.parquet")).toPandas()
    for acc in accounts:
        part = logs[logs[S.FILE] == f"account-{acc}.parquet"].drop(columns=[S.FILE])
        import pyarrow as pa

        pq.write_table(pa.Table.from_pandas(part, schema=pa.schema(
            [("time", pa.string()), ("logid", pa.int32()), ("session", pa.int64()),
             ("log_detail_code", pa.int32()), ("actor_account_id", pa.string()), ("actor_level", pa.int32())]),
            preserve_index=False), f"{raw_dir}/account-{acc}.parquet")


def test_ingest_matches_batch(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    out = str(tmp_path / "out")
    _split_into_files(spark, raw, range(0, 8))
    q1 = start_ingest(spark, str(raw), out, checkpoint_location=str(tmp_path / "ck"))
    q1.awaitTermination(300)
    _split_into_files(spark, raw, range(8, 15))
    q2 = start_ingest(spark, str(raw), out, checkpoint_location=str(tmp_path / "ck"))
    q2.awaitTermination(300)
    streamed = features_from_ingest(spark, out)
    batch = preprocess(scan_logs(spark, str(raw))).players
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
    status = spark.read.parquet(f"{out}/file_status")
    assert status.select(S.FILE).distinct().count() == 15
    assert status.select("batch_id").distinct().count() == 2


def test_replayed_batch_is_not_duplicated(spark, tmp_path):
    from sessionsmith.streaming.file_ingest import ingest_batch

    raw = tmp_path / "raw"
    raw.mkdir()
    _split_into_files(spark, raw, range(0, 4))
    batch = footer_listing(spark, str(raw))
    out = str(tmp_path / "out")
    ingest_batch(batch, 7, out)
    first = spark.read.parquet(f"{out}/sessions").count()
    ingest_batch(batch, 7, out)  # the same batch again, as after a failure
    assert spark.read.parquet(f"{out}/sessions").count() == first > 0


def test_files_without_rows_get_a_status(spark, tmp_path):
    """Empty and unreadable files are not lost: the stream carries names, not rows."""
    raw = tmp_path / "raw"
    raw.mkdir()
    _split_into_files(spark, raw, range(0, 1))
    one = pq.read_table(f"{raw}/account-0.parquet")
    pq.write_table(one.slice(0, 0), f"{raw}/empty one.parquet")
    (raw / "broken.parquet").write_bytes(b"no parquet")
    out = str(tmp_path / "out")
    start_ingest(spark, str(raw), out, checkpoint_location=str(tmp_path / "ck")).awaitTermination(300)
    status = {r[S.FILE].rsplit("/", 1)[-1]: r["status"] for r in spark.read.parquet(f"{out}/file_status").collect()}
    assert status == {"account-0.parquet": "success", "empty%20one.parquet": "skipped", "broken.parquet": "failed"}
