"""Incremental processing of raw log files as they land in a folder.

The batch pipeline handles every file on its own (all keys carry the
file), so the session rows of a set of new files do not depend on any
other file. A file-source stream therefore runs the same batch plan per
micro-batch (``foreachBatch``) and appends the session rows and file
status to Parquet tables. The stream carries file names; each batch reads
its own files, whatever types they store. Account features are a plain aggregate over the
session table, so a full recompute after ingest equals the batch run.

Writes are idempotent per micro-batch: each batch overwrites its own
``batch_id`` partition, so a batch replayed after a failure replaces
rather than duplicates its rows. Stream progress lives in the checkpoint
location, under the session's shared ``spark.checkpoint.dir`` by default.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..context import Workspace, ensure_checkpoint_dir
from ..operators import features as feat
from ..operators import quality as q
from ..plans.feature_pipeline import preprocess
from ..sources.logs import scan_files


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("batch_id")
        .parquet(path)
    )


def ingest_batch(batch: DataFrame, batch_id: int, out_dir: str) -> None:
    """One micro-batch of file names (``source_file``, ``path``): read the
    footers, scan, validate, build sessions, write both tables.

    The batch is the list of files, not their rows, so files that are empty
    or can't be read get their status too. Replaying a batch id (after a
    failure) overwrites that batch's partitions, so the tables never hold a
    batch twice.
    """
    spark = batch.sparkSession
    with Workspace(spark) as work:
        footers = work.materialize(q.footer_facts(batch.select(S.FILE, "path")))
        pre = preprocess(scan_files(footers), footers, work=work)
        _write_batch(pre.status, os.path.join(out_dir, "file_status"), batch_id)
        _write_batch(pre.sessions, os.path.join(out_dir, "sessions"), batch_id)


def start_ingest(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int = 10_000,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Start the stream; returns the running query.

    ``available_now`` processes every file present and stops (a scheduled
    job); otherwise it polls every ``processing_time``.
    """
    if checkpoint_location is None:
        checkpoint_location = os.path.join(ensure_checkpoint_dir(spark), "ingest-" + os.path.basename(out_dir.rstrip("/")))
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files_per_trigger)
    )
    stream = reader.load(raw_dir).select(F.col("_metadata.file_path").alias(S.FILE), "path")

    def process(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, out_dir)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def features_from_ingest(spark: SparkSession, out_dir: str) -> DataFrame:
    """Account features (T5) over every session row ingested so far."""
    sessions = spark.read.parquet(os.path.join(out_dir, "sessions")).drop("batch_id")
    return feat.player_features(sessions)
