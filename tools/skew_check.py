"""Skew check: one account owns a third of all log rows.

Derives a skewed log view from the given ``events`` (every row with
``user_id % 3 = 0`` is re-keyed to one account and one file), runs the
preprocessing, the snapshot store and the point-in-time join with Spark's
event log in a scratch folder, and reports, per stage that reads a shuffle,
the share of records read by its largest task.

Usage: python tools/skew_check.py [sf_dir] [cores] [max_share] [mode]

With ``max_share`` (e.g. 0.25) the exit code is 1 when a shuffle stage of
more than 1000 records gives one task a larger share than that. ``mode``
``day`` runs the point-in-time join alone, with a third of the label rows
on one account and one day; ``null`` gives that third a null account;
``minute`` puts it on one account within one minute and joins by ranges.
"""

from __future__ import annotations

import glob
import io
import json
import sys
import tempfile
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from sessionsmith import schema as S  # noqa: E402
from sessionsmith.context import local_session, materialize  # noqa: E402
from sessionsmith.operators.features import feature_snapshots  # noqa: E402
from sessionsmith.plans.feature_pipeline import preprocess  # noqa: E402
from sessionsmith.plans.train_pipeline import pit_join  # noqa: E402
from sessionsmith.sources.logs import log_view, read_label_view  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = sys.argv[2] if len(sys.argv) > 2 else "8"
    logdir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    spark = local_session(
        cores,
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": logdir,
            # keep every shuffle partition visible (no coalescing into one task)
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16",
        },
    )
    mode = sys.argv[4] if len(sys.argv) > 4 else "account"
    events = spark.read.parquet(f"{sf}/events.parquet")
    third = F.pmod(F.col(S.KEY).cast("long"), F.lit(3)) == 0
    labels = read_label_view(spark, sf)
    if mode == "account":
        hot = F.pmod(F.col("user_id"), F.lit(3)) == 0
        logs = log_view(events.withColumn("user_id", F.when(hot, F.lit(-1)).otherwise(F.col("user_id"))))
        total = logs.count()
        hot_rows = logs.where(F.col(S.KEY) == "-1").count()
        snaps = feature_snapshots(preprocess(logs).sessions)
        labels = labels.withColumn(S.KEY, F.when(third, F.lit("-1")).otherwise(F.col(S.KEY)))
    else:
        snaps = materialize(feature_snapshots(preprocess(log_view(events)).sessions))
        clock = F.lit("12:30:") if mode == "minute" else F.date_format(S.LABEL_TIME, "HH:mm:")
        one_day = F.to_timestamp_ntz(F.concat(F.lit("2024-01-15 "), clock, F.date_format(S.LABEL_TIME, "ss")))
        labels = labels.withColumn("hot", third).withColumns(
            {
                S.KEY: F.when(F.col("hot"), F.lit(None if mode == "null" else "3").cast("string")).otherwise(F.col(S.KEY)),
                S.LABEL_TIME: F.when(F.col("hot"), one_day).otherwise(F.col(S.LABEL_TIME)),
            }
        )
        labels = materialize(labels.repartition(16))
        total, hot_rows = labels.count(), labels.where("hot").count()
    spark.sparkContext.setJobDescription("SKEW")
    started = time.time()
    pit_join(labels, snaps, by_ranges=mode == "minute").write.format("noop").mode("overwrite").save()
    spark.stop()
    print(f"rows {total}, hot account rows {hot_rows} ({hot_rows / total:.0%})")
    worst = report(logdir, 0 if mode == "account" else started * 1000)
    if len(sys.argv) > 3 and worst > float(sys.argv[3]):
        sys.exit(1)


def report(logdir: str, since: float = 0) -> float:
    """Largest share of a task; of tasks launched after ``since`` (ms)."""
    import zstandard

    stage_tasks: dict[int, list[int]] = {}
    names: dict[int, str] = {}
    for f in glob.glob(f"{logdir}/*/events_*") + glob.glob(f"{logdir}/*.zstd"):
        fh = open(f, "rb")
        stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        for line in stream:
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd" and e["Task Info"]["Launch Time"] >= since:
                m = e.get("Task Metrics") or {}
                recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if recs:
                    stage_tasks.setdefault(e["Stage ID"], []).append(recs)
            elif e["Event"] == "SparkListenerStageCompleted":
                names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:40]
    worst = (0.0, None)
    for sid, recs in sorted(stage_tasks.items()):
        share = max(recs) / sum(recs)
        if len(recs) > 1 and sum(recs) > 1000 and share > worst[0]:
            worst = (share, sid)
        print(f"stage {sid:4d} tasks {len(recs):3d} records {sum(recs):8d} largest task {max(recs):7d} ({share:.0%})")
    print(f"largest task share in a shuffle stage of >1000 records: {worst[0]:.0%} (stage {worst[1]})")
    return worst[0]


if __name__ == "__main__":
    main()
