"""Raw logs -> file status -> sessions -> account features.

Physical shape (see ``docs/plans/``): the footers are read once, the raw
files are scanned once into one partial/final hash aggregate on (file,
account, session, date, orphan_time), written once as the grain table; the
file status, the session starts, the orphan events and the session rows are
all computed from that small table; the account aggregate is keyed by a
subset of the grain key. Driver actions: the intermediate writes, the few
distinct type signatures of the files, and the final writes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from .. import schema as S
from ..context import Workspace, _filesystem, materialize
from ..operators import features as feat
from ..operators import quality as q
from ..operators import sessions as sess
from ..sources.logs import footer_listing, scan_logs
from ..sources.versions import VersionedTable


@dataclass
class Preprocessed:
    grain: DataFrame
    status: DataFrame
    sessions: DataFrame
    players: DataFrame


def preprocess(
    logs: DataFrame,
    footers: DataFrame | None = None,
    materialize_grain: bool = True,
    work: Workspace | None = None,
) -> Preprocessed:
    """Compose validation, quarantine, orphan handling and aggregation.

    The grain is read by three consumers (file status, session starts,
    session rows). ``materialize_grain`` writes it once to the checkpoint
    folder (in ``work``, whose owner releases it) so the raw scan and its
    aggregate run once; without it each consumer rescans the raw logs.
    """
    grain = sess.session_grain(logs)
    if materialize_grain:
        grain = materialize(grain, work)
    status = q.validate_logs(grain, footers, logs)
    ok = q.validate_logs(grain, footers, with_reasons=False)
    sessions = q.quarantine(sess.sessions_from_grain(grain), ok)
    players = feat.player_features(sessions)
    return Preprocessed(grain, status, sessions, players)


def preprocess_files(spark: SparkSession, raw_dir: str, work: Workspace | None = None) -> Preprocessed | None:
    """``preprocess`` of all files below ``raw_dir``: one listing, footers (kept, so that no file is opened for them again), scan by stored types. ``None`` without files."""
    try:
        listing = footer_listing(spark, raw_dir)
    except AnalysisException:  # the folder is missing
        return None
    footers = materialize(q.footer_facts(listing), work)
    logs = scan_logs(spark, raw_dir, footers=footers)
    return None if logs is None else preprocess(logs, footers, work=work)


def run_feature_pipeline(
    spark: SparkSession,
    raw_dir: str,
    output_path: str,
    write_sessions: str | None = None,
    write_status: str | None = None,
    versioned: bool = False,
) -> DataFrame | None:
    """Read every ``*.parquet`` under ``raw_dir``; write the account features
    (snappy Parquet, replaced), and the session and file status tables where
    paths are given. Returns the written features. With ``versioned`` the
    output is a ``VersionedTable``, in which earlier versions stay readable.

    Without input, or if no file passes, nothing but the status is written,
    an earlier output stays as it is, and the result is ``None``. A result
    that breaks the feature contract raises before anything is overwritten.
    Intermediate tables are gone afterwards, also after a failure.
    """
    with Workspace(spark) as work:
        out = preprocess_files(spark, raw_dir, work)
        if out is None:
            return None
        if write_status:
            write_parquet(out.status, write_status)
        problems = check_feature_contract(out.players)
        if problems:
            raise ValueError("features break their contract: " + "; ".join(problems))
        sessions = materialize(out.sessions, work)
        if sessions.isEmpty():
            return None
        if write_sessions:
            write_parquet(sessions, write_sessions)
        players = feat.player_features(sessions)
        if versioned:
            table = VersionedTable(spark, output_path)
            return table.read(table.replace(players)["version"])
        write_parquet(players, output_path)
    return spark.read.parquet(output_path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the Parquet folder ``path``. It is written beside the earlier one first, so a write that fails leaves that as it was.

    Between the two renames at the end a reader may find no folder; ``VersionedTable`` has no such moment and needs no renames.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    staged, fs = _filesystem(spark, f"{path.rstrip('/')}.staged-{mark}")
    target, earlier = (_filesystem(spark, f"{path.rstrip('/')}{x}")[0] for x in ("", f".earlier-{mark}"))
    try:
        df.write.option("compression", "snappy").parquet(staged.toString())
        had = fs.exists(target)
        if had and not fs.rename(target, earlier):
            raise OSError(f"cannot replace {path}")
        if not fs.rename(staged, target):
            if had:
                fs.rename(earlier, target)
            raise OSError(f"cannot write {path}")
    except BaseException:
        fs.delete(staged, True)
        raise
    if had:
        fs.delete(earlier, True)


def check_feature_contract(df: DataFrame, declared=S.ACCOUNT_FEATURES) -> list[str]:
    """Differences between a frame's schema and the declared T5 contract."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in declared.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    extra = [n for n in have if n not in {f.name for f in declared.fields}]
    problems += [f"unexpected column {n}" for n in extra]
    return problems


def materialize_online(features: DataFrame, output_path: str, start=None, end=None, buckets: int = 64) -> DataFrame:
    """Bring the online view up to date: the newest feature row per account.

    The rows are those of ``features`` with ``start <= time <= end``; without
    bounds, of the table's time range widened by one day
    (``latest_in_range``). They are merged by account into the view at
    ``output_path`` (a ``VersionedTable``): a row replaces an older one, an
    older range changes nothing, accounts outside the range stay.
    """
    bounded = start is not None or end is not None
    rows = feat.latest_per_key(features, start=start, end=end) if bounded else feat.latest_in_range(features)
    view = VersionedTable(features.sparkSession, output_path)
    return view.read() if view.upsert(rows, S.KEY, S.EVENT_TIME, buckets) else rows
