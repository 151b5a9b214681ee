"""DuckDB SQL for each registered query (the correctness oracle).

Written the way the source pipeline computes each step (ASOF JOIN for the
orphan events, a LEFT JOIN of boundaries, pandas-style rounding), not the
way the Spark plan does it, so the two cross-check each other.
Every count is cast to BIGINT and every ratio to DOUBLE, as in Spark.
"""

from __future__ import annotations

from .. import schema as S
from ..sources.logs import VIEW_CODES
from .catalog import TTL_SECONDS


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _round2(x: str) -> str:
    return f"(round_even(({x}) * {_d('100')}, 0) / {_d('100')})"


def _us(a: str, b: str) -> str:
    return f"date_diff('microsecond', {a}, {b})"


_SIMPLE = ", ".join(str(c) for c in S.SIMPLE_LOGIDS)
_PAIRS = " OR ".join(f"(logid = {c} AND log_detail_code = {d})" for c, d in S.DETAIL_CODES)
TRACKED = f"coalesce(logid IN ({_SIMPLE}) OR {_PAIRS}, false)"
_CODES = ", ".join(str(c) for c in VIEW_CODES)
FEATS = ", ".join(S.FEATURES)
COUNTS_FILTER = ",\n    ".join(
    f"CAST(count(*) FILTER (WHERE logid = {c}) AS BIGINT) AS {label}" for c, label in S.EVENT_CODES
)

BASE = f"""
ev AS (
  SELECT event_id, ts, user_id, user_id % 50 AS kind, event_id % 7 = 0 AS hit,
         [{_CODES}][event_id % 23 + 1] AS lid
  FROM events
),
logs AS (
  SELECT
    CASE WHEN kind = 3 AND hit THEN NULL
         WHEN kind = 4 AND hit THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS time,
    CAST(lid AS INTEGER) AS logid,
    CAST(CASE WHEN kind = 8 THEN 0
              WHEN kind = 2 AND hit THEN -1
              WHEN lid = {S.ORPHAN_CODE} OR event_id % 11 = 0 THEN 0
              ELSE 1 + (dayofmonth(ts) - 1) // 3 END AS BIGINT) AS session,
    CAST(1 + (event_id // 23) % 2 AS INTEGER) AS log_detail_code,
    CASE WHEN kind = 6 AND hit THEN NULL ELSE CAST(user_id AS VARCHAR) END AS actor_account_id,
    CAST(CASE WHEN kind = 1 AND hit THEN 56
              WHEN kind = 5 AND hit THEN -3
              WHEN kind = 7 AND hit THEN NULL
              ELSE 1 + (event_id * 7919) % 55 END AS INTEGER) AS actor_level,
    'account-' || CAST(user_id AS VARCHAR) || '.parquet' AS source_file
  FROM ev
),
parsed0 AS (
  SELECT *, CAST(try_strptime(time, '%Y-%m-%d %H:%M:%S.%g') AS TIMESTAMP) AS timestamp FROM logs
),
parsed AS (
  SELECT *, CAST(timestamp AS DATE) AS session_date, {TRACKED} AS tracked FROM parsed0
),
file_rules AS (
  SELECT source_file,
    count(*) AS n_rows,
    count(*) FILTER (WHERE time IS NULL) AS n_null_time,
    count(*) FILTER (WHERE session IS NULL) AS n_null_session,
    count(*) FILTER (WHERE actor_account_id IS NULL) AS n_null_account,
    count(*) FILTER (WHERE logid IS NULL) AS n_null_logid,
    count(*) FILTER (WHERE time IS NOT NULL AND timestamp IS NULL) AS n_bad_time,
    min(time) FILTER (WHERE time IS NOT NULL AND timestamp IS NULL) AS bad_time,
    count(*) FILTER (WHERE session < 0) AS n_neg_session,
    count(*) FILTER (WHERE actor_level < 0) AS n_neg_level,
    count(*) FILTER (WHERE actor_level > {S.MAX_LEVEL}) AS n_high_level,
    count(*) FILTER (WHERE tracked AND session > 0) AS n_tracked_pos
  FROM parsed GROUP BY source_file
),
status AS (
  SELECT source_file, CASE WHEN reason = '' THEN 'success' ELSE 'skipped' END AS status, reason
  FROM (
    SELECT source_file, CASE
      WHEN n_rows = 0 THEN {_q(S.MSG_EMPTY)}
      WHEN n_null_time + n_null_session + n_null_account + n_null_logid > 0 THEN
        'Null values found in critical columns: [' || concat_ws(', ',
          CASE WHEN n_null_time > 0 THEN '''time''' END,
          CASE WHEN n_null_session > 0 THEN '''session''' END,
          CASE WHEN n_null_account > 0 THEN '''actor_account_id''' END,
          CASE WHEN n_null_logid > 0 THEN '''logid''' END) || ']'
      WHEN n_bad_time > 0 THEN 'Invalid timestamp format: ' || bad_time
      WHEN n_neg_session > 0 THEN {_q(S.MSG_NEG_SESSION)}
      WHEN n_neg_level > 0 THEN {_q(S.MSG_NEG_LEVEL)}
      WHEN n_high_level > 0 THEN {_q(S.MSG_HIGH_LEVEL)}
      WHEN n_tracked_pos = 0 THEN {_q(S.MSG_NO_SESSIONS)}
      ELSE '' END AS reason
    FROM file_rules
  ) r
),
ok AS (SELECT source_file FROM status WHERE status = 'success'),
valid AS (SELECT * FROM parsed WHERE tracked AND session > 0),
starts AS (
  SELECT source_file, actor_account_id, session, min(timestamp) AS start_ts
  FROM valid GROUP BY source_file, actor_account_id, session
),
starts1 AS (
  SELECT source_file, actor_account_id, start_ts, min(session) AS session
  FROM starts WHERE actor_account_id IS NOT NULL GROUP BY source_file, actor_account_id, start_ts
),
orphans AS (
  SELECT source_file, actor_account_id, timestamp, session_date, logid, actor_level
  FROM parsed WHERE session = 0 AND logid = {S.ORPHAN_CODE} AND log_detail_code = 1
),
attached AS (
  SELECT o.source_file, o.actor_account_id, o.timestamp, o.session_date, o.logid, o.actor_level, s.session
  FROM orphans o ASOF JOIN starts1 s
    ON o.source_file = s.source_file AND o.actor_account_id = s.actor_account_id
   AND o.timestamp <= s.start_ts
),
stat_rows AS (
  SELECT source_file, actor_account_id, session, session_date, timestamp, logid, actor_level FROM valid
  UNION ALL
  SELECT source_file, actor_account_id, session, session_date, timestamp, logid, actor_level FROM attached
),
stats AS (
  SELECT source_file, actor_account_id, session, session_date,
    min(timestamp) AS f_first, max(timestamp) AS f_last,
    {COUNTS_FILTER},
    arg_max(actor_level, (timestamp, actor_level)) FILTER (WHERE actor_level IS NOT NULL AND timestamp IS NOT NULL) AS lvl
  FROM stat_rows GROUP BY source_file, actor_account_id, session, session_date
),
bounds AS (
  SELECT source_file, actor_account_id, session, session_date,
         min(timestamp) AS first_ts, max(timestamp) AS last_ts
  FROM parsed WHERE session > 0
  GROUP BY source_file, actor_account_id, session, session_date
),
sessions_all AS (
  SELECT s.source_file, s.session, s.session_date,
    coalesce(b.first_ts, s.f_first) AS first_timestamp,
    coalesce(b.last_ts, s.f_last) AS last_timestamp,
    s.actor_account_id,
    CAST(round_even({_d(_us('coalesce(b.first_ts, s.f_first)', 'coalesce(b.last_ts, s.f_last)'))}
         / {_d('1000000')} / {_d('60')}, 0) AS BIGINT) AS session_duration_minutes,
    CAST(s.lvl AS INTEGER) AS actor_level,
    {", ".join(f"s.{label}" for label in S.EVENT_LABELS)}
  FROM stats s LEFT JOIN bounds b
    ON s.source_file = b.source_file AND s.actor_account_id = b.actor_account_id
   AND s.session = b.session AND s.session_date = b.session_date
),
sessions AS (SELECT * FROM sessions_all WHERE source_file IN (SELECT source_file FROM ok)),
player_parts AS (
  SELECT actor_account_id,
    min(last_timestamp) AS first_ts, max(last_timestamp) AS last_ts,
    count(last_timestamp) AS n, count(session_duration_minutes) AS nd,
    CAST(sum(session_duration_minutes) AS BIGINT) AS s,
    sum(CAST(session_duration_minutes AS HUGEINT) * session_duration_minutes) AS ss,
    min(session_duration_minutes) AS mn, max(session_duration_minutes) AS mx,
    {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in S.EVENT_LABELS)}
  FROM sessions GROUP BY actor_account_id
),
day_parts AS (
  SELECT actor_account_id, CAST(last_timestamp AS DATE) AS day,
    min(last_timestamp) AS first_ts, max(last_timestamp) AS last_ts,
    count(last_timestamp) AS n, count(session_duration_minutes) AS nd,
    CAST(sum(session_duration_minutes) AS BIGINT) AS s,
    sum(CAST(session_duration_minutes AS HUGEINT) * session_duration_minutes) AS ss,
    min(session_duration_minutes) AS mn, max(session_duration_minutes) AS mx,
    {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in S.EVENT_LABELS)}
  FROM sessions GROUP BY actor_account_id, CAST(last_timestamp AS DATE)
),
snap_parts AS (
  SELECT actor_account_id,
    min(first_ts) OVER w AS first_ts, max(last_ts) OVER w AS last_ts,
    CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(nd) OVER w AS BIGINT) AS nd,
    CAST(sum(s) OVER w AS BIGINT) AS s, sum(ss) OVER w AS ss,
    min(mn) OVER w AS mn, max(mx) OVER w AS mx,
    {", ".join(f"CAST(sum({c}) OVER w AS BIGINT) AS {c}" for c in S.EVENT_LABELS)}
  FROM day_parts
  WINDOW w AS (PARTITION BY actor_account_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
"""


def _finish(src: str) -> str:
    life = _round2(f"{_d(_us('first_ts', 'last_ts'))} / {_d('1000000')} / {_d('86400')}")
    std = (
        f"CASE WHEN nd > 1 THEN sqrt(CAST(CAST(nd AS HUGEINT) * ss - CAST(s AS HUGEINT) * s AS DOUBLE)"
        f" / CAST(CAST(nd AS HUGEINT) * (nd - 1) AS DOUBLE)) END"
    )
    events = ", ".join(
        f"CAST(coalesce({c}, 0) AS BIGINT) AS {n}" for c, n in zip(S.EVENT_LABELS, S.ACCOUNT_EVENT_LABELS)
    )
    return f"""
  SELECT actor_account_id, last_ts AS last_session_timestamp,
    CAST(n AS BIGINT) AS total_sessions,
    life AS account_lifespan_days,
    {_round2("n / CASE WHEN life = 0 THEN " + _d('1') + " ELSE life END")} AS average_sessions_per_day,
    s AS total_playtime_minutes,
    {_round2("s / nd")} AS avg_session_duration_minutes,
    {_round2(f"coalesce({std}, {_d('0')})")} AS std_session_duration_minutes,
    mn AS min_session_duration_minutes, mx AS max_session_duration_minutes,
    {events}
  FROM (SELECT *, {life} AS life FROM {src}) x"""


FEATURE_TABLES = f"""
players AS ({_finish('player_parts')}),
snapshots AS ({_finish('snap_parts')}),
labels_v AS (
  SELECT CAST(user_id AS VARCHAR) AS actor_account_id, ts AS event_timestamp,
         CAST(value < 20 AS INTEGER) AS churn_yn
  FROM events WHERE event_type = 'purchase'
),
pit AS (
  SELECT l.actor_account_id, l.event_timestamp, l.churn_yn, {", ".join(f"f.{c}" for c in S.FEATURES)}
  FROM labels_v l ASOF LEFT JOIN snapshots f
    ON l.actor_account_id = f.actor_account_id AND l.event_timestamp >= f.last_session_timestamp
),
pit_ttl AS (
  SELECT l.actor_account_id, l.event_timestamp, l.churn_yn,
    {", ".join(
        f"CASE WHEN {_us('f.last_session_timestamp', 'l.event_timestamp')} <= {TTL_SECONDS * 1_000_000} THEN f.{c} END AS {c}"
        for c in S.FEATURES)}
  FROM labels_v l ASOF LEFT JOIN snapshots f
    ON l.actor_account_id = f.actor_account_id AND l.event_timestamp >= f.last_session_timestamp
),
online AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY actor_account_id ORDER BY last_session_timestamp DESC) AS rn
    FROM snapshots
    WHERE last_session_timestamp BETWEEN (SELECT min(last_session_timestamp) - INTERVAL 1 DAY FROM snapshots)
                                     AND (SELECT max(last_session_timestamp) + INTERVAL 1 DAY FROM snapshots)
  ) t WHERE rn = 1
),
doc_scores AS (
  SELECT l.quality AS churn_yn,
         {_d('d.n_chars')} / ({_d('d.n_chars')} + {_d('2000')}) AS p
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
),
doc_pred AS (SELECT churn_yn, p, CAST(p > 0.5 AS INTEGER) AS prediction FROM doc_scores)
"""

# The cut points of the query, and the largest double: all known values against the missing ones.
GROW_TREE = """
WITH rows AS (
  SELECT l.quality AS y, CASE WHEN d.doc_id % 7 <> 0 THEN d.n_chars END AS n_chars,
         length(d.text) - length(replace(d.text, chr(10), '')) AS n_lines, length(d.text) - length(replace(d.text, ' ', '')) AS n_spaces
  FROM labels l JOIN documents d USING (doc_id) WHERE l.quality IS NOT NULL
),
graded AS (SELECT r.*, round((p - y) * 1073741824) AS g, round(p * (1 - p) * 1073741824) AS h FROM rows r, (SELECT avg(y) AS p FROM rows)),
vals AS (
  SELECT g, h, 0 AS f, CAST(n_chars AS DOUBLE) AS v FROM graded UNION ALL
  SELECT g, h, 1, CAST(n_lines AS DOUBLE) FROM graded UNION ALL SELECT g, h, 2, CAST(n_spaces AS DOUBLE) FROM graded
),
cuts AS (
  SELECT 0 AS f, 250.0 * k AS e FROM range(1, 24) t(k) UNION ALL SELECT 1, unnest([0, 1, 2, 4, 8, 16]) UNION ALL
  SELECT 2, 40.0 * k FROM range(1, 24) t(k) UNION ALL SELECT k, 1.7976931348623157e308::DOUBLE FROM range(3) t(k)
),
sides AS (
  SELECT f, CAST(e AS DOUBLE) AS e, m, coalesce(v <= e, m) AS goes_left, sum(g) AS g, sum(h) AS h, count(*) AS n
  FROM vals JOIN cuts USING (f), (VALUES (false), (true)) t(m) GROUP BY ALL
),
splits AS (
  SELECT l.f, l.e, l.m, l.g AS gl, l.h AS hl, l.n AS nl, r.g AS gr, r.h AS hr, r.n AS nr,
         (l.g * l.g / l.h + r.g * r.g / r.h - (l.g + r.g) * (l.g + r.g) / (l.h + r.h)) / 1073741824 AS gain
  FROM sides l JOIN sides r ON l.f = r.f AND l.e = r.e AND l.m = r.m AND l.goes_left AND NOT r.goes_left
  WHERE l.n >= 20 AND r.n >= 20 ORDER BY gain DESC, l.f, l.e, l.m LIMIT 1
)
SELECT 0 AS node, ['n_chars', 'n_lines', 'n_spaces'][f + 1] AS feature, e AS threshold, m AS missing_left, 1 AS "left", 2 AS "right",
       round(gain, 6) AS gain, 0.0::DOUBLE AS value, nl + nr AS n_rows FROM splits
UNION ALL SELECT 1, NULL, NULL, NULL, NULL, NULL, 0.0, round(-gl / hl * 0.05, 9), nl FROM splits
UNION ALL SELECT 2, NULL, NULL, NULL, NULL, NULL, 0.0, round(-gr / hr * 0.05, 9), nr FROM splits
"""
WITH = "WITH " + BASE + FEATURE_TABLES

_CSV_LABELS = (
    "CAST(user_id AS VARCHAR) AS actor_account_id, ts AS event_timestamp,"
    " CASE WHEN event_id % 13 <> 0 THEN CAST(value < 20 AS INTEGER) END AS churn_yn"
)
_RAGGED = """WITH parts AS (
  SELECT event_id % 17 AS kind, CAST(event_id % 4 AS VARCHAR) AS batch, CAST(user_id AS VARCHAR) AS account, ts, value FROM events WHERE event_type = 'purchase'),
texts AS (
  SELECT *, CASE kind WHEN 2 THEN 'soon' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS time,
         CASE kind WHEN 3 THEN 'maybe' WHEN 4 THEN '0.5' WHEN 5 THEN '' ELSE CAST(CAST(value < 20 AS INTEGER) AS VARCHAR) END AS label FROM parts)
"""
_LOG_COLS = "time, logid, session, log_detail_code, actor_account_id, actor_level, source_file"


def _split_sql() -> str:
    """Split oracle with quotas computed in SQL (largest remainder)."""
    return f"""
, h AS (
  SELECT actor_account_id, event_timestamp, churn_yn,
         md5('{S.SEED}:' || actor_account_id || ':' || CAST(epoch_us(event_timestamp) AS VARCHAR)) AS hh
  FROM labels_v
),
cc AS (SELECT churn_yn, count(*) AS n FROM h GROUP BY churn_yn),
tot AS (SELECT sum(n) AS n FROM cc),
a1 AS (
  SELECT churn_yn, n, (SELECT n FROM tot) - CAST(ceil({S.TEST_SIZE} * (SELECT n FROM tot)) AS BIGINT) AS ntr,
         (SELECT n FROM tot) AS nt FROM cc
),
a1b AS (SELECT *, ntr * n / nt AS ex, floor(ntr * n / nt) AS fl FROM a1),
a1c AS (
  SELECT *, row_number() OVER (ORDER BY ex - fl DESC, churn_yn) AS rk,
         ntr - sum(fl) OVER () AS leftover FROM a1b
),
tr AS (SELECT churn_yn, n, CAST(fl + CASE WHEN rk <= leftover THEN 1 ELSE 0 END AS BIGINT) AS train FROM a1c),
a2 AS (
  SELECT churn_yn, n, train, sum(train) OVER () AS n2,
         sum(train) OVER () - CAST(ceil({S.VAL_SIZE} * sum(train) OVER ()) AS BIGINT) AS ntr2 FROM tr
),
a2b AS (SELECT *, ntr2 * train / n2 AS ex, floor(ntr2 * train / n2) AS fl FROM a2),
a2c AS (
  SELECT *, row_number() OVER (ORDER BY ex - fl DESC, churn_yn) AS rk,
         ntr2 - sum(fl) OVER () AS leftover FROM a2b
),
quota AS (
  SELECT churn_yn, n - train AS qt,
         train - CAST(fl + CASE WHEN rk <= leftover THEN 1 ELSE 0 END AS BIGINT) AS qv FROM a2c
),
ranked AS (
  SELECT h.*, row_number() OVER (PARTITION BY h.churn_yn ORDER BY hh, actor_account_id, event_timestamp) AS rnk
  FROM h
)
SELECT r.actor_account_id, r.event_timestamp, r.churn_yn,
       CASE WHEN rnk <= q.qt THEN 'test' WHEN rnk <= q.qt + q.qv THEN 'val' ELSE 'train' END AS split
FROM ranked r JOIN quota q ON r.churn_yn = q.churn_yn
"""


def oracle_sql() -> dict[str, str]:
    w = WITH
    return {
        "scan_logs": f"{w} SELECT {_LOG_COLS} FROM logs",
        "file_lineage": f"{w} SELECT source_file, count(*) AS n_rows, count(DISTINCT actor_account_id) AS n_accounts,"
        " min(timestamp) AS first_time, max(timestamp) AS last_time FROM parsed GROUP BY source_file",
        "filter_codes": f"{w} SELECT {_LOG_COLS} FROM parsed WHERE tracked",
        "parse_times": f"{w} SELECT {_LOG_COLS}, timestamp, session_date FROM parsed",
        "validate_logs": f"{w} SELECT source_file, status, reason FROM status",
        "validate_filtered": f"{w} SELECT source_file, CAST(n_tracked_pos AS BIGINT) AS n_tracked_pos,"
        " n_tracked_pos > 0 AS passes FROM file_rules",
        "file_status": f"{w} SELECT status, count(*) AS files FROM status GROUP BY status",
        "quarantine": f"{w} SELECT {_LOG_COLS} FROM logs WHERE source_file IN (SELECT source_file FROM ok)",
        "feature_pipeline": f"{w} SELECT * FROM players",
        "materialize": f"{w} SELECT * FROM online",
        "materialize_upsert": f"{w} SELECT * FROM online",
        "scan_labels": f"SELECT {_CSV_LABELS} FROM events WHERE event_type = 'purchase'",
        "label_rejects": f"""{_RAGGED} SELECT batch, CASE WHEN kind < 2 THEN 'fields' WHEN kind = 2 THEN 'time' ELSE 'label' END AS reason,
            account || ',' || time || ',' || label || CASE kind WHEN 0 THEN '' WHEN 1 THEN ',a,b' ELSE ',a' END AS record FROM texts WHERE kind < 5""",
        "labels_accepted": f"""{_RAGGED} SELECT account AS actor_account_id, ts AS event_timestamp, CASE WHEN kind <> 5 THEN CAST(value < 20 AS INTEGER) END AS churn_yn
            FROM texts WHERE kind >= 5""",
        "drop_null_labels": f"SELECT * FROM (SELECT {_CSV_LABELS} FROM events WHERE event_type = 'purchase') l"
        " WHERE churn_yn IS NOT NULL",
        "topk": "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10",
        "head_sample": f"{w} SELECT * FROM players ORDER BY actor_account_id LIMIT 5",
        "write_metrics": f"""{w}
          , s AS (SELECT count(*) AS total, count(*) FILTER (WHERE churn_yn IS NULL) AS null_labels,
                         avg({_d('churn_yn')}) AS churn_rate, sum(churn_yn) AS num_churned,
                         sum(1 - churn_yn) AS num_retained FROM labels_v),
          m AS (SELECT 'total' AS metric, {_d('total')} AS value FROM s
                UNION ALL SELECT 'null_labels', {_d('null_labels')} FROM s
                UNION ALL SELECT 'churn_rate', churn_rate FROM s
                UNION ALL SELECT 'num_churned', {_d('num_churned')} FROM s
                UNION ALL SELECT 'num_retained', {_d('num_retained')} FROM s)
          SELECT run_id, metric, value FROM m, (VALUES ('a'), ('b')) r(run_id)""",
        "write_model": f"{w} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM labels_v",
        "grow_tree": GROW_TREE,
        "assemble": f"{w} SELECT count(*) AS n_rows, CAST({len(S.FEATURES) + 1} AS BIGINT) AS shortest,"
        f" CAST({len(S.FEATURES) + 1} AS BIGINT) AS longest, CAST(0 AS BIGINT) AS n_undefined,"
        " count(*) FILTER (WHERE total_sessions IS NULL) AS n_without_features FROM pit WHERE churn_yn IS NOT NULL",
        "batch_score_facts": f"{w} SELECT count(DISTINCT actor_account_id) AS n_scores,"
        " count(DISTINCT actor_account_id) AS n_ids, count(DISTINCT actor_account_id) AS n_probabilities,"
        " count(DISTINCT actor_account_id) AS n_decided FROM labels_v",
        "session_boundaries": f"{w} SELECT source_file, actor_account_id, session, session_date,"
        " first_ts, last_ts, actor_account_id AS actor_id FROM bounds",
        "session_starts": f"{w} SELECT source_file, actor_account_id, session, start_ts FROM starts",
        "asof_forward": f"{w} SELECT source_file, actor_account_id, timestamp, session_date,"
        " count(*) AS n_events, CAST(max(actor_level) AS INTEGER) AS actor_level,"
        " session"
        " FROM attached GROUP BY source_file, actor_account_id, timestamp, session_date, session",
        "session_event_counts": f"{w} SELECT source_file, actor_account_id, session, session_date, "
        + ", ".join(S.EVENT_LABELS)
        + " FROM sessions",
        "session_stats": f"{w} SELECT * FROM sessions",
        "player_features": f"{w} SELECT * FROM players",
        "feature_snapshots": f"{w} SELECT * FROM snapshots",
        "feature_time_range": f"{w} SELECT min(last_session_timestamp) AS min_time,"
        " max(last_session_timestamp) AS max_time,"
        " min(last_session_timestamp) - INTERVAL 1 DAY AS start_time,"
        " max(last_session_timestamp) + INTERVAL 1 DAY AS end_time,"
        " count(*) AS total_records FROM players",
        "latest_per_key": f"{w} SELECT * FROM online",
        "lookup_features": f"{w} SELECT i.actor_account_id, o.* EXCLUDE (actor_account_id)"
        " FROM (SELECT DISTINCT actor_account_id FROM labels_v) i"
        " LEFT JOIN online o ON i.actor_account_id = o.actor_account_id",
        "pit_join": f"{w} SELECT * FROM pit",
        "pit_join_ranges": f"{w} SELECT * FROM pit",
        "pit_join_ttl": f"{w} SELECT * FROM pit_ttl",
        "label_join": f"{w} SELECT * FROM pit WHERE churn_yn IS NOT NULL",
        "project_entity": f"{w} SELECT actor_account_id, event_timestamp FROM labels_v",
        "label_distribution": f"{w} SELECT churn_yn, count(*) AS n FROM labels_v GROUP BY churn_yn",
        "label_stats": f"{w} SELECT count(*) AS total, count(*) FILTER (WHERE churn_yn IS NULL) AS null_labels,"
        " avg(CAST(churn_yn AS DOUBLE)) AS churn_rate, CAST(sum(churn_yn) AS BIGINT) AS num_churned,"
        " CAST(sum(1 - churn_yn) AS BIGINT) AS num_retained FROM labels_v",
        "project_features": f"{w} SELECT {FEATS} FROM pit WHERE churn_yn IS NOT NULL",
        "stratified_split": w + _split_sql(),
        "binary_metrics": f"""{w}
          , c AS (SELECT count(*) FILTER (WHERE churn_yn = 1 AND prediction = 1) AS tp,
                         count(*) FILTER (WHERE churn_yn = 0 AND prediction = 1) AS fp,
                         count(*) FILTER (WHERE churn_yn = 1 AND prediction = 0) AS fn,
                         count(*) FILTER (WHERE churn_yn = 0 AND prediction = 0) AS tn FROM doc_pred)
          SELECT CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE {_d('tp + tn')} / {_d('tp + fp + fn + tn')} END AS accuracy,
                 CASE WHEN tp + fp = 0 THEN 0.0 ELSE {_d('tp')} / {_d('tp + fp')} END AS precision,
                 CASE WHEN tp + fn = 0 THEN 0.0 ELSE {_d('tp')} / {_d('tp + fn')} END AS recall,
                 CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE {_d('2 * tp')} / {_d('2 * tp + fp + fn')} END AS f1
          FROM c""",
        "evaluate": f"""{w}
          , c AS (SELECT count(*) FILTER (WHERE churn_yn = 1 AND prediction = 1) AS tp,
                         count(*) FILTER (WHERE churn_yn = 0 AND prediction = 1) AS fp,
                         count(*) FILTER (WHERE churn_yn = 1 AND prediction = 0) AS fn,
                         count(*) FILTER (WHERE churn_yn = 0 AND prediction = 0) AS tn,
                         avg(-({_d('churn_yn')} * ln(least(greatest(p, 1e-15), 1.0 - 1e-15))
                             + (1.0 - {_d('churn_yn')}) * ln(1.0 - least(greatest(p, 1e-15), 1.0 - 1e-15)))) AS log_loss
                  FROM doc_pred)
          SELECT {_d('tp + tn')} / {_d('tp + fp + fn + tn')} AS accuracy,
                 CASE WHEN tp + fp = 0 THEN 0.0 ELSE {_d('tp')} / {_d('tp + fp')} END AS precision,
                 CASE WHEN tp + fn = 0 THEN 0.0 ELSE {_d('tp')} / {_d('tp + fn')} END AS recall,
                 CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE {_d('2 * tp')} / {_d('2 * tp + fp + fn')} END AS f1,
                 log_loss
          FROM c""",
        "log_loss": f"""{w}
          , pc AS (SELECT churn_yn, least(greatest(p, 1e-15), 1.0 - 1e-15) AS p FROM doc_pred)
          SELECT avg(-({_d('churn_yn')} * ln(p) + (1.0 - {_d('churn_yn')}) * ln(1.0 - p))) AS log_loss,
                 count(*) AS n FROM pc""",
        "row_counts": f"""{w}
          SELECT 'raw_rows' AS table_name, count(*) AS n_rows FROM logs
          UNION ALL SELECT 'tracked_rows', count(*) FROM parsed WHERE tracked
          UNION ALL SELECT 'sessions', count(*) FROM sessions
          UNION ALL SELECT 'accounts', count(*) FROM players
          UNION ALL SELECT 'labels', count(*) FROM labels_v""",
    }
