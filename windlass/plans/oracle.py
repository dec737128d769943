"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on the pre-registered parquet views (``events`` ...)
and names its columns exactly as the Spark query does. Building blocks are
CTEs spelled out once here; every query is plain SQL over them.
"""

from __future__ import annotations

from .. import config as C

P = C.FIXTURE_PARTITIONS
SAMPLE_W = C.SAMPLE_WINDOW_SECONDS * 1_000_000
STORE_W = C.STORE_WINDOW_SECONDS * 1_000_000
SEG = C.segment_interval_seconds(C.STORE_RETENTION_SECONDS) * 1_000_000
RET = C.STORE_RETENTION_SECONDS * 1_000_000
TOPIC = C.SAMPLE_TOPIC
APP = C.SAMPLE_APPLICATION_ID
STORE = C.STORE_NAME
CHANGELOG_TOPIC = C.changelog_topic(APP, STORE)


def ws(us: int, col: str = "ts") -> str:
    return f"make_timestamp((epoch_us({col}) // {us}) * {us})"


def we(us: int, col: str = "ts") -> str:
    return f"make_timestamp((epoch_us({col}) // {us} + 1) * {us})"


RECORD = f"""
record AS (
  SELECT '{TOPIC}' AS topic,
         CAST(user_id % {P} AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY user_id % {P} ORDER BY event_id) - 1 AS BIGINT) AS "offset",
         CASE WHEN event_id % {C.FIXTURE_LATE_EVERY} = 0
              THEN ts - INTERVAL {C.FIXTURE_LATE_SHIFT_HOURS} HOUR ELSE ts END AS ts,
         CAST(user_id AS VARCHAR) AS key,
         CAST(round(value * 100) AS BIGINT) AS value
  FROM events),
rec AS (
  SELECT topic, "partition", "offset", ts, key, coalesce(value, 0) AS value
  FROM record WHERE key IS NOT NULL)"""

# zero-grace store over 1 hour windows: stream time per partition, kept rows
KEPT = RECORD + f""",
timed AS (
  SELECT *, max(ts) OVER (PARTITION BY topic, "partition" ORDER BY "offset"
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time,
         {ws(STORE_W)} AS window_start, {we(STORE_W)} AS window_end
  FROM rec),
kept AS (
  SELECT * FROM timed
  WHERE epoch_us(window_end) + {C.STORE_GRACE_SECONDS * 1_000_000} > epoch_us(stream_time)),
strict_state AS (
  SELECT key, window_start, window_end, CAST(count(*) AS BIGINT) AS n, CAST(sum(value) AS BIGINT) AS agg
  FROM kept GROUP BY key, window_start, window_end),
updates AS (
  SELECT topic, "partition", "offset", ts, key, window_start, window_end,
         CAST(sum(value) OVER (PARTITION BY key, window_start ORDER BY "offset"
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS agg
  FROM kept),
changelog AS (
  SELECT '{CHANGELOG_TOPIC}' AS topic, '{STORE}' AS store, "partition", "offset", ts, key,
         window_start, window_end, agg
  FROM updates),
part_time AS (
  SELECT topic, "partition", max(ts) AS stream_time FROM rec GROUP BY topic, "partition")"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {}

ORACLE["read_records"] = with_(RECORD, 'SELECT topic, "partition", "offset", ts, key, value FROM record')

ORACLE["tumbling_sum"] = with_(RECORD, f"""
SELECT key, {ws(SAMPLE_W)} AS window_start, {we(SAMPLE_W)} AS window_end, CAST(sum(value) AS BIGINT) AS agg
FROM rec GROUP BY ALL""")

ORACLE["tumbling_count"] = with_(RECORD, f"""
SELECT key, {ws(SAMPLE_W)} AS window_start, {we(SAMPLE_W)} AS window_end, CAST(count(*) AS BIGINT) AS n
FROM rec GROUP BY ALL""")

ORACLE["tumbling_stats"] = with_(RECORD, f"""
SELECT key, {ws(SAMPLE_W)} AS window_start, {we(SAMPLE_W)} AS window_end,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(value) AS BIGINT) AS total,
       min(value) AS min_value, max(value) AS max_value
FROM rec GROUP BY ALL""")

ORACLE["tumbling_timestamped"] = with_(RECORD, f"""
SELECT key, {ws(SAMPLE_W)} AS window_start, {we(SAMPLE_W)} AS window_end,
       CAST(sum(value) AS BIGINT) AS agg, max(ts) AS value_ts
FROM rec GROUP BY ALL""")

ORACLE["keyed_sum"] = with_(RECORD, """
SELECT key, CAST(sum(value) AS BIGINT) AS agg, CAST(count(*) AS BIGINT) AS n FROM rec GROUP BY key""")

ORACLE["hopping_sum"] = with_(RECORD, """
SELECT key, window_start, window_start + INTERVAL 2 HOUR AS window_end,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(value) AS BIGINT) AS agg
FROM (SELECT key, value, unnest([make_timestamp((epoch_us(ts) // 3600000000) * 3600000000),
                                 make_timestamp((epoch_us(ts) // 3600000000 - 1) * 3600000000)]) AS window_start
      FROM rec)
GROUP BY ALL""")

ORACLE["sliding_sum"] = with_(RECORD, """
SELECT topic, "partition", "offset", ts, key, value,
       CAST(sum(value) OVER (PARTITION BY key ORDER BY ts
            RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS BIGINT) AS agg
FROM rec""")

ORACLE["sliding_windows"] = with_(RECORD + """,
ms AS (SELECT key, epoch_us(ts) // 1000 AS t, value FROM rec),
ends AS (SELECT DISTINCT key, t AS e FROM ms UNION SELECT DISTINCT key, t + 21600001 FROM ms)""", """
SELECT e.key, make_timestamp((e.e - 21600000) * 1000) AS window_start, make_timestamp(e.e * 1000) AS window_end,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(m.value) AS BIGINT) AS agg
FROM ends e JOIN ms m ON m.key = e.key AND m.t BETWEEN e.e - 21600000 AND e.e
GROUP BY e.key, e.e""")

ORACLE["longest_rise"] = with_(RECORD + f""",
w AS (SELECT key, {ws(SAMPLE_W)} AS window_start, {we(SAMPLE_W)} AS window_end, "offset", value FROM rec),
f AS (SELECT *, CASE WHEN value > lag(value) OVER (PARTITION BY key, window_start ORDER BY "offset") THEN 0 ELSE 1 END AS nw
      FROM w),
g AS (SELECT *, sum(nw) OVER (PARTITION BY key, window_start ORDER BY "offset") AS run FROM f),
r AS (SELECT key, window_start, window_end, run, count(*) AS n FROM g GROUP BY ALL)""", """
SELECT key, window_start, window_end, CAST(sum(n) AS BIGINT) AS n, CAST(max(n) AS BIGINT) AS longest
FROM r GROUP BY key, window_start, window_end""")

ORACLE["session_sum"] = with_(RECORD + """,
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY key ORDER BY ts) <= INTERVAL 6 HOUR
                     THEN 0 ELSE 1 END AS nw FROM rec),
h AS (SELECT *, sum(nw) OVER (PARTITION BY key ORDER BY ts, nw DESC
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g)""", """
SELECT key, min(ts) AS session_start, max(ts) AS session_end, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(value) AS BIGINT) AS agg
FROM h GROUP BY key, sid""")

ORACLE["window_rows"] = with_(RECORD, f"""
SELECT key, {ws(SAMPLE_W)} AS window_start, {we(SAMPLE_W)} AS window_end, "partition", "offset", value,
       CAST(row_number() OVER (PARTITION BY key, {ws(SAMPLE_W)} ORDER BY "offset") AS BIGINT) AS seq
FROM rec""")

ORACLE["window_last"] = with_(RECORD, f"""
SELECT key, {ws(SAMPLE_W)} AS window_start, {we(SAMPLE_W)} AS window_end,
       arg_max(value, "offset") AS value, max("offset") AS "offset"
FROM rec GROUP BY ALL""")

ORACLE["ordered_fold"] = with_(RECORD, f"""
SELECT key, {ws(SAMPLE_W)} AS window_start, {we(SAMPLE_W)} AS window_end,
       CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list(value ORDER BY "offset")),
                        lambda a, x: greatest(0, a + x - {{drift}})) AS BIGINT) AS agg
FROM rec GROUP BY ALL""")

ORACLE["strict_late_drop"] = with_(KEPT, "SELECT key, window_start, window_end, n, agg FROM strict_state")

ORACLE["update_stream"] = with_(KEPT, """
SELECT topic, "partition", "offset", ts, key, window_start, window_end, agg FROM updates""")

ORACLE["final_windows"] = with_(KEPT, f"""
SELECT s.key, s.window_start, s.window_end, s.n, s.agg
FROM (SELECT topic, "partition", key, window_start, window_end, CAST(count(*) AS BIGINT) AS n,
             CAST(sum(value) AS BIGINT) AS agg FROM kept GROUP BY ALL) s
JOIN part_time p USING (topic, "partition")
WHERE epoch_us(s.window_end) + {C.STORE_GRACE_SECONDS * 1_000_000} <= epoch_us(p.stream_time)""")

ORACLE["live_windows"] = with_(KEPT, f"""
SELECT s."partition", s.key, s.window_start, s.window_end, s.n, s.agg
FROM (SELECT topic, "partition", key, window_start, window_end, CAST(count(*) AS BIGINT) AS n,
             CAST(sum(value) AS BIGINT) AS agg FROM kept GROUP BY ALL) s
JOIN part_time p USING (topic, "partition")
WHERE epoch_us(s.window_start) > epoch_us(p.stream_time) - {RET}""")

ORACLE["segment_rollup"] = with_(KEPT, f"""
SELECT epoch_us(window_start) // {SEG} AS segment_id, CAST(count(*) AS BIGINT) AS windows,
       CAST(sum(n) AS BIGINT) AS records, CAST(sum(agg) AS BIGINT) AS agg,
       min(window_start) AS min_window_start, max(window_start) AS max_window_start
FROM strict_state GROUP BY 1""")

ORACLE["changelog_compact"] = with_(KEPT, """
SELECT "partition", key, window_start, window_end, arg_max(agg, "offset") AS agg, max("offset") AS "offset"
FROM changelog GROUP BY "partition", key, window_start, window_end""")

ORACLE["source_positions"] = with_(RECORD, """
SELECT topic, "partition", max("offset") AS position, CAST(count(*) AS BIGINT) AS records
FROM record GROUP BY topic, "partition" """)

ORACLE["offsets_checkpoint"] = with_(KEPT, """
SELECT topic, "partition", store, max("offset") AS "offset" FROM changelog GROUP BY topic, "partition", store""")

SC_CUTS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
SC_LOCAL_CUT = "2024-01-05 00:00:00"
SC_LOST = "(2)"
N = C.DEFAULT_SNAPSHOT_FREQUENCY
T = C.RESTORE_OFFSET_THRESHOLD

SNAP = KEPT + f""",
flush AS (
  SELECT *, CAST('0x' || substr(md5(CAST("partition" AS VARCHAR) || ':' || CAST("offset" AS VARCHAR)), 1, 8)
                 AS BIGINT) % {N} = 0 AS sampled
  FROM changelog),
pos1 AS (SELECT "partition", max("offset") AS version FROM flush
         WHERE sampled AND ts < TIMESTAMP '{SC_CUTS[0]}' GROUP BY "partition"),
pos2 AS (SELECT "partition", max("offset") AS version FROM flush
         WHERE sampled AND ts < TIMESTAMP '{SC_CUTS[1]}' GROUP BY "partition"),
state1 AS (SELECT c."partition", c.key, c.window_start, c.window_end, arg_max(c.agg, c."offset") AS agg, p.version
           FROM changelog c JOIN pos1 p USING ("partition") WHERE c."offset" <= p.version GROUP BY ALL),
state2 AS (SELECT c."partition", c.key, c.window_start, c.window_end, arg_max(c.agg, c."offset") AS agg, p.version
           FROM changelog c JOIN pos2 p USING ("partition") WHERE c."offset" <= p.version GROUP BY ALL),
pointers AS (
  SELECT '{APP}' AS app, '0_' || CAST("partition" AS VARCHAR) AS task, '{STORE}' AS store, version,
         CAST(count(*) AS BIGINT) AS row_count FROM state1 GROUP BY ALL
  UNION ALL
  SELECT '{APP}' AS app, '0_' || CAST("partition" AS VARCHAR) AS task, '{STORE}' AS store, version,
         CAST(count(*) AS BIGINT) AS row_count FROM state2 GROUP BY ALL),
localc AS (
  SELECT '{APP}' AS app, '0_' || CAST("partition" AS VARCHAR) AS task, store, topic, "partition",
         max("offset") AS "offset"
  FROM changelog WHERE ts < TIMESTAMP '{SC_LOCAL_CUT}' AND "partition" NOT IN {SC_LOST}
  GROUP BY ALL),
remotec AS (
  SELECT '{APP}' AS app, '0_' || CAST("partition" AS VARCHAR) AS task, '{STORE}' AS store,
         '{CHANGELOG_TOPIC}' AS topic, "partition", version AS "offset" FROM pos2)"""

ORACLE["snapshot_state"] = with_(SNAP, "SELECT * FROM pointers")

ORACLE["latest_snapshot"] = with_(SNAP, """
SELECT app, task, store, arg_max(version, version) AS version, arg_max(row_count, version) AS row_count
FROM pointers GROUP BY app, task, store""")

ORACLE["read_snapshot"] = with_(SNAP, f"""
SELECT '0_' || CAST("partition" AS VARCHAR) AS task, '{STORE}' AS store, version, "partition", key,
       window_start, window_end, agg, epoch_us(window_start) // {SEG} AS segment_id
FROM state2""")

ORACLE["snapshot_manifest"] = with_(SNAP, f"""
SELECT '0_' || CAST("partition" AS VARCHAR) AS task, version, epoch_us(window_start) // {SEG} AS segment_id,
       CAST(count(*) AS BIGINT) AS "rows", CAST(sum(agg) AS BIGINT) AS agg,
       min(window_start) AS min_window_start, max(window_start) AS max_window_start, true AS files_listed
FROM state2 GROUP BY ALL""")

ORACLE["snapshot_aggregates"] = with_(KEPT, """
SELECT k."partition", key, window_start, window_end, CAST(count(*) AS BIGINT) AS n, CAST(sum(value) AS BIGINT) AS total,
       max(ts) AS value_ts, any_value(p.version) AS version
FROM kept k JOIN (SELECT "partition", max("offset") AS version FROM kept GROUP BY ALL) p USING ("partition")
GROUP BY k."partition", key, window_start, window_end""")

ORACLE["restore_with_tail"] = with_(KEPT, "SELECT key, window_start, window_end, agg FROM strict_state")

ORACLE["restore_decision"] = with_(SNAP + """,
stores AS (SELECT app, task, store FROM localc UNION SELECT app, task, store FROM remotec),
r AS (SELECT app, task, store, count(*) AS n, min(topic) AS r_topic, min("partition") AS r_partition,
             max("offset") AS r_offset FROM remotec GROUP BY ALL),
t AS (SELECT DISTINCT app, task, true AS has_local FROM localc),
d AS (SELECT s.app, s.task, s.store, coalesce(r.n, 0) AS n, r.r_topic, r.r_partition, r.r_offset,
             coalesce(t.has_local, false) AS has_local, l."offset" AS l_offset
      FROM stores s LEFT JOIN r ON s.app = r.app AND s.task = r.task AND s.store = r.store
      LEFT JOIN t ON s.app = t.app AND s.task = t.task
      LEFT JOIN localc l ON l.app = s.app AND l.task = s.task AND l.topic = r.r_topic
                         AND l."partition" = r.r_partition)""", f"""
SELECT app, task, store,
       CASE WHEN n = 1 THEN r_topic END AS topic,
       CASE WHEN n = 1 THEN r_partition END AS "partition",
       CASE WHEN n = 1 THEN l_offset END AS local_offset,
       CASE WHEN n = 1 THEN r_offset END AS remote_offset,
       CASE WHEN n = 0 THEN false WHEN NOT has_local THEN true WHEN n <> 1 THEN false
            WHEN l_offset IS NULL THEN true ELSE l_offset + {T} < r_offset END AS should_fetch,
       CASE WHEN n = 0 THEN 'no remote checkpoint' WHEN NOT has_local THEN 'no local checkpoint'
            WHEN n <> 1 THEN 'remote checkpoint names several partitions'
            WHEN l_offset IS NULL THEN 'partition missing locally'
            WHEN l_offset + {T} < r_offset THEN 'local behind remote by more than threshold'
            ELSE 'local within threshold' END AS reason
FROM d""")

ORACLE["merge_offsets"] = with_(SNAP, """
SELECT coalesce(r.app, l.app) AS app, coalesce(r.task, l.task) AS task, coalesce(r.topic, l.topic) AS topic,
       coalesce(r."partition", l."partition") AS "partition", coalesce(r."offset", l."offset") AS "offset",
       CASE WHEN r."offset" IS NOT NULL THEN 'remote' ELSE 'local' END AS source
FROM (SELECT * FROM localc WHERE (app, task) IN (SELECT app, task FROM remotec)) l
FULL OUTER JOIN remotec r
  ON l.app = r.app AND l.task = r.task AND l.topic = r.topic AND l."partition" = r."partition" """)

ORACLE["lag_report"] = with_(SNAP + f""",
endc AS (SELECT '{APP}' AS app, '0_' || CAST("partition" AS VARCHAR) AS task, store, topic, "partition",
                max("offset") + 1 AS end_offset FROM changelog GROUP BY ALL)""", f"""
SELECT e.app, e.task, e.store, e.topic, e."partition", e.end_offset,
       coalesce(l."offset" + 1, 0) AS current_offset,
       e.end_offset - coalesce(l."offset" + 1, 0) AS lag,
       e.end_offset - coalesce(l."offset" + 1, 0) <= {C.ACCEPTABLE_RECOVERY_LAG} AS caught_up
FROM endc e LEFT JOIN localc l
  ON e.app = l.app AND e.task = l.task AND e.store = l.store AND e.topic = l.topic
 AND e."partition" = l."partition" """)

_EVENT_LIST = "[" + ", ".join(f"'{e}'" for e in C.TASK_EVENTS) + "]"
TASK_EVENT = f"""
te AS (
  SELECT event_id AS seq, CAST(user_id % {P} AS INTEGER) AS "partition",
         CASE WHEN user_id % {2 * P} < {P} THEN 'agg-store' ELSE 'count-store' END AS store,
         {_EVENT_LIST}[event_id % {len(C.TASK_EVENTS)} + 1] AS event, event_id % 3 AS total
  FROM events),
status AS (
  SELECT "partition", store,
         coalesce(arg_max(event IN ('restore_start', 'standby_start')
                          OR (event IN ('restore_suspended', 'standby_suspended') AND total <= 0), seq)
                  FILTER (WHERE event IN ('restore_start', 'restore_end', 'restore_suspended',
                                          'standby_start', 'standby_suspended')), false) AS restoring,
         coalesce(arg_max(event = 'standby_start', seq)
                  FILTER (WHERE event IN ('standby_start', 'standby_suspended')), false) AS standby,
         CAST(count(*) AS BIGINT) AS events
  FROM te GROUP BY ALL)"""

ORACLE["task_status"] = with_(TASK_EVENT, 'SELECT "partition", store, restoring, standby, events FROM status')

ORACLE["snapshot_eligible"] = with_(KEPT + "," + TASK_EVENT + """,
offs AS (SELECT topic, "partition", store, max("offset") AS "offset" FROM changelog GROUP BY ALL),
src AS (SELECT DISTINCT "partition", topic AS source_topic FROM record)""", """
SELECT coalesce(s."partition", o."partition") AS "partition", coalesce(s.store, o.store) AS store,
       coalesce(s.restoring, false) AS restoring, coalesce(s.standby, false) AS standby,
       o."offset", src.source_topic,
       NOT coalesce(s.restoring, false) AND NOT coalesce(s.standby, false) AND o."offset" IS NOT NULL
         AND src.source_topic IS NOT NULL AS eligible
FROM status s FULL OUTER JOIN offs o ON s."partition" = o."partition" AND s.store = o.store
LEFT JOIN src ON src."partition" = coalesce(s."partition", o."partition")""")

ORACLE["snapshot_sampled"] = with_(SNAP, """
SELECT topic, "partition", "offset", key, window_start, agg FROM flush WHERE sampled""")

# Streams: batch b of a partition is floor(offset * BATCHES / end). With a zero delay a
# record is late in batch b if its window ended by the newest time of the batches up to
# b - 2, and a window is closed once it ended by the newest time of all batches.
BATCHES = 4


def stream_(us: int) -> str:
    return RECORD + f""",
cut AS (
  SELECT r.*, CAST(floor(r."offset" * {BATCHES} / e.n) AS BIGINT) AS batch_id
  FROM record r JOIN (SELECT "partition", max("offset") + 1 AS n FROM record GROUP BY ALL) e USING ("partition")),
sized AS (SELECT batch_id, CAST(count(*) AS BIGINT) AS input_rows FROM cut GROUP BY ALL),
b AS (
  SELECT batch_id, ts, key, coalesce(value, 0) AS value, {ws(us)} AS window_start, {we(us)} AS window_end
  FROM cut WHERE key IS NOT NULL),
newest AS (SELECT batch_id, max(ts) AS ts FROM b GROUP BY ALL),
late AS (
  SELECT i.batch_id, max(n.ts) AS mark
  FROM (SELECT unnest(range({BATCHES})) AS batch_id) i LEFT JOIN newest n ON n.batch_id <= i.batch_id - 2 GROUP BY ALL),
on_time AS (SELECT b.* FROM b JOIN late USING (batch_id) WHERE mark IS NULL OR window_end > mark)"""


ORACLE["tumbling_stream"] = with_(stream_(SAMPLE_W), """
SELECT key, window_start, window_end, CAST(sum(value) AS BIGINT) AS agg FROM on_time GROUP BY ALL""")

ORACLE["for_each_update"] = with_(stream_(STORE_W) + """,
per AS (SELECT batch_id, key, window_start, window_end, sum(value) AS v, count(*) AS c FROM on_time GROUP BY ALL)""", """
SELECT batch_id, key, window_start, window_end,
       CAST(sum(v) OVER (PARTITION BY key, window_start ORDER BY batch_id) AS BIGINT) AS agg,
       CAST(sum(c) OVER (PARTITION BY key, window_start ORDER BY batch_id) AS BIGINT) AS n
FROM per""")

ORACLE["read_operator_state"] = with_(stream_(STORE_W), """
SELECT key, window_start, window_end, CAST(sum(value) AS BIGINT) AS agg, CAST(count(*) AS BIGINT) AS n
FROM on_time WHERE window_end > (SELECT max(ts) FROM b) GROUP BY ALL""")

ORACLE["query_events"] = with_(stream_(STORE_W), f"""
SELECT 'started' AS event, CAST(NULL AS BIGINT) AS batch_id, CAST(NULL AS BIGINT) AS input_rows
UNION ALL SELECT 'progress', batch_id, input_rows FROM sized
UNION ALL SELECT 'progress', {BATCHES}, 0
UNION ALL SELECT 'terminated', NULL, NULL""")

# streaming forms whose final state has an exact batch twin
ORACLE["strict_stream"] = ORACLE["restore_with_tail"]
ORACLE["final_stream"] = ORACLE["final_windows"]
ORACLE["update_changelog_stream"] = ORACLE["update_stream"]
ORACLE["live_stream"] = ORACLE["live_windows"]
ORACLE["window_rows_stream"] = ORACLE["window_rows"]
ORACLE["session_stream"] = ORACLE["session_sum"]
# a window is past its retention once the newest time (in ms, as watermarks are) reaches its
# start + retention; until then every record of it counts
ORACLE["expiring_stream"] = with_(RECORD + f""",
w AS (SELECT key, {ws(STORE_W)} AS window_start, value FROM rec)""", f"""
SELECT key, window_start, CAST(sum(value) AS BIGINT) AS agg FROM w
WHERE epoch_us(window_start) + {RET} > (SELECT max(epoch_us(ts)) // 1000 * 1000 FROM rec) GROUP BY ALL""")
ORACLE["enrich_orders"] = with_(RECORD, """
SELECT r.topic, r."partition", r."offset", r.ts, r.key, r.value, c.c_name, c.c_mktsegment, n.n_name
FROM rec r LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = r.key LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
ORACLE["bootstrap_stream"] = ORACLE["tumbling_sum"]


def oracle_sql() -> dict[str, str]:
    from .queries import CUSUM_DRIFT
    out = dict(ORACLE)
    out["ordered_fold"] = out["ordered_fold"].replace("{drift}", str(CUSUM_DRIFT))
    return out
