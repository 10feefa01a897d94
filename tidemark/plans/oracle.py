"""DuckDB oracle SQL for every registered query with a SQL equivalent.

Written independently of the Spark code from the same derivation rules
(see ``derive``): windows with lag/lead per key, EXCEPT ALL, scalar
subqueries.  Column names match the Spark outputs.
"""

from __future__ import annotations

from tidemark.functions.timeconv import SENTINEL_NS
from tidemark.plans.derive import (DAY_NS, DUP_OFFSET, MALFORMED_OFFSET, PARTITIONS, SNAPSHOT_OFFSET, T_CUTOFF, WINDOW_HI,
                                   WINDOW_LO)
from tidemark.plans.queries import BATCH_ROWS, DELETE_DELAY_NS, HOT_USER, LOADED_AT, T_ORDERS

S, T, LO, HI = SENTINEL_NS, T_CUTOFF, WINDOW_LO, WINDOW_HI


def R(x: str) -> str:
    """Round epoch ns to whole seconds, half up; the sentinel stays."""
    return (f"(CASE WHEN {x} = {S} THEN {x} ELSE ({x} + 500000000) - "
            f"((({x} + 500000000) % 1000000000) + 1000000000) % 1000000000 END)")


BASE = f"""
WITH ev AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) * 1000 AS ts_ns FROM events
), nb AS (
  SELECT *, lag(event_id) OVER w AS p_id, lag(event_type) OVER w AS p_type, lag(value) OVER w AS p_value,
         lag(ts_ns) OVER w AS p_ts, lead(event_type) OVER w AS n_type, lead(ts_ns) OVER w AS n_ts
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts_ns, event_id)
), cl AS (
  SELECT event_id AS message_id, user_id AS key_id,
         CASE WHEN event_type = 'error' THEN 'd' WHEN p_id IS NULL OR p_type = 'error' THEN 'c' ELSE 'u' END AS op,
         ts_ns,
         CASE WHEN p_id IS NOT NULL AND p_type <> 'error' THEN p_type END AS before_event_type,
         CASE WHEN p_id IS NOT NULL AND p_type <> 'error' THEN p_value END AS before_value,
         CASE WHEN p_id IS NOT NULL AND p_type <> 'error' THEN p_ts END AS before_valid_from,
         CASE WHEN event_type <> 'error' THEN event_type END AS after_event_type,
         CASE WHEN event_type <> 'error' THEN value END AS after_value,
         CASE WHEN event_type <> 'error' THEN ts_ns END AS after_valid_from
  FROM nb
), msg AS (
  SELECT message_id, op AS operation, ts_ns,
         CASE WHEN op <> 'd' OR before_valid_from IS NOT NULL THEN key_id END AS key_id, ts_ns AS event_time,
         cl.key_id AS owner
  FROM cl
), ver AS (
  SELECT event_id, user_id, event_type, value, ts_ns AS valid_from, COALESCE(n_ts, {S}) AS valid_to,
         COALESCE(n_type = 'error', false) AS deleted, n_ts IS NULL AS is_live
  FROM nb WHERE event_type <> 'error'
), v_main AS (
  SELECT user_id, event_type, value, valid_from, valid_to FROM ver WHERE is_live
), v_archive AS (
  SELECT user_id, event_type, value, valid_from, valid_to FROM ver WHERE NOT is_live
), asof_h AS (
  SELECT event_id, user_id, event_type, value, valid_from, valid_to FROM ver WHERE is_live AND valid_from <= {T}
  UNION ALL
  SELECT event_id, user_id, event_type, value, valid_from, valid_to FROM (
    SELECT *, max(valid_from) OVER (PARTITION BY user_id) AS mf, max(valid_to) OVER (PARTITION BY user_id) AS mt
    FROM ver a WHERE NOT is_live AND valid_from <= {T} AND (valid_to = {S} OR {T} < valid_to)
      AND NOT EXISTS (SELECT 1 FROM ver m WHERE m.is_live AND m.user_id = a.user_id
                      AND m.valid_from = a.valid_to AND m.valid_from <= {T})
  ) x WHERE valid_from = mf AND valid_to = mt
), recs AS (
  SELECT 'shop.dbo.user_state' AS topic, message_id AS "offset", operation, 'dbo' AS "schema",
         'user_state' AS "table", ts_ns, key_id, event_time, owner FROM msg
  UNION ALL
  SELECT 'shop.dbo.user_state', message_id + {DUP_OFFSET}, operation, 'dbo', 'user_state', ts_ns, key_id, event_time, owner
  FROM msg WHERE message_id % 89 = 0
  UNION ALL
  SELECT 'shop.dbo.user_state', message_id + {MALFORMED_OFFSET}, NULL, NULL, NULL, NULL, NULL, NULL, owner
  FROM msg WHERE message_id % 97 = 0
  UNION ALL
  SELECT 'shop.dbo.user_state_archive', event_id, 'c', 'dbo', 'user_state_archive', valid_to, user_id, valid_to, user_id
  FROM ver WHERE NOT is_live
  UNION ALL
  SELECT 'shop.dbo.user_state', event_id + {SNAPSHOT_OFFSET}, 'r', 'dbo', 'user_state', {T}, user_id, valid_from, user_id
  FROM asof_h
), ord AS (
  SELECT o_custkey, o_orderkey, o_totalprice, epoch_us(o_orderdate) * 1000 AS ts_ns FROM orders
), o_nb AS (
  SELECT *, lead(ts_ns) OVER (PARTITION BY o_custkey ORDER BY ts_ns, o_orderkey) AS n_ts FROM ord
), o_main AS (
  SELECT o_custkey, ts_ns AS valid_from, {S} AS valid_to FROM o_nb WHERE n_ts IS NULL
), snap AS (
  SELECT 'user_state' AS table_name,
         (SELECT count(*) FROM v_main WHERE valid_from <= {T})
         + (SELECT count(*) FROM v_archive a WHERE valid_from <= {T} AND (valid_to = {S} OR {T} <= valid_to)
            AND NOT EXISTS (SELECT 1 FROM v_main m WHERE m.user_id = a.user_id AND m.valid_from = a.valid_to
                            AND m.valid_from <= {T})) AS ending_offset
  UNION ALL
  SELECT 'user_state_archive', (SELECT count(*) FROM v_archive WHERE valid_to <> {S} AND valid_to <= {T})
), oh AS (
  SELECT s.table_name, CAST(0 AS BIGINT) AS load_id, CAST(0 AS BIGINT) AS version, CAST({LOADED_AT} AS BIGINT) AS load_date,
         CAST(-1 AS BIGINT) AS last_message_id, 'Initial' AS status, true AS is_preloaded,
         CAST(s.ending_offset + COALESCE(r.n, 0) AS BIGINT) AS ending_offset, false AS is_validated,
         CAST(NULL AS BIGINT) AS validated_date
  FROM snap s LEFT JOIN (SELECT 'user_state' AS table_name, count(*) AS n FROM asof_h) r ON r.table_name = s.table_name
), bh AS (
  SELECT 'all' AS table_name, event_time // {DAY_NS} AS load_id, CAST(0 AS BIGINT) AS version,
         CAST({LOADED_AT} AS BIGINT) AS load_date, max(message_id) AS last_message_id, 'Successful' AS status,
         false AS is_preloaded, CAST(-1 AS BIGINT) AS ending_offset, false AS is_validated,
         max(event_time) AS validated_date
  FROM msg GROUP BY event_time // {DAY_NS}
), pl AS (
  SELECT table_name, load_id, CAST(1 AS BIGINT) AS version, load_date, last_message_id, 'Successful' AS status,
         is_preloaded, ending_offset, is_validated, validated_date FROM oh
), pv AS (
  SELECT table_name, load_id, CAST(2 AS BIGINT) AS version, load_date, last_message_id, status, is_preloaded, ending_offset,
         true AS is_validated, CAST({T} AS BIGINT) AS validated_date FROM pl WHERE table_name = 'user_state'
), hist AS (
  SELECT * FROM oh UNION ALL SELECT * FROM pl UNION ALL SELECT * FROM pv UNION ALL SELECT * FROM bh WHERE validated_date > {T}
), eff AS (
  SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY table_name, load_id ORDER BY version DESC) = 1
), flags AS (
  SELECT table_name, bool_or(status IN ('Initial', 'Successful')) AS initialized,
         bool_or(status = 'Successful' AND COALESCE(is_preloaded, false)) AS preloaded,
         bool_or(status = 'Successful' AND COALESCE(is_preloaded, false) AND COALESCE(is_validated, false)) AS validated
  FROM eff GROUP BY table_name
), pos AS (
  SELECT topic, owner % {PARTITIONS} AS "partition", max("offset") + 1 AS "offset" FROM recs
  WHERE operation IS NOT NULL AND ts_ns <= {T} GROUP BY topic, owner % {PARTITIONS}
), ol AS (
  SELECT table_name, topic, COALESCE("partition", 0)::INTEGER AS "partition", COALESCE("offset", 0) AS "offset" FROM (
    SELECT DISTINCT table_name, CASE table_name WHEN 'user_state' THEN 'shop.dbo.user_state' ELSE 'shop.dbo.user_state_archive' END AS topic
    FROM eff WHERE status IN ('Initial', 'Successful') AND is_preloaded AND table_name IN ('user_state', 'user_state_archive')
  ) LEFT JOIN pos USING (topic)
)
"""


def windows(name: str, main: str, archive: str) -> str:
    """CTEs <name>_rows and <name>_archive: what validates the window (LO, HI] of a current table and its archive."""
    return f""", {name}_a AS (
  SELECT a.*, m.valid_from AS m_from, m.user_id IS NULL AS gone
  FROM {archive} a LEFT JOIN {main} m ON m.user_id = a.user_id
), {name}_b AS (
  SELECT *, CASE WHEN gone THEN {R('valid_from')} ELSE valid_from END AS pf,
         CASE WHEN gone THEN {R('valid_to')} ELSE valid_to END AS pt,
         CASE WHEN gone THEN {R(str(HI))} ELSE {HI} END AS ph
  FROM {name}_a
), {name}_p AS (
  SELECT *, max(valid_from) OVER (PARTITION BY user_id) AS mf, max(valid_to) OVER (PARTITION BY user_id) AS mt
  FROM {name}_b WHERE valid_from > {LO} AND pf <= ph AND (valid_to = {S} OR ph <= pt)
                   AND NOT COALESCE(m_from = valid_to AND m_from <= {HI}, false)
), {name}_rows AS (
  SELECT user_id, event_type, value, valid_from, valid_to FROM {main} WHERE valid_from > {LO} AND valid_from <= {HI}
  UNION ALL
  SELECT user_id, event_type, value, valid_from, pt AS valid_to FROM {name}_p WHERE valid_from = mf AND valid_to = mt
), {name}_archive AS (
  SELECT user_id, event_type, value, valid_from, pt AS valid_to FROM {name}_b WHERE pt > {LO} AND pt <= ph
)"""


def applied(name: str, msgs: str, existing: str | None = None) -> str:
    """CTE <name>: ``msgs`` (k, t, i, op, event_type, value, valid_from) applied in the order of (t, i) to
    ``existing`` (user_id, event_type, value, valid_from)."""
    rows = existing or "(SELECT NULL::BIGINT AS user_id, NULL::VARCHAR AS event_type, NULL::DOUBLE AS value, NULL::BIGINT AS valid_from WHERE false)"
    return f""", {name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY t, i) AS n FROM {msgs}
), {name}_d AS (SELECT k, max(n) AS dn FROM {name}_r WHERE op = 'd' GROUP BY k
), {name}_c AS (SELECT r.k, min(n) AS cn FROM {name}_r r LEFT JOIN {name}_d d ON d.k = r.k
                WHERE op = 'c' AND n > COALESCE(dn, 0) GROUP BY r.k
), {name}_u AS (SELECT k, max(n) AS un FROM {name}_r WHERE op = 'u' GROUP BY k
), {name}_e AS (SELECT user_id AS k, event_type, value, valid_from FROM {rows}
), {name}_w AS (
  SELECT x.k, CASE WHEN e.k IS NOT NULL AND dn IS NULL THEN 0 ELSE cn END AS base, un
  FROM (SELECT k FROM {name}_r UNION SELECT k FROM {name}_e) x LEFT JOIN {name}_d d ON d.k = x.k
  LEFT JOIN {name}_c c ON c.k = x.k LEFT JOIN {name}_u u ON u.k = x.k LEFT JOIN {name}_e e ON e.k = x.k
), {name}_f AS (
  SELECT k, CASE WHEN un > base THEN un ELSE base END AS n FROM {name}_w WHERE base IS NOT NULL
), {name} AS (
  SELECT e.k AS user_id, e.event_type, e.value, e.valid_from, {S} AS valid_to FROM {name}_f f JOIN {name}_e e ON e.k = f.k AND f.n = 0
  UNION ALL
  SELECT r.k, r.event_type, r.value, r.valid_from, {S} FROM {name}_f f JOIN {name}_r r ON r.k = f.k AND r.n = f.n
)"""


# messages of the log as apply sees them; a delete of an absent key has no key
LOG = """, lg AS (
  SELECT CASE WHEN op <> 'd' OR before_valid_from IS NOT NULL THEN key_id END AS k, ts_ns AS t, message_id AS i, op,
         after_event_type AS event_type, after_value AS value, after_valid_from AS valid_from FROM cl
), log AS (SELECT * FROM lg WHERE k IS NOT NULL)"""


def late(ignore: bool, every: int = 7) -> str:
    kept = "WHERE NOT COALESCE(t < last_t, false)" if ignore else ""
    return (BASE + LOG + f""", on_time AS (SELECT * FROM log WHERE i % {every} <> 0),
marks AS (SELECT k, max(t) AS last_t FROM on_time GROUP BY k)""" + applied("first", "on_time") + f""",
later AS (SELECT log.* FROM (SELECT * FROM log WHERE i % {every} = 0) log LEFT JOIN marks USING (k) {kept})"""
            + applied("second", "later", "first") + "SELECT * FROM second")


MIXED = BASE + f""", mx AS (
  SELECT message_id AS i, CASE WHEN op = 'u' AND message_id % 11 = 0 THEN 'c' WHEN op = 'c' AND message_id % 13 = 0 THEN 'u' ELSE op END AS op,
         CASE WHEN message_id % 3 = 0 THEN {T} ELSE ts_ns - ts_ns % 3600000000000 END AS t,
         CASE WHEN op <> 'd' OR before_valid_from IS NOT NULL THEN CASE WHEN message_id % 3 = 0 THEN {HOT_USER} ELSE key_id END END AS k,
         after_event_type AS event_type, after_value AS value, after_valid_from AS valid_from, message_id % 17 = 0 AS cut FROM cl
), mixed AS (SELECT * FROM mx WHERE k IS NOT NULL AND (op = 'd' OR NOT cut)
), seeds AS (SELECT DISTINCT user_id, 'seed' AS event_type, 0.0::DOUBLE AS value, 0::BIGINT AS valid_from FROM events WHERE user_id % 2 = 0)"""

# a target of its own: lost messages, late deletes, changed and doubled rows
FAULTS = (LOG + f""", flog AS (SELECT k, CASE WHEN op = 'd' THEN t + {DELETE_DELAY_NS} ELSE t END AS t, i, op, event_type, value, valid_from
  FROM log WHERE i % 53 <> 7)""" + applied("f_live", "flog") + f""",
f_main AS (SELECT user_id, event_type, CASE WHEN user_id % 13 = 5 THEN value + 1.0 ELSE value END AS value, valid_from, valid_to FROM f_live),
f_arch1 AS (SELECT key_id AS user_id, before_event_type AS event_type, before_value AS value, before_valid_from AS valid_from,
                   CASE WHEN op = 'd' THEN ts_ns + {DELETE_DELAY_NS} ELSE ts_ns END AS valid_to
            FROM cl WHERE op IN ('u', 'd') AND before_valid_from IS NOT NULL AND message_id % 53 <> 7),
f_arch AS (SELECT * FROM f_arch1 UNION ALL SELECT * FROM f_arch1 WHERE user_id % 11 = 7)""")


def summary(name: str, src: str, tgt: str, ctes: str = "") -> str:
    return f"""{BASE}{ctes}, src AS ({src}), tgt AS ({tgt})
SELECT '{name}' AS table_name, (SELECT count(*) FROM src) AS source_rows, (SELECT count(*) FROM tgt) AS target_rows,
       (SELECT count(*) FROM (SELECT * FROM src EXCEPT ALL SELECT * FROM tgt)) AS only_in_source,
       (SELECT count(*) FROM (SELECT * FROM tgt EXCEPT ALL SELECT * FROM src)) AS only_in_target,
       (SELECT count(*) FROM (SELECT * FROM src EXCEPT ALL SELECT * FROM tgt)) = 0
       AND (SELECT count(*) FROM (SELECT * FROM tgt EXCEPT ALL SELECT * FROM src)) = 0 AS is_equal"""


TS = "'%Y-%m-%d %H:%M:%S.%f'"
ROWS = "user_id, event_type, value, valid_from, valid_to"
STATUS_TABLES = {
    "load_status": "['user_state', 'user_state_archive']",
    "table_status": "['user_state', 'user_state_archive', 'customer_last_order']",
}


def _table_status(tables: str) -> str:
    return f"""SELECT q.table_name, COALESCE(f.initialized, false) AS initialized,
       COALESCE(f.preloaded, false) AS preloaded, COALESCE(f.validated, false) AS validated
FROM (SELECT DISTINCT unnest({tables}) AS table_name) q LEFT JOIN flags f ON f.table_name = q.table_name"""


ORACLE: dict[str, str] = {
    "changelog": BASE + """SELECT message_id, key_id, op, ts_ns, before_event_type, before_value, before_valid_from,
       after_event_type, after_value, after_valid_from FROM cl""",
    "apply_current": BASE + "SELECT * FROM v_main",
    "apply_archive": BASE + f"SELECT {ROWS}, deleted FROM ver WHERE NOT is_live",
    "apply_multi_table": BASE + """SELECT 'user_state' AS table_name, user_id AS key_id, valid_from, valid_to FROM v_main
UNION ALL SELECT 'customer_last_order', o_custkey, valid_from, valid_to FROM o_main""",
    "apply_in_batches": BASE + "SELECT * FROM v_main",
    "process_journal": BASE + "SELECT * FROM v_main",
    "stream_bootstrap_then_apply": BASE + "SELECT * FROM v_main",
    "apply_mixed": MIXED + applied("r", "mixed", "seeds") + "SELECT * FROM r",
    "apply_rejects": MIXED + """SELECT op AS operation, 'malformed after image' AS reason, count(*) AS n
FROM mx WHERE op <> 'd' AND cut GROUP BY op""",
    "late_messages": late(False),
    "late_messages_ignore": late(True),
    "preload_load": BASE + f"SELECT user_id, event_type, value, valid_from, {S} AS valid_to FROM asof_h",
    "preload_archive": BASE + f"SELECT {ROWS}, deleted FROM ver WHERE valid_to <> {S} AND valid_to <= {T}",
    "validation_cycle": BASE + "SELECT max(event_time) AS last_validated_ns, NULL::BIGINT AS next_validated_ns FROM msg",
    "envelope_parse": BASE + """SELECT topic, owner % 3 AS "partition", "offset", operation, "schema", "table", ts_ns FROM recs""",
    "key_extract": BASE + """SELECT topic, "offset", key_id FROM recs""",
    "event_time": BASE + """SELECT "offset", operation, "table", event_time FROM recs""",
    "row_image": BASE + f"""SELECT message_id AS "offset", key_id AS user_id, after_event_type AS event_type,
       after_value AS value, after_valid_from AS valid_from, {S} AS valid_to FROM cl WHERE op <> 'd'
UNION ALL
SELECT message_id + {DUP_OFFSET}, key_id, after_event_type, after_value, after_valid_from, {S}
FROM cl WHERE op <> 'd' AND message_id % 89 = 0
UNION ALL
SELECT event_id + {SNAPSHOT_OFFSET}, user_id, event_type, value, valid_from, {S} FROM asof_h""",
    "journal_dedupe": BASE + f""", jr AS (SELECT key_id, operation, ts_ns FROM msg WHERE event_time <= {T}),
dd AS (SELECT operation, "schema", "table", ts_ns, key_id, event_time, min("offset") AS message_id
       FROM recs WHERE operation <> 'r' GROUP BY operation, "schema", "table", ts_ns, key_id, event_time)
SELECT message_id, operation, "schema", "table", ts_ns, key_id, event_time FROM dd
WHERE NOT EXISTS (SELECT 1 FROM jr WHERE jr.key_id = dd.key_id AND jr.operation = dd.operation
                  AND dd."table" = 'user_state' AND jr.ts_ns = dd.ts_ns)""",
    "duplicate_keys": BASE + """SELECT key_id, operation, "table", ts_ns, count(*) AS n FROM recs
GROUP BY key_id, operation, "table", ts_ns HAVING count(*) > 1""",
    "batch_select": f"""WITH m AS (SELECT o_orderkey AS message_id, epoch_us(o_orderdate) * 1000 AS event_time FROM orders),
top AS (SELECT * FROM m ORDER BY event_time NULLS FIRST, message_id LIMIT {BATCH_ROWS}),
b AS (SELECT min(event_time) AS lo, max(event_time) AS hi FROM top)
SELECT message_id, event_time FROM m
WHERE message_id IN (SELECT message_id FROM top) OR event_time BETWEEN (SELECT lo FROM b) AND (SELECT hi FROM b)""",
    "batch_select_journal": BASE + f""", m AS (SELECT topic, owner % {PARTITIONS} AS "partition", "offset" AS message_id, operation, event_time
  FROM recs WHERE operation <> 'r' AND event_time > {LO}),
top AS (SELECT event_time FROM m ORDER BY event_time, message_id LIMIT {BATCH_ROWS})
SELECT * FROM m WHERE event_time BETWEEN (SELECT min(event_time) FROM top) AND (SELECT max(event_time) FROM top)""",
    "batch_select_third": """WITH m AS (SELECT o_orderkey AS message_id, epoch_us(o_orderdate) * 1000 AS event_time FROM orders),
top AS (SELECT * FROM m ORDER BY event_time NULLS FIRST, message_id LIMIT (SELECT count(*) // 3 FROM m)),
b AS (SELECT min(event_time) AS lo, max(event_time) AS hi FROM top)
SELECT message_id, event_time FROM m
WHERE message_id IN (SELECT message_id FROM top) OR event_time BETWEEN (SELECT lo FROM b) AND (SELECT hi FROM b)""",
    "unprocessed_intervals": BASE + f"""SELECT topic, owner % {PARTITIONS} AS "partition", "offset" AS message_id, operation, event_time
FROM recs WHERE operation <> 'r' AND NOT coalesce(event_time <= {LO} OR "offset" % 5 = 0, false)""",
    "load_history_partitions": BASE + f"""SELECT event_time // {DAY_NS} AS load_id, topic, owner % {PARTITIONS} AS "partition",
  max("offset") AS last_message_id, max(event_time) AS event_time, count(*) AS n FROM recs WHERE operation <> 'r' GROUP BY 1, 2, 3""",
    "stream_compacted": BASE + f"SELECT {ROWS}, deleted FROM ver WHERE NOT is_live",
    "stream_late_ignore": late(True, 3),
    "stream_dedupe_watermark": BASE + """SELECT DISTINCT operation, "schema", "table", ts_ns, key_id, event_time FROM recs WHERE key_id IS NOT NULL
UNION ALL SELECT operation, "schema", "table", ts_ns, key_id, event_time FROM recs WHERE key_id IS NULL""",
    "journal_dedupe_indexed": BASE + """SELECT min("offset") AS message_id, operation, "schema", "table", ts_ns, key_id, event_time
FROM recs WHERE operation <> 'r' AND key_id IS NOT NULL GROUP BY operation, "schema", "table", ts_ns, key_id, event_time
UNION ALL SELECT unnest([m, m]), operation, "schema", "table", ts_ns, NULL, event_time FROM (
  SELECT min("offset") AS m, operation, "schema", "table", ts_ns, event_time
  FROM recs WHERE operation <> 'r' AND key_id IS NULL GROUP BY operation, "schema", "table", ts_ns, event_time)""",
    "journal_summary": BASE + f""", dd AS (SELECT "table", min(topic) AS topic, arg_min(owner, "offset") % {PARTITIONS} AS "partition", min("offset") AS m, event_time
  FROM recs WHERE operation <> 'r' GROUP BY operation, "schema", "table", ts_ns, key_id, event_time)
SELECT "table", topic, "partition", count(*) AS n, 0::BIGINT AS reads, min(event_time) AS first_time, max(event_time) AS last_time,
       min(m) AS first_message_id, max(m) AS last_message_id FROM dd GROUP BY 1, 2, 3""",
    "epoch_to_ts": BASE + f"""SELECT event_id, valid_from, valid_to,
       strftime(make_timestamp(valid_from // 1000), {TS}) AS from_ts,
       CASE WHEN valid_to = {S} THEN '9999-12-31 23:59:59.999999'
            ELSE strftime(make_timestamp(valid_to // 1000), {TS}) END AS to_ts,
       strftime(make_timestamp((valid_from // 1000000) * 1000), {TS}) AS from_ms_ts,
       true AS unknown_unit_is_null
FROM ver""",
    "epoch_day_to_date": """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS INTEGER) AS order_day,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS order_date FROM orders""",
    "round_seconds": BASE + f"SELECT event_id, valid_to, {R('valid_to')} AS rounded_ns FROM ver",
    "asof_rebuild": BASE + f"SELECT {ROWS} FROM asof_h",
    "asof_rebuild_orders": f"""WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
  epoch_us(o_orderdate) * 1000 AS ts_ns FROM orders), v AS (
SELECT o_custkey, o_orderkey, o_totalprice, order_date, ts_ns AS valid_from,
       COALESCE(lead(ts_ns) OVER (PARTITION BY o_custkey ORDER BY ts_ns, o_orderkey), {S}) AS valid_to FROM o)
SELECT * FROM v WHERE valid_from <= {T_ORDERS} AND (valid_to = {S} OR valid_to > {T_ORDERS})""",
    "asof_rebuild_reference": BASE + f"""SELECT {ROWS} FROM v_main WHERE valid_from <= {T}
UNION ALL
SELECT user_id, event_type, value, valid_to AS valid_from, {S} AS valid_to FROM (
  SELECT *, max(valid_from) OVER (PARTITION BY user_id) AS mf, max(valid_to) OVER (PARTITION BY user_id) AS mt
  FROM v_archive a WHERE valid_from <= {T} AND (valid_to = {S} OR {T} <= valid_to)
    AND NOT EXISTS (SELECT 1 FROM v_main m WHERE m.user_id = a.user_id AND m.valid_from = a.valid_to
                    AND m.valid_from <= {T})
) x WHERE valid_from = mf AND valid_to = mt""",
    "snapshot_size": BASE + "SELECT table_name, ending_offset FROM snap",
    "suggest_cutoff": BASE + """SELECT min(v) AS cutoff_ns FROM (
  SELECT v FROM (SELECT valid_from AS v FROM v_main UNION SELECT valid_from FROM o_main) u ORDER BY v DESC LIMIT 2) t""",
    "window_rows": BASE + windows("win", "v_main", "v_archive") + "SELECT * FROM win_rows",
    "archive_window_rows": BASE + windows("win", "v_main", "v_archive") + "SELECT * FROM win_archive",
    "validate_window": summary("user_state", "SELECT * FROM win_rows", "SELECT * FROM fwin_rows",
                               windows("win", "v_main", "v_archive") + FAULTS + windows("fwin", "f_main", "f_arch")),
    "validate_checksum": summary("user_state", "SELECT * FROM win_rows", "SELECT * FROM fwin_rows",
                                 windows("win", "v_main", "v_archive") + FAULTS + windows("fwin", "f_main", "f_arch")),
    "validate_archive_window": summary("user_state_archive", "SELECT * FROM win_archive", "SELECT * FROM fwin_archive",
                                       windows("win", "v_main", "v_archive") + FAULTS + windows("fwin", "f_main", "f_arch")),
    "validate_preload": summary(
        "user_state", f"SELECT user_id, event_type, value, valid_from, {S} AS valid_to FROM asof_h",
        f"""SELECT user_id, event_type, CASE WHEN user_id % 13 = 5 THEN value + 1.0 ELSE value END AS value, ts_ns AS valid_from, {S} AS valid_to FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ns DESC, event_id DESC) AS rn
              FROM ev WHERE ts_ns <= {T}) x WHERE rn = 1 AND event_type <> 'error'"""),
    "validate_preload_archive": summary(
        "user_state_archive", f"SELECT {ROWS}, deleted FROM ver WHERE valid_to <> {S} AND valid_to <= {T}",
        """SELECT * FROM pa UNION ALL SELECT * FROM pa WHERE user_id % 11 = 7""",
        f""", pa AS (SELECT key_id AS user_id, before_event_type AS event_type, before_value AS value, before_valid_from AS valid_from,
  ts_ns AS valid_to, op = 'd' AS deleted FROM cl WHERE op IN ('u', 'd') AND before_valid_from IS NOT NULL AND ts_ns <= {T})"""),
    "multiset_diff": """WITH a AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) * 1000 AS ts_ns FROM events),
b0 AS (SELECT * FROM a WHERE event_id % 97 <> 0 UNION ALL SELECT * FROM a WHERE event_id % 89 = 0),
b AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 83 = 0 THEN value + 1.0 ELSE value END AS value,
             ts_ns FROM b0)
SELECT *, 'source' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) x
UNION ALL
SELECT *, 'target' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) y""",
    "stream_journal": BASE + """SELECT min("offset") AS message_id, operation, "schema", "table", ts_ns, key_id, event_time
FROM recs WHERE operation <> 'r' GROUP BY operation, "schema", "table", ts_ns, key_id, event_time""",
    "stream_apply": BASE + "SELECT * FROM v_main",
    "stream_bootstrap": BASE + "SELECT * FROM oh",
    "preload_cutoff": BASE + f"SELECT COALESCE(max(valid_from), {T}) AS cutoff_ns FROM asof_h",
    "offset_history": BASE + "SELECT * FROM oh",
    "load_history": BASE + "SELECT * FROM bh",
    "mark_validated": BASE + f"""SELECT table_name, load_id, CAST(1 AS BIGINT) AS version, load_date, last_message_id,
       status, is_preloaded, ending_offset, true AS is_validated, validated_date
FROM bh WHERE status = 'Successful' AND validated_date > {LO} AND validated_date <= {HI} AND NOT is_validated""",
    "load_status": BASE + f""", ts AS ({_table_status(STATUS_TABLES['load_status'])})
SELECT bool_and(initialized) OR bool_and(preloaded) OR bool_and(validated) AS is_initialized,
       bool_and(preloaded) OR bool_and(validated) AS is_preloaded, bool_and(validated) AS is_preloaded_validated
FROM ts""",
    "table_status": BASE + _table_status(STATUS_TABLES["table_status"]),
    "validation_watermarks": BASE + """SELECT
  max(validated_date) FILTER (WHERE status = 'Successful' AND is_validated) AS last_validated_ns,
  max(validated_date) FILTER (WHERE status = 'Successful' AND NOT is_validated AND validated_date >
      (SELECT max(validated_date) FROM eff WHERE status = 'Successful' AND is_validated)) AS next_validated_ns
FROM eff""",
    "offset_lookup": BASE + """SELECT table_name, topic, "partition", "offset" FROM ol""",
    "starting_offsets": BASE + """, tp AS (SELECT topic, string_agg('"' || CAST("partition" AS VARCHAR) || '":' || CAST("offset" AS VARCHAR), ','
  ORDER BY "partition") AS p FROM ol GROUP BY topic)
SELECT '{' || string_agg('"' || topic || '":{' || p || '}', ',' ORDER BY topic) || '}' AS starting_offsets FROM tp""",
}
