"""Named queries over the driver's tables, each with a DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator on whole tables;
``ORACLE_SQL[name]`` is the same result in plain SQL over the tables registered
as views. Column names match on both sides; decimals are compared as plain
text and averages are rounded to 6 places.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import constants as C
from quayside import schemas
from quayside.functions import epoch_seconds
from quayside.operators import cdc, ingest, metrics, producer
from quayside.session import checkpoint_dir
from quayside.sinks import graph as graph_store, index
from quayside.sources import graphs, snapshot as snap_src, standins, streams
from quayside.sources.tables import table
from quayside.streaming import pipelines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return wrap


# --- fixed parameters of the registered queries -----------------------------------
K_PATH = "$.k"                  # the stand-in messages carry {"k": n}
START_TS = "2024-01-15T00:00:00"
ROLL_MINUTES = C.ROLL_MINUTES
GAP_SECONDS = C.INACTIVITY_SECONDS
SIZE_BYTES = 32                 # small enough that parts split at test scale
CHUNK = C.SNAPSHOT_CHUNK_ROWS
DURATION_S = C.LOAD_DURATION_SECONDS
PCTS = C.PERCENTILES
FAST_BOUND = graphs.DEVICE_EPOCH + 180000
ORDER_BOUND = 820454400         # 1996-01-01
PART_PRICE = 910
SUPPLIER_BALANCE = 5000
USER_IDS = [f"user-{i:06d}" for i in range(1, 6)]
CUSTOMER_IDS = [f"customer-{i}" for i in range(1, 6)]
EVENT_LABELS = ["signup", "view", "click", "purchase", "error"]
NATIONS = ["NATION_1", "NATION_7", "NATION_12", "NATION_20"]
TARGET_NATION = "NATION_3"
SEGMENTS = ["BUILDING", "AUTOMOBILE"]


# --- SQL snippets -------------------------------------------------------------------
def _jscalar(m: str, path: str) -> str:
    return (f"CASE WHEN json_valid({m}) THEN CASE WHEN json_type({m}, '{path}') NOT IN ('OBJECT','ARRAY','NULL') "
            f"THEN json_extract_string({m}, '{path}') END END")


def _jbigint(m: str, path: str) -> str:
    v = _jscalar(m, path)
    return f"CASE WHEN regexp_full_match(trim({v}), '[+-]?[0-9]+') THEN TRY_CAST(trim({v}) AS BIGINT) END"


MIXED = """(SELECT 'events' AS source, event_id AS id, props AS value FROM events
  UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations
  UNION ALL SELECT 'pages', page_id, html FROM pages)"""
DATE = "strftime(ts, '%Y-%m-%d')"
FRAMED_BYTES = "(strlen(props) + 2)"   # message + appended newline + sink newline

_M = "CAST(CAST({e} AS DECIMAL(15,2)) AS DECIMAL(36,18))"
TYPED_CTE = f"""typed AS (
  SELECT CAST(l_orderkey * 8 + l_linenumber AS DECIMAL(20,0)) AS f_id,
         CAST(l_orderkey AS DECIMAL(20,0)) AS f_order_id,
         CAST(l_linenumber AS DECIMAL(20,0)) AS f_seq_id,
         CAST(o_custkey AS DECIMAL(20,0)) AS f_user_id,
         l_returnflag || l_linestatus AS f_symbol,
         CAST(ascii(l_returnflag) AS SMALLINT) AS f_type,
         CAST(ascii(l_linestatus) AS SMALLINT) AS f_action,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DECIMAL(36,18)) AS f_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) AS DECIMAL(36,18)) AS f_available,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(15,2)) AS DECIMAL(36,18)) AS f_hold,
         CAST(CAST(l_quantity AS DECIMAL(15,2)) AS DECIMAL(36,18)) AS f_intra_delta,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(15,2)) AS DECIMAL(36,18)) AS f_fee,
         CAST(1 AS DECIMAL(20,0)) AS f_version,
         CAST(floor(epoch_us(l_shipdate) / 1000000) AS DECIMAL(20,0)) AS f_created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
TYPED_COLS = schemas.ASSET_RECORD.fieldNames()
_DEC = {f.name for f in schemas.ASSET_RECORD.fields if isinstance(f.dataType, T.DecimalType)}
TYPED_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in _DEC else c for c in TYPED_COLS)
TYPED_JSON = "CAST(to_json({" + ", ".join(f"'{c}': CAST({c} AS VARCHAR)" if c in _DEC else f"'{c}': {c}"
                                          for c in TYPED_COLS) + "}) AS VARCHAR)"
CHANGE_LOG = """(SELECT user_id AS key,
   CASE WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op,
   ts AS change_ts, event_id AS position, value AS amount, props AS note FROM events)"""
STATUS = "CASE WHEN event_type = 'error' THEN 'error: ' || props ELSE 'success' END"
SNAP_LOG = f"""(SELECT key, amount, note, op, position FROM (
   SELECT key, amount, note, op, position, tier,
          row_number() OVER (PARTITION BY key ORDER BY position DESC, tier DESC) AS rn
   FROM (SELECT o_orderkey AS key, o_totalprice AS amount, o_orderstatus AS note, 'r' AS op,
                CAST(-1 AS BIGINT) AS position, 0 AS tier FROM orders
         UNION ALL
         SELECT key, amount, note, op, position, 1 FROM {CHANGE_LOG} WHERE op <> 'd')) WHERE rn = 1)"""
K_OF = _jbigint("props", "$.k")
EVENT_VERTICES = f"""(SELECT printf('user-%06d', user_id) AS id, 'user' AS label, user_id, NULL::BIGINT AS k, NULL::BIGINT AS gmt_occur
   FROM (SELECT DISTINCT user_id FROM events)
   UNION ALL SELECT 'device-' || k, 'device', NULL, k, {graphs.DEVICE_EPOCH} + {graphs.DEVICE_STEP} * k
   FROM (SELECT DISTINCT {K_OF} AS k FROM events) WHERE k IS NOT NULL)"""
EVENT_EDGES = f"""(SELECT printf('user-%06d', user_id) AS src, 'device-' || {K_OF} AS dst, event_type AS label,
   {graphs.DEVICE_EPOCH} + {graphs.DEVICE_STEP} * {K_OF} AS dst_gmt FROM events WHERE {K_OF} IS NOT NULL)"""
ORDER_VERTICES = """(SELECT 'customer-' || c_custkey AS id, 'customer' AS label, c_name AS name, c_mktsegment AS mktsegment,
          c_acctbal AS acctbal, NULL::BIGINT AS gmt_occur, NULL AS status, NULL::DOUBLE AS totalprice, NULL AS brand, NULL::DOUBLE AS amount FROM customer
   UNION ALL SELECT 'order-' || o_orderkey, 'order', NULL, NULL, NULL, CAST(floor(epoch_us(o_orderdate) / 1000000) AS BIGINT), o_orderstatus, o_totalprice, NULL, NULL FROM orders
   UNION ALL SELECT 'part-' || p_partkey, 'part', p_name, NULL, NULL, NULL, NULL, NULL, p_brand, p_retailprice FROM part
   UNION ALL SELECT 'supplier-' || s_suppkey, 'supplier', s_name, NULL, NULL, NULL, NULL, NULL, NULL, s_acctbal FROM supplier
   UNION ALL SELECT 'nation-' || n_nationkey, 'nation', n_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM nation
   UNION ALL SELECT 'region-' || r_regionkey, 'region', r_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM region)"""
ORDER_EDGES = """(SELECT 'customer-' || o_custkey AS src, 'order-' || o_orderkey AS dst, 'placed' AS label FROM orders
   UNION ALL SELECT 'order-' || l_orderkey, 'part-' || l_partkey, 'contains' FROM lineitem
   UNION ALL SELECT 'order-' || l_orderkey, 'supplier-' || l_suppkey, 'supplied_by' FROM lineitem
   UNION ALL SELECT 'customer-' || c_custkey, 'nation-' || c_nationkey, 'in_nation' FROM customer
   UNION ALL SELECT 'supplier-' || s_suppkey, 'nation-' || s_nationkey, 'in_nation' FROM supplier
   UNION ALL SELECT 'nation-' || n_nationkey, 'region-' || n_regionkey, 'in_region' FROM nation)"""


def _folder(spark, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _inlist(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ====================================================================================
# Ingest: landing and stream-to-lake
# ====================================================================================

@register("lake_rows", f"""
SELECT props AS payload, {_jbigint('props', K_PATH)} AS ts,
       make_timestamp(epoch_us(ts) // 1000 * 1000) AS processing_timestamp,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d') AS partition_date
FROM events""")
def q_lake_rows(spark, base):
    return ingest.lake_rows(standins.message_stream(spark, base), path=K_PATH)


@register("framed_messages", f"""
SELECT CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", {DATE} AS date, props || chr(10) AS value
FROM events""")
def q_framed_messages(spark, base):
    return ingest.framed_messages(standins.message_stream(spark, base), framing="blank_line")


@register("date_bucket_counts", f"""
SELECT {DATE} AS date, count(*) AS n_messages, CAST(sum({FRAMED_BYTES}) AS BIGINT) AS n_bytes
FROM events GROUP BY 1""")
def q_date_bucket_counts(spark, base):
    return ingest.date_bucket_counts(standins.message_stream(spark, base), framing="blank_line")


@register("json_scalar", f"SELECT source, id, {_jscalar('value', K_PATH)} AS json_value FROM {MIXED}")
def q_json_scalar(spark, base):
    return ingest.json_values(standins.mixed_messages(spark, base), K_PATH)


@register("json_ts_bigint", f"SELECT source, id, {_jbigint('value', K_PATH)} AS ts FROM {MIXED}")
def q_json_ts_bigint(spark, base):
    return ingest.json_timestamps(standins.mixed_messages(spark, base), K_PATH)


@register("json_ts_rejects", f"""
SELECT source, id, json_value FROM (
  SELECT source, id, {_jscalar('value', K_PATH)} AS json_value, {_jbigint('value', K_PATH)} AS ts
  FROM (SELECT * FROM {MIXED} UNION ALL SELECT 'values', event_id, '{{"k":"' || CAST(value AS VARCHAR) || '"}}' FROM events))
WHERE json_value IS NOT NULL AND ts IS NULL""")
def q_json_ts_rejects(spark, base):
    values = standins.value_messages(spark, base).withColumn("source", F.lit("values"))
    return ingest.json_rejects(standins.mixed_messages(spark, base).unionByName(values), K_PATH)


@register("json_outcomes", f"""
SELECT source, id, CASE WHEN json_valid(value) THEN 'json' WHEN value IS NOT NULL THEN 'not_json' END AS outcome FROM {MIXED}""")
def q_json_outcomes(spark, base):
    return ingest.json_outcomes(standins.mixed_messages(spark, base))


@register("json_validity", f"SELECT source, id, json_valid(value) AS is_json FROM {MIXED}")
def q_json_validity(spark, base):
    return ingest.json_validity(standins.mixed_messages(spark, base))


_HARD_SCALAR = """CASE n % 16 WHEN 0 THEN n || '.0' WHEN 1 THEN n || 'e400' WHEN 2 THEN CAST(n AS VARCHAR) WHEN 3 THEN 'a' || chr(65533) || 'b'
  WHEN 4 THEN chr(128512) WHEN 5 THEN '{' || n || '}' WHEN 7 THEN '-0' WHEN 8 THEN n || '.' || n || '0E-07' WHEN 9 THEN chr(92) WHEN 12 THEN 'true'
  WHEN 14 THEN ' ' || n || ' ' END"""


@register("json_exact", f"""
SELECT id, json_value, CASE WHEN regexp_full_match(trim(json_value), '[+-]?[0-9]+') THEN TRY_CAST(trim(json_value) AS BIGINT) END AS ts, is_json
FROM (SELECT n AS id, {_HARD_SCALAR} AS json_value, n % 16 NOT IN (11, 13) AS is_json FROM (SELECT event_id AS n FROM events))""")
def q_json_exact(spark, base):
    """Texts that parsers change: what counts is what the message writes, so the oracle spells it out."""
    return ingest.json_exact(standins.hard_messages(spark, base), K_PATH)


@register("byte_outcomes", f"""
SELECT source, id, CASE WHEN value IS NULL THEN NULL WHEN id % 7 >= 2 THEN 'not_utf8' WHEN id % 7 = 1 THEN 'not_json'
       WHEN valid THEN 'json' ELSE 'not_json' END AS outcome
FROM (SELECT source, id, value, json_valid(value) AS valid FROM {MIXED}
      UNION ALL SELECT 'hard', n, 'hard', n % 16 NOT IN (11, 13) FROM (SELECT event_id AS n FROM events))""")
def q_byte_outcomes(spark, base):
    return ingest.byte_outcomes(standins.byte_messages(spark, base))


@register("peek_first_records", """
SELECT CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", ts AS arrival_ts,
       CAST(user_id AS VARCHAR) AS partition_key, props AS data, json_valid(props) AS is_json
FROM events WHERE user_id % 4 = (SELECT min(user_id % 4) FROM events)
ORDER BY event_id LIMIT 10""")
def q_peek_first_records(spark, base):
    return ingest.peek_first_records(standins.message_stream(spark, base), 10)


@register("start_at_timestamp", f"""
SELECT CAST(user_id % 4 AS INTEGER) AS partition, count(*) AS n_records,
       min(event_id) AS first_offset, max(event_id) AS last_offset
FROM events WHERE ts >= TIMESTAMP '{START_TS.replace('T', ' ')}' GROUP BY 1""")
def q_start_at_timestamp(spark, base):
    spec = streams.resolve_start_position({"start.position": "AT_TIMESTAMP", "start.timestamp": START_TS})
    return ingest.start_counts(streams.apply_start_position(standins.message_stream(spark, base), spec))


@register("start_trim_horizon", """
SELECT CAST(user_id % 4 AS INTEGER) AS partition, count(*) AS n_records,
       min(event_id) AS first_offset, max(event_id) AS last_offset
FROM events GROUP BY 1""")
def q_start_trim_horizon(spark, base):
    spec = streams.resolve_start_position({"start.position": "TRIM_HORIZON"})
    return ingest.start_counts(streams.apply_start_position(standins.message_stream(spark, base), spec))


_WIN = f"make_timestamp(epoch_us(ts) // {ROLL_MINUTES * 60_000_000} * {ROLL_MINUTES * 60_000_000})"


@register("roll_by_age", f"""
SELECT {DATE} AS date, {_WIN} AS window_start, count(*) AS n_messages,
       CAST(sum({FRAMED_BYTES}) AS BIGINT) AS n_bytes, min(event_id) AS first_offset, max(event_id) AS last_offset
FROM events GROUP BY 1, 2""")
def q_roll_by_age(spark, base):
    return ingest.roll_by_age(standins.message_stream(spark, base), ROLL_MINUTES, framing="blank_line")


@register("roll_on_inactivity", f"""
WITH m AS (SELECT {DATE} AS date, ts, event_id, {FRAMED_BYTES} AS b FROM events),
f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL
                      OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= {GAP_SECONDS * 1_000_000}
                     THEN 1 ELSE 0 END AS s
      FROM m WINDOW w AS (PARTITION BY date ORDER BY ts, event_id)),
p AS (SELECT *, sum(s) OVER (PARTITION BY date ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - 1 AS part_no FROM f)
SELECT date, CAST(part_no AS BIGINT) AS part_no, count(*) AS n_messages, CAST(sum(b) AS BIGINT) AS n_bytes,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM p GROUP BY 1, 2""")
def q_roll_on_inactivity(spark, base):
    return ingest.roll_on_inactivity(standins.message_stream(spark, base), GAP_SECONDS, framing="blank_line")


@register("roll_by_size", f"""
WITH m AS (SELECT {DATE} AS date, {_WIN} AS window_start, ts, event_id, {FRAMED_BYTES} AS b FROM events),
r AS (SELECT *, sum(b) OVER (PARTITION BY date, window_start ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running FROM m)
SELECT date, window_start, CAST(floor((running - b) / {SIZE_BYTES}) AS BIGINT) AS part_no, count(*) AS n_messages,
       CAST(sum(b) AS BIGINT) AS n_bytes, min(event_id) AS first_offset, max(event_id) AS last_offset
FROM r GROUP BY 1, 2, 3""")
def q_roll_by_size(spark, base):
    return ingest.roll_by_size(standins.message_stream(spark, base), SIZE_BYTES, ROLL_MINUTES, framing="blank_line")


# ====================================================================================
# Change data
# ====================================================================================

@register("cdc_typed_rows", f"WITH {TYPED_CTE} SELECT {TYPED_TEXT} FROM typed")
def q_cdc_typed_rows(spark, base):
    return cdc.plain_decimals(cdc.conform(standins.typed_rows(spark, base)))


@register("cdc_without_deletes", f"SELECT * FROM {CHANGE_LOG} WHERE op <> 'd'")
def q_cdc_without_deletes(spark, base):
    return cdc.skip_operations(standins.change_log(spark, base))


@register("cdc_latest_image", f"""
SELECT key, op, change_ts, position, amount, note FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY change_ts DESC, position DESC) AS rn
  FROM {CHANGE_LOG} WHERE op <> 'd') WHERE rn = 1""")
def q_cdc_latest_image(spark, base):
    log = cdc.skip_operations(standins.change_log(spark, base))
    return cdc.latest_image(log, "key", ["change_ts", "position"])


@register("cdc_snapshot_plus_log", f"SELECT * FROM {SNAP_LOG}")
def q_cdc_snapshot_plus_log(spark, base):
    return cdc.snapshot_plus_log(standins.snapshot(spark, base),
                                 standins.change_log(spark, base).drop("change_ts"), "key")


@register("cdc_index_compacted", f"SELECT key, amount, note, op, position FROM {SNAP_LOG}")
def q_cdc_index_compacted(spark, base):
    """Snapshot and three batches of changes; a base after the second, an old batch again and late changes
    after it: the state comes from the base and what follows."""
    root = _folder(spark, "index")
    snap = standins.snapshot(spark, base).select("key", "amount", "note", F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("position"))
    log = standins.change_log(spark, base).select("key", "amount", "note", "op", "position")
    part = F.col("position") % 3  # each batch has changes older than those of the one before
    index.write_changes(snap, 0, root)
    for batch_id in (1, 2):
        index.write_changes(log.where(part == batch_id), batch_id, root)
    index.compact_index(spark, root, "key", ["position"])
    index.write_changes(log.where(part == 2), 2, root)
    index.write_changes(log.where(part == 0), 3, root)
    return index.index_state(spark, root, "key", ["position"]).select("key", "amount", "note", "op", "position")


@register("cdc_keyed_stream", f"""
SELECT key, op, change_ts, position, amount, note FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY change_ts DESC, position DESC) AS rn
  FROM {CHANGE_LOG} WHERE op <> 'd') WHERE rn = 1""")
def q_cdc_keyed_stream(spark, base):
    """The change log as a stream through keyed state into the index, read back."""
    root = _folder(spark, "index")
    pipelines.start_keyed_upsert(standins.change_stream(spark, base), "key", ["change_ts", "position"], _folder(spark, "stream"),
                                 lambda rows, batch_id: index.write_changes(rows, batch_id, root), trigger="availableNow").awaitTermination()
    return index.index_state(spark, root, "key", ["change_ts", "position"]).select("key", "op", "change_ts", "position", "amount", "note")


_READ_LOW = f"(key // {standins.READ_CHUNK} * {standins.READ_STEP})"
_READ_ROWS = f"""(SELECT o.key, CASE WHEN c.key IS NULL THEN o.amount ELSE c.amount END AS amount, CASE WHEN c.key IS NULL THEN o.note ELSE c.note END AS note
   FROM (SELECT o_orderkey AS key, o_totalprice AS amount, o_orderstatus AS note FROM orders) o LEFT JOIN
        (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY position DESC) AS rn FROM {CHANGE_LOG}
                        WHERE position <= {_READ_LOW} + {standins.READ_SPAN // 2}) WHERE rn = 1) c USING (key)
   WHERE c.op IS NULL OR c.op <> 'd')"""
_MAX_LOW = f"(SELECT max(o_orderkey) // {standins.READ_CHUNK} * {standins.READ_STEP} FROM orders)"


@register("cdc_incremental_snapshot", f"""
SELECT key, amount, note, op, position FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY tier DESC, position DESC) AS rn FROM (
    SELECT key, amount, note, 'r' AS op, CAST(NULL AS BIGINT) AS position, 0 AS tier FROM {_READ_ROWS}
    UNION ALL SELECT key, amount, note, op, position, 1 FROM {CHANGE_LOG}
    WHERE op <> 'd' AND position > least({_READ_LOW}, {_MAX_LOW}))) WHERE rn = 1""")
def q_cdc_incremental_snapshot(spark, base):
    """Every chunk is read at its own time, while the log goes on."""
    log = standins.change_log(spark, base).drop("change_ts")
    return cdc.incremental_snapshot(standins.read_rows(spark, base), log, standins.read_chunks(spark, base), "key")


@register("cdc_chunk_rows", f"""
SELECT key, amount, note, op, position FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY tier DESC, position DESC) AS rn FROM (
    SELECT key, amount, note, 'r' AS op, CAST(NULL AS BIGINT) AS position, 0 AS tier FROM {_READ_ROWS}
    UNION ALL SELECT key, amount, note, op, position, 1 FROM {CHANGE_LOG}
    WHERE op <> 'd' AND position > least({_READ_LOW}, {_MAX_LOW}) AND position <= least({_READ_LOW}, {_MAX_LOW}) + {standins.READ_SPAN})) WHERE rn = 1""")
def q_cdc_chunk_rows(spark, base):
    log = standins.change_log(spark, base).drop("change_ts")
    return cdc.chunk_rows(standins.read_rows(spark, base), log, standins.read_chunks(spark, base), "key")


@register("cdc_index_state", f"""
SELECT CAST(key AS VARCHAR) AS doc_id,
       CAST(to_json({{'key': key, 'amount': CAST(CAST(amount AS DECIMAL(15,2)) AS VARCHAR), 'note': note, 'op': op, 'position': position}}) AS VARCHAR) AS document
FROM {SNAP_LOG}""")
def q_cdc_index_state(spark, base):
    """Snapshot and change log written as two batches, the second one twice, then read back."""
    root = _folder(spark, "index")
    snap = standins.snapshot(spark, base).select("key", "amount", "note", F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("position"))
    log = standins.change_log(spark, base).select("key", "amount", "note", "op", "position")
    for batch_id, rows in ((0, snap), (1, log), (1, log)):
        index.write_changes(rows, batch_id, root)
    state = index.index_state(spark, root, "key", ["position"])
    state = state.withColumn("amount", F.col("amount").cast("decimal(15,2)"))
    return cdc.json_documents(state.select("key", "amount", "note", "op", "position"), key="key")


@register("cdc_envelope_rows", """
WITH e AS (SELECT *, CASE WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op,
                  CAST(CAST(value AS DECIMAL(15,2)) AS DECIMAL(36,18)) AS a, CAST(0 AS DECIMAL(36,18)) AS zero FROM events)
SELECT op, make_timestamp(epoch_us(ts) // 1000 * 1000) AS change_ts, event_id AS position,
       CAST(event_id AS VARCHAR) AS f_id, CAST(event_id // 10 AS VARCHAR) AS f_order_id, CAST(event_id % 10 AS VARCHAR) AS f_seq_id,
       CAST(user_id AS VARCHAR) AS f_user_id, event_type AS f_symbol, CAST(length(event_type) AS SMALLINT) AS f_type,
       CAST(1 AS SMALLINT) AS f_action, CAST(a AS VARCHAR) AS f_amount, CAST(a AS VARCHAR) AS f_available,
       CAST(zero AS VARCHAR) AS f_hold, CAST(-a AS VARCHAR) AS f_intra_delta, CAST(zero AS VARCHAR) AS f_fee, '1' AS f_version,
       CAST(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS VARCHAR) AS f_created_at
FROM e""")
def q_cdc_envelope_rows(spark, base):
    return cdc.plain_decimals(cdc.decode_envelopes(standins.change_envelopes(spark, base)))


@register("cdc_envelope_rejects", """
SELECT event_id AS id, CASE event_id % 11 WHEN 1 THEN 'bad_value' WHEN 2 THEN 'bad_operation' WHEN 3 THEN 'no_image' WHEN 4 THEN 'null_column'
       WHEN 5 THEN 'no_position' WHEN 6 THEN 'no_time' WHEN 7 THEN 'no_image' ELSE 'not_an_envelope' END AS reason
FROM events WHERE event_id % 11 < 10 AND NOT (event_id % 11 = 7 AND event_type = 'error')""")
def q_cdc_envelope_rejects(spark, base):
    return cdc.envelope_rejects(standins.damaged_envelopes(spark, base)).select("id", "reason")


@register("cdc_duplicate_keys", f"SELECT key, count(*) AS n_rows FROM {CHANGE_LOG} GROUP BY key HAVING count(*) > 1")
def q_cdc_duplicate_keys(spark, base):
    return cdc.duplicate_keys(standins.change_log(spark, base), "key")


@register("mod_partition_key", f"""
WITH {TYPED_CTE} SELECT CAST(f_id AS VARCHAR) AS f_id, CAST(f_id % 4 AS BIGINT) AS partition_key FROM typed""")
def q_mod_partition_key(spark, base):
    return cdc.plain_decimals(cdc.mod_partition_key(standins.typed_rows(spark, base), "f_id", 4))


@register("json_documents", f"WITH {TYPED_CTE} SELECT CAST(f_id AS VARCHAR) AS doc_id, {TYPED_JSON} AS document FROM typed")
def q_json_documents(spark, base):
    return cdc.json_documents(standins.typed_rows(spark, base))


@register("bulk_batches", f"""
WITH {TYPED_CTE},
d AS (SELECT CAST(f_id % 4 AS BIGINT) AS partition_key, f_id, {TYPED_JSON} AS document, strlen({TYPED_JSON}) AS bytes FROM typed),
r AS (SELECT *, row_number() OVER w AS rk, sum(bytes) OVER (w ROWS UNBOUNDED PRECEDING) AS running
      FROM d WINDOW w AS (PARTITION BY partition_key ORDER BY f_id, md5(document)))
SELECT partition_key, CAST(greatest(floor((rk - 1) / 1000), floor((running - bytes) / {5 * 1024 * 1024})) AS BIGINT) AS batch_no,
       count(*) AS n_actions, CAST(sum(bytes) AS BIGINT) AS n_bytes,
       CAST(min(f_id) AS VARCHAR) AS first_key, CAST(max(f_id) AS VARCHAR) AS last_key
FROM r GROUP BY 1, 2""")
def q_bulk_batches(spark, base):
    typed = standins.typed_rows(spark, base)
    docs = cdc.json_documents(typed, extra=[F.col("f_id"), F.expr("mod(f_id, 4)").cast("bigint").alias("partition_key")])
    # f_id repeats (the key is not enforced): md5 of the document breaks ties; its 16 bytes sort like the hex text in SQL
    docs = docs.withColumn("doc_md5", F.unhex(F.md5("document")))
    return cdc.plain_decimals(cdc.bulk_batches(docs, "partition_key", ["f_id", "doc_md5"], "document"))


@register("snapshot_chunks_even", f"""
SELECT CAST(floor((o_orderkey - (SELECT min(o_orderkey) FROM orders)) / {CHUNK}) AS BIGINT) AS chunk,
       min(o_orderkey) AS low, max(o_orderkey) AS high, count(*) AS n_rows
FROM orders GROUP BY 1""")
def q_snapshot_chunks_even(spark, base):
    return snap_src.even_chunks(table(spark, base, "orders").select("o_orderkey"), "o_orderkey", CHUNK)


@register("snapshot_chunks_planned", f"""
SELECT 'orders' AS source, CAST((o_orderkey - (SELECT min(o_orderkey) FROM orders)) // {CHUNK} AS BIGINT) AS chunk,
       min(o_orderkey) AS low, max(o_orderkey) AS high, count(*) AS n_rows FROM orders GROUP BY 2
UNION ALL
SELECT 'order_dates', CAST((rk - 1) // {CHUNK} AS BIGINT), min(k), max(k), count(*)
FROM (SELECT CAST(floor(epoch_us(o_orderdate) / 1000000) AS BIGINT) AS k, row_number() OVER (ORDER BY epoch_us(o_orderdate)) AS rk FROM orders) GROUP BY 2""")
def q_snapshot_chunks_planned(spark, base):
    """The factor rule chooses: dense order keys get equal widths, repeated dates runs of rows."""
    orders = table(spark, base, "orders")
    dates = orders.select(epoch_seconds("o_orderdate").alias("k"))
    even = snap_src.plan_chunks(orders.select("o_orderkey"), "o_orderkey", CHUNK).select(F.lit("orders").alias("source"), "*")
    return even.unionByName(snap_src.plan_chunks(dates, "k", CHUNK).select(F.lit("order_dates").alias("source"), "*"))


@register("snapshot_chunks_uneven", f"""
SELECT CAST(floor((rk - 1) / {CHUNK}) AS BIGINT) AS chunk, min(f_id) AS low, max(f_id) AS high, count(*) AS n_rows
FROM (SELECT l_orderkey * 8 + l_linenumber AS f_id, row_number() OVER (ORDER BY l_orderkey * 8 + l_linenumber) AS rk
      FROM lineitem) GROUP BY 1""")
def q_snapshot_chunks_uneven(spark, base):
    li = table(spark, base, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("f_id"))
    return snap_src.uneven_chunks(li, "f_id", CHUNK)


# ====================================================================================
# Load metrics
# ====================================================================================

@register("throughput_summary", f"""
SELECT CAST({DURATION_S} AS BIGINT) AS duration_s, s AS total_queries, e AS n_errors,
       s / {float(DURATION_S)} AS actual_qps,
       CASE WHEN s > 0 THEN round((s - e) / s * 100.0, 6) END AS success_rate_compat,
       CASE WHEN s + e > 0 THEN round(s / (s + e) * 100.0, 6) END AS success_rate
FROM (SELECT count(*) FILTER (WHERE event_type <> 'error') AS s, count(*) FILTER (WHERE event_type = 'error') AS e FROM events)""")
def q_throughput_summary(spark, base):
    out = metrics.throughput_summary(standins.result_log(spark, base), DURATION_S)
    return out.withColumn("success_rate_compat", F.round("success_rate_compat", 6)) \
              .withColumn("success_rate", F.round("success_rate", 6))


@register("latency_summary", """
WITH o AS (SELECT value AS latency, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n
           FROM events WHERE event_type <> 'error')
SELECT CAST(max(n) AS BIGINT) AS n, min(latency) AS min_ms, max(latency) AS max_ms, round(avg(latency), 6) AS avg_ms,
       min(CASE WHEN i = floor(n * 0.5) THEN latency END) AS p50,
       min(CASE WHEN i = floor(n * 0.95) THEN latency END) AS p95,
       min(CASE WHEN i = floor(n * 0.99) THEN latency END) AS p99
FROM o""")
def q_latency_summary(spark, base):
    out = metrics.latency_summary(standins.result_log(spark, base), PCTS)
    return out.withColumn("avg_ms", F.round("avg_ms", 6))


@register("status_counts", f"""
SELECT trim(split_part({STATUS}, ':', 1)) AS status_class, count(*) AS n FROM events GROUP BY 1""")
def q_status_counts(spark, base):
    return metrics.status_counts(standins.result_log(spark, base))


@register("results_csv_rows", f"""
SELECT printf('req-%012d', event_id) AS client_request_id, event_type AS query_type,
       printf('user-%06d', user_id) AS user_id, value AS latency_ms,
       CAST(CASE WHEN event_type = 'error' THEN 0 ELSE length(props) END AS INTEGER) AS result_count,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", {STATUS} AS status,
       CAST(user_id % 20 AS INTEGER) AS thread_id
FROM events""")
def q_results_csv_rows(spark, base):
    return metrics.csv_rows(standins.result_log(spark, base))


# ====================================================================================
# Graph reads
# ====================================================================================

@register("graph_vertex_count", f"""
SELECT 'events' AS graph, count(*) AS n_vertices FROM {EVENT_VERTICES}
UNION ALL SELECT 'orders', count(*) FROM {ORDER_VERTICES}""")
def q_graph_vertex_count(spark, base):
    a = graphs.event_graph(spark, base).vertex_count().select(F.lit("events").alias("graph"), "n_vertices")
    b = graphs.order_graph(spark, base).vertex_count().select(F.lit("orders").alias("graph"), "n_vertices")
    return a.unionByName(b)


@register("graph_edge_count", f"""
SELECT 'events' AS graph, count(*) AS n_edges FROM {EVENT_EDGES}
UNION ALL SELECT 'orders', count(*) FROM {ORDER_EDGES}""")
def q_graph_edge_count(spark, base):
    a = graphs.event_graph(spark, base).edge_count().select(F.lit("events").alias("graph"), "n_edges")
    b = graphs.order_graph(spark, base).edge_count().select(F.lit("orders").alias("graph"), "n_edges")
    return a.unionByName(b)


_ORDER_PROPS = ["name", "mktsegment", "acctbal", "gmt_occur", "status", "totalprice", "brand", "amount"]


def _long_sql(src: str, keys) -> str:
    parts = [f"SELECT id, '{k}' AS key, CAST({k} AS VARCHAR) AS value FROM {src} WHERE {k} IS NOT NULL" for k in keys]
    return " UNION ALL ".join(parts)


@register("graph_sample_properties", f"""
WITH s AS (SELECT * FROM {ORDER_VERTICES} ORDER BY id LIMIT 3)
{_long_sql('s', _ORDER_PROPS)}""")
def q_graph_sample_properties(spark, base):
    g = graphs.order_graph(spark, base)
    return g.value_map_long(g.sample(3), _ORDER_PROPS)


@register("graph_value_map", f"""
WITH v AS (SELECT * FROM {EVENT_VERTICES})
{_long_sql('v', ['user_id', 'k', 'gmt_occur'])}""")
def q_graph_value_map(spark, base):
    g = graphs.event_graph(spark, base)
    return g.value_map_long(g.V(), ["user_id", "k", "gmt_occur"])


@register("graph_edge_value_map", f"""
WITH e AS (SELECT printf('user-%06d', user_id) AS src, 'device-' || {K_OF} AS dst, event_type AS label, event_id, value FROM events WHERE {K_OF} IS NOT NULL)
SELECT src, dst, label, 'event_id' AS key, CAST(event_id AS VARCHAR) AS value FROM e
UNION ALL SELECT src, dst, label, 'amount', CAST(value AS VARCHAR) FROM e WHERE value IS NOT NULL""")
def q_graph_edge_value_map(spark, base):
    return graphs.event_graph(spark, base).edge_value_map_long(EVENT_LABELS, ["event_id", "amount"])


@register("graph_vertex_by_id", f"""
SELECT id, label FROM {EVENT_VERTICES} WHERE id IN ({_inlist(USER_IDS)})""")
def q_graph_vertex_by_id(spark, base):
    return graphs.event_graph(spark, base).vertex_by_id(USER_IDS).select("id", "label")


@register("graph_has", """
SELECT 'customer-' || c_custkey AS id, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING'""")
def q_graph_has(spark, base):
    return graphs.order_graph(spark, base).has("mktsegment", "BUILDING", label="customer").select("id", "name")


@register("graph_has_within", f"""
SELECT id, label, name FROM {ORDER_VERTICES} WHERE name IN ({_inlist(NATIONS)})""")
def q_graph_has_within(spark, base):
    return graphs.order_graph(spark, base).has_within("name", NATIONS).select("id", "label", "name")


@register("graph_edges_where_source", f"""
SELECT 'customer-' || c_custkey AS src, 'nation-' || c_nationkey AS dst FROM customer
WHERE c_mktsegment IN ({_inlist(SEGMENTS)})""")
def q_graph_edges_where_source(spark, base):
    return graphs.order_graph(spark, base).edges_where_source("in_nation", "mktsegment", SEGMENTS).select("src", "dst")


@register("graph_out_values", """
SELECT k AS prop_key, v AS prop_value FROM (
  SELECT 'status' AS k, o_orderstatus AS v FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT 'totalprice', CAST(o_totalprice AS VARCHAR) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')
WHERE v IS NOT NULL""")
def q_graph_out_values(spark, base):
    g = graphs.order_graph(spark, base)
    return g.out_values(g.has("mktsegment", "BUILDING", label="customer"), "placed", ["status", "totalprice"],
                        to_labels=["order"])


_FAST_SQL = f"""
SELECT src AS center_id, dst AS neighbour_id FROM {EVENT_EDGES}
WHERE src IN ({_inlist(USER_IDS)}) AND label IN ({_inlist(EVENT_LABELS)}) AND dst_gmt >= {FAST_BOUND}"""


@register("neighbours_fast", _FAST_SQL)
def q_neighbours_fast(spark, base):
    g = graphs.event_graph(spark, base)
    return g.neighbours(USER_IDS, EVENT_LABELS, "gmt_occur", FAST_BOUND)


@register("neighbours_union_form", _FAST_SQL)
def q_neighbours_union_form(spark, base):
    g = graphs.event_graph(spark, base)
    return g.neighbours_union(USER_IDS, EVENT_LABELS, "gmt_occur", FAST_BOUND)


_STORED: dict[tuple, object] = {}


def _stored(spark, base, make, name: str):
    """A graph written to the shared folder once per application and table folder."""
    key = (spark.sparkContext.applicationId, base, name)
    if key not in _STORED:
        _STORED[key] = graph_store.stored_graph(make(spark, base), f"{name}_{uuid.uuid4().hex[:12]}", _folder(spark, name), buckets=8)
    return _STORED[key]


@register("neighbours_stored", f"""
SELECT src AS center_id, dst AS neighbour_id FROM {EVENT_EDGES}
WHERE src IN ({_inlist(USER_IDS)}) AND label IN ('view', 'click') AND dst_gmt >= {FAST_BOUND}""")
def q_neighbours_stored(spark, base):
    """G6 from edges stored by label and in buckets by source: two label folders, five buckets at most."""
    return _stored(spark, base, graphs.event_graph, "event_graph").neighbours(USER_IDS, ["view", "click"], "gmt_occur", FAST_BOUND)


@register("graph_edges_stored", f"""
SELECT 'customer-' || c_custkey AS src, 'nation-' || c_nationkey AS dst FROM customer
WHERE c_mktsegment IN ({_inlist(SEGMENTS)})""")
def q_graph_edges_stored(spark, base):
    """G10 from stored edges: one label folder, joined to the source vertices bucket by bucket."""
    return _stored(spark, base, graphs.order_graph, "order_graph").edges_where_source("in_nation", "mktsegment", SEGMENTS).select("src", "dst")


def _two_hop_sql(where_label: str, bound: int) -> str:
    return f"""
WITH v AS {ORDER_VERTICES}, e AS {ORDER_EDGES},
n AS (SELECT e.src AS center_id, e.dst AS neighbour_id FROM e JOIN v ON e.dst = v.id
      WHERE e.src IN ({_inlist(CUSTOMER_IDS)}) AND e.label IN ('placed', 'in_nation') AND v.gmt_occur >= {ORDER_BOUND})
SELECT center_id, neighbour_id FROM n
WHERE EXISTS (SELECT 1 FROM e JOIN v ON e.dst = v.id
              WHERE e.label = '{where_label}' AND e.src = n.neighbour_id AND v.amount >= {bound})"""


@register("neighbours_medium", _two_hop_sql("contains", PART_PRICE))
def q_neighbours_medium(spark, base):
    g = graphs.order_graph(spark, base)
    return g.neighbours(CUSTOMER_IDS, ["placed", "in_nation"], "gmt_occur", ORDER_BOUND,
                        where_label="contains", where_key="amount", where_bound=PART_PRICE)


@register("neighbours_slow", _two_hop_sql("supplied_by", SUPPLIER_BALANCE))
def q_neighbours_slow(spark, base):
    g = graphs.order_graph(spark, base)
    return g.neighbours(CUSTOMER_IDS, ["placed", "in_nation"], "gmt_occur", ORDER_BOUND,
                        where_label="supplied_by", where_key="amount", where_bound=SUPPLIER_BALANCE)


@register("neighbour_counts", f"""
WITH c AS (SELECT DISTINCT printf('user-%06d', user_id) AS center_id FROM events),
f AS (SELECT src AS center_id, count(*) AS n FROM {EVENT_EDGES}
      WHERE label IN ({_inlist(EVENT_LABELS)}) AND dst_gmt >= {FAST_BOUND} GROUP BY src)
SELECT c.center_id, CAST(coalesce(f.n, 0) AS BIGINT) AS result_count FROM c LEFT JOIN f USING (center_id)""")
def q_neighbour_counts(spark, base):
    g = graphs.event_graph(spark, base)
    return g.neighbour_counts(g.V(["user"]), EVENT_LABELS, "gmt_occur", FAST_BOUND)


# ====================================================================================
# Graph writes
# ====================================================================================

def _markets(spark, base):
    seg = table(spark, base, "customer").select("c_mktsegment").distinct()
    return seg.select(F.concat(F.lit("market-"), F.col("c_mktsegment")).alias("id"), F.col("c_mktsegment").alias("name"))


@register("graph_add_vertices", f"""
SELECT id, label, name FROM {ORDER_VERTICES}
UNION ALL SELECT 'market-' || c_mktsegment, 'market', c_mktsegment FROM (SELECT DISTINCT c_mktsegment FROM customer)""")
def q_graph_add_vertices(spark, base):
    g = graphs.order_graph(spark, base).add_vertices("market", _markets(spark, base))
    return g.V().select("id", "label", "name")


@register("graph_add_vertices_any_id", f"""
SELECT id, label, name FROM {ORDER_VERTICES} WHERE label = 'supplier'
UNION ALL SELECT CASE WHEN c_custkey % 3 = 0 THEN 'supplier-' || (c_custkey + 1000000) WHEN c_custkey % 3 = 1 THEN md5(c_name) ELSE 'supplier-0' || c_custkey END,
                 'supplier', c_name FROM customer""")
def q_graph_add_vertices_any_id(spark, base):
    """Vertices under a label with an id rule: ids it makes, and ids it does not make, stay what they are."""
    key = F.col("c_custkey")
    ids = F.when(key % 3 == 0, F.concat(F.lit("supplier-"), key + 1000000)).when(key % 3 == 1, F.md5("c_name")).otherwise(F.concat(F.lit("supplier-0"), key))
    rows = table(spark, base, "customer").select(ids.alias("id"), F.col("c_name").alias("name"))
    return graphs.order_graph(spark, base).add_vertices("supplier", rows).V(["supplier"]).select("id", "label", "name")


@register("graph_add_edges", f"""
SELECT 'customer-' || c_custkey AS src,
       (SELECT min('nation-' || n_nationkey) FROM nation WHERE n_name = '{TARGET_NATION}') AS dst, 'preferred' AS kind
FROM customer WHERE c_mktsegment = 'BUILDING'
  AND (SELECT min('nation-' || n_nationkey) FROM nation WHERE n_name = '{TARGET_NATION}') IS NOT NULL""")
def q_graph_add_edges(spark, base):
    g = graphs.order_graph(spark, base)
    src = g.has("mktsegment", "BUILDING", label="customer")
    dst = g.has("name", TARGET_NATION, label="nation")
    return g.add_edges("prefers", src, dst, {"kind": "preferred"}).edge_table("prefers")


@register("graph_drop_edges", f"""
SELECT e.src, e.dst, e.label FROM {ORDER_EDGES} e
WHERE e.src NOT IN (SELECT id FROM {ORDER_VERTICES} WHERE mktsegment IN ({_inlist(SEGMENTS)}))""")
def q_graph_drop_edges(spark, base):
    return graphs.order_graph(spark, base).drop_edges_where_source("mktsegment", SEGMENTS).E().select("src", "dst", "label")


@register("graph_drop_vertices", f"""
SELECT id, label FROM {ORDER_VERTICES}
WHERE name IS NULL OR name NOT IN ({_inlist(NATIONS)})""")
def q_graph_drop_vertices(spark, base):
    return graphs.order_graph(spark, base).drop_vertices("name", NATIONS).V().select("id", "label")


@register("graph_drop_vertices_edges", f"""
WITH gone AS (SELECT id FROM {ORDER_VERTICES} WHERE name IN ({_inlist(NATIONS)}))
SELECT src, dst, label FROM {ORDER_EDGES}
WHERE src NOT IN (SELECT id FROM gone) AND dst NOT IN (SELECT id FROM gone)""")
def q_graph_drop_vertices_edges(spark, base):
    return graphs.order_graph(spark, base).drop_vertices("name", NATIONS).E().select("src", "dst", "label")


# ====================================================================================
# Producer
# ====================================================================================

@register("generated_messages", """
SELECT 'messages' AS topic, event_id AS idx,
       'Message ' || event_id || ' at ' || ((epoch_us((SELECT min(ts) FROM events)) + event_id * 10000) // 1000) AS value
FROM events""")
def q_generated_messages(spark, base):
    ev = table(spark, base, "events").select("event_id", "ts")
    counter = producer.paced_counter(ev, "event_id", "ts")
    return producer.outgoing_messages(counter, "messages", with_key=False)
