"""Map the driver's tables onto the roles the operators expect.

| role | from | rule |
| --- | --- | --- |
| message stream | events | value = props, arrival_ts = ts, offset = event_id, partition = user_id % 4, partition_key = user_id |
| non-JSON messages | conversations, pages | value = text / html |
| change log | events | key = user_id; signup -> c, view/click/purchase -> u, error -> d; order (ts, event_id) |
| snapshot | orders | key = o_orderkey (dense from 0) |
| typed 14-column rows | lineitem join orders | ids DECIMAL(20,0), amounts DECIMAL(36,18) |
| result log | events | latency = value, error rows fail, thread = user_id % 20 |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import schemas
from quayside.functions import epoch_millis, epoch_seconds, iso_text, padded_id
from quayside.sources.tables import SCHEMAS, table

SHARDS = 4
THREADS = 20


def message_stream(spark: SparkSession, base: str) -> DataFrame:
    ev = table(spark, base, "events", ["event_id", "ts", "user_id", "props"])
    return ev.select(
        (F.col("user_id") % SHARDS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("arrival_ts"),
        F.col("user_id").cast("string").alias("partition_key"),
        F.col("props").alias("value"),
    )


def mixed_messages(spark: SparkSession, base: str) -> DataFrame:
    """JSON messages plus free text and HTML (most of which is not JSON)."""
    ev = table(spark, base, "events", ["event_id", "props"]).select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"), F.col("props").alias("value"))
    conv = table(spark, base, "conversations", ["conv_id", "turn", "text"]).select(
        F.lit("conversations").alias("source"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("value"))
    pages = table(spark, base, "pages", ["page_id", "html"]).select(
        F.lit("pages").alias("source"), F.col("page_id").alias("id"), F.col("html").alias("value"))
    return ev.unionByName(conv).unionByName(pages)


def value_messages(spark: SparkSession, base: str) -> DataFrame:
    """Messages ``{"k": "<value>"}``: a scalar that is mostly no whole number."""
    ev = table(spark, base, "events", ["event_id", "value"])
    return ev.select(F.lit("events").alias("source"), F.col("event_id").alias("id"),
                     F.concat(F.lit('{"k":"'), F.col("value").cast("string"), F.lit('"}')).alias("value"))


#: SQL for JSON texts that parsers like to change or refuse, from the number ``n`` of an event
HARD_JSON = """CASE n % 16
  WHEN 0 THEN '{"k":' || n || '.0}'
  WHEN 1 THEN '{"k":' || n || 'e400}'
  WHEN 2 THEN '{"k":1,"k":' || n || '}'
  WHEN 3 THEN '{"k":"a' || chr(92) || 'ud800b"}'
  WHEN 4 THEN '{"k":"' || chr(92) || 'uD83D' || chr(92) || 'uDE00"}'
  WHEN 5 THEN '{"k":"{' || n || '}"}'
  WHEN 6 THEN '{"k":{"k":' || n || '}}'
  WHEN 7 THEN '{"j":"k' || chr(92) || '":1,","k":-0}'
  WHEN 8 THEN ' { "k" : ' || n || '.' || n || '0E-07 } '
  WHEN 9 THEN '{"' || chr(92) || 'u006b":"' || chr(92) || chr(92) || '"}'
  WHEN 10 THEN '{"k":[' || n || ']}'
  WHEN 11 THEN '{"k":' || n || '} ' || n
  WHEN 12 THEN '{"k":true}'
  WHEN 13 THEN '{"k":0' || n || '}'
  WHEN 14 THEN '{"k":" ' || n || ' "}'
  ELSE '{"k":null}' END"""

#: SQL for bytes put after a message: none, then sequences that are or are not UTF-8
TAILS = ["", "F09F9880", "FF", "C3", "C080", "EDA080", "F4908080"]


def hard_messages(spark: SparkSession, base: str) -> DataFrame:
    """``id, value``: a JSON text of ``HARD_JSON`` per event."""
    return table(spark, base, "events").select(F.col("event_id").alias("n")).select(F.col("n").alias("id"), F.expr(HARD_JSON).alias("value"))


def byte_messages(spark: SparkSession, base: str) -> DataFrame:
    """``source, id, value``: the mixed messages and the hard ones as bytes, with a tail of ``TAILS`` by id."""
    hard = hard_messages(spark, base).select(F.lit("hard").alias("source"), "id", "value")
    tail = F.element_at(F.array(*[F.unhex(F.lit(t)) for t in TAILS]), (F.col("id") % len(TAILS) + 1).cast("int"))
    return mixed_messages(spark, base).unionByName(hard).select("source", "id", F.concat(F.encode("value", "UTF-8"), tail).alias("value"))


def _operation():
    return F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")


def change_log(spark: SparkSession, base: str) -> DataFrame:
    return change_log_of(table(spark, base, "events"))


def change_stream(spark: SparkSession, base: str) -> DataFrame:
    """The change log as a stream over the events table (a pattern, as the table may be one file)."""
    return change_log_of(spark.readStream.schema(SCHEMAS["events"]).parquet(f"{base.rstrip('/')}/event[s].parquet"))


def change_log_of(ev: DataFrame) -> DataFrame:
    op = _operation()
    return ev.select(
        F.col("user_id").alias("key"), op.alias("op"), F.col("ts").alias("change_ts"),
        F.col("event_id").alias("position"), F.col("value").alias("amount"), F.col("props").alias("note"))


def snapshot(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("note"))


READ_CHUNK = 100      # keys per chunk of the incremental snapshot
READ_STEP = 40         # log positions from one chunk's start to the next one's
READ_SPAN = 60         # log positions that go by while a chunk is read


def read_chunks(spark: SparkSession, base: str) -> DataFrame:
    """Chunks of ``snapshot`` with the log positions before and after each was read."""
    chunk = F.expr(f"key div {READ_CHUNK}")
    return snapshot(spark, base).groupBy(chunk.alias("chunk")).agg(F.min("key").alias("low")).select(
        "chunk", "low", (F.col("chunk") * READ_STEP).alias("low_position"), (F.col("chunk") * READ_STEP + READ_SPAN).alias("high_position"))


def read_rows(spark: SparkSession, base: str) -> DataFrame:
    """What a chunk-wise read of ``snapshot`` sees while ``change_log`` goes on: each chunk in the state halfway
    through its read, rows deleted by then left out."""
    at = F.expr(f"key div {READ_CHUNK}") * READ_STEP + READ_SPAN // 2
    seen = change_log(spark, base).where(F.col("position") <= at).groupBy("key").agg(F.max_by(F.struct("op", "amount", "note"), "position").alias("c"))
    rows = snapshot(spark, base).join(seen, "key", "left").where("c IS NULL OR c.op <> 'd'")
    return rows.select("key", F.when(F.col("c").isNull(), F.col("amount")).otherwise(F.col("c.amount")).alias("amount"),
                       F.when(F.col("c").isNull(), F.col("note")).otherwise(F.col("c.note")).alias("note"))


def typed_rows(spark: SparkSession, base: str) -> DataFrame:
    """Rows of the 14-column asset table (M5), cast to its declared types."""
    li = table(spark, base, "lineitem", [
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate"])
    od = table(spark, base, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    money = lambda c: F.col(c).cast("decimal(15,2)")  # noqa: E731  (values carry two decimals)
    price = money("l_extendedprice")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast(schemas.ID).alias("f_id"),
        F.col("l_orderkey").cast(schemas.ID).alias("f_order_id"),
        F.col("l_linenumber").cast(schemas.ID).alias("f_seq_id"),
        F.col("o_custkey").cast(schemas.ID).alias("f_user_id"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("f_symbol"),
        F.ascii("l_returnflag").cast("smallint").alias("f_type"),
        F.ascii("l_linestatus").cast("smallint").alias("f_action"),
        price.cast(schemas.AMOUNT).alias("f_amount"),
        (price * (F.lit(1) - money("l_discount"))).cast(schemas.AMOUNT).alias("f_available"),
        (price * money("l_discount")).cast(schemas.AMOUNT).alias("f_hold"),
        money("l_quantity").cast(schemas.AMOUNT).alias("f_intra_delta"),
        (price * money("l_tax")).cast(schemas.AMOUNT).alias("f_fee"),
        F.lit(1).cast(schemas.ID).alias("f_version"),
        epoch_seconds("l_shipdate").cast(schemas.ID).alias("f_created_at"),
    )


def change_envelopes(spark: SparkSession, base: str, *besides: str) -> DataFrame:
    """One change envelope per event (JSON text ``value``): the 14 columns as images ``before`` and ``after``;
    ``besides`` are columns of the event to keep."""
    ev = table(spark, base, "events").withColumn("op", _operation())
    amount = F.col("value").cast("decimal(15,2)").cast(schemas.AMOUNT)
    values = {"f_id": F.col("event_id"), "f_order_id": F.expr("event_id div 10"), "f_seq_id": F.col("event_id") % 10, "f_user_id": F.col("user_id"),
              "f_symbol": F.col("event_type"), "f_type": F.length("event_type"), "f_action": F.lit(1), "f_amount": amount, "f_available": amount,
              "f_hold": F.lit(0), "f_intra_delta": -amount, "f_fee": F.lit(0), "f_version": F.lit(1), "f_created_at": epoch_seconds("ts")}
    text = lambda f, c: c.cast(f.dataType).cast("string") if isinstance(f.dataType, T.DecimalType) else c
    image = F.struct(*[text(f, values[f.name]).alias(f.name) for f in schemas.ASSET_RECORD.fields])
    envelope = F.struct("op", F.when(F.col("op") != "c", image).alias("before"), F.when(F.col("op") != "d", image).alias("after"),
                        epoch_millis("ts").alias("ts_ms"), F.col("event_id").alias("position"))
    return ev.select(*besides, F.to_json(envelope).alias("value"))


def damaged_envelopes(spark: SparkSession, base: str) -> DataFrame:
    """``id, value``: the change envelopes, ten of eleven with one damage each, by the event's id."""
    v = F.col("value")
    damage = [F.concat(v, F.lit(" x")), F.regexp_replace(v, '"f_type":[0-9]+', '"f_type":"abc"'), F.replace(v, F.lit('"op":"'), F.lit('"op":"x')),
              F.replace(F.replace(v, F.lit('"before":'), F.lit('"was":')), F.lit('"after":'), F.lit('"is":')), F.regexp_replace(v, '"f_user_id":"[0-9]+",', ""),
              F.replace(v, F.lit('"position":'), F.lit('"pos":')), F.replace(v, F.lit('"ts_ms":'), F.lit('"ts":')), F.replace(v, F.lit('"after":'), F.lit('"is":')),
              F.concat(v, F.lit(","), v), F.concat(F.lit("["), v, F.lit("]")), v]
    rows = change_envelopes(spark, base, "event_id").withColumnRenamed("event_id", "id")
    return rows.select("id", F.element_at(F.array(*damage), (F.col("id") % len(damage) + 1).cast("int")).alias("value"))


def result_log(spark: SparkSession, base: str) -> DataFrame:
    """Query-result log (M7) in CSV column order."""
    ev = table(spark, base, "events")
    failed = F.col("event_type") == "error"
    return ev.select(
        F.format_string("req-%012d", F.col("event_id")).alias("client_request_id"),
        F.col("event_type").alias("query_type"),
        padded_id("user-", F.col("user_id")).alias("user_id"),
        F.col("value").alias("latency_ms"),
        F.when(failed, F.lit(0)).otherwise(F.length("props")).cast("int").alias("result_count"),
        iso_text("ts").alias("timestamp"),
        F.when(failed, F.concat(F.lit("error: "), F.col("props"))).otherwise(F.lit("success")).alias("status"),
        (F.col("user_id") % THREADS).cast("int").alias("thread_id"),
    )
