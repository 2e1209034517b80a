"""Change-data operators.

The newest image per key is taken with ``max_by(struct(image), struct(order))``
in a group-by: Spark aggregates partially before the shuffle, so a key with a
third of all changes is reduced to one row per map task instead of being
sorted in one task (which a ``row_number()`` window would do).
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import schemas
from quayside.constants import BULK_MAX_ACTIONS, BULK_MAX_BYTES, SKIPPED_OPERATIONS
from quayside.functions import from_epoch_micros
from quayside.functions.json import STRICT
from quayside.plans import locate, running_sum


def conform(df: DataFrame, schema: T.StructType = schemas.ASSET_RECORD, check_nulls: bool = True) -> DataFrame:
    """Identity projection with casts to the declared types; NOT NULL
    columns raise on a null instead of passing it on."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if check_nulls and not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"NOT NULL column {f.name} is null"))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def skip_operations(log: DataFrame, skipped: Sequence[str] = SKIPPED_OPERATIONS, op_col: str = "op") -> DataFrame:
    """Drop skipped operations (deletes) before collapsing, so a deleted key keeps its last image.
    Only the listed operations go; a row without an operation stays."""
    return log.where(F.col(op_col).isNull() | ~F.col(op_col).isin(list(skipped)))


#: why a message is no usable change, in the order in which the rules are tried
REJECTS = ("not_an_envelope", "bad_value", "bad_operation", "no_image", "null_column", "no_position", "no_time")
OPERATIONS = ("c", "r", "u", "d")
_WRAP, _END, _BAD = "_qs_envelopes", "_qs_end", "_qs_bad"


def checked_envelopes(messages: DataFrame, value_col: str = "value", schema: T.StructType = schemas.ASSET_RECORD) -> DataFrame:
    """``messages`` with a struct column ``_e``: ``reason`` (null for a usable change, else one of
    ``REJECTS``), ``op``, ``ts_ms``, ``position`` and ``image``.

    * ``not_an_envelope``: null, no JSON, no object, or text beside the object;
    * ``bad_value``: some value does not fit its column's type (also in the image that is not used);
    * ``bad_operation``: not one of ``OPERATIONS``;
    * ``no_image``: the operation's image is missing: ``before`` for a delete, else ``after``;
    * ``null_column``: a NOT NULL column of that image is null or missing;
    * ``no_position``, ``no_time``: without these the newest image is not defined.

    The text is parsed once, as an element of an array that ends with a known envelope, so text before
    or behind the object shows in the array; the parser's own column says whether a value was
    dropped. A generator carries the parsed struct, so filters on it do not repeat the parse."""
    image = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    envelope = T.StructType([T.StructField("op", T.StringType()), T.StructField("before", image), T.StructField("after", image),
                             T.StructField("ts_ms", T.LongType()), T.StructField("position", T.LongType())])
    whole = T.StructType([T.StructField(_WRAP, T.ArrayType(envelope)), T.StructField(_BAD, T.StringType())])
    # a text that spells out the wrapper's name could end it early
    text = F.when(~F.contains(value_col, F.lit(_WRAP)), F.concat(F.lit(f'{{"{_WRAP}":['), value_col, F.lit(f',{{"op":"{_END}"}}]}}')))
    parsed = F.from_json(text, whole, STRICT | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    rows = messages.select("*", F.explode(F.array(parsed)).alias("_p"))
    held, one = F.col(f"_p.{_WRAP}"), F.get(F.col(f"_p.{_WRAP}"), F.lit(0))
    rows = rows.select("*", ((F.size(held) == 2) & (F.get(held, F.lit(1))["op"] == _END)).alias("_whole"), one.alias("_one"))
    rows = rows.withColumn("_img", F.when(F.col("_one.op") == "d", F.col("_one.before")).otherwise(F.col("_one.after")))
    missing = [F.col(f"_img.{f.name}").isNull() for f in schema.fields if not f.nullable]
    rules = [~F.coalesce("_whole", F.lit(False)) | F.col("_one").isNull(), F.col(f"_p.{_BAD}").isNotNull(),
             ~F.coalesce(F.col("_one.op").isin(*OPERATIONS), F.lit(False)), F.col("_img").isNull(),
             functools.reduce(operator.or_, missing, F.lit(False)), F.col("_one.position").isNull(), F.col("_one.ts_ms").isNull()]
    reason = functools.reduce(lambda held_, pair: held_.when(pair[0], pair[1]), list(zip(rules, REJECTS))[1:], F.when(rules[0], REJECTS[0]))
    return rows.select(*messages.columns, F.struct(reason.alias("reason"), F.col("_one.op").alias("op"), F.col("_one.ts_ms").alias("ts_ms"),
                                                   F.col("_one.position").alias("position"), F.col("_img").alias("image")).alias("_e"))


def decode_envelopes(messages: DataFrame, value_col: str = "value", schema: T.StructType = schemas.ASSET_RECORD) -> DataFrame:
    """Change envelopes (JSON text with ``op``, ``before``, ``after``, ``ts_ms``, ``position``) to rows
    ``op, change_ts, position`` + the typed columns. The image is ``after``, for a delete ``before``.
    What ``checked_envelopes`` finds fault with is left to ``envelope_rejects``."""
    return checked_envelopes(messages, value_col, schema).where("_e.reason IS NULL").select(
        F.col("_e.op").alias("op"), from_epoch_micros(F.col("_e.ts_ms") * 1000).alias("change_ts"),
        F.col("_e.position").alias("position"), *[F.col(f"_e.image.{f.name}").alias(f.name) for f in schema.fields])


def envelope_rejects(messages: DataFrame, value_col: str = "value", schema: T.StructType = schemas.ASSET_RECORD) -> DataFrame:
    """The messages that ``decode_envelopes`` leaves out, with the ``reason``."""
    return checked_envelopes(messages, value_col, schema).where("_e.reason IS NOT NULL").select(*messages.columns, F.col("_e.reason").alias("reason"))


def latest_image(log: DataFrame, key: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Newest row per key by the explicit order ``order_cols``."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order_cols]))
    return log.groupBy(*keys).agg(newest.alias("_img")).select(*keys, *[F.col(f"_img.{c}") .alias(c) for c in rest])


def snapshot_plus_log(snapshot: DataFrame, log: DataFrame, key: str, snapshot_position: int = -1,
                      op_col: str = "op", position_col: str = "position",
                      skipped: Sequence[str] = SKIPPED_OPERATIONS) -> DataFrame:
    """C4: snapshot rows are ordered as ``(position noted before the snapshot, 0)``,
    log rows as ``(position, 1)``; log rows carry full images, so the overlap
    replays harmlessly. Deletes are skipped, then the newest image wins."""
    image = [c for c in snapshot.columns if c != key]
    snap = snapshot.select(key, *image, F.lit("r").alias(op_col),
                           F.lit(snapshot_position).cast("bigint").alias(position_col),
                           F.lit(0).alias("tier"))
    changes = skip_operations(log, skipped, op_col).select(
        key, *image, op_col, F.col(position_col).cast("bigint").alias(position_col), F.lit(1).alias("tier"))
    return latest_image(snap.unionByName(changes), key, [position_col, "tier"]).drop("tier")


def _placed(log: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """Log rows with ``_c``, the log positions of the chunk their key lies in. Keys are made distinct
    before they are sorted into chunks, so a key with a third of all changes is sorted once."""
    first = F.col("low") == chunks.agg(F.min("low")).scalar()
    starts = chunks.select(F.when(~first, F.col("low")).alias("low"), "low_position", "high_position")
    keys = locate(log.select(key).distinct(), key, starts, "low", "_c")
    return log.join(keys.withColumnRenamed(key, "_k"), F.col(key) == F.col("_k")).drop("_k")


def chunk_rows(read: DataFrame, log: DataFrame, chunks: DataFrame, key: str, op_col: str = "op", position_col: str = "position",
               skipped: Sequence[str] = SKIPPED_OPERATIONS) -> DataFrame:
    """C4: the rows of an incremental snapshot, each as of its chunk's ``high_position``.

    ``chunks`` (``low``, the smallest key, ``low_position``, ``high_position``; keys beyond the outer chunks
    belong to these) tells between which positions of the log each chunk was read, ``read`` holds what
    was read (key and image). Of the changes in between nobody knows which the read has seen; they carry
    whole images, so replaying them over the chunk gives the state at ``high_position``. A change up to
    ``low_position`` is in the read already, and is not replayed: its row may have gone since."""
    image = [c for c in read.columns if c != key]
    inside = _placed(log, chunks, key).where(f"{position_col} > _c.low_position AND {position_col} <= _c.high_position")
    changes = skip_operations(inside, skipped, op_col).select(key, *image, op_col, F.col(position_col).cast("bigint").alias(position_col), F.lit(1).alias("tier"))
    rows = read.select(key, *image, F.lit("r").alias(op_col), F.lit(None).cast("bigint").alias(position_col), F.lit(0).alias("tier"))
    return latest_image(rows.unionByName(changes), key, ["tier", position_col]).drop("tier")


def chunk_changes(log: DataFrame, chunks: DataFrame, key: str, op_col: str = "op", position_col: str = "position",
                  skipped: Sequence[str] = SKIPPED_OPERATIONS) -> DataFrame:
    """C4: the log rows that follow ``chunk_rows``: those beyond the ``high_position`` of their key's chunk."""
    return skip_operations(_placed(log, chunks, key).where(f"{position_col} > _c.high_position"), skipped, op_col).drop("_c")


def incremental_snapshot(read: DataFrame, log: DataFrame, chunks: DataFrame, key: str, op_col: str = "op", position_col: str = "position",
                         skipped: Sequence[str] = SKIPPED_OPERATIONS) -> DataFrame:
    """C4 in one: the newest image per key of a snapshot read chunk by chunk while the log went on, plus
    the whole log. Equals ``chunk_rows`` followed by ``chunk_changes``, with the log collapsed to one row
    per key before it meets the chunks."""
    image = [c for c in read.columns if c != key]
    newest = latest_image(skip_operations(log, skipped, op_col).select(key, *image, op_col, F.col(position_col).cast("bigint").alias(position_col)), key, [position_col])
    later = _placed(newest, chunks, key).where(f"{position_col} > _c.low_position").drop("_c").withColumn("tier", F.lit(1))
    rows = read.select(key, *image, F.lit("r").alias(op_col), F.lit(None).cast("bigint").alias(position_col), F.lit(0).alias("tier"))
    return latest_image(rows.unionByName(later), key, ["tier"]).drop("tier")


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """C1 as a data-quality check: keys seen more than once."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def mod_partition_key(df: DataFrame, key: str = schemas.ASSET_KEY, parallelism: int = 4) -> DataFrame:
    """``MOD(f_id, n)``; sign follows the dividend, cast to BIGINT."""
    return df.select(key, F.expr(f"mod(`{key}`, {int(parallelism)})").cast("bigint").alias("partition_key"))


def plain_decimals(df: DataFrame) -> DataFrame:
    """Decimals as plain text: CAST gives ``0.000000000000000000`` where ``to_json``
    of a decimal would print ``0E-18``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def document(df: DataFrame, decimals: str = "plain"):
    """The JSON text of a row (struct of all columns, in column order)."""
    fields = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if decimals == "plain" and isinstance(f.dataType, T.DecimalType):
            c = c.cast("string")
        fields.append(c.alias(f.name))
    return F.to_json(F.struct(*fields))


def json_documents(df: DataFrame, key: str = schemas.ASSET_KEY, decimals: str = "plain",
                   extra: Sequence = ()) -> DataFrame:
    """One JSON document per row, document id = key."""
    return df.select(F.col(key).cast("string").alias("doc_id"), *extra,
                     document(df, decimals).alias("document"))


def bulk_batches(docs: DataFrame, partition_col: str, order_cols: Sequence[str], doc_col: str = "document",
                 max_actions: int = BULK_MAX_ACTIONS, max_bytes: int = BULK_MAX_BYTES) -> DataFrame:
    """K8 as a plan: inside each writer partition, in key order, a row goes to
    ``greatest(floor(rank / max_actions), floor(bytes before it / max_bytes))``.
    Running counts use the range-split running sum, so one partition key with
    a third of all rows is not one task. ``order_cols`` must order rows
    uniquely (ties of whole identical rows are harmless)."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    order_col = order_cols[0]
    rows = docs.select(partition_col, *order_cols, F.lit(1).cast("bigint").alias("one"),
                       F.octet_length(doc_col).cast("bigint").alias("bytes"))
    ranked = running_sum(rows, [partition_col], order_cols, ["one", "bytes"], ["rank", "running"])
    batch = F.greatest(F.call_function("div", F.col("rank") - 1, F.lit(max_actions).cast("bigint")),
                       F.call_function("div", F.col("running") - F.col("bytes"), F.lit(max_bytes).cast("bigint")))
    return (ranked.withColumn("batch_no", batch)
            .groupBy(partition_col, "batch_no")
            .agg(F.count(F.lit(1)).alias("n_actions"), F.sum("bytes").alias("n_bytes"),
                 F.min(order_col).alias("first_key"), F.max(order_col).alias("last_key")))
