"""Uniform shuffle of a table into shards of exact sizes by a hypergeometric communication matrix.

Five steps, all DataFrame operations:

1. Rows are dealt to about sqrt(rows) blocks by a hash (the partitions that send).
2. The matrix of counts (block, shard) is drawn exactly: each block contributes as many narrow
   slots as it has rows, the slots are put in a hashed random order, and the slot at place r goes
   to shard r mod ``shards``. Counts per (block, shard) of a uniformly random order are
   multivariate hypergeometric, and shard sizes differ by one at most.
3. Each block permutes its rows locally (row numbers by a hashed key) and hands them out to the
   shards in the drawn amounts.
4. Rows are exchanged, keyed by shard and sub-shard.
5. Each sub-shard permutes again; the row's place becomes its slot, gapless from 0 in its shard.

Random keys are hashes of all columns that can be hashed with the seed, so a lost executor's rows
come out the same again. Rows that repeat often are numbered and the number goes into the hash, so
a third of equal rows fills no block (rows with columns that cannot be hashed, such as maps, are not
numbered). Blocks and sub-shards hold about sqrt(rows) rows each, so no task grows with the table;
only counts pass through single tasks (sqrt(rows) rows).

Defined results: rows that are equal in all columns are interchangeable, and each gets a place of
its own. Nulls in any column, empty and very long texts are ordinary values. An empty table gives
an empty result. Helper columns take names that the input does not use.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import free_name, packed, quoted, stored, table, unpacked


def _unhashable(kind: T.DataType) -> bool:
    return isinstance(kind, (T.MapType, T.VariantType)) or isinstance(kind, T.ArrayType) and _unhashable(kind.elementType) or isinstance(kind, T.StructType) and any(_unhashable(f.dataType) for f in kind.fields)


def _before(rows: DataFrame, *group: str) -> DataFrame:
    """(group, part, before): how many rows of the group lie in parts before this one."""
    ahead = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy(*group, "part").count().select(*group, "part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))


def draw_matrix(blocks: DataFrame, shards: int, parts: int, seed: int) -> DataFrame:
    """(block, upto): for each row of ``blocks`` (block, n) the running totals of the rows that go
    to shards 0, 1, ..., drawn exactly."""
    slots = blocks.select("block", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i")).withColumn("u", F.xxhash64(F.lit(seed), "block", "i"))
    slots = slots.withColumn("part", F.pmod(F.shiftrightunsigned("u", 8), F.lit(parts)))
    # the order is by part, then by u: any fixed order of independent keys is a uniform order
    placed = slots.withColumn("r", F.row_number().over(Window.partitionBy("part").orderBy("u", "block", "i")) - 1).join(_before(slots), "part")
    cells = placed.groupBy("block", F.pmod(F.col("r") + F.col("before"), F.lit(shards)).alias("shard")).count()
    each = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.try_element_at("by_shard", s.cast("long")), F.lit(0).cast("long")))
    matrix = cells.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("shard", "count"))).alias("by_shard")).select("block", each.alias("counts"))
    return matrix.select("block", F.transform("counts", lambda c, i: F.aggregate(F.slice("counts", 1, i + 1), F.lit(0).cast("long"), lambda a, b: a + b)).alias("upto"))


def number_copies(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """``rows`` (row, k1, k2) with keys of their own for rows that repeat more than ``most`` times: these are
    collapsed to one row and a count, and dealt out again in portions, the number of the copy in the
    keys. The set of keys is the same however the copies lay."""
    often = stored(rows.groupBy("k1", "k2").agg(F.count("*").alias("n")).where(F.col("n") > most).select("k1", "k2"), "repeated")  # at most rows / most
    if often.isEmpty():
        return rows
    held = rows.join(often, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.any_value("row").alias("row"), F.count("*").alias("n"))
    portion = F.lit(most).cast("long")
    dealt = held.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("n") - 1, portion))).alias("c")).repartition("k1", "k2", "c")
    copies = dealt.select("*", F.explode(F.sequence(F.col("c") * portion, F.least((F.col("c") + 1) * portion, F.col("n")) - 1)).alias("i"))
    numbered = copies.select("row", F.xxhash64(F.lit(seed + 4), "k1", "i").alias("k1"), F.xxhash64(F.lit(seed + 5), "k2", "i").alias("k2"))
    return rows.join(often, ["k1", "k2"], "left_anti").select("row", "k1", "k2").unionByName(numbered)


def shuffle_shards(df: DataFrame, shards: int = 16, seed: int = 20240501) -> DataFrame:
    """``df`` with a struct column ``place`` (``place_`` if taken): shard (0 to ``shards`` - 1) and
    slot (0, 1, ... in its shard)."""
    out = free_name(df, "place")
    keys = [quoted(f.name) for f in df.schema.fields if not _unhashable(f.dataType)]
    parts = max(1, math.isqrt(df.count()))
    rows = df.select(packed(df), F.xxhash64(F.lit(seed + 1), *keys).alias("k1"), F.xxhash64(F.lit(seed + 2), *keys).alias("k2"))
    if len(keys) == len(df.columns):
        rows = number_copies(rows, max(16, parts // 4), seed)
    rows = rows.withColumn("block", F.pmod(F.shiftrightunsigned("k1", 8), F.lit(parts)))
    matrix = draw_matrix(rows.groupBy("block").agg(F.count("*").alias("n")), shards, parts, seed)
    local = rows.withColumn("j", F.row_number().over(Window.partitionBy("block").orderBy("k2", "k1")) - 1).join(matrix, "block")
    sent = local.withColumn("shard", F.size(F.filter("upto", lambda c: c <= F.col("j"))))
    sent = sent.withColumn("v", F.xxhash64(F.lit(seed + 3), "k1", "k2", "j")).withColumn("part", F.pmod(F.shiftrightunsigned("v", 8), F.lit(-(-parts // shards))))
    before = _before(sent.select("shard", "part"), "shard")
    placed = sent.select("row", "shard", "part", (F.row_number().over(Window.partitionBy("shard", "part").orderBy("v", "k1", "k2", "j")) - 1).alias("at")).join(before, ["shard", "part"])
    return placed.select(*unpacked(df), F.struct("shard", (F.col("at") + F.col("before")).cast("long").alias("slot")).alias(out))


def op1(spark, sf_dir: str) -> DataFrame:
    """Registered query: every document's shard and slot; shard sizes differ by one row at most."""
    text = F.col("text")
    return shuffle_shards(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "place.shard", "place.slot", F.lit(None).cast("int").alias("grown_shard"))
