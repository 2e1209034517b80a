"""Exact running sums without funnelling a group into one task.

A window ``sum(...) OVER (PARTITION BY g ORDER BY o)`` sends every row of a group to one task; with
one group holding a third of the data that task is the job. Here rows are dealt by range over
(group, order) first:

1. The rows (groups, order and value columns: keep them narrow) are written, so that what makes them runs
   once and not for the count and the sample too. The written rows are range-partitioned with Spark's
   own sampled cut points and written with their bucket's number. There is a bucket per
   ``ROWS_PER_BUCKET`` rows, so buckets stay of one size when the table grows, and a group with a third of
   the rows spans a third of the buckets. Cut points can be chosen over any orderable types.
   Writing fixes the buckets: sampling again, in a retry or for a second use, could choose others.
2. Sums per (bucket, group), with partial aggregation. A group that continues into a bucket does so
   in one bucket after the other, so what lies before it there is a window over at most one row per
   bucket and group; at most one group continues into a bucket, so the table of offsets has at most
   as many rows as there are buckets.
3. A window inside (bucket, group) gives what lies before a row in its bucket.

Built-in expressions only; decimals stay decimals. The order columns must make the order unique inside
a group (add a tie-breaker such as an offset), otherwise ties are cut arbitrarily. Rows that agree in
all of them share a bucket, so collapse such repeats first where they can be many (see
``sources.snapshot``). Building the frame runs two writes, and a count and a sample of
what was written first.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import checkpoint_dir

ROWS_PER_BUCKET = 1_000_000
#: tables with fewer rows are cut finer, as long as there are cores to use
LEAST_PER_BUCKET = 4_096

_BUCKET, _BEFORE = "_qs_bucket", "_qs_before"
_WRITTEN: dict[str, list[str]] = {}


def _write(df: DataFrame, name: str) -> str:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return path


def _delete(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    return df.sparkSession.read.schema(df.schema).parquet(_write(df, name))


def clear(spark: SparkSession) -> int:
    """Delete what this application has put into the shared folder through ``written``; frames built on
    it cannot be read any more. Returns how many folders went."""
    return sum(_delete(spark, path) for path in _WRITTEN.pop(spark.sparkContext.applicationId, []))


def n_buckets(rows: int, width: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for ``rows`` rows where ``width`` tasks can run side by side."""
    return max(1, -(-rows // rows_per_bucket), min(width, -(-rows // LEAST_PER_BUCKET)))


def bucketed(df: DataFrame, keys: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with the number of the range of ``keys`` that each row lies in. What makes ``df`` runs once:
    its rows are written before they are counted, sampled and dealt. That copy goes once they are dealt."""
    spark = df.sparkSession
    path = _write(df, "unordered")
    rows = spark.read.schema(df.schema).parquet(path)
    n = n_buckets(rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions")), rows_per_bucket)
    dealt = written(rows.repartitionByRange(n, *_quick(rows, keys)).withColumn(_BUCKET, F.spark_partition_id()), "ordered")
    _WRITTEN[spark.sparkContext.applicationId].remove(path)
    _delete(spark, path)
    return dealt


def _quick(df: DataFrame, cols: Sequence[str]) -> list:
    """``cols`` to order by. Whole decimals beyond a long are compared as big numbers, so their nearest double,
    which never orders two of them the other way, goes before them and decides unless it is equal."""
    big = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18 and not f.dataType.scale}
    return [x for c in cols for x in ([F.col(c).cast("double"), F.col(c)] if c in big else [F.col(c)])]


def running_sum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                value_cols, out_cols, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``out_cols`` = inclusive running sums of ``value_cols`` within
    ``group_cols`` ordered by ``order_cols`` (ascending, nulls first). Null values
    count as 0. Integers give BIGINT, decimals DECIMAL, other numbers DOUBLE."""
    if isinstance(value_cols, str):
        value_cols, out_cols = [value_cols], [out_cols]
    group_cols, order_cols = list(group_cols), list(order_cols)
    value_cols, out_cols = list(value_cols), list(out_cols)
    cut = bucketed(df, [*group_cols, *order_cols], rows_per_bucket)
    values = [F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in value_cols]
    befores = [f"{_BEFORE}{i}" for i in range(len(value_cols))]
    sums = cut.groupBy(*group_cols, _BUCKET).agg(*[F.sum(v).alias(b) for v, b in zip(values, befores)])
    # at most one row per bucket in each group
    earlier = Window.partitionBy(*group_cols).orderBy(_BUCKET)
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias(f"_qs_g{i}") for i, c in enumerate(group_cols)], F.col(_BUCKET).alias("_qs_b"),
                          *[F.sum(b).over(before).alias(b) for b in befores], F.row_number().over(earlier).alias("_qs_nth"))
    offsets = offsets.where("_qs_nth > 1").drop("_qs_nth")
    inside = Window.partitionBy(_BUCKET, *group_cols).orderBy(*_quick(df, order_cols)).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select("*", *[F.sum(v).over(inside).alias(o) for v, o in zip(values, out_cols)])
    same = F.col(_BUCKET) == F.col("_qs_b")
    for i, c in enumerate(group_cols):
        same &= F.col(c).eqNullSafe(F.col(f"_qs_g{i}"))
    joined = local.join(F.broadcast(offsets), same, "left")  # a row per bucket at most: no row is dealt again for it
    totals = {o: F.col(o) + F.coalesce(F.col(b), F.lit(0).cast(sums.schema[b].dataType)) for o, b in zip(out_cols, befores)}
    return joined.select(*df.columns, *[totals[o].alias(o) for o in out_cols])
