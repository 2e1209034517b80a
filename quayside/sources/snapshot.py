"""Chunked parallel snapshot reads.

A chunk is a key range read by one task. With evenly spread keys
(``(max - min + 1) / count`` inside the factor bounds, by exact arithmetic)
chunks are equal key widths; otherwise they are runs of ``chunk_size``
consecutive rows in key order. Keys are counted before they are ranked, so a
key that repeats in a third of all rows is one row of the ranking.
"""

from __future__ import annotations

import datetime as dt
import decimal
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.constants import SNAPSHOT_CHUNK_ROWS, SNAPSHOT_FETCH_ROWS
from quayside.plans import running_sum


def key_stats(df: DataFrame, key: str) -> tuple:
    row = df.agg(F.min(key), F.max(key), F.count(key)).first()
    return row[0], row[1], row[2]


def even_chunks(df: DataFrame, key: str, chunk_size: int = SNAPSHOT_CHUNK_ROWS) -> DataFrame:
    """Equal key widths from the smallest key on (whole-number division, no floating point)."""
    whole = F.col(key).cast("decimal(38,0)")
    low = df.select(F.min(whole)).scalar()
    offset = (whole - low).cast("decimal(38,0)")
    chunk = F.call_function("div", offset, F.lit(chunk_size).cast("decimal(38,0)"))
    return (df.groupBy(chunk.cast("bigint").alias("chunk"))
            .agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n_rows")))


def uneven_chunks(df: DataFrame, key: str, chunk_size: int = SNAPSHOT_CHUNK_ROWS) -> DataFrame:
    """Runs of ``chunk_size`` rows in key order. A key whose rows lie on a chunk's edge ends one
    chunk and begins the next, so neighbouring chunks may share a key."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sum(counted, [], [key], "_n", "_upto")
    chunk = F.lit(chunk_size).cast("bigint")
    first = F.call_function("div", F.col("_upto") - F.col("_n"), chunk)
    last = F.call_function("div", F.col("_upto") - 1, chunk)
    parts = ranked.select(key, "_n", "_upto", F.explode(F.sequence(first, last)).alias("chunk"))
    inside = (F.least(F.col("_upto"), (F.col("chunk") + 1) * chunk)
              - F.greatest(F.col("_upto") - F.col("_n"), F.col("chunk") * chunk))
    return (parts.groupBy("chunk").agg(F.min(key).alias("low"), F.max(key).alias("high"),
                                       F.sum(inside).alias("n_rows")))


def is_even(low, high, count: int, factor_bounds: tuple = (1, 1)) -> bool:
    """Is ``(high - low + 1) / count`` inside the bounds? Exact for whole and decimal keys."""
    factor = (Fraction(high) - Fraction(low) + 1) / count
    return Fraction(factor_bounds[0]) <= factor <= Fraction(factor_bounds[1])


def plan_chunks(df: DataFrame, key: str, chunk_size: int = SNAPSHOT_CHUNK_ROWS,
                factor_bounds: tuple = (1, 1)) -> DataFrame:
    low, high, count = key_stats(df, key)
    if count and isinstance(low, (int, decimal.Decimal)) and is_even(low, high, count, factor_bounds):
        return even_chunks(df, key, chunk_size)
    return uneven_chunks(df, key, chunk_size)


def jdbc_chunk_options(low: int, high: int, max_partitions: int, chunk_size: int = SNAPSHOT_CHUNK_ROWS,
                       fetch_size: int = SNAPSHOT_FETCH_ROWS) -> dict:
    """Options for an evenly spread key: ``numPartitions = ceil((high-low+1)/chunk)``.
    More than ``max_partitions`` is an error: choose a larger chunk or more partitions."""
    parts = max(1, -((low - high - 1) // chunk_size))
    if parts > max_partitions:
        raise ValueError(f"{parts} chunks of {chunk_size} keys are more than max_partitions={max_partitions}")
    return {"lowerBound": str(low), "upperBound": str(high + 1), "numPartitions": str(parts),
            "fetchsize": str(fetch_size)}


def sql_literal(value) -> str:
    """A key as an SQL literal; text and times are quoted."""
    if isinstance(value, bool) or not isinstance(value, (int, float, decimal.Decimal)):
        text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
        return "'" + text.replace("'", "''") + "'"
    return format(value, "f") if isinstance(value, decimal.Decimal) else repr(value)


def jdbc_chunk_predicates(chunks: DataFrame, key: str, max_partitions: int) -> list[str]:
    """WHERE clauses for ``spark.read.jdbc(predicates=...)`` that read every row once.

    Ranges are half-open between distinct lows; the first and the last are open-ended and the
    first holds the null keys, so rows inserted after planning are read too. Consecutive chunks
    are merged so that at most ``max_partitions`` ranges reach the driver (a task then reads
    several chunks, each with the fetch size)."""
    n_chunks = chunks.agg(F.max("chunk")).first()[0]
    if n_chunks is None:
        return ["1 = 1"]
    per_task = max(1, -(-(n_chunks + 1) // max_partitions))
    task = F.call_function("div", F.col("chunk"), F.lit(per_task).cast("bigint"))
    starts = chunks.groupBy(task.alias("task")).agg(F.min("low").alias("low")).select("low").distinct().orderBy("low")
    lows = [sql_literal(r["low"]) for r in starts.toLocalIterator() if r["low"] is not None]
    edges = lows[1:]
    if not edges:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"({key} < {edges[0]} OR {key} IS NULL)", *inner, f"{key} >= {edges[-1]}"]


def read_jdbc_snapshot(spark: SparkSession, url: str, table: str, key: str, low: int, high: int,
                       props: dict, max_partitions: int, chunk_size: int = SNAPSHOT_CHUNK_ROWS,
                       fetch_size: int = SNAPSHOT_FETCH_ROWS) -> DataFrame:
    opts = jdbc_chunk_options(low, high, max_partitions, chunk_size, fetch_size)
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .option("partitionColumn", key).options(**opts).options(**props).load())
