"""Exact selection of ranks by rounds of plain aggregates.

The value is mapped to a 64-bit integer that keeps its order. A round counts rows by the next 16 bits
of those that share the bits found so far, and the counts (at most 65,536 a rank) say which bits the
rank's row has; after four rounds the value is known. No sample, no sort, no window over rows, and no
task sees more than its share of the rows and one round's counts, whatever the distribution: a value
that fills a third of the rows is one count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS, ROUNDS = 16, 4


def ordered_bits(value: Column, kind: T.DataType) -> Column:
    """A BIGINT in the order of ``value`` (NaN last, both zeros equal)."""
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        bits = F.expr("0L") + F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("bigint")
        # a negative double's other bits count downwards
        return F.transform(F.array(bits), lambda b: F.when(b < 0, b.bitwiseXOR(F.lit(2**63 - 1))).otherwise(b))[0]
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (value * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), value)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    raise TypeError(f"no 64-bit order for {kind.simpleString()}")


def _place(counts: list, rank: int):
    """Of counted prefixes in order, the one that holds the row number ``rank`` (from 0), and the rank inside it."""
    for c in sorted(counts, key=lambda c: c.prefix):
        if rank < c.n:
            return c, rank
        rank -= c.n
    return None, 0


def index_percentiles(df: DataFrame, value_col: str, percentiles: Sequence[float]) -> tuple[int, list]:
    """Rows with a value, and for each of ``percentiles`` the value at place ``floor(n * p)`` of the sorted
    rows, counted from 0 (None where there is no such place). Runs one aggregate per round; what
    comes to the driver is at most 2^BITS counts per percentile and round."""
    kind = df.schema[value_col].dataType
    rows = df.where(F.col(value_col).isNotNull()).select(F.col(value_col).alias("value"), ordered_bits(F.col(value_col), kind).alias("bits"))
    n, left, found = 0, [], [None] * len(percentiles)
    for turn in range(ROUNDS):
        shift, last = 64 - BITS * (turn + 1), turn == ROUNDS - 1
        kept = [F.count(F.lit(1)).alias("n"), *([F.min("value").alias("value")] if last else [])]
        part = rows
        if turn:
            wanted = {c.prefix for c in found if c is not None}
            part = rows.where(F.shiftright("bits", shift + BITS).isin(*wanted)) if wanted else rows.where(F.lit(False))
        counts = part.groupBy(F.shiftright("bits", shift).alias("prefix")).agg(*kept).collect()
        if not turn:
            n = sum(c.n for c in counts)
            left = [math.floor(n * p) for p in percentiles]
        for i, before in enumerate(found):
            mine = [c for c in counts if not turn or (before is not None and c.prefix >> BITS == before.prefix)]
            found[i], left[i] = _place(mine, left[i])
    return n, [None if c is None else c.value for c in found]
