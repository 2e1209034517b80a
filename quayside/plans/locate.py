"""Which range does a value lie in: an as-of join without comparing rows to all ranges.

Starts of ranges and rows are sorted together, in range buckets that are written once; inside a bucket the
last start seen is the row's range, and a row before the bucket's first start takes the last start of
the buckets before (one row per bucket).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.plans.ordered import _BUCKET, ROWS_PER_BUCKET, bucketed


def locate(rows: DataFrame, key: str, starts: DataFrame, start: str, out: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``rows`` with the struct column ``out``: the other columns of that row of ``starts`` with the greatest
    ``start`` at or below ``key``. A null start comes before every key; starts are distinct. Rows that
    share a key share a bucket: pass distinct keys where a key can fill many rows."""
    held = F.struct(*[F.col(c) for c in starts.columns if c != start])
    kind = rows.schema[key].dataType
    marks = starts.select(F.col(start).cast(kind).alias("k"), F.lit(0).alias("tier"), held.alias("mark"), F.lit(None).cast(rows.select(F.struct("*").alias("r")).schema["r"].dataType).alias("r"))
    both = marks.unionByName(rows.select(F.col(key).alias("k"), F.lit(1).alias("tier"), F.lit(None).cast(marks.schema["mark"].dataType).alias("mark"), F.struct("*").alias("r")))
    cut = bucketed(both, ["k", "tier"], rows_per_bucket)
    inside = Window.partitionBy(_BUCKET).orderBy("k", "tier").rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select(_BUCKET, "r", F.last("mark", ignorenulls=True).over(inside).alias("mark")).where("r IS NOT NULL")
    last = cut.groupBy(_BUCKET).agg(F.max(F.when(F.col("tier") == 0, F.struct("k", "mark"))).alias("top"))
    earlier = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    carried = last.select(F.col(_BUCKET).alias("b"), F.last("top", ignorenulls=True).over(earlier).alias("before"))
    joined = local.join(carried, F.col(_BUCKET) == F.col("b"), "left")
    return joined.select("r.*", F.coalesce("mark", "before.mark").alias(out))
