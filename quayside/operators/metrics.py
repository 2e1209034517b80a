"""Load-run summaries over a query-result log.

Percentiles follow the index rule ``sorted[(int)(n * p)]`` (zero-based) over
successful queries. They are selected by counting, so no step puts all rows, or
all distinct values, into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.constants import CSV_COLUMNS, PERCENTILES
from quayside.functions import status_class
from quayside.plans import index_percentiles


def _pct_name(p: float) -> str:
    return "p" + f"{p * 100:g}".replace(".", "_")


def throughput_summary(log: DataFrame, duration_seconds: int, status_col: str = "status") -> DataFrame:
    """F1-F3. ``total_queries`` counts successes only; ``actual_qps`` divides by
    the configured duration; ``success_rate_compat`` is the reference's
    ``(success - errors) / success * 100`` (can be negative), ``success_rate`` is
    ``success / (success + errors) * 100``; both null when the divisor is 0."""
    ok = F.col(status_col) == "success"
    counts = log.agg(F.count_if(ok).alias("n_success"), F.count_if(~ok).alias("n_errors"))
    s, e = F.col("n_success"), F.col("n_errors")
    return counts.select(
        F.lit(duration_seconds).cast("bigint").alias("duration_s"),
        s.alias("total_queries"), e.alias("n_errors"),
        (s / F.lit(float(duration_seconds))).alias("actual_qps"),
        F.when(s > 0, (s - e) / s * 100.0).alias("success_rate_compat"),
        F.when(s + e > 0, s / (s + e) * 100.0).alias("success_rate"),
    )


def latency_histogram(log: DataFrame, latency_col: str = "latency_ms", status_col: str = "status") -> DataFrame:
    """F5 then O1: successes only, one row per distinct latency."""
    return (log.where(F.col(status_col) == "success")
            .groupBy(F.col(latency_col).alias("latency"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def latency_summary(log: DataFrame, percentiles: Sequence[float] = PERCENTILES,
                    latency_col: str = "latency_ms", status_col: str = "status") -> DataFrame:
    """n, min, max, mean and index-rule percentiles over successes; the percentiles by rounds of
    counts over the bits of the value (``plans.selection``)."""
    rows = log.where(F.col(status_col) == "success").select(F.col(latency_col).alias("latency")).where("latency IS NOT NULL")
    _, found = index_percentiles(rows, "latency", percentiles)
    kind = rows.schema["latency"].dataType
    return rows.agg(
        F.count("latency").alias("n"), F.min("latency").alias("min_ms"), F.max("latency").alias("max_ms"), F.avg("latency").alias("avg_ms"),
    ).select("*", *[F.lit(v).cast(kind).alias(_pct_name(p)) for v, p in zip(found, percentiles)])


def status_counts(log: DataFrame, status_col: str = "status") -> DataFrame:
    """Rows per status class (``success``, ``timeout``, ``error``)."""
    return log.groupBy(status_class(status_col).alias("status_class")).agg(F.count(F.lit(1)).alias("n"))


def csv_rows(log: DataFrame) -> DataFrame:
    """K10 columns, in header order."""
    return log.select(*CSV_COLUMNS)


def write_csv(log: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line; a directory of part files written in parallel."""
    csv_rows(log).write.mode(mode).option("header", True).csv(path)
