"""File sinks (K1-K4, K6).

Spark's file sinks commit a batch's files atomically through their commit
protocol (and, in streaming, the sink log), so a retried task or a restarted
query never leaves half a file visible. A part file per task and batch replaces
the reference's open/roll/close cycle; ``max_records`` bounds the rows of a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

def write_text_by_date(framed: DataFrame, path: str, mode: str = "append",
                       max_records: int | None = None) -> None:
    """K1 batch form: ``date=yyyy-MM-dd`` folders of UTF-8 text, one message per line."""
    w = framed.select("date", "value").write.mode(mode).partitionBy("date")
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.text(path)


def text_landing_writer(framed_stream: DataFrame, path: str, checkpoint: str,
                        max_records: int | None = None) -> DataStreamWriter:
    """K1/K13 streaming form; the trigger interval plays the roll-by-age part."""
    w = (framed_stream.select("date", "value").writeStream.format("text")
         .option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy("date").outputMode("append"))
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    return w


def lake_append(rows: DataFrame, target: str, fmt: str = "parquet", partition_col: str = "partition_date",
                as_table: bool | None = None) -> None:
    """K6 batch append, partitioned by ``partition_col``.

    ``as_table`` (default: on for ``fmt="iceberg"``) treats ``target`` as a
    catalog table name: the table is created, partitioned, when it does not
    exist yet (``CREATE TABLE IF NOT EXISTS``), then appended to. Otherwise
    ``target`` is a path."""
    as_table = (fmt == "iceberg") if as_table is None else as_table
    if not as_table:
        rows.write.mode("append").partitionBy(partition_col).format(fmt).save(target)
        return
    if fmt != "iceberg":
        # session-catalog tables: append creates the table on first use
        rows.write.mode("append").format(fmt).partitionBy(partition_col).saveAsTable(target)
        return
    if rows.sparkSession.catalog.tableExists(target):
        rows.writeTo(target).append()
    else:
        rows.writeTo(target).using(fmt).partitionedBy(F.col(partition_col)).create()


def lake_append_writer(rows_stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet",
                       partition_col: str = "partition_date") -> DataStreamWriter:
    """K6 streaming append; for a catalog table call ``.toTable(target)`` on the result."""
    w = (rows_stream.writeStream.format(fmt).option("checkpointLocation", checkpoint)
         .partitionBy(partition_col).outputMode("append"))
    if fmt != "iceberg":
        w = w.option("path", target)
    return w
