"""Graphs stored as tables: edges in a folder per label and in buckets by source.

A filter on the label then reads the folders of these labels only, a lookup by source reads one bucket
of them, and joining edges to their source vertices needs no shuffle, as vertices are stored in the same
number of buckets by id. A source with very many edges would make one bucket long: such sources,
those with more than ``HEAVY`` times a bucket's share of all edges, keep their edges in a part of their
own, by label but without buckets. There are at most buckets / ``HEAVY`` of them, so their keys are
broadcast.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.graph import PropertyGraph

HEAVY = 4


def _table(frame: DataFrame, name: str, path: str, key: str | None, buckets: int, by_label: bool) -> DataFrame:
    spark = frame.sparkSession
    if key:  # a task per bucket, so a bucket is one file per label
        frame = frame.repartition(buckets, key)
    w = frame.write.mode("overwrite").format("parquet").option("path", path)
    if by_label:
        w = w.partitionBy("label")
    if key:
        w = w.bucketBy(buckets, key).sortBy(key)
    w.saveAsTable(name)
    return spark.table(name)


def stored_graph(graph: PropertyGraph, name: str, root: str, buckets: int = 64) -> PropertyGraph:
    """``graph`` written as the tables ``<name>_v<i>`` and ``<name>_e<i>`` with their files below ``root``,
    and the same graph reading from them. Tables of the same names are replaced."""
    vertices = {}
    for i, (label, frame) in enumerate(graph.vertices.items()):
        vertices[label] = _table(frame, f"{name}_v{i}", f"{root}/v{i}", "id", buckets, False)
    parts = []
    for i, part in enumerate(graph.parts):
        frame = part.frame if part.labelled else part.frame.withColumn("label", F.lit(part.labels[0]))
        plain = replace(part, labelled=True)
        total = frame.count()
        heavy = frame.groupBy("src").agg(F.count("*").alias("n")).where(F.col("n") * buckets > total * HEAVY).select(F.col("src").alias("_heavy"))
        keys = [r._heavy for r in heavy.collect()]  # at most buckets / HEAVY sources
        if not keys:
            parts.append(replace(plain, frame=_table(frame, f"{name}_e{i}", f"{root}/e{i}", "src", buckets, True)))
            continue
        often = F.broadcast(frame.sparkSession.createDataFrame([(k,) for k in keys], heavy.schema))
        same = F.col("src") == F.col("_heavy")
        parts.append(replace(plain, frame=_table(frame.join(often, same, "left_anti"), f"{name}_e{i}", f"{root}/e{i}", "src", buckets, True)))
        parts.append(replace(plain, frame=_table(frame.join(often, same, "left_semi"), f"{name}_h{i}", f"{root}/h{i}", None, buckets, True)))
    return PropertyGraph(vertices, parts=parts, ids=graph.ids)


def drop_graph(spark: SparkSession, name: str) -> None:
    """Forget the tables of a stored graph; their files stay."""
    for row in spark.sql(f"SHOW TABLES LIKE '{name}_*'").collect():
        spark.sql(f"DROP TABLE IF EXISTS {row.tableName}")
