"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import checkpoint_dir


_SHIPPED: set[str] = set()
_WRITTEN: dict[str, list[str]] = {}


def as_uri(path: str) -> str:
    """``path`` with a scheme: a plain path lies in the file system of this machine."""
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once per application, through the
    shared folder."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for folder, _, files in os.walk(package):
                for f in sorted(files):
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        target = f"{shared_folder(spark, 'code')}/quayside_code.zip"
        fs, path = _hadoop(spark, target)
        out = fs.create(path)
        out.write(bytearray(held.getvalue()))
        out.close()
        context.addPyFile(str(path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()))
        _SHIPPED.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors and the driver share."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Delete what this application's operators have written to the shared folder (intermediate
    tables, archives of ``op4``, stages of the pipeline); call it when results are written elsewhere.
    Returns how many folders went."""
    gone = 0
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        fs, folder = _hadoop(spark, path)
        gone += bool(fs.delete(folder, True))
    return gone


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``shared_folder`` that no plan reads any more."""
    fs, folder = _hadoop(spark, path)
    fs.delete(folder, True)
    held = _WRITTEN.get(spark.sparkContext.applicationId, [])
    if path in held:
        held.remove(path)


def _hadoop(spark: SparkSession, path: str):
    """The file system, as Spark knows it, and the path in it."""
    context = spark.sparkContext
    held = context._jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(context._jsc.hadoopConfiguration()), held


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (columns of the input may carry any name)."""
    have, name = {c.lower() for c in df.columns}, base
    while name.lower() in have:
        name += "_"
    return name


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, besides: str | None = None):
    """All columns of ``df`` but ``besides`` as one struct column ``row``, so that no name clashes
    with a helper column (a filler keeps the struct from being empty)."""
    return F.struct(F.lit(0).alias(free_name(df, "_")), *[quoted(c).alias(c) for c in df.columns if c != besides]).alias("row")


def unpacked(df: DataFrame, besides: str | None = None, held: str = "text") -> list:
    """The columns of ``df`` again, from ``row`` and the column ``held``."""
    return [F.col(held).alias(c) if c == besides else F.col("row")[c].alias(c) for c in df.columns]


def doc_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n+1 offsets of an Arrow string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


_GOLD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = x ^ (x >> np.uint64(29))
    x *= _MIX
    x ^= x >> np.uint64(32)
    x *= _GOLD
    x ^= x >> np.uint64(29)
    return x


def crc_bucket(column: str, parts: int):
    """crc32 of the id written as text, modulo ``parts``: the fold of a row."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def bounded_sample(rows: DataFrame, kind: str, id_col: str, per_kind: int, texts: DataFrame | None = None) -> DataFrame:
    """For each value of ``kind`` about ``per_kind`` rows, never more, chosen by a hash ``h`` of the id; rows of
    one id count once. Where the rows with ids are too few for a kind, rows without one join in, by a
    hash of ``text`` (equal texts without an id count once), so no kind vanishes. ``rows`` has kind, id and
    ``text``; the result kind, ``h``, ``text``, ``n`` (rows of the kind) and ``rank`` (by h, from 0), written to
    the shared folder.

    Keys are chosen from kinds and ids alone; texts are read, and shuffled, for the chosen rows only. With
    ``texts`` (id and ``text``), ``rows`` needs no text, and rows without an id are left out."""
    kind_, id_ = quoted(kind), quoted(id_col)
    by_id = F.xxhash64(id_, F.lit(7))
    ways = [(rows.where(id_.isNotNull()), by_id, F.approx_count_distinct(id_, 0.02))]
    if texts is None:
        by_text = F.when(id_.isNotNull(), by_id).otherwise(F.xxhash64("text", F.lit(8)))
        ways.append((rows, by_text, F.approx_count_distinct(by_text, 0.02)))
    place = F.shiftrightunsigned("h", 1) / F.lit(float(1 << 63))
    every = F.count(F.lit(1)).alias("n")
    for part, hashed, distinct in ways:
        sizes = stored(rows.groupBy(kind).agg(every, (distinct + (F.count_if(id_.isNull()) if part is not rows else F.lit(0))).alias("distinct")), "sample-sizes")  # one row per kind
        near = part.select(kind_, hashed.alias("h")).join(sizes, kind).where(place < (2.0 * per_kind + 50.0) / F.col("distinct"))
        ranked = near.groupBy(kind, "h").agg(F.min("n").alias("n")).withColumn("rank", F.row_number().over(Window.partitionBy(kind).orderBy("h")) - 1)
        chosen = stored(ranked.where(F.col("rank") < per_kind), "sample-keys")  # per_kind narrow rows a kind at most
        taken = chosen.groupBy(kind).agg(F.count("*").alias("taken"))
        if sizes.join(taken, kind, "left").where(F.coalesce("taken", F.lit(0)) < F.least(F.lit(per_kind), F.col("distinct")) / 2).isEmpty():
            break
    source, on = (part.select(kind_, hashed.alias("h"), "text"), [kind, "h"]) if texts is None else (texts.select(hashed.alias("h"), "text"), ["h"])
    found = source.join(F.broadcast(chosen), on).groupBy(kind, "h", "n", "rank").agg(F.min("text").alias("text"))
    return stored(found, "sample")
