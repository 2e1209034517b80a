"""Keyed document index with upserts (K7, K9).

With an index connector on the classpath, ``write_documents`` sends a batch with the options of
``index_options`` (document id = key, bulk sizes, retries): writes are idempotent by id, so task
retries are safe, and ``version_col`` lets the index itself refuse older changes.

Without one, ``write_changes`` keeps every micro-batch as the partition ``batch_id=<n>`` of a plain
Parquet table. A replayed batch overwrites its own partition (dynamic partition overwrite), so
it neither doubles nor loses rows, and ``index_state`` is the newest image per key over all
batches, whatever the order in which changes arrived. ``compact_index`` folds the batches into a base of
one row per key, so that reading the state costs the keys and the batches since, not all history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import constants as C
from quayside.operators.cdc import json_documents, latest_image, skip_operations

BULK_DEFAULTS = {
    "es.batch.size.entries": str(C.BULK_MAX_ACTIONS),
    "es.batch.size.bytes": f"{C.BULK_MAX_BYTES // C.MB}mb",
    "es.batch.write.retry.count": str(C.BULK_MAX_RETRIES),
    "es.batch.write.retry.wait": C.BULK_RETRY_WAIT,
}
CONNECTOR = "org.elasticsearch.spark.sql"
BATCH = "batch_id"
THROUGH = "through"


def index_options(props: dict, key: str, version_col: str | None = None) -> dict:
    opts = {"es.nodes": props["hosts"], "es.resource": props["index"], "es.mapping.id": key,
            "es.write.operation": "index" if version_col else "upsert", **BULK_DEFAULTS}
    if version_col:
        opts |= {"es.mapping.version": version_col, "es.mapping.version.type": "external_gte"}
    if props.get("username"):
        opts["es.net.http.auth.user"] = props["username"]
        opts["es.net.http.auth.pass"] = props.get("password", "")
    return opts


def newest_documents(changes: DataFrame, key: str, order_cols: Sequence[str], skipped: Sequence[str] = C.SKIPPED_OPERATIONS) -> DataFrame:
    """The batch's newest image per key as ``doc_id, version, document``."""
    newest = latest_image(skip_operations(changes, skipped), key, order_cols)
    return json_documents(newest, key, extra=[F.col(order_cols[-1]).alias("version")])


def write_documents(batch: DataFrame, props: dict, key: str, order_cols: Sequence[str], fmt: str = CONNECTOR) -> None:
    """One micro-batch to the index connector; a failed write fails the batch."""
    documents = newest_documents(batch, key, order_cols)
    documents.write.format(fmt).options(**index_options(props, "doc_id", "version")).mode("append").save()


def write_changes(changes: DataFrame, batch_id: int, root: str) -> None:
    """Keep one batch of change rows; writing the same batch again replaces it."""
    (changes.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(root))


def _base_folder(root: str) -> str:
    return root.rstrip("/") + "-base"


def _folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the sub-folders ``<name>=<number>`` of a folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(name + "="))


def base_through(spark: SparkSession, root: str) -> int | None:
    """The last batch that the newest complete base holds; a base counts once its write has committed."""
    context = spark.sparkContext
    for n in reversed(_folders(spark, _base_folder(root), THROUGH)):
        done = context._jvm.org.apache.hadoop.fs.Path(f"{_base_folder(root)}/{THROUGH}={n}/_SUCCESS")
        if done.getFileSystem(context._jsc.hadoopConfiguration()).exists(done):
            return n
    return None


def index_state(spark: SparkSession, root: str, key: str, order_cols: Sequence[str],
                skipped: Sequence[str] = C.SKIPPED_OPERATIONS, upto: int | None = None) -> DataFrame:
    """Newest image per key over all batches written to ``root`` (``upto``: not the later ones). With a base
    from ``compact_index`` only the base and the batches after it are read."""
    through = base_through(spark, root)
    batches = spark.read.parquet(root)
    if through is not None:
        batches = batches.where(F.col(BATCH) > through)
    if upto is not None:
        batches = batches.where(F.col(BATCH) <= upto)
    rows = skip_operations(batches.drop(BATCH), skipped)
    if through is not None:
        rows = spark.read.parquet(f"{_base_folder(root)}/{THROUGH}={through}").select(*rows.columns).unionByName(rows)
    return latest_image(rows, key, order_cols)


def compact_index(spark: SparkSession, root: str, key: str, order_cols: Sequence[str],
                  skipped: Sequence[str] = C.SKIPPED_OPERATIONS) -> int | None:
    """Write the state after the last batch as the new base, and return that batch's number. One row per key
    is written, from the last base and the batches since. Order columns stay in the base, so changes
    that arrive late lose against it as they would against the batches. A base left half written by
    a crash is not read, and written anew."""
    batches = _folders(spark, root, BATCH)
    through = base_through(spark, root)
    if not batches or through == batches[-1]:
        return through
    state = index_state(spark, root, key, order_cols, skipped, upto=batches[-1])
    state.write.mode("overwrite").parquet(f"{_base_folder(root)}/{THROUGH}={batches[-1]}")
    return batches[-1]


def expire(spark: SparkSession, root: str) -> int:
    """Delete the bases before the newest one and the batches it holds, but for its last batch (which a
    restarted stream may write again); readers of older plans lose their files. Returns the number of
    folders deleted."""
    through, context, gone = base_through(spark, root), spark.sparkContext, 0
    if through is None:
        return 0
    old = [f"{root.rstrip('/')}/{BATCH}={n}" for n in _folders(spark, root, BATCH) if n < through]
    old += [f"{_base_folder(root)}/{THROUGH}={n}" for n in _folders(spark, _base_folder(root), THROUGH) if n < through]
    for path in old:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True))
    return gone
