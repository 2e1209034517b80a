"""Five-stage cleaning of ``documents``: language, near duplicates, repeats, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept, read back from
Parquet. All but the last return the columns of ``documents``. Nulls, empty and very long texts,
repeated rows and empty tables follow the definitions of the operators:

1. ``language_id``: documents without an identified language go (null texts and texts without a
   letter); a null ``lang`` becomes the identified one.
2. ``near_dedup``: one document of each near-duplicate class stays, that of the smallest doc_id.
3. ``suffix_dedup``: bytes covered by a 100-byte string that starts earlier go (characters that a
   cut splits go too); ``n_chars`` is counted anew; documents stay, also if nothing is left.
4. ``decontaminate``: documents that hold a window of ten words of a benchmark item go.
5. ``tokenize``: ids of the rest and digests of what they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import byte_bpe, cross_parsing, dart_minhash, decontaminate, suffix_dedup
from quayside.llm.common import free_name, shared_folder, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = free_name(docs, "language")
    found = cross_parsing.identify(docs, docs).where(F.col(named)["lang_pred"] != "und")
    return found.withColumn("lang", F.coalesce("lang", F.col(named)["lang_pred"])).drop(named)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart_minhash.keep_one(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = free_name(docs, "cut")
    found = suffix_dedup.remove_repeats(docs, as_text=True)
    return found.withColumn("text", F.when(F.col("text").isNotNull(), F.col(named)["kept"])).withColumn("n_chars", F.char_length("text").cast("long")).drop(named)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = free_name(docs, "found")
    return decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark")).where(F.col(named)["n_hit"] == 0).drop(named)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = byte_bpe.encode_decode(docs.select("doc_id", "text"), byte_bpe.default_vocabulary())
    return found.select("doc_id", "tokens.n_tokens", F.sha2("tokens.ids", 256).alias("ids_sha256"), F.sha2(F.col("tokens.decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", remove_repeats),
    ("decontaminate", drop_leaks),
    ("tokenize", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
