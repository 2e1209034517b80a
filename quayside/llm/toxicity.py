"""Toxicity scores: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features of a text (``FEATURES``): densities of a lexicon of words and of word beginnings, how
often a lexicon word stands near a second-person pronoun, capitals, punctuation and obfuscation
rates, and the text's length. The lexicon is learned: words and four-letter beginnings whose log
odds between toxic and other texts pass ``LEAST_ODDS``, counted per document. Labels, languages,
sources and ids are never features.

Learning reads a bounded sample of labelled rows: at most half of ``sample_rows`` of each label, chosen by a
hash of the id; a row stands for as many as its label has more than the sample, in the trees and in the
calibration. Of each label a fifth calibrates; the rest gives the lexicon and the trees, crosswise:
it is halved, and the trees see each half through a lexicon read from the other, so no text is
judged by words it taught. A label with fewer than ``LEAST_SPLIT`` rows gives all of them to every part,
which makes its scores too sure, but no part is without it. Lexicon size is bounded by
``lexicon_size`` for each kind. Scoring reads whole texts.

Defined results: null and empty texts have all features 0 and get the score of such a text. If the
labelled rows hold one class only, every score is that class (0.0 with none at all). Rows with a
null label or a null id are not learned from; rows that repeat an id within a label count once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import bounded_sample, crc_bucket, packed, quoted, ship, stored, table

FEATURES = ["lexicon_density", "stem_density", "lexicon_hits", "mean_odds", "second_person_near", "second_person", "capitals", "capital_words", "punctuation", "punctuation_runs", "obfuscated", "plain_hits", "length"]
SECOND_PERSON = frozenset("you your yours yourself u ur thou thee tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch usted ustedes ti vosotros".split())
LEAST_ODDS, LEAST_DOCS, STEM, NEAR = 2.5, 4, 4, 3
LEAST_SPLIT = 30
_WORD = re.compile(r"[^\W_]+(?:[@$*|+][^\W_]+)*")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_CAPITAL_WORD = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{2,}\b")
_PUNCTUATION = re.compile(r"[!?*]")
_RUN = re.compile(r"[!?*.,#$%&]{2,}")
_MIXED = re.compile(r"(?=\S*[@$*|+0-9])[a-z]+[@$*|+0-9]+[a-z]")
_PLAIN = str.maketrans("013457@$|+", "oieastasit", "*")


def _stem(word: str) -> str:
    return word[:STEM] if len(word) > STEM else ""


def features(text: str, words_odds: dict[str, float], stems_odds: dict[str, float]) -> list[float]:
    words = _WORD.findall(text.lower())
    if not words:
        return [0.0] * len(FEATURES)
    per = 100.0 / len(words)
    odds = list(map(words_odds.get, words))
    hits = [i for i, v in enumerate(odds) if v is not None]
    stems = sum(s in stems_odds for s in map(_stem, words))
    pronouns = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if hits and pronouns:
        places = np.array(pronouns)
        at = np.searchsorted(places, hits)
        before = np.abs(places[np.maximum(at - 1, 0)] - hits)
        after = np.abs(places[np.minimum(at, len(places) - 1)] - hits)
        near = int((np.minimum(before, after) <= NEAR).sum())
    mixed = [w for w in set(words) if not w.isalpha() and _MIXED.search(w)]
    plain = sum(w.translate(_PLAIN) in words_odds for w in mixed)
    return [len(hits) * per, stems * per, math.log1p(len(hits)), sum(odds[i] for i in hits) / len(words), near * per, len(pronouns) * per,
            len(_CAPITAL.findall(text)) / len(text), len(_CAPITAL_WORD.findall(text)) * per, 100.0 * len(_PUNCTUATION.findall(text)) / len(text),
            len(_RUN.findall(text)) * per, len(mixed) * per, plain * per, math.log1p(len(words))]


COUNTS = ("yes_a", "no_a", "yes_b", "no_b")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per word and per beginning, by label and half; one row per token and batch."""
    for rb in batches:
        counts = {c: Counter() for c in COUNTS}
        for text, toxic, half in zip(rb.column("text").to_pylist(), rb.column("toxic").to_pylist(), rb.column("half").to_pylist()):
            words = set(_WORD.findall(text.lower()))
            mine = counts[("yes_" if toxic else "no_") + half]
            mine.update(words)
            mine.update({" " + s for s in map(_stem, words) if s})
        tokens = sorted(set().union(*counts.values()))
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), *(pa.array([counts[c][t] for t in tokens], pa.int64()) for c in COUNTS)], names=["token", *COUNTS])


def count_tokens(labelled: DataFrame) -> DataFrame:
    """(token, yes_a, no_a, yes_b, no_b) from rows (text, toxic, half); beginnings have a blank before them.
    Only tokens that some lexicon may take are kept."""
    counted = labelled.mapInArrow(_counted, "token string, " + ", ".join(f"{c} long" for c in COUNTS))
    tokens = counted.groupBy("token").agg(*[F.sum(c).alias(c) for c in COUNTS])
    return stored(tokens.where(F.col("yes_a") + F.col("yes_b") >= LEAST_DOCS), "toxic-tokens")


def learn_lexicon(tokens: DataFrame, sizes: dict[str, int], halves: str, lexicon_size: int) -> tuple[dict[str, float], dict[str, float]]:
    """Log odds of words and of beginnings that mark toxic texts in the given halves (``a``, ``b`` or ``ab``);
    ``sizes`` has the documents behind each of the counts."""
    yes, no = (sum((F.col(f"{c}_{h}") for h in halves), F.lit(0)) for c in ("yes", "no"))
    n_yes, n_no = (sum(sizes.get(f"{c}_{h}", 0) for h in halves) for c in ("yes", "no"))
    odds = F.log((yes + 0.5) / (n_yes + 1.0)) - F.log((no + 0.5) / (n_no + 1.0))
    marked = tokens.where(yes >= LEAST_DOCS).select("token", odds.alias("odds")).where(F.col("odds") >= LEAST_ODDS)
    out = []
    for kind in (~F.col("token").startswith(" "), F.col("token").startswith(" ")):
        best = marked.where(kind).orderBy(F.desc("odds"), "token").limit(lexicon_size).collect()
        out.append({r["token"].strip(): float(r["odds"]) for r in best})
    return out[0], out[1]


def _featured(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stems = lexicon.value
        for rb in batches:
            text = rb.column("text")
            rows = [features(text[i].as_py() or "", words, stems) for i in range(rb.num_rows)]
            yield pa.RecordBatch.from_arrays([rb.column("row"), pa.array(rows, pa.list_(pa.float64()))], names=["row", "features"])

    return run


def score(docs: DataFrame, labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id", sample_rows: int = 20_000, lexicon_size: int = 2_000, trees: int = 15, depth: int = 3) -> DataFrame:
    """``docs`` without its text, with columns score (0 to 1) and predicted (1 from 0.5 on). ``labelled`` has
    id and label, and text; without a text column, the texts of ``docs`` are meant, by id."""
    spark = ship(docs.sparkSession)
    known = labelled.where(quoted(id_col).isNotNull() & quoted(label_col).cast("int").isin(0, 1))
    own = text_col in labelled.columns
    known = known.select(quoted(id_col).alias("id"), *([F.coalesce(quoted(text_col), F.lit("")).alias("text")] if own else []), quoted(label_col).cast("int").alias("toxic"))
    texts = None if own else docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    plain = docs.select(packed(docs, text_col), quoted(text_col).alias("text"))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c != text_col]
    sample = bounded_sample(known, "toxic", "id", sample_rows // 2, texts)
    taken = {r["toxic"]: (r["n"], r["taken"]) for r in sample.groupBy("toxic").agg(F.max("n").alias("n"), F.count("*").alias("taken")).collect()}
    if len(taken) < 2:
        constant = float(1 in taken)
        return plain.select(*kept, F.lit(constant).alias("score"), F.lit(int(constant >= 0.5)).alias("predicted"))
    # turns 0-3 and 4-7 learn, 8-9 calibrate; rows stand for as many as their label has
    few = [t for t, (_, k) in taken.items() if k < LEAST_SPLIT]
    own = F.array(F.pmod("rank", F.lit(10)))
    turns = F.when(F.col("toxic").isin(*few), F.array(F.lit(0), F.lit(4), F.lit(8))).otherwise(own) if few else own
    weight = F.when(F.col("toxic") == 1, taken[1][0] / taken[1][1]).otherwise(taken[0][0] / taken[0][1])
    sample = sample.select("toxic", "text", F.explode(turns).alias("turn"), weight.alias("weight"))

    def seen(part, lexicon) -> DataFrame:
        rows = sample.where(part).select(F.struct("toxic", "weight").alias("row"), "text").mapInArrow(_featured(lexicon), "row struct<toxic:int,weight:double>, features array<double>")
        return rows.select(F.col("row.toxic").cast("double").alias("label"), "row.weight", "features")

    halves = sample.where("turn < 8").withColumn("half", F.when(F.col("turn") < 4, "a").otherwise("b"))
    sizes = {("yes_" if r["toxic"] else "no_") + r["half"]: r["count"] for r in halves.groupBy("toxic", "half").count().collect()}
    tokens = count_tokens(halves.select("text", "toxic", "half"))
    lexicon, first, second = (spark.sparkContext.broadcast(learn_lexicon(tokens, sizes, part, lexicon_size)) for part in ("ab", "a", "b"))
    # a text that a lexicon was read from would look richer in its words than others do
    fit = stored(seen("turn < 4", second).unionByName(seen("turn BETWEEN 4 AND 7", first)), "toxic-fit")
    calibration = stored(seen("turn >= 8", lexicon), "toxic-calibration")
    step, vectors = _featured(lexicon), array_to_vector("features").alias("features")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7, featuresCol="features", labelCol="label", weightCol="weight").fit(fit.select("label", "weight", vectors))
    raw = vector_to_array("probability")[1]
    held = model.transform(calibration.select("label", "weight", vectors)).select(raw.alias("raw"), "label", "weight")
    calibrated = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score", weightCol="weight").fit(held)
    rows = plain.mapInArrow(step, f"row {plain.schema['row'].dataType.simpleString()}, features array<double>")
    scored = model.transform(rows.select("row", array_to_vector("features").alias("features"))).select("row", raw.alias("raw"))
    return calibrated.transform(scored).select(*kept, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"), (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7(spark, sf_dir: str) -> DataFrame:
    """Registered query: toxicity of every document, learned from the folds other than 0 of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = crc_bucket("doc_id", 5)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold != 0)
    found = score(docs, labels.join(docs.select("doc_id"), "doc_id", "left_semi"))
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")
