"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability from a logistic model over its distinct words, and the
document's is their noisy-or, 1 - prod(1 - p). Only document labels are known; the gradient of the document's likelihood
reaches each sentence through the noisy-or, so the model learns which sentences made a document toxic, and can point at them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import hash01, map_arrow, table

#: Bounds of the training sample: documents of each label, and characters of all its texts.
SAMPLE_DOCS, SAMPLE_CHARS = 2500, 24_000_000
#: A word or stem is a feature if so many sampled documents hold it and the labels' shares of them differ by so many
#: standard errors; so many features at most, the most telling.
MIN_DOCS, MIN_SIGMA, MAX_WORDS = 3, 4.0, 1 << 13
ROUNDS, RATE, RIDGE = 150, 0.3, 2e-3
THRESHOLD = 0.7
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
WORD = re.compile(r"\w+")


#: Beginnings of words are features as well: insults come with endings.
STEMS = (4, 5, 6)
CACHE_WORDS = 400_000


def features(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in STEMS if len(word) > n)]


def sentences(text: str | None) -> list[str]:
    return [s for s in SENTENCE.split(text) if s] if text else []


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict:
    """{"bias": b, "weights": {word: w}} from labelled(doc_id, text, toxic), a bounded, repeatable sample of it.

    Rows whose toxic is not 0 or 1 are passed over; a null text is empty. Of rows that repeat a doc_id, or have none, one of each label
    may take part. Without both labels the model is empty and scores 0.
    """
    rows = labelled.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic").where("toxic IN (0, 1)")
    chosen = _sample(rows.withColumn("c", F.char_length("text")), sample_docs, sample_chars)
    return fit([] if chosen is None else chosen.groupBy("doc_id", "toxic").agg(_one_text()).collect())


def train_joined(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict:
    """As train, from docs(doc_id, text) and labels(doc_id, toxic), where only ids and lengths are joined in full.

    The sample's ids are collected, as its texts are (bounded alike), and only their texts are fetched. Repeated label rows count once in
    the sample, and of several texts of a doc_id one; a null doc_id has no label.
    """
    lengths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.char_length("text"), F.lit(0)).alias("c"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("toxic IN (0, 1)")
    chosen = _sample(lengths.join(known, "doc_id"), sample_docs, sample_chars)
    ids = [] if chosen is None else chosen.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct().collect()
    if not ids:
        return fit([])
    sample = docs.sparkSession.createDataFrame(ids, "doc_id long, toxic int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return fit(texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(_one_text()).collect())


def _one_text() -> Column:
    return F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")


def _sample(rows: DataFrame, sample_docs: int, sample_chars: int) -> DataFrame | None:
    """About sample_docs of each label's rows(doc_id, toxic, c), fewer if long; none without both labels."""
    stats = {r["toxic"]: r for r in rows.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()}
    if len(stats) < 2:
        return None
    chance = {y: min(1.0, sample_docs / r["n"], sample_chars / 2 / max(1, r["c"])) for y, r in stats.items()}
    u = hash01(F.col("doc_id"), "toxicity")
    return rows.where(u < F.when(F.col("toxic") == 1, chance[1]).otherwise(chance[0]))


def fit(picked: list, max_words: int = MAX_WORDS, min_docs: int = MIN_DOCS, min_sigma: float = MIN_SIGMA) -> dict:
    """The model of rows (text, toxic), over the max_words most telling features that min_docs texts hold and whose shares differ by
    min_sigma standard errors. Without both labels it is empty and scores 0; without telling features every sentence scores alike."""
    if len({r["toxic"] for r in picked}) < 2:
        return {"bias": -30.0, "weights": {}}
    picked.sort(key=lambda r: (r["toxic"], r["text"]))
    size = {y: max(1, sum(r["toxic"] == y for r in picked)) for y in (0, 1)}
    held: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for r in picked:
        held[r["toxic"]].update({f for w in set(WORD.findall(r["text"].lower())) for f in features(w)})

    def sigma(f: str) -> float:
        share = (held[0][f] + held[1][f]) / (size[0] + size[1])
        return (held[1][f] / size[1] - held[0][f] / size[0]) / math.sqrt(share * (1 - share) * (1 / size[0] + 1 / size[1]) + 1e-12)

    telling = sorted(((abs(sigma(f)), f) for f in set(held[0]) | set(held[1]) if held[0][f] + held[1][f] >= min_docs), reverse=True)
    words = [f for s, f in telling[:max_words] if s >= min_sigma]
    at = {w: i for i, w in enumerate(words)}
    bags = [[{f for w in set(WORD.findall(s.lower())) for f in features(w) if f in at} for s in sentences(r["text"])] for r in picked]
    y = np.array([r["toxic"] for r in picked], float)
    doc_of, row_of, col_of = [], [], []
    for d, bag in enumerate(bags):
        for s in bag:
            ids = [at[w] for w in s]
            row_of += [len(doc_of)] * len(ids)
            col_of += ids
            doc_of.append(d)
    doc_of, row_of, col_of = (np.array(x, np.int64) for x in (doc_of, row_of, col_of))
    # Documents of either label count as the two halves, so scores hold for equal shares; the bias stays as it is fitted.
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b = np.zeros(len(words)), -4.0
    gw, gb = np.full(len(words), 1e-8), 1e-8
    for _ in range(ROUNDS):
        z = b + np.bincount(row_of, w[col_of], len(doc_of))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), len(picked)))  # of each document
        toxic = np.maximum(1 - clean, 1e-9)
        slope = np.where(y == 1, weight * clean / toxic, -weight)[doc_of] * p
        dw, db = np.bincount(col_of, slope[row_of], len(words)) - RIDGE / max(1, len(words)) * w, slope.sum()
        gw, gb = gw + dw**2, gb + db**2
        w, b = w + RATE * dw / np.sqrt(gw), b + RATE * db / math.sqrt(gb)
    return {"bias": float(b), "weights": {x: float(v) for x, v in zip(words, w) if abs(v) > 1e-3}}


class Scorer:
    """A model with the summed weights of words seen lately."""

    def __init__(self, model: dict):
        self.bias, self.weights, self.words = model["bias"], model["weights"], {}

    def word(self, w: str) -> float:
        if (z := self.words.get(w)) is None:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            z = self.words[w] = sum(self.weights.get(f, 0.0) for f in features(w))
        return z

    def sentence(self, s: str) -> float:
        z = self.bias + sum(map(self.word, set(WORD.findall(s.lower()))))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def score_text(text: str | None, scorer: Scorer) -> tuple[float, list[float]]:
    """The document's probability and its sentences' own."""
    each = [scorer.sentence(s) for s in sentences(text)]
    return 1 - math.exp(sum(math.log1p(-min(p, 1 - 1e-12)) for p in each)), each


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, worst (the sentences of 0.5 or more, or none) for each row of docs(doc_id, text); whole texts.

    A null or empty text scores 0. Other columns are not read; repeated rows are each scored, also those without a doc_id. No rows
    give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_WORDS words at most

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            scores, worst = [], []
            for text in b.column(1).to_pylist():
                s, each = score_text(text, scorer)
                scores.append(s)
                worst.append([x for x, p in zip(sentences(text), each) if p >= 0.5])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(worst, pa.list_(pa.string()))], names=["doc_id", "score", "worst"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), judge, "doc_id long, score double, worst array<string>")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    model = train_joined(docs, labels)
    got = score(docs, model)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), F.size("worst").alias("n_worst"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLES: dict[str, str] = {}
