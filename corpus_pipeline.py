"""A training corpus from `documents`: five stages, each over all rows its predecessor kept.

Every stage but the last returns the columns of its input. Between stages rows are written and read again, so a lost executor
never costs more than one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import passing, stored, table
from riverlog.llm.op2_decontamination import decontaminate
from riverlog.llm.op3_best_fit_packing import pack
from riverlog.llm.op6_language_id import held_out, identify, train
from riverlog.llm.op7_repeated_strings import remove_repeats
from riverlog.llm.op10_minhash_dedup import near_duplicates
from riverlog.llm.tokens import default_vocabulary


def _aside(docs: DataFrame) -> tuple[list[str], list[Column]]:
    """Names that no operator uses for all columns of docs but text, and those columns under them."""
    names = [f"column_{i}" for i, c in enumerate(docs.columns) if c != "text"]
    return names, [F.col(f"`{c}`").alias(n) for n, c in zip(names, (c for c in docs.columns if c != "text"))]


def _back(df: DataFrame, docs: DataFrame, names: list[str], **new: Column) -> DataFrame:
    """The columns of docs again, some of them anew."""
    name = dict(zip((c for c in docs.columns if c != "text"), names)) | {"text": "text"}
    return df.select(*[(new[c] if c in new else F.col(name[c])).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected: no text, no letters, or no clear winner. Each row is judged by its text alone, so
    repeated rows share their fate, and a null doc_id or lang changes nothing."""
    known = train(docs.where(~held_out(F.col("doc_id"))))
    names, columns = _aside(docs)
    return _back(identify(docs.select(*columns, "text"), known, keep=[*names, "text"]).where(~F.col("rejected")), docs, names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the least doc_id, of each group of near duplicates. A document is a doc_id: rows that repeat the one
    that is kept all stay, those that repeat another all go. Documents without words, and rows without a doc_id, stay."""
    with passing(spark):
        gone = stored(near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct(), "gone", outlives=True)
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out strings of 400 bytes that stand anywhere else too; no row goes, though a text may become empty, as a null text does."""
    names, columns = _aside(docs)
    cut = remove_repeats(docs.select("doc_id", "text", *columns), keep=names, as_text=True)
    return _back(cut, docs, names, text=F.col("kept"), n_chars=F.char_length("kept").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows that hold a benchmark item's passage in at least a twentieth of their words. Each row is judged by its own text, also
    where rows repeat a doc_id or have none. Texts without words stay."""
    each = docs.select(F.struct(F.col("doc_id").alias("i"), F.xxhash64("text").alias("h")).alias("doc_id"), "text")
    bad = decontaminate(each, table(spark, sf_dir, "benchmark")).where("contaminated").select(F.col("doc_id.i").alias("bad_id"), F.col("doc_id.h").alias("bad_text")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_text"]), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every row's text in sequences of 4096 tokens; one without text is its end token alone."""
    return pack(docs, default_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeated_strings),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: Compression, the genetic packing and tokenizing have no SQL form; stages and run() are tested against brute force
#: on a small corpus instead (language_id: against the classifier's own verdicts).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
