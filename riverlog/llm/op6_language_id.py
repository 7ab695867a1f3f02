"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from labelled training texts. A text is compressed, in chunks,
with each dictionary, and the smallest total wins. The margin is how much larger, per byte of the best, the second is; a
text with a narrower margin than MARGIN is rejected. Sizes are whole bytes, too coarse for short texts, so the end of each
text, long or short, is compressed from some later words on too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import hash01, map_arrow, table

#: Bounds of the training sample: texts of a language, bytes of its dictionary, bytes of all dictionaries together.
SAMPLE_TEXTS, DICTIONARY_BYTES, ALL_BYTES = 400, 64 << 10, 32 << 20
#: Bytes of a text that are compressed at once, so that the dictionary counts throughout a long text.
CHUNK, LEVEL, MIN_MATCH = 2048, 6, 3
#: The bytes at the end of a text that are compressed again, from up to SUFFIXES later words on.
TAIL, SUFFIXES = 400, 12
#: Rejected below it: hardly any but ties of very short texts and junk.
MARGIN = 0.001
UNKNOWN = "und"


def train(labelled: DataFrame, sample_texts: int = SAMPLE_TEXTS, dictionary_bytes: int = DICTIONARY_BYTES, slice_chars: int | None = None) -> dict[str, bytes]:
    """A dictionary for each lang of labelled(doc_id, text, lang), from a bounded, repeatable sample of its texts.

    About sample_texts texts of each language take part, with one slice of slice_chars characters each (by default twice what fills
    the dictionary from all of them), from a place that varies. Of rows that repeat a doc_id, or have none, one of a language may take
    part. Rows without text or lang are passed over. No rows: no languages.
    """
    rows = labelled.select("doc_id", "text", "lang").where("text IS NOT NULL AND text <> '' AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    each = min(dictionary_bytes, max(1024, ALL_BYTES // len(counts)))
    chance = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample_texts / n))])
    spread = slice_chars or max(256, 2 * each // sample_texts)
    picked = rows.withColumn("u", hash01(F.col("doc_id"), "language")).where(F.col("u") < F.element_at(chance, F.col("lang")))
    at = F.lit(1) + F.floor(hash01(F.col("doc_id"), "slice") * F.greatest(F.lit(1), F.char_length("text") - spread)).cast("int")
    parts = picked.select("lang", "u", "doc_id", F.substr("text", at, F.lit(spread)).alias("part"))
    parts = parts.groupBy("lang", "u", "doc_id").agg(F.min("part").alias("part")).collect()  # however many rows repeat a drawn id
    out: dict[str, list[bytes]] = {}
    for r in sorted(parts, key=lambda r: (r["lang"], r["u"], r["part"])):
        out.setdefault(r["lang"], []).append(r["part"].lower().encode())
    return {lang: b"\n".join(x)[:each] for lang, x in sorted(out.items())}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str] | None = None, margin: float = MARGIN) -> DataFrame:
    """docs' columns in `keep` (doc_id by default), then lang_pred, score, margin, rejected; whole texts, one row for each.

    lang_pred is UNKNOWN, score 0 and the row rejected where the text is null or has no letter, or no language was learned. One language
    alone always wins, with score 1. Equal sizes go to the first language by name and are rejected. Only `text` is judged; repeated
    rows are each judged, no rows give no rows. Columns in `keep` must not have the names of the four results.
    """
    keep = ["doc_id"] if keep is None else keep
    out = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("rejected", pa.bool_())])
    if clash := set(keep) & set(out.names):
        raise ValueError(f"columns to keep have names of results: {sorted(clash)}")
    read = keep if "text" in keep else [*keep, "text"]
    inner, at = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(read)]), read.index("text")
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in inner.schema.fields[: len(keep)])
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(dictionaries)  # bounded by ALL_BYTES

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = list(shared.value)
        packers = [packer(d) for d in shared.value.values()]
        for b in batches:
            rows = []
            for text in b.column(at).to_pylist():
                if not langs or not text or not any(map(str.isalpha, text)):
                    rows.append((UNKNOWN, 0.0, 0.0, True))
                    continue
                chunks = parts(text)
                sizes = [sum(len(p.compress(c)) for c in chunks) for p in packers]
                first, *more = sorted(zip(sizes, langs))
                gap = (more[0][0] - first[0]) / first[0] if more else 1.0
                rows.append((first[1], 1 - math.exp(-gap / 0.02) if more else 1.0, gap, gap < margin))
            cols = [pa.array(x, f.type) for x, f in zip(zip(*rows), out)] if rows else [pa.array([], f.type) for f in out]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *cols], names=[*b.schema.names[: len(keep)], *out.names])

    done = map_arrow(inner, judge, f"{schema}lang_pred string, score double, margin double, rejected boolean")
    return done.toDF(*keep, *out.names)


def parts(text: str) -> list[bytes]:
    raw = text.lower().encode("utf-8", "replace")
    words = raw[-TAIL:].split()
    return [*(raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)), *(b" ".join(words[i:]) for i in range(1, min(len(words), SUFFIXES)))]


def packer(dictionary: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=MIN_MATCH)
    return zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = train(docs.where(~held_out(F.col("doc_id"))))
    got = identify(docs.select("doc_id", "text"), known)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")


QUERIES = {"op6_language_id": op6_language_id}
ORACLES: dict[str, str] = {}
