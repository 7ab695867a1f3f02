"""Importance resampling towards a target: hashed n-gram counts as CSR blocks, column sums as distributions, weights by a product.

Each text is one row of a sparse matrix with a column for each bucket of hashed n-grams. The matrix is stored as CSR blocks (row
pointers, column indices, counts), one table row a block of bounded size. Its column sums are the bucket counts of the corpus, those of
the target's matrix the target's. Both give each bucket a gain, and the matrix times the gains gives each document's weight, block by
block. Documents with the highest weights, each with Gumbel noise drawn from its id, are the sample: as a draw without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import map_arrow, numbered, stored, table, word_runs

GRAMS, BUCKETS, SEED = 3, 10_000, 42
#: Of the documents with MIN_WORDS words, PERCENT are drawn.
MIN_WORDS, PERCENT = 20, 5
#: Stored entries of a block, at most by one row too many.
BLOCK_ENTRIES = 1 << 15
#: indptr, indices and counts are little-endian unsigned integers as bytes (arrays of so many would fill a reader's memory): of 8 bytes,
#: of _index_kind() and of `width` bytes.
MATRIX = "doc_ids array<long>, n_words array<long>, width int, indptr binary, indices binary, counts binary"


def bucket_counts(raw: bytes | None, buckets: int = BUCKETS, grams: int = GRAMS) -> tuple[int, np.ndarray]:
    """Words of a text, and how many of its runs of 1 to `grams` words fall into each bucket: crc32 of a run joined by spaces."""
    total, n, before = np.zeros(buckets, np.int64), 0, []
    for new in word_runs(raw):
        words, k = before + new, len(before)
        spaced = [b" " + w for w in words]
        each, hashed = map(crc32, words), []
        for size in range(grams):  # a run's checksum goes on from that of the run without its last word
            if size:
                each = map(crc32, spaced[size:], hashed[-1])
            hashed.append(list(each))
        ends = chain.from_iterable(h[max(0, k - size) :] for size, h in enumerate(hashed))  # runs that end in a new word
        total += np.bincount(np.fromiter(ends, np.uint32) % buckets, minlength=buckets)
        n += len(new)
        before = words[max(0, len(words) - grams + 1) :] if grams > 1 else []
    return n, total


def _index_kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(next(k for k in ("<u1", "<u2", "<u4", "<u8") if x.max(initial=0) <= np.iinfo(k).max))


def count_matrix(docs: DataFrame, buckets: int = BUCKETS, grams: int = GRAMS) -> DataFrame:
    """The rows of docs(doc_id, text) as stored CSR blocks."""
    kinds = pa.schema([("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("width", pa.int32()), *[(c, pa.binary()) for c in ("indptr", "indices", "counts")]])

    def block(ids: list, words: list, indices: list, counts: list) -> pa.RecordBatch:
        ends = np.concatenate([[0], np.cumsum([len(x) for x in indices])]).astype("<u8")
        n = _narrow(np.concatenate(counts))
        values = [ids, words, n.itemsize, ends.tobytes(), np.concatenate(indices).tobytes(), n.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], k.type) for v, k in zip(values, kinds)], schema=kinds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, indices, counts, size = [], [], [], [], 0
        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                n, total = bucket_counts(raw, buckets, grams)
                at = np.flatnonzero(total).astype(_index_kind(buckets))
                for held, x in zip((ids, words, indices, counts), (doc_id, n, at, total[at])):
                    held.append(x)
                size += len(at) + 1
                if size >= BLOCK_ENTRIES:
                    yield block(ids, words, indices, counts)
                    ids, words, indices, counts, size = [], [], [], [], 0
        if ids:
            yield block(ids, words, indices, counts)

    return stored(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), count, MATRIX), "count-matrix")


def column_sums(matrix: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's count: summed up in every task before anything moves; `buckets` numbers come to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for width, indices, counts in zip(*(c.to_pylist() for c in b.columns)):
                np.add.at(total, np.frombuffer(indices, _index_kind(buckets)), np.frombuffer(counts, f"<u{width}").astype(np.int64))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in map_arrow(matrix.select("width", "indices", "counts"), add, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's share in the target by that in the corpus, one added to every count."""
    a, b = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1) * a / ((s + 1) * b))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(matrix: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the matrix times the gains."""

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                ends, indices, n = (np.frombuffer(b.column(i)[r].as_py(), kind).astype(np.int64) for i, kind in ((3, "<u8"), (4, _index_kind(len(gain))), (5, f"<u{b.column(2)[r].as_py()}")))
                whole = [np.concatenate([[0], np.cumsum(x)]) for x in (n, gain[indices] * n)]
                sums = [pa.array((x[ends[1:]] - x[ends[:-1]]).astype(np.int64)) for x in whole]
                yield pa.RecordBatch.from_arrays([b.column(0)[r].values, b.column(1)[r].values, *sums], ["doc_id", "n_words", "n_features", "weight"])

    return map_arrow(matrix, product, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) from a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, grams: int = GRAMS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank for each row of docs(doc_id, text), drawn towards the texts of target(text).

    rank is 1, 2, ... for the drawn rows, by falling score, then doc_id, and null for all others. A null or empty text, or one without
    words, has no features and weight 0. Rows that repeat a doc_id are documents each; equal ones in all columns have ranks in any order.
    A row without a doc_id counts in the corpus, has no score and is not drawn, nor one of those of which a percentage is drawn. An
    empty target gives gains by the corpus alone; no documents give no rows. Other columns are not read.
    """
    matrix = count_matrix(docs, buckets, grams)
    aim = count_matrix(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, grams)
    got = weigh(matrix, gains(column_sums(matrix, buckets), column_sums(aim, buckets)))
    got = stored(got.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("_row", F.monotonically_increasing_id()), "weights")
    may = F.col("doc_id").isNotNull() & (F.col("n_words") >= min_words)
    drawn = got.where(may).count() * percent // 100
    ranked = numbered(got.where(may), [F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("_row")], "rank", drawn)
    return ranked.unionByName(got.where(~may).withColumn("rank", F.lit(None).cast("long"))).drop("_row")


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


#: Every feature as a string; its crc32 byte by byte, by a table from the rule of the polynomial.
ORACLE = r"""
WITH tab AS MATERIALIZED (SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
q AS MATERIALIZED (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT unnest([1, 2, 3]) AS k),
df AS MATERIALIZED (SELECT doc_id, f, count(*) AS n FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS f FROM d, k WHERE len(w) >= k) GROUP BY 1, 2),
qf AS MATERIALIZED (SELECT f, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS f FROM q, k WHERE len(w) >= k) GROUP BY 1),
h AS MATERIALIZED (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, octet_length(encode(f))), lambda i: CAST(16 * (instr('0123456789ABCDEF', hex(f)[2 * i + 1]) - 1) + instr('0123456789ABCDEF', hex(f)[2 * i + 2]) - 1 AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b
  FROM (SELECT f FROM df UNION SELECT f FROM qf), tab),
s AS (SELECT b, sum(n) AS s FROM df JOIN h USING (f) GROUP BY b), t AS (SELECT b, sum(n) AS t FROM qf JOIN h USING (f) GROUP BY b),
u AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS us, (SELECT coalesce(sum(t), 0) FROM t) AS ut),
g AS (SELECT b, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(us + 10000 AS DOUBLE) / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(ut + 10000 AS DOUBLE)))) AS BIGINT) AS g FROM (SELECT unnest(range(0, 10000)) AS b) LEFT JOIN s USING (b) LEFT JOIN t USING (b), u),
w AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * g) AS BIGINT) AS weight FROM df JOIN h USING (f) JOIN g USING (b) GROUP BY doc_id),
x AS (SELECT d.doc_id, len(d.w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM x WHERE words >= 20)
SELECT x.doc_id, n_features, weight, score, CASE WHEN r <= 5 * (SELECT count(*) FROM r) // 100 THEN r END AS rank FROM x LEFT JOIN r USING (doc_id)
"""

QUERIES = {"op12_importance_resample": op12_importance_resample}
ORACLES = {"op12_importance_resample": ORACLE}
