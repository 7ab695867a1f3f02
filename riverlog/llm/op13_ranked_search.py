"""Exact ranked search by words: postings of a shard as one wavelet tree, ordered by impact within each list and by document along it.

A shard is a bounded run of documents, numbered by doc_id. Its lists, one for each term, hold documents by falling impact and stand one
after the other in a single sequence, which is kept as a wavelet tree over document numbers. A list's range at the root maps to a range
at each node, which holds the list's documents of that node's number range, still by falling impact; so the first impact of a range
bounds all of it, and at a leaf, one document, it is the document's own. A query's node has the ranges of all its terms, and the sum of
their first impacts times their weights bounds every score below. Nodes are opened best first until no bound reaches the kth score.

The kth score is propagated: a part of the shards is searched first, and what it finds is the floor for the others; within a task it
rises from shard to shard. Queries are read by tasks from the shared folder, in blocks of bounded size.
"""

from __future__ import annotations

import io
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverlog.llm.common import map_arrow, stored, table, word_runs
from riverlog.sources.folders import file_system, scratch

TOP = 10
#: A shard ends with the document that reaches one of these.
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 19
#: Nodes opened at once, queries in a block, one shard in how many is searched first, and shards of a task.
NODES, BLOCK_QUERIES, FIRST, SHARDS_A_TASK = 32, 1024, 16, 4
#: The share in 100 of the length in a document's impact.
LENGTH = 75
#: Shards lie one after another in files of the shared folder, one file a task; a row tells where one lies.
PLACES = "file string, offset long, length long, n_docs long, n_terms long"


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _File:
    """Shards of a task, in a file of its own that no other attempt of the task touches."""

    def __init__(self, folder: str):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.shards"
        self.uri, self.out, self.at = f"{folder}/{name}", fs.open_output_stream(f"{root}/{name}"), 0

    def add(self, **arrays: np.ndarray) -> tuple[str, int, int]:
        raw = io.BytesIO()
        np.savez(raw, **arrays)
        packed = zstandard.ZstdCompressor(1).compress(raw.getvalue())
        self.out.write(packed)
        self.at += len(packed)
        return self.uri, self.at - len(packed), len(packed)


def _load(uri: str, offset: int, length: int) -> dict[str, np.ndarray]:
    fs, path = file_system(uri)
    with fs.open_input_file(path) as f:
        f.seek(offset)
        with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(f.read(length)))) as z:
            return dict(z)


def postings(docs: DataFrame, folder: str, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """Counted terms of docs(doc_id, text), in files: lists by term, each by document number. A row for each shard and, with term and df
    alone, one for each of its terms."""
    kinds = pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in ("offset", "length", "n_docs", "n_terms")], ("term", pa.binary()), ("df", pa.int64())])

    def shard(held: list[tuple[int, np.ndarray, np.ndarray]], vocabulary: dict, file: _File) -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda x: x[0])
        term = np.concatenate([t for _, t, _ in held])
        doc = np.repeat(np.arange(len(held), dtype=np.uint16), [len(t) for _, t, _ in held])
        order = np.argsort(term, kind="stable")
        tf, lengths = np.concatenate([n for _, _, n in held])[order], np.array([n.sum() for _, _, n in held], np.int64)
        words, dfs = list(vocabulary), np.bincount(term, minlength=len(vocabulary))
        place = file.add(doc_ids=np.array([i for i, _, _ in held]), lengths=lengths, words=np.frombuffer(b" ".join(words), np.uint8), dfs=dfs, docs=doc[order], tfs=tf)
        yield pa.RecordBatch.from_arrays([pa.array([x], k.type) for x, k in zip((*place, len(held), int(lengths.sum()), None, None), kinds)], schema=kinds)
        for i in range(0, len(words), 1 << 15):
            part = words[i : i + (1 << 15)]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(part), k.type) for k in list(kinds)[:5]), pa.array(part, pa.binary()), pa.array(dfs[i : i + len(part)])], schema=kinds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, vocabulary, size, file = [], _Vocabulary(), 0, None
        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids = [np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)) for words in word_runs(raw)]
                if ids:
                    terms, n = np.unique(np.concatenate(ids), return_counts=True)
                    held.append((doc_id, terms, n))
                    size += len(terms)
                if len(held) >= min(shard_docs, 1 << 16) or size >= shard_postings:
                    file = file or _File(folder)
                    yield from shard(held, vocabulary, file)
                    held, vocabulary, size = [], _Vocabulary(), 0
        if held:
            file = file or _File(folder)
            yield from shard(held, vocabulary, file)
        if file:
            file.out.close()

    return stored(map_arrow(docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text"), count, f"{PLACES}, term binary, df long"), "postings")


def ordered(docs: np.ndarray, tfs: np.ndarray, dfs: np.ndarray, lengths: np.ndarray, n: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, impacts) of all lists, each list by falling impact, then document. n documents have `total` terms in all."""
    m = np.array([100 - LENGTH + LENGTH * x * n // total for x in lengths.tolist()], np.int64)
    impact = 1_000_000_000 * tfs // (1000 * tfs + 8 * m[docs])  # under a million
    key = (np.repeat(np.arange(len(dfs)), dfs) << 36) | ((1_000_000 - impact) << 16) | docs
    key.sort()
    return (key & 0xFFFF).astype(np.uint16), (1_000_000 - (key >> 16 & 0xFFFFF)).astype(np.int32)


def wavelet(docs: np.ndarray, n_docs: int) -> np.ndarray:
    """Packed bits of each level: at level l the sequence stands in order of the documents' l highest bits, and its bit is the next."""
    depth, out, at = _depth(n_docs), [], docs
    for left in range(depth - 1, -1, -1):
        out.append(np.packbits((at >> left & 1).astype(np.uint8)))
        at = at[np.argsort(at >> left, kind="stable")]
    return np.concatenate(out)


def _depth(n_docs: int) -> int:
    return max(1, (n_docs - 1).bit_length())


class Tree:
    """ones: set bits before each place of a level. firsts: impacts in a level's order. Both end each level with one place more."""

    def __init__(self, n_docs: int, bits: np.ndarray, impacts: np.ndarray):
        self.depth, now = _depth(n_docs), impacts
        self.size = n = len(now)
        packed = bits.reshape(self.depth, -1)
        self.ones, self.firsts = np.zeros((self.depth, n + 1), np.int32), np.zeros((self.depth + 1, n + 1), np.int32)
        self.firsts[0, :n] = now
        edges, place = np.array([0, n]), np.arange(n, dtype=np.int32)
        for level in range(self.depth):
            bit = np.unpackbits(packed[level], count=n)
            ones = self.ones[level]
            np.cumsum(bit, out=ones[1:])
            sizes = np.diff(edges)
            zeros = sizes - (ones[edges[1:]] - ones[edges[:-1]])
            before = ones[:-1] - np.repeat(ones[edges[:-1]], sizes)
            to = np.where(bit, np.repeat((edges[:-1] + zeros).astype(np.int32), sizes) + before, place - before)
            self.firsts[level + 1, to] = now
            now = self.firsts[level + 1, :n]
            edges = np.append(np.stack([edges[:-1], edges[:-1] + zeros], 1).ravel(), n)
        self.ones, self.firsts = self.ones.ravel(), self.firsts.ravel()

    def search(self, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offers documents to best until no node's bound reaches its floor."""
        stride = self.size + 1
        # A node: bound, level, first document's number at leaf level, its place in the level, and the terms' ranges there.
        bound = self._bounds(np.zeros(1, np.int64), starts[None], ends[None], weights)
        level, node, low, high, a, b = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([self.size]), starts[None], ends[None]
        while True:
            open_ = (bound >= best.floor) & (bound > 0)
            if not open_.all():
                bound, level, node, low, high, a, b = (x[open_] for x in (bound, level, node, low, high, a, b))
            if not len(bound):
                return
            if len(bound) > NODES:
                order = np.argpartition(-bound, NODES)
                now, later = order[:NODES], order[NODES:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, np.int64)
            leaf = level[now] == self.depth
            for i in now[leaf]:
                best.offer(int(bound[i]), int(node[i]))
            now = now[~leaf]
            at = level[now] * stride
            lo, hi, s, e = low[now], high[now], a[now], b[now]
            skip = self.ones[at + lo]
            middle = lo + (hi - lo) - (self.ones[at + hi] - skip)
            s1, e1 = (self.ones[at[:, None] + x] - skip[:, None] for x in (s, e))
            new_a, new_b = np.concatenate([s - s1, middle[:, None] + s1]), np.concatenate([e - e1, middle[:, None] + e1])
            new_level = np.concatenate([level[now] + 1] * 2)
            fresh = (self._bounds(new_level, new_a, new_b, weights), new_level, np.concatenate([2 * node[now], 2 * node[now] + 1]), np.concatenate([lo, middle]), np.concatenate([middle, hi]), new_a, new_b)
            bound, level, node, low, high, a, b = (np.concatenate([x[later], y]) for x, y in zip((bound, level, node, low, high, a, b), fresh))

    def _bounds(self, level: np.ndarray, a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> np.ndarray:
        first = self.firsts[level[:, None] * (self.size + 1) + a]
        return np.where(b > a, first * weights, 0).sum(1)


class Best:
    """The k best (score, doc_id) of a query so far, best first; floor: the score that another must reach."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.rows, self.doc_ids = k, max(1, floor), [], None

    def offer(self, score: int, number: int) -> None:
        self.rows.append((-score, int(self.doc_ids[number])))
        self.rows.sort()
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.floor = max(self.floor, -self.rows[-1][0])


def _dealt(places: DataFrame, shards: int) -> DataFrame:
    """Rows of places, some to a task, so that a task's later shards profit from its earlier ones."""
    return places.repartition(max(1, min(-(-shards // SHARDS_A_TASK), 1 << 16)))


def build_index(counted: DataFrame, folder: str, shards: int, n: int, total: int) -> DataFrame:
    """The shards of postings() as wavelet trees, in files; n documents with `total` terms in all fix the impacts."""
    kinds = pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in ("offset", "length", "n_docs", "n_terms")]])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for b in batches:
            for uri, offset, length, n_docs, n_terms in zip(*(c.to_pylist() for c in b.columns)):
                x, file = _load(uri, offset, length), file or _File(folder)
                docs, impacts = ordered(x["docs"], x["tfs"], x["dfs"], x["lengths"], n, total)
                place = file.add(doc_ids=x["doc_ids"], words=x["words"], starts=np.concatenate([[0], np.cumsum(x["dfs"])]), bits=wavelet(docs, n_docs), impacts=impacts)
                yield pa.RecordBatch.from_arrays([pa.array([y], k.type) for y, k in zip((*place, n_docs, n_terms), kinds)], schema=kinds)
        if file:
            file.out.close()

    return stored(map_arrow(_dealt(counted, shards), build, PLACES).withColumn("shard", F.monotonically_increasing_id()), "word-index")


def query_terms(items: DataFrame) -> DataFrame:
    """item_id, term, n (its occurrences) for items(item_id, text); equal rows are one, other rows of an item add up."""
    rows = items.select("item_id", "text").distinct()
    kind = rows.schema["item_id"].dataType.simpleString()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, raw in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                n = Counter()
                for words in word_runs(raw):
                    n.update(words)
                at = pa.array([i] * len(n), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["item_id", "term", "n"])

    return map_arrow(rows, spell, f"item_id {kind}, term binary, n long").groupBy("item_id", "term").agg(F.sum("n").alias("n"))


def _search(index: DataFrame, path: str, block: int, k: int) -> DataFrame:
    """q, doc_id, score: the best k of each task's shards for the queries of a block, read from path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = None
        for b in batches:
            if queries is None:
                fs, root = file_system(f"{path}/block={block}")
                queries = [(r["q"], r["terms"], np.array(r["weights"], np.int64), Best(k, r["floor"])) for r in pads.dataset(root, filesystem=fs, format="parquet").to_table(["q", "terms", "weights", "floor"]).to_pylist()]
            for uri, offset, length, n_docs in zip(*(c.to_pylist() for c in b.columns)):
                x = _load(uri, offset, length)
                place = {t: i for i, t in enumerate(x["words"].tobytes().split(b" "))}
                tree, starts, doc_ids = Tree(n_docs, x["bits"], x["impacts"]), x["starts"], x["doc_ids"]
                for _, terms, weights, best in queries:
                    here = [(at, j) for j, t in enumerate(terms) if (at := place.get(t)) is not None]
                    if here:
                        at, j = np.array(here).T
                        best.doc_ids = doc_ids
                        tree.search(starts[at], starts[at + 1], weights[j], best)
        rows = [(q, doc_id, -score) for q, _, _, best in queries or () for score, doc_id in best.rows]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3, ["q", "doc_id", "score"])

    return map_arrow(index.select("file", "offset", "length", "n_docs"), run, "q long, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS, block_queries: int = BLOCK_QUERIES, first: int = FIRST) -> DataFrame:
    """item_id, rank, doc_id, score: for each item of items(item_id, text) the k best of docs(doc_id, text), scores above 0.

    Equal scores go by ascending doc_id. Only those columns are read. Texts that are null, empty or without words have no terms: such
    documents count nowhere, such items have no rows. Rows without a doc_id are left out and not counted. Rows that repeat a doc_id are
    documents each, and each has a rank. Items of null item_id are one item. No documents or no items: no rows.
    """
    spark = docs.sparkSession
    counted = postings(docs, scratch(spark, "posting-files"), shard_docs, shard_postings)
    places = counted.where("file IS NOT NULL").drop("term", "df")
    sums = places.agg(F.count("*").alias("shards"), F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    shards, n, total = sums["shards"], sums["n"] or 0, sums["total"] or 1
    index = build_index(places, scratch(spark, "index-files"), shards, n, total)
    asked = stored(query_terms(items), "query-terms")
    df = counted.where("term IS NOT NULL").select("term", "df").join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n + 2) / (2 * F.col("df") + 1)))
    of_item = asked.join(df, "term").groupBy("item_id").agg(F.collect_list("term").alias("terms"), F.collect_list(weight * F.col("n")).alias("weights"))
    queries = stored(of_item.withColumn("q", F.monotonically_increasing_id()), "queries")
    blocks = -(-queries.count() // block_queries)
    if not blocks:
        return queries.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int"))
    numbers = [r["block"] for r in dealt.select("block").distinct().collect()]  # a number for each block_queries queries

    def search(part: DataFrame, floors: DataFrame | None) -> DataFrame:
        path = scratch(spark, "queries")
        with_floor = dealt.withColumn("floor", F.lit(1).cast("long")) if floors is None else dealt.join(floors, "q", "left").na.fill(1, ["floor"])
        with_floor.select("block", "q", "terms", "weights", "floor").write.partitionBy("block").parquet(path)
        found = None
        for b in numbers:
            one = _search(_dealt(part, part.count()), path, b, k)
            found = one if found is None else found.unionByName(one)
        return stored(found, "found")

    early = F.pmod(F.xxhash64("shard"), F.lit(first)) == 0
    some = search(index.where(early), None)
    floors = _top(some, k).where(F.col("rank") == k).select("q", F.col("score").alias("floor"))
    got = _top(some.unionByName(search(index.where(~early), floors)), k)
    return got.join(queries.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Every document's score for every item.
ORACLE = r"""
WITH d AS MATERIALIZED (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
i AS (SELECT item_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM benchmark),
s AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
q AS (SELECT item_id, t, count(*) AS k FROM (SELECT item_id, unnest(w) AS t FROM i) GROUP BY 1, 2),
p AS MATERIALIZED (SELECT doc_id, t, any_value(m) AS m, count(*) AS tf FROM (SELECT doc_id, 25 + (75 * len(w) * n) // total AS m, unnest(w) AS t FROM d, s) WHERE t IN (SELECT t FROM q) GROUP BY 1, 2),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s),
f AS (SELECT item_id, doc_id, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN p USING (t) JOIN w USING (t) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM f WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""

QUERIES = {"op13_ranked_search": op13_ranked_search}
ORACLES = {"op13_ranked_search": ORACLE}
