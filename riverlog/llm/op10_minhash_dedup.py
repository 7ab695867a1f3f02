"""Near-duplicates: banded MinHash candidates, sequential Bayesian pruning, exact confirmation.

Rows with equal shingle sets are one class from the start, so exact copies cost one row each. Representatives meet in buckets
of equal signature bands. A bucket does not pair its members with each other. In each of a few rounds a representative is paired
with one other only, the links confirmed so far form components, and buckets within one component are done. What is left is
paired by one member of each component in a bucket, and only then are members of different components of one bucket paired in
full, where their set sizes and their odd sketches allow a link, so no link that can change a component is left out.

An odd sketch has one bit for each of BITS slots: whether the set has an odd number of hashes there. Two sketches differ in no
more bits than their sets have differing members, so the bound it gives rules out pairs without ever losing a link. It keeps a
group of look-alikes that are not links from meeting pair by pair, up to about 2 * BITS shingles a text.

A pair's signatures are compared in batches; after each batch the pair is dropped if, with a uniform prior on its similarity,
the chance that it reaches the threshold is below MISS. Survivors are confirmed on their full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import map_arrow, split, stored, table
from riverlog.llm.graph import components

SHINGLE = 5
#: The similarity from which documents are linked, as a fraction: 100 * common >= 75 * all.
NUM, DEN = 75, 100
#: Bands are WIDTH signature places each, cut from DEALS shuffles of all places: narrow enough that pairs at 0.3 rarely meet, and
#: a pair at 0.75 shares none with probability 4e-7.
HASHES, BATCH, WIDTH, DEALS = 128, 16, 5, 4
#: Rounds in which each representative is paired with one other.
ROUNDS = 3
#: Chance of being a link below which a pair is dropped.
MISS = 1e-7
#: Classes whose band keys are spelled at once, and bytes of band keys that one task counts: hardly any two of a task's keys are equal,
#: so its table in memory is about seven times that.
SPELLED, COUNTED = 256, 4 << 20
#: Bits of an odd sketch, kept as longs.
BITS = 1024
#: Bits of the filter by which texts that no pair needs stay where they are: 4 MB at any size of input. A full one lets all pass.
FILTER_BITS, FILTER_PART = 1 << 25, 32768
_seeds = np.random.default_rng(20240229)
_XOR, _MUL = _seeds.integers(0, 1 << 32, HASHES, dtype=np.uint32), _seeds.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLACES = np.concatenate([_seeds.permutation(HASHES)[: HASHES // WIDTH * WIDTH].reshape(-1, WIDTH) for _ in range(DEALS)])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(raw: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a UTF-8 text (bytes.lower and bytes.split go by ASCII)."""
    words = raw.lower().split() if raw else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    size = min(n, SHINGLE)
    out = np.full(n - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j : n - size + 1 + j])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(x), 512):
            y = (x[i : i + 512, None] ^ _XOR) * _MUL
            y ^= y >> np.uint32(15)
            y *= np.uint32(0x2C1B3C6D)
            np.minimum(best, y.min(0), out=best)
    return best


def least_matches(num: int = NUM, den: int = DEN, miss: float = MISS) -> list[int]:
    """For each batch end n: the fewest matches of n at which P(similarity >= num / den | matches) is at least miss."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    high = grid >= num / den
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(logs - logs.max())
            if weight[high].sum() >= miss * weight.sum():
                out.append(m)
                break
    return out


def prune(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Places of the pairs of signatures (rows of a and b) that no batch rules out."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i, need in enumerate(least):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches = matches + (a[alive, part] == b[alive, part]).sum(1)
        keep = matches >= need
        alive, matches = alive[keep], matches[keep]
    return alive


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, h, n, fp (of the set), sig for each row of docs(doc_id, h, text)."""
    out = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("sig", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, fp, sig = [], [], []
            for raw in b.column(2).cast(pa.binary()).to_pylist():
                s = shingle_set(raw)
                n.append(len(s))
                fp.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sig, pa.binary())], schema=out)

    return map_arrow(docs, sign, "doc_id long, h long, n long, fp binary, sig binary")


def _keys(classes: DataFrame) -> DataFrame:
    """rep, n, key for each band of classes(rep, n, sig)."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(at, SPELLED) for x in batches for at in range(0, x.num_rows, SPELLED)):
            sig = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(-1, HASHES)
            key = np.tile(_mix(np.arange(1, len(_PLACES) + 1, dtype=np.uint64)), (len(sig), 1))
            with np.errstate(over="ignore"):
                for j in range(WIDTH):
                    key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, _PLACES[:, j]])
            each = [pa.array(np.repeat(b.column(i).to_numpy(), len(_PLACES))) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*each, pa.array(key.ravel().view(np.int64))], ["rep", "n", "key"])

    return map_arrow(classes.select("rep", "n", "sig"), spell, "rep long, n long, key long")


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """BITS bits as longs, by other bits of the hashes than signatures use."""
    odd = np.bincount((shingles & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS))


def _picked(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, Callable[[pa.RecordBatch], pa.RecordBatch]]:
    """(docs as doc_id, h, text, slot; a test of its batches: the rows whose doc_id may be among those of wanted)."""
    slot = wanted.select(_slot(F.col("doc_id")).alias("s"))
    parts = slot.groupBy(F.expr(f"s div {FILTER_PART}").alias("part")).agg(F.bitmap_construct_agg(F.col("s") % FILTER_PART).alias("bits")).collect()
    bits = np.zeros((FILTER_BITS // FILTER_PART, FILTER_PART // 8), np.uint8)
    for r in parts:
        bits[r["part"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    flat = bits.ravel()

    def test(b: pa.RecordBatch) -> pa.RecordBatch:
        s = b.column(3).to_numpy(zero_copy_only=False)
        return b.filter(pa.array((flat[s >> 3] >> (s & 7).astype(np.uint8) & 1).astype(bool)))

    return docs.select("doc_id", "h", "text", _slot(F.col("doc_id"))), test


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, text of the classes wanted(rep, doc_id, h); only their texts move, one for each however many rows repeat it."""
    rows, needed = _picked(docs, wanted)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield needed(b).select([0, 1, 2])

    once = map_arrow(rows, pick, "doc_id long, h long, text string").groupBy("doc_id", "h").agg(F.first("text").alias("text"))
    return once.join(wanted, ["doc_id", "h"]).select("rep", "text")


def _sketches(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, o0, o1, ... of the texts of the classes wanted(rep, doc_id, h)."""
    (rows, needed), places = _picked(docs, wanted), [f"o{i}" for i in range(BITS // 64)]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in map(needed, batches):
            sets = [shingle_set(x) for x in b.column(2).cast(pa.binary()).to_pylist()]
            odd = np.array([odd_sketch(x) for x in sets], np.int64).reshape(-1, len(places))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, odd.T.copy())], ["doc_id", "h", *places])

    schema = ", ".join(f"{c} long" for c in ["doc_id", "h", *places])
    return map_arrow(rows, draw, schema).distinct().join(wanted, ["doc_id", "h"]).select("rep", *places)


def _wanted(classes: DataFrame, reps: DataFrame) -> DataFrame:
    return stored(classes.join(reps.distinct(), "rep", "left_semi").select("rep", "doc_id", "h"), "wanted-texts")


def _verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, num: int, den: int, miss: float) -> DataFrame:
    """Those of pairs(a, b) that are links."""
    sigs = classes.select("rep", "sig")
    met = pairs.join(sigs.toDF("a", "sa"), "a").join(sigs.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    least = least_matches(num, den, miss)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sa, sb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint32).reshape(-1, HASHES) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).take(pa.array(prune(sa, sb, least)))

    left = stored(map_arrow(met, sift, "a long, b long"), "near-pairs")
    texts = _texts(docs, _wanted(classes, left.select(F.col("a").alias("rep")).union(left.select("b"))))
    both = left.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b").select("a", "b", "x", "y")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column(2).cast(pa.binary()).to_pylist(), b.column(3).cast(pa.binary()).to_pylist())):
                s, t = sorted((shingle_set(x), shingle_set(y)), key=len)
                at = np.searchsorted(t, s)
                common = int((t[np.minimum(at, len(t) - 1)] == s).sum()) if len(t) else 0
                if den * common >= num * (len(s) + len(t) - common) > 0:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).take(pa.array(keep, pa.int64()))

    return stored(map_arrow(both, confirm, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, num: int = NUM, den: int = DEN, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs(doc_id, text).

    doc_id stands for the document: rows that repeat one belong together, whatever their texts. A row whose text is null, empty or
    blank has no shingles, is linked with nothing, not even by its doc_id, and kept; texts of fewer than five words are one shingle. A null doc_id is linked with nothing.
    No rows: no rows. Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    signed = stored(_signed(docs), "signatures")
    # A class: rows of one shingle set, summed up before the shuffle. It has a number of its own, rep, and a row that stands for it.
    named = signed.where("n > 0 AND doc_id IS NOT NULL")
    least = named.groupBy("fp").agg(F.min(F.struct("doc_id", "h", "n", "sig")).alias("m"))
    classes = stored(least.select("fp", "m.*", F.monotonically_increasing_id().alias("rep")), "classes")
    keys = stored(_keys(classes), "bands", group=COUNTED)
    # Buckets of two or more, and in them one row of each member.
    size = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    tried, links = None, _of_one_id(named, classes)
    comp = components(links)
    with split(docs.sparkSession, COUNTED):
        buckets = stored(keys.join(size, "key"), "buckets")
    buckets = _labelled(buckets, comp)
    for i in range(ROUNDS + 2):
        ends = buckets.groupBy("key").agg(F.min(F.struct("comp", "rep", "n")).alias("lo"), F.max("comp").alias("high")).where("lo.comp < high").drop("high")
        buckets = stored(buckets.join(ends, "key"), "open-buckets")
        if buckets.isEmpty():
            break
        fits = f"{den} * least(n, lo.n) >= {num} * greatest(n, lo.n)"
        if i < ROUNDS:  # one partner each: the least, then that of the largest bucket, then of any
            far = buckets.where("comp <> lo.comp").where(fits)
            rank = [F.struct("lo.rep"), F.struct(-F.col("size"), "lo.rep"), F.struct(F.xxhash64("key", "rep"), F.col("lo.rep"))][i % 3]
            pairs = far.groupBy(F.col("rep").alias("a")).agg(F.min_by("lo.rep", rank).alias("b"))
        elif i == ROUNDS:  # one member of each component in a bucket
            pairs = buckets.where("comp <> lo.comp").groupBy("key", "comp").agg(F.min("rep").alias("a"), F.first("lo.rep").alias("b"))
        else:
            sketches = stored(_sketches(docs, _wanted(classes, buckets.select("rep"))), "sketches")
            drawn = buckets.select("key", "rep", "n", "comp").join(sketches, "rep")
            odd = [c for c in sketches.columns if c != "rep"]
            mine, other = drawn.select("key", *[F.col(c).alias(f"{c}_a") for c in ["rep", "comp", "n", *odd]]), drawn.select("key", *[F.col(c).alias(f"{c}_b") for c in ["rep", "comp", "n", *odd]])
            # common / all >= num / den means that at most (den - num) of each den + num members of both sets differ.
            differ = " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in odd)
            allows = f"{den} * least(n_a, n_b) >= {num} * greatest(n_a, n_b) AND {den + num} * ({differ}) <= {den - num} * (n_a + n_b)"
            pairs = mine.join(other, "key").where(f"rep_a < rep_b AND comp_a <> comp_b AND {allows}").selectExpr("rep_a AS a", "rep_b AS b")
        buckets = buckets.drop("lo")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        found = _verify(pairs, classes, docs, num, den, miss)
        tried = pairs if tried is None else tried.union(pairs)
        if found.isEmpty():
            continue
        links = links.union(found)
        comp = components(links)
        buckets = _labelled(buckets, comp)
    ids = classes.select("fp", "rep", "doc_id").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    of_comp = ids.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least"))
    of_class = ids.join(of_comp, "comp", "left").select("fp", F.coalesce("least", "doc_id").alias("least"))
    got = signed.select("doc_id", "n", "fp").join(of_class, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return got.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _labelled(buckets: DataFrame, comp: DataFrame) -> DataFrame:
    return buckets.select("key", "rep", "n", "size").join(comp.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))


def _of_one_id(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of each doc_id that several texts have."""
    several = stored(named.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("doc_id"), "repeated-ids")
    each = stored(named.join(several, "doc_id", "left_semi").select("doc_id", "fp").distinct().join(classes.select("fp", "rep"), "fp").select("doc_id", "rep"), "repeated-classes")
    first = each.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return stored(each.join(first, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b")).distinct(), "links")


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Every pair with a common shingle, and components by repeated least labels.
ORACLE = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, x) AS (SELECT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON r.x = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m, d.doc_id) AS component_id, coalesce(m, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT id AS doc_id, min(x) AS m FROM r GROUP BY id) USING (doc_id)
"""

QUERIES = {"op10_minhash_dedup": op10_minhash_dedup}
ORACLES = {"op10_minhash_dedup": ORACLE}
