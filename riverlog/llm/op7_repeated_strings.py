"""Exact removal of long repeated strings.

Every window of LENGTH bytes has one anchor: the place of the least hash of K bytes within it (the last, if equal). Equal
windows have equal anchors at equal places, so windows are compared only within a group of one anchor hash. Windows that
follow each other with one anchor form a unit, a stretch of at most 2 * LENGTH bytes. Of the units of a group,

  * those alone hold no repeat; that drops most of the corpus after one shuffle of a few numbers a unit;
  * units with equal bytes repeat as a whole, however many they are, and none of their bytes is moved;
  * of different ones, one of each kind is fetched and their windows are compared by hash. Groups of few kinds are compared
    in one task. In larger ones the windows that start within STEP bytes of each other share a core, counted first by a
    shuffle on core hashes; only windows whose core stands in another kind too are counted, in the same way.

Whether bytes are equal is judged by two hashes only. Units are told apart by BLAKE2b. Windows have a polynomial modulo the prime
2 ** 61 - 1 at a base drawn anew for each run, so no text can be made that its hashes fail on: two different windows agree with chance
LENGTH / 2 ** 61 at most. The cheaper hashes modulo 2 ** 64 place anchors and rule out cores; where they agree, nothing follows yet.

Runs of words can be removed too, by the same steps: each word becomes a code of WIDTH bytes, so that a run of n words, whatever spaces
stand between them, is a window of n * WIDTH bytes. Two different words have one code with chance 2 ** -48, under a key drawn for each run.

The method named for this operator merges the Burrows-Wheeler transforms of shards by refining their interleave, one pass
over all symbols for each byte of common prefix. bwt.py has that merge; the README says why it isn't used here.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import WORD_BYTES, map_arrow, passing, prepare, stored, table

LENGTH, K = 400, 16
#: Bytes of a text looked at at once; blocks overlap by LENGTH - 1.
BLOCK = 1 << 18
#: Kinds of units compared in one task: at most about 3 MB of text.
GROUP_KINDS = 4096
#: Windows of large groups whose starts lie in one stretch of STEP bytes are ruled out together.
STEP = 32
#: Bytes of a word's code; codes of words of up to 64 bytes that a task keeps.
WIDTH, CODES = 6, 1 << 17
_WORD, _SPACE = re.compile(rb"[^\x20\x09-\x0D]+"), re.compile(rb"[\x20\x09-\x0D]")
_rng = np.random.default_rng(20240301)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}
PRIME = (1 << 61) - 1
#: Bytes whose window hashes are computed at once.
HASHED = 1 << 20
_PRIME_POWERS: dict[int, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if not _POWERS:
        inverse = pow(int(_BASE), -1, 1 << 64)
        with np.errstate(over="ignore"):
            for name, b in (("up", int(_BASE)), ("down", inverse)):
                x = np.full(BLOCK + 2 * LENGTH + 1, np.uint64(b))
                x[0] = 1
                _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


class Hashes:
    """of(a, b): a hash of data[a:b], for arrays of places."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers()
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((self.sums[b] - self.sums[a]) * self.down[a])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` in a row, in log2(width) steps."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if width > have else out


def units(text: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(first window, last window, anchor, anchor hash, unit hash) arrays for each block of a text."""
    step = BLOCK - (length - 1)
    for at in range(0, max(1, len(text) - length + 1), step):
        data = np.frombuffer(text, np.uint8, min(BLOCK, len(text) - at), at)
        if len(data) < length:
            return
        hashes = Hashes(data)
        places = np.arange(len(data) - K + 1)
        gram = hashes.of(places, places + K)
        # The hash's high bits, then the later place first.
        order = (gram & ~np.uint64(0xFFFFFF)) | (np.uint64(0xFFFFFF) - places.astype(np.uint64))
        anchor = (np.uint64(0xFFFFFF) - (_least(order, length - K + 1) & np.uint64(0xFFFFFF))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(anchor) - 1]])
        q = anchor[first]
        raw = data.tobytes()
        whole = np.array([_digest(raw[i : j + length], k - i) for i, j, k in zip(first.tolist(), last.tolist(), q.tolist())], np.int64)
        yield first + at, last + at, q + at, gram[q].view(np.int64), whole


def _digest(unit: bytes, anchor: int) -> int:
    """Of a unit's bytes and its anchor's place in it."""
    return int.from_bytes(hashlib.blake2b(unit, digest_size=8, salt=anchor.to_bytes(4, "little")).digest(), "little", signed=True)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of numbers below it, exactly, by halves of 31 and 30 bits."""
    low, half, u = np.uint64((1 << 31) - 1), np.uint64(30), np.uint64(31)
    ah, al, bh, bl = a >> u, a & low, b >> u, b & low
    middle = ah * bl + al * bh
    return _reduced((ah * bh << np.uint64(1)) + (middle >> half) + ((middle & np.uint64((1 << 30) - 1)) << u) + al * bl)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


def _prime_powers(base: int) -> np.ndarray:
    """base ** 0 to base ** HASHED modulo PRIME; the last base's stay with the worker."""
    if base not in _PRIME_POWERS:
        x = np.ones(1, np.uint64)
        while len(x) <= HASHED:
            x = np.concatenate([x, _times(x, np.full(len(x), pow(base, len(x), PRIME), np.uint64))])
        _PRIME_POWERS.clear()
        _PRIME_POWERS[base] = x
    return _PRIME_POWERS[base]


def new_base() -> int:
    return 1 << 32 | secrets.randbelow(PRIME >> 1)


def window_hashes(parts: list[bytes], anchors: list[int], base: int, length: int = LENGTH) -> list[np.ndarray]:
    """For each unit's bytes: a hash of each window and its distance to the anchor."""
    powers, out, at = _prime_powers(base), [], 0
    while at < len(parts):
        stop, size = at + 1, len(parts[at])
        while stop < len(parts) and size + len(parts[stop]) <= HASHED:
            size += len(parts[stop])
            stop += 1
        data = np.frombuffer(b"".join(parts[at:stop]), np.uint8)
        terms = _times(data.astype(np.uint64) + np.uint64(1), powers[:size])
        # Sums of the terms' halves stay below 2 ** 64; put together modulo PRIME, they are the polynomial up to each place.
        high, low = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (terms >> np.uint64(32), terms & np.uint64((1 << 32) - 1)))
        sums = _reduced(_reduced((high >> np.uint64(29)) + ((high & np.uint64((1 << 29) - 1)) << np.uint64(32))) + _reduced(low))
        sizes = np.array([len(p) for p in parts[at:stop]])
        counts, begins = sizes - length + 1, np.cumsum(sizes) - sizes
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts, away = np.repeat(begins, counts) + inside, np.repeat(np.array(anchors[at:stop]), counts) - inside
        between = _reduced(sums[starts + length] + np.uint64(PRIME) - sums[starts])
        with np.errstate(over="ignore"):
            hashed = _mix(_times(between, powers[HASHED - starts]) + away.astype(np.uint64)).view(np.int64)
        out += np.split(hashed, np.cumsum(counts)[:-1])
        at = stop
    return out


def core_hashes(part: bytes, anchor: int, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Of a unit's bytes: for each window start its place in the list of cores, and a hash of each core and its distance.

    Distances to the anchor in ((i - 1) * step, i * step] have one core: the bytes that all those windows hold. Windows that
    are equal at equal distances have equal cores.
    """
    data = np.frombuffer(part, np.uint8)
    step = max(1, min(STEP, length // 4))
    away = np.arange(anchor, anchor - (len(data) - length + 1), -1)
    stretch = -(-away // step)
    which, place = np.unique(stretch, return_inverse=True)
    # The last window of a stretch, whether the unit holds it or not, starts the core; the first one ends it.
    low, high = anchor - (which - 1) * step - 1, anchor - which * step + length
    with np.errstate(over="ignore"):
        return place, _mix(Hashes(data).of(low, high) + which.astype(np.uint64)).view(np.int64)


def _runs(flags: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of runs of set flags; starts rise by 1."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(starts[a]), int(starts[b - 1])) for a, b in zip(edge[::2], edge[1::2])]


def repeated_spans(docs: DataFrame, length: int = LENGTH, group_kinds: int = GROUP_KINDS) -> DataFrame:
    """doc_id, h, spans: for each text of docs(doc_id, h, raw) with repeats, the (first, last) starts of repeated windows.

    h is a hash of the text: rows equal in doc_id and text share one row here, yet count as two occurrences.
    """
    base = new_base()
    ddl = "doc_id long, h long, a long, b long, q long, key long, whole long"
    names = ["doc_id", "h", "a", "b", "q", "key", "whole"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list[np.ndarray]] = [[] for _ in names]
            for doc_id, h, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for found in units(raw, length):
                    n = len(found[0])
                    for c, x in zip(cols, (np.full(n, -1 if doc_id is None else doc_id), np.full(n, h), *found)):
                        c.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names)

    found = stored(map_arrow(docs.select("doc_id", "h", "raw"), find, ddl), "units")
    # Counts first, so that equal units are one row before they move.
    kinds = found.groupBy("key", "whole").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "a", "b", "q")).alias("one"))
    kinds = stored(kinds, "unit-kinds")
    groups = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("n").alias("all")).where(F.col("all") > 1)
    kinds = stored(kinds.join(groups, "key"), "shared-kinds")
    whole = found.join(kinds.where("n > 1").select("key", "whole"), ["key", "whole"], "left_semi").select("doc_id", "h", "a", "b")
    # One unit of each kind of a mixed group, by text.
    ask = kinds.where("kinds > 1").select(F.col("one.doc_id").alias("doc_id"), F.col("one.h").alias("h"), F.struct(F.col("one.a").alias("a"), F.col("one.b").alias("b"), F.col("one.q").alias("q"), "key", "n", (F.col("kinds") > group_kinds).alias("large")).alias("u"))
    wanted = ask.groupBy("doc_id", "h").agg(F.collect_list("u").alias("us"))
    texts = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))
    cut = ["doc_id", "h", "a", "q", "key", "n", "large", "part"]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("a", pa.int64()), ("q", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("large", pa.bool_()), ("part", pa.binary())])
        for batch in batches:
            for doc_id, h, raw, us in zip(*(batch.column(i).to_pylist() for i in range(4))):
                rows = [(doc_id, h, u["a"], u["q"], u["key"], u["n"], u["large"], raw[u["a"] : u["b"] + length]) for u in us]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind.types)], cut)

    parts = stored(map_arrow(texts.join(wanted, ["doc_id", "h"]).select("doc_id", "h", "raw", "us"), fetch, "doc_id long, h long, a long, q long, key long, n long, large boolean, part binary").dropDuplicates(["doc_id", "h", "a", "key"]), "unit-texts")
    span = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def compare(held: list[tuple]) -> pa.RecordBatch:
        """Windows that at least two kinds hold, of whole groups (doc_id, h, a, q, key, n, part)."""
        each = window_hashes([x[6] for x in held], [x[3] - x[2] for x in held], base, length)
        values, counts = np.unique(np.concatenate(each), return_counts=True)
        many = values[counts > 1]
        rows = []
        for (doc_id, h, a, _, _, n, _), x in zip(held, each):
            if n == 1 and len(many):
                flags = many[np.minimum(np.searchsorted(many, x), len(many) - 1)] == x
                rows += [(doc_id, h, *r) for r in _runs(flags, np.arange(a, a + len(x)))]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), span)] if rows else [pa.array([], f.type) for f in span], schema=span)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups come in order of their key; many small ones are compared at once (equal windows have one key)."""
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "a", "q", "key", "n", "part"))):
                if len(held) >= 1024 and held[-1][4] != row[4]:
                    yield compare(held)
                    held = []
                held.append(row)
        if held:
            yield compare(held)

    ordered = parts.where("NOT large").repartition("key").sortWithinPartitions("key")
    few = map_arrow(ordered, stream, "doc_id long, h long, a long, b long")

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "a", "q", "key", "part"))))
            if held:
                each = [core_hashes(x[5], x[3] - x[2], length)[1] for x in held]
                sizes = [len(x) for x in each]
                whose = [pa.array(np.repeat([x[i] for x in held], sizes), pa.int64()) for i in (0, 1, 2, 4)]
                yield pa.RecordBatch.from_arrays([*whose, pa.array(np.concatenate([np.arange(k) for k in sizes]), pa.int64()), pa.array(np.concatenate(each))], ["doc_id", "h", "a", "key", "i", "core"])

    large = parts.where("large")
    cored = stored(map_arrow(large, cores, "doc_id long, h long, a long, key long, i long, core long"), "cores")
    met = cored.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core")
    open_cores = cored.join(met, "core", "left_semi").groupBy("doc_id", "h", "a", "key").agg(F.collect_list("i").alias("open"))
    large = large.join(open_cores, ["doc_id", "h", "a", "key"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of large groups with open cores, combined within a batch: those that meet there are runs (x null) at once, and each
        such window then stands in one row for all; the others go one by one to be counted."""
        for batch in batches:
            held = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "a", "q", "n", "part", "open"))))
            if not held:
                continue
            each = window_hashes([x[5] for x in held], [x[3] - x[2] for x in held], base, length)
            kept = [np.isin(core_hashes(x[5], x[3] - x[2], length)[0], x[6]) for x in held]
            values, counts = np.unique(np.concatenate([x[k] for x, k in zip(each, kept)]), return_counts=True)
            many, rows = values[counts > 1], []
            for (doc_id, h, a, _, n, _, _), x, asked in zip(held, each, kept):
                met = many[np.minimum(np.searchsorted(many, x), len(many) - 1)] == x if len(many) else np.zeros(len(x), bool)
                if n == 1:
                    rows += [(doc_id, h, i, j, 1, None) for i, j in _runs(met, np.arange(a, a + len(x)))]
                rows += [(doc_id, h, a + k, a + k, n, int(x[k])) for k in np.flatnonzero(~met & asked).tolist()]
            rows += [(None, None, None, None, 2, x) for x in many.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "h", "a", "b", "n", "x"])

    spelled = stored(map_arrow(large, spell, "doc_id long, h long, a long, b long, n long, x long"), "windows")
    counted = spelled.where("x IS NOT NULL").groupBy("x").agg(F.sum("n").alias("times")).where("times > 1")
    alone = spelled.where("n = 1 AND x IS NOT NULL").join(counted, "x", "left_semi").select("doc_id", "h", "a", "b")
    many = spelled.where("x IS NULL").select("doc_id", "h", "a", "b").union(alone)
    return whole.union(few).union(many).groupBy("doc_id", "h").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


class Codes(dict):
    """Codes of words, made when they are asked for."""

    def __init__(self, key: bytes):
        self.key = key

    def __missing__(self, word: bytes) -> bytes:
        code = hashlib.blake2b(word, digest_size=WIDTH, key=self.key).digest()
        if len(word) <= 64:
            if len(self) >= CODES:
                self.clear()
            self[word] = code
        return code


def word_codes(raw: bytes, codes: Codes) -> bytes:
    """The codes of a text's words in a row; words end at ASCII spaces."""
    out, at = [], 0
    while at < len(raw):
        space = _SPACE.search(raw, at + WORD_BYTES)
        end = space.start() if space else len(raw)
        out.append(b"".join(map(codes.__getitem__, raw[at:end].split())))
        at = end
    return b"".join(out)


def repeated_words(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, h, spans: as repeated_spans, for runs of that many words; (first, last) are the numbers of words that repeated runs cover."""
    key = secrets.token_bytes(16)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(key)
        for b in batches:
            raw = pa.array([word_codes(x, codes) for x in b.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), raw], ["doc_id", "h", "raw"])

    found = repeated_spans(map_arrow(docs.select("doc_id", "h", "raw"), code, "doc_id long, h long, raw binary"), words * WIDTH)
    # Windows that start within a code say nothing.
    span = f"named_struct('a', cast(ceil(s.a / {WIDTH}) AS long), 'b', cast(floor(s.b / {WIDTH}) AS long))"
    whole = F.expr(f"filter(transform(spans, s -> {span}), s -> s.a <= s.b)")
    return found.select("doc_id", "h", F.transform(whole, lambda s: F.struct(s["a"].alias("a"), (s["b"] + (words - 1)).alias("b"))).alias("spans")).where("size(spans) > 0")


def word_places(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Bytes (start, end) from the first to the last word of spans of word numbers, joined where they overlap or follow each other."""
    runs: list[list[int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    out, k, start = [], 0, 0
    for i, m in enumerate(_WORD.finditer(text) if runs else ()):
        if i == runs[k][0]:
            start = m.start()
        if i == runs[k][1]:
            out.append((start, m.end()))
            k += 1
            if k == len(runs):
                break
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: list[str] | None = None, as_text: bool = False, words: int | None = None) -> DataFrame:
    """docs' columns in `keep` (doc_id by default), then n_bytes, n_removed, n_spans, kept (binary) for each row of docs(doc_id, text).

    A null text is empty; texts shorter than `length` bytes lose nothing; no rows give no rows. Each row's text counts, also where
    rows repeat a doc_id or have none: equal texts of two rows are removed as repeats whatever their doc_ids. Other columns are not
    judged; those in `keep` must not have the names of the four results.
    With as_text, kept is a string: bytes of characters that a removed span cut through are left out.
    With words, runs of that many words (ended by ASCII spaces, of any kind and number) that stand anywhere else go as well, also where
    they have fewer than `length` bytes; both are judged on the texts as they came.
    """
    keep = ["doc_id"] if keep is None else keep
    results = ["n_bytes", "n_removed", "n_spans", "kept"]
    if clash := set(keep) & set(results):
        raise ValueError(f"columns to keep have names of results: {sorted(clash)}")
    spark = docs.sparkSession
    prepare(spark)
    raw = F.coalesce("text", F.lit("")).cast("binary")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(raw).alias("h"), raw.alias("raw"))
    # One search after the other, so that only one's tables take up room.
    with passing(spark):
        spans = stored(repeated_spans(base, length), "spans", outlives=True)
    if words is None:
        spans = spans.withColumn("runs", F.lit(None).cast(spans.schema["spans"].dataType))
    else:
        with passing(spark):
            runs = stored(repeated_words(base, words), "word-runs", outlives=True)
        spans = spans.join(runs.withColumnRenamed("spans", "runs"), ["doc_id", "h"], "full")
    inner = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), F.xxhash64(raw).alias("h"), raw.alias("raw"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    full = inner.join(spans, ["doc_id", "h"], "left").select(*[f"k{i}" for i in range(len(keep))], "raw", "spans", "runs")
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in full.schema.fields[:-3])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, count, left = [], [], [], []
            for text, where, runs in zip(*(b.column(b.num_columns - i).to_pylist() for i in (3, 2, 1))):
                out, at, k = [], 0, 0
                places = word_places(text, [(s["a"], s["b"]) for s in runs or ()])
                for s in sorted([*((s["a"], s["b"] + length) for s in where or ()), *places]):
                    if not k or s[0] > at:
                        out.append(text[at : s[0]])
                        k += 1
                    at = max(at, s[1])
                out.append(text[at:])
                kept = b"".join(out)
                n.append(len(text))
                removed.append(len(text) - len(kept))
                count.append(k)
                left.append(kept.decode("utf-8", "ignore") if as_text else kept)
            yield pa.RecordBatch.from_arrays([*b.columns[:-3], *(pa.array(x, pa.int64()) for x in (n, removed, count)), pa.array(left, pa.string() if as_text else pa.binary())], [*b.schema.names[:-3], "n_bytes", "n_removed", "n_spans", "kept"])

    return map_arrow(full, cut, f"{schema}n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}").toDF(*keep, *results)


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = remove_repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), (F.col("n_removed") > 0).alias("repeats"))


#: Every window of every text, by its MD5.
ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS MATERIALIZED (SELECT r, p, md5_number(b[p:p + 399]) AS h FROM (SELECT r, b, unnest(range(1, n - 398)) AS p FROM d WHERE n >= 400)),
s AS (SELECT r, p FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
m AS (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 400 THEN 0 ELSE 1 END AS fresh FROM s),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS k FROM m),
gone AS MATERIALIZED (SELECT r, min(p) AS a, max(p) + 400 AS e FROM g GROUP BY r, k),
cuts AS (SELECT r, a, e FROM gone UNION ALL SELECT r, n + 1, n + 1 FROM d),
parts AS (SELECT r, a, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a, e), 1) AS since FROM cuts),
kept AS (SELECT r, string_agg(hex(b[since:a - 1]), '' ORDER BY a) AS x FROM parts JOIN d USING (r) GROUP BY r),
sums AS (SELECT r, sum(e - a) AS removed, count(*) AS spans FROM gone GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(x)) AS kept_sha256, coalesce(removed, 0) > 0 AS repeats
FROM d JOIN kept USING (r) LEFT JOIN sums USING (r)
"""

QUERIES = {"op7_repeated_strings": op7_repeated_strings}
ORACLES = {"op7_repeated_strings": ORACLE}


def plain(texts: list[bytes], length: int = LENGTH) -> list[bytes]:
    """What is left of each text, by looking at every window: for small inputs and tests."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            w = hashlib.blake2b(t[i : i + length], digest_size=16).digest()
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[hashlib.blake2b(t[i : i + length], digest_size=16).digest()] > 1:
                gone[i : i + length] = True
        out.append(np.frombuffer(t, np.uint8)[~gone].tobytes())
    return out
