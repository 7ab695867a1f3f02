"""Packing by a grouping genetic algorithm on islands.

Pieces are dealt to regions of bounded size. A region is evolved by several islands from different seeds: an individual is an
assignment of pieces to sequences; crossover injects whole well-filled sequences of one parent into the other, drops the
sequences that hold the same pieces, and best-fits the displaced ones. After each epoch every island sends its best to the
next island of its region. An island stops once it uses ceil(tokens / capacity) sequences, the fewest possible.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm import tokens
from riverlog.llm.common import map_arrow, prepare, stored, table

CAPACITY, END_ID = 4096, 1
REGION_PIECES, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 8192, 3, 2, 4, 6
#: A sequence that full is injected whole.
WELL_FILLED = 0.99


def best_fit(lengths: np.ndarray, items: np.ndarray, assign: np.ndarray, free: list[int], capacity: int) -> None:
    """Puts items (in the given order) where the least room is left; `free` holds each sequence's room, assign the results."""
    stacks: dict[int, list[int]] = {}
    mask = 0
    for b, room in enumerate(free):
        if room:
            stacks.setdefault(room, []).append(b)
            mask |= 1 << room
    for i in items.tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            room = (fits & -fits).bit_length() - 1 + n
            stack = stacks[room]
            b = stack.pop()
            if not stack:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        assign[i] = b
        free[b] = left = room - n
        if left:
            if not mask >> left & 1:
                stacks[left] = []
                mask |= 1 << left
            stacks[left].append(b)


def fitness(lengths: np.ndarray, assign: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then squares of how full they are, as uneven as can be."""
    fill = np.bincount(assign, lengths)
    fill = fill[fill > 0] / capacity
    return len(fill), -float((fill**2).sum())


def _renumbered(assign: np.ndarray) -> np.ndarray:
    return np.unique(assign, return_inverse=True)[1].astype(np.int32)


def crossover(lengths: np.ndarray, into: np.ndarray, source: np.ndarray, rng: np.random.Generator, capacity: int) -> np.ndarray:
    fill = np.bincount(source, lengths)
    good = np.flatnonzero(fill >= WELL_FILLED * capacity)
    if not len(good):
        good = np.argsort(-fill)[: max(1, len(fill) // 4)]
    chosen = rng.choice(good, max(1, len(good) // 3), replace=False)
    injected = np.isin(source, chosen)
    hit = np.isin(into, np.unique(into[injected]))
    kept = ~hit
    child = np.full(len(lengths), -1, np.int64)
    child[kept] = np.unique(into[kept], return_inverse=True)[1]
    n = int(child.max(initial=-1)) + 1
    child[injected] = np.unique(source[injected], return_inverse=True)[1] + n
    return _filled(lengths, child, rng, capacity)


def mutate(lengths: np.ndarray, assign: np.ndarray, rng: np.random.Generator, capacity: int) -> np.ndarray:
    """Empties the least filled sequences and a few at random."""
    fill = np.bincount(assign, lengths)
    gone = np.union1d(np.argsort(fill)[: max(1, len(fill) // 50)], rng.integers(0, len(fill), max(1, len(fill) // 50)))
    child = assign.astype(np.int64)
    child[np.isin(assign, gone)] = -1
    child[child >= 0] = np.unique(child[child >= 0], return_inverse=True)[1]
    return _filled(lengths, child, rng, capacity)


def _filled(lengths: np.ndarray, child: np.ndarray, rng: np.random.Generator, capacity: int) -> np.ndarray:
    out = np.flatnonzero(child < 0)
    placed = child >= 0
    free = (capacity - np.bincount(child[placed], lengths[placed])).astype(int).tolist() if placed.any() else []
    order = out[np.argsort(-lengths[out] + rng.random(len(out)), kind="stable")]
    best_fit(lengths, order, child, free, capacity)
    return _renumbered(child)


def evolve(lengths: np.ndarray, population: list[np.ndarray], seed: int, capacity: int = CAPACITY, size: int = POPULATION, generations: int = GENERATIONS) -> list[np.ndarray]:
    """A population, best first; from nothing it starts with best-fit by falling length and disturbed orders."""
    rng = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // capacity)
    if not population:
        population = [_filled(lengths, np.full(len(lengths), -1, np.int64), rng, capacity)]
    ranked = sorted(((fitness(lengths, p, capacity), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])
    if ranked[0][0][0] <= least:
        return [ranked[0][2]]
    pool = [p for _, _, p in ranked]
    while len(pool) < size:
        pool.append(mutate(lengths, pool[0], rng, capacity))
    for _ in range(generations):
        for _ in range(size):
            x, y = rng.integers(0, len(pool), 2)
            child = crossover(lengths, pool[x], pool[y], rng, capacity) if x != y else mutate(lengths, pool[x], rng, capacity)
            pool.append(child)
        pool = [p for _, _, p in sorted(((fitness(lengths, p, capacity), k, p) for k, p in enumerate(pool)), key=lambda x: x[:2])[:size]]
        if fitness(lengths, pool[0], capacity)[0] <= least:
            return pool[:1]
    return pool


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each row of docs(doc_id, text), whole texts."""
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        for b in batches:
            rows = []
            for doc_id, raw in zip(b.column(0).to_pylist(), encoder.encode_all(b.column(1).to_pylist())):
                raw += end
                for k, i in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[i : i + 4 * capacity]
                    rows.append((doc_id, k, i // 4, len(part) // 4, zlib.crc32(part)))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut, "doc_id long, piece int, start long, length long, ids_crc32 long", tokens.OWNER)


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, region_pieces: int = REGION_PIECES, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of docs(doc_id, text).

    A null text is empty and has one piece, the end id. Repeated rows are each packed; a null doc_id stays null. Other columns are not
    read. No rows: no pieces. Regions are as many as the pieces need, so a region and its islands stay within one task's memory.
    """
    spark = docs.sparkSession
    prepare(spark)
    pieces = stored(pieces_of(docs, vocabulary, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    loose = pieces.where(F.col("length") < capacity)
    regions = max(1, -(-loose.count() // region_pieces))
    region = F.pmod(F.xxhash64("row"), F.lit(regions))
    loose = loose.withColumn("region", region)
    state = pa.schema([("region", pa.int64()), ("island", pa.int32()), ("lengths", pa.binary()), ("best", pa.bool_()), ("individual", pa.binary())])
    ddl = "region long, island int, lengths binary, best boolean, individual binary"

    def island_start(t: pa.Table) -> pa.Table:
        t = t.sort_by("row")
        raw = t.column("length").to_numpy().astype("<i4").tobytes()
        return pa.Table.from_pylist([{"region": t.column("region")[0].as_py(), "island": i, "lengths": raw, "best": True, "individual": None} for i in range(islands)], schema=state)

    def epoch(t: pa.Table) -> pa.Table:
        """One island's population, and its best for the next island."""
        home, island = t.column("region")[0].as_py(), t.column("island")[0].as_py()
        raw = t.column("lengths")[0].as_py()
        lengths = np.frombuffer(raw, "<i4").astype(np.int64)
        pool = [np.frombuffer(x, "<i4") for x in sorted(y for y in t.column("individual").to_pylist() if y is not None)]
        pool = evolve(lengths, pool, (home * islands + island) * 7919 + len(pool), capacity)
        rows = [{"region": home, "island": island, "lengths": raw, "best": k == 0, "individual": p.astype("<i4").tobytes()} for k, p in enumerate(pool)]
        if islands > 1:
            rows.append(rows[0] | {"island": (island + 1) % islands, "best": False})
        return pa.Table.from_pylist(rows, schema=state)

    now = loose.select("region", "row", "length").groupBy("region").applyInArrow(island_start, ddl)
    for _ in range(epochs):
        now = stored(now.groupBy("region", "island").applyInArrow(epoch, ddl), "islands")

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(items: pa.Table, best: pa.Table) -> pa.Table:
        items = items.sort_by("row")
        lengths = items.column("length").to_numpy()
        found = min((np.frombuffer(x, "<i4") for x in sorted(best.column("individual").to_pylist())), key=lambda p: fitness(lengths, p, capacity))
        order = np.argsort(found, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.concatenate([[True], found[order][1:] != found[order][:-1]])
        begins = ends - lengths[order]
        offset = np.empty(len(order), np.int64)
        offset[order] = begins - np.repeat(begins[first], np.diff([*np.flatnonzero(first), len(order)]))
        home = items.column("region")[0].as_py()
        out = items.select(names[:5])
        return out.append_column("sequence_id", pa.array(found.astype(np.int64) + home * (1 << 32))).append_column("offset", pa.array(offset))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    placed = loose.groupBy("region").cogroup(now.where("best").groupBy("region")).applyInArrow(place, schema)
    whole = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    return whole.select(*names).unionByName(placed)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokens.default_vocabulary())


QUERIES = {"op3_best_fit_packing": op3_best_fit_packing}
ORACLES: dict[str, str] = {}
