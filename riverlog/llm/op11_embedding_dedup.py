"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector by the signs of random projections, orders the vectors of a group by the concatenated bits, and compares
each with the WINDOW before it in that order. What the passes find is united to components.

Two things stand around the passes, so that bounded windows lose nothing in crowded places. Before them, vectors close to one another
become balls: all within a radius of half the threshold's angle around their leader, so that any two are linked without a comparison.
Balls also come from sorted passes, and a group of copies of any size, dealt over all ranges it spans, is a few balls. After them, the
balls of a component are compared completely, in tiles of bounded size: two balls are linked whole, or not at all, or, where their radii
leave it open, member by member. Only sums of links and the links that hold components together leave a tile. So within a component
found by the passes every link counts, and what can be missed are links between components that no pass brought together: for a pair
right at the threshold with chance MISS, for closer ones less.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import map_arrow, partitions, stored, table
from riverlog.llm.graph import components

THRESHOLD = 0.93
#: Rows before a row that it is compared with in a pass, and the chance that all passes miss a pair at the threshold.
WINDOW, MISS = 32, 1e-3
#: Bits of a hash, passes in one job, passes for balls at most, rows of a side of a tile.
BITS, AT_ONCE, BALL_PASSES, TILE = 62, 4, 3, 512
#: Radians by which angles may be off.
SLACK = 1e-7
SEED = 11
BALLS = "id long, grp string, v binary, r double, n long, least long"


def passes_for(rows: int, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold has stood within a window with chance 1 - miss: it must agree in so many bits that
    no more than a window of all rows share them."""
    bits = max(0.0, math.log2(max(1, rows) / window))
    met = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if met >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-met)))


def hashes(x: np.ndarray, number: int) -> np.ndarray:
    """BITS signs of projections of the rows of x, as integers that sort like their bits; number tells the passes' projections apart."""
    planes = np.random.default_rng([SEED, x.shape[1], number]).standard_normal((x.shape[1], BITS))
    return (x @ planes > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _units(rows: DataFrame) -> DataFrame:
    """rows(id, grp, vec_id, vector) as balls of one, by length of their vectors; rows without a direction drop out."""
    kinds = pa.schema([("id", pa.int64()), ("grp", pa.string()), ("v", pa.binary()), ("r", pa.float64()), ("n", pa.int64()), ("least", pa.int64())])

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = pc.fill_null(pc.list_value_length(b.column(3)), 0).to_numpy(zero_copy_only=False)
            flat = b.column(3).flatten().to_numpy(zero_copy_only=False).astype(float)  # nulls become NaN
            at = np.concatenate([[0], np.cumsum(lengths)])[:-1]
            for d in np.unique(lengths[lengths > 0]):
                rows = np.flatnonzero(lengths == d)
                x = flat[at[rows][:, None] + np.arange(d)]
                with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
                    x = x / np.abs(x).max(1, keepdims=True)
                    x = x / np.sqrt((x * x).sum(1, keepdims=True))
                fine = np.isfinite(x).all(1)
                rows, x = rows[fine], x[fine]
                grp = pa.array([f"{d}:{g}" for g in b.column(1).take(pa.array(rows)).to_pylist()], pa.string())
                each = [b.column(0).take(pa.array(rows)), grp, pa.array([y.tobytes() for y in x], pa.binary()), pa.array(np.zeros(len(x))), pa.array(np.ones(len(x), np.int64)), b.column(2).take(pa.array(rows))]
                yield pa.RecordBatch.from_arrays(each, schema=kinds)

    return map_arrow(rows.select("id", "grp", "vec_id", "vector"), scale, BALLS)


def _sorted(balls: DataFrame, numbers: list[int], ranges: int) -> DataFrame:
    """The balls once for each pass, in the pass's order by ranges; the id last, so that equal vectors are no range of their own."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(2).to_pylist()
            sizes = np.array([len(x) for x in raw])
            for number in numbers:
                keys = np.zeros(len(raw), np.int64)
                for size in np.unique(sizes):
                    rows = np.flatnonzero(sizes == size)
                    keys[rows] = hashes(np.frombuffer(b"".join(raw[i] for i in rows)).reshape(len(rows), -1), number)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(raw), number, np.int32)), pa.array(keys)], [*b.schema.names, "pass", "key"])

    order = ["pass", "grp", "key", "id"]
    return map_arrow(balls.select("id", "grp", "v", "r", "n", "least"), key, f"{BALLS}, pass int, key long").repartitionByRange(ranges, *order).sortWithinPartitions(*order)


def _ranges(spark: SparkSession, rows: int, window: int) -> int:
    """As many as the session's partitions, but of many windows each."""
    return max(1, min(partitions(spark), rows // (64 * window)))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(whether a pass or group begins, ids, vectors, radii, sizes, least vec_ids) of the rows of one pass and group in a batch."""
    last = None
    for b in batches:
        names = list(zip(b.column(6).to_pylist(), b.column(1).to_pylist()))
        raw, at = b.column(2).to_pylist(), 0
        ids, r, n, least = (b.column(i).to_numpy() for i in (0, 3, 4, 5))
        for name, same in groupby(names):
            to = at + sum(1 for _ in same)
            part = slice(at, to)
            yield name != last, ids[part], np.frombuffer(b"".join(raw[part])).reshape(to - at, -1), r[part], n[part], least[part]
            last, at = name, to


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


class _Leaders:
    """The last WINDOW leaders of a group in a pass, and the balls around them."""

    def __init__(self, limit: float):
        self.limit, self.rows = limit, []  # [id, vector, radius, size, least]

    def take(self, ids: np.ndarray, x: np.ndarray, r: np.ndarray, n: np.ndarray, least: np.ndarray) -> list[tuple[int, int]]:
        """Deals balls to leaders that hold them whole, makes leaders of the others; (id, leader) of those dealt."""
        moved, todo = [], np.arange(len(ids))
        if self.rows:
            todo = self._deal(np.stack([y[1] for y in self.rows]), self.rows, todo, ids, x, r, n, least, moved)
        while len(todo):
            i = todo[0]
            self.rows.append([int(ids[i]), x[i], float(r[i]), int(n[i]), int(least[i])])
            todo = self._deal(x[i : i + 1], self.rows[-1:], todo[1:], ids, x, r, n, least, moved)
        return moved

    def _deal(self, y, leaders, todo, ids, x, r, n, least, moved) -> np.ndarray:
        reach = _angles(x[todo], y) + SLACK + r[todo, None]
        best = reach.argmin(1)
        fits = reach[np.arange(len(todo)), best] <= self.limit
        for k in np.flatnonzero(fits):
            i, leader = todo[k], leaders[best[k]]
            leader[2:] = max(leader[2], float(reach[k, best[k]])), leader[3] + int(n[i]), min(leader[4], int(least[i]))
            moved.append((int(ids[i]), leader[0]))
        return todo[~fits]


def _gathered(balls: DataFrame, number: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(balls after a pass that puts balls into others, (id, leader) of those put)."""
    limit = (math.acos(threshold) - SLACK) / 2
    kinds = pa.schema([("id", pa.int64()), ("leader", pa.int64()), ("v", pa.binary()), ("r", pa.float64()), ("n", pa.int64()), ("least", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(moved: list, done: list) -> pa.RecordBatch:
            all_ = [(i, to, None, None, None, None) for i, to in moved] + [(y[0], y[0], y[1].tobytes(), y[2], y[3], y[4]) for y in done]
            return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*all_), kinds)], schema=kinds)

        leaders = _Leaders(limit)
        for fresh, ids, x, r, n, least in _runs(batches):
            if fresh and leaders.rows:
                yield rows([], leaders.rows)
                leaders = _Leaders(limit)
            for i in range(0, len(ids), 256):
                p = slice(i, i + 256)
                moved = leaders.take(ids[p], x[p], r[p], n[p], least[p])
                done, leaders.rows = leaders.rows[:-WINDOW], leaders.rows[-WINDOW:]
                if moved or done:
                    yield rows(moved, done)
        if leaders.rows:
            yield rows([], leaders.rows)

    got = stored(map_arrow(_sorted(balls, [number], partitions(balls.sparkSession)), scan, "id long, leader long, v binary, r double, n long, least long"), "gathered")
    grp = balls.select("id", "grp")
    return stored(got.where("id = leader").drop("leader").join(grp, "id").select("id", "grp", "v", "r", "n", "least"), "balls"), got.where("id <> leader").select("id", "leader")


class _Sets:
    """Union-find, for the rows of one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


class _Ends:
    """The first and last rows of a task's range, `window` of each, kept while its batches pass."""

    def __init__(self, window: int):
        self.window, self.head, self.tail = window, None, None

    def watch(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            last = b.slice(max(0, b.num_rows - self.window))
            if self.head is None:
                self.head, self.tail = b.slice(0, self.window), last
            else:
                self.head = pa.concat_batches([self.head, b.slice(0, self.window - self.head.num_rows)])
                self.tail = pa.concat_batches([self.tail, last])
                self.tail = self.tail.slice(max(0, self.tail.num_rows - self.window))
            yield b


def near_balls(balls: DataFrame, numbers: list[int], rows: int, threshold: float = THRESHOLD, window: int = WINDOW) -> DataFrame:
    """Pairs (a, b) of balls that stand within a window in one of the passes and may hold linked vectors. Of the pairs of a task those
    that hold its components together. Rows on both sides of the edge of two tasks' ranges meet in a seam. rows: how many balls."""
    spark, angle = balls.sparkSession, math.acos(threshold)
    ball = [("id", pa.int64()), ("grp", pa.string()), ("v", pa.binary()), ("r", pa.float64()), ("pass", pa.int32())]
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("seam", pa.int32()), ("side", pa.int32()), ("place", pa.int32()), *ball])

    def wide(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[k.name].cast(k.type) if k.name in columns else pa.nulls(n, k.type) for k in kinds], schema=kinds)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held, ends = _Sets(), None, _Ends(window)
        for fresh, ids, x, r, _, _ in _runs(ends.watch(batches)):
            if fresh or held is None:
                held = (ids[:0], x[:0], r[:0])
            edges = []
            for i in range(0, len(ids), 256):
                p = slice(i, i + 256)
                new = ids[p], x[p], r[p]
                ids_, x_, r_ = (np.concatenate([h, y]) for h, y in zip(held, new))
                k, m = len(held[0]), len(ids_)
                away = np.arange(k, m)[:, None] - np.arange(m)
                one, other = np.nonzero((away >= 1) & (away <= window) & (_angles(new[1], x_) <= angle + SLACK + new[2][:, None] + r_))
                edges += [(a, b) for a, b in zip(ids_[k + one].tolist(), ids_[other].tolist()) if sets.join(a, b)]
                held = ids_[-window:], x_[-window:], r_[-window:]
            if edges:
                yield wide({c: pa.array(y, pa.int64()) for c, y in zip("ab", zip(*edges))}, len(edges))
        if ends.head is not None:
            range_ = TaskContext.get().partitionId()
            for b, seam, side in ((ends.head, range_, 1), (ends.tail, range_ + 1, 0)):
                n = b.num_rows
                yield wide({"seam": pa.array([seam] * n), "side": pa.array([side] * n), "place": pa.array(range(n)), **{c: b.column(b.schema.get_field_index(c)) for c, _ in ball}}, n)

    def seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        for _, same in groupby(held, lambda x: x[0]):
            sides = [], []
            for row in same:
                sides[row[1]].append(row)
            edges, tail = [], len(sides[0])
            for key in {(x[7], x[4]) for x in sides[0]} & {(x[7], x[4]) for x in sides[1]}:
                one, other = ([x for x in side if (x[7], x[4]) == key] for side in sides)
                (x, r, at), (y, s, to) = ((np.frombuffer(b"".join(z[5] for z in side)).reshape(len(side), -1), np.array([z[6] for z in side]), np.array([z[2] for z in side])) for side in (one, other))
                may = (tail - at[:, None] + to <= window) & (_angles(x, y) <= angle + SLACK + r[:, None] + s)
                edges += [(one[i][3], other[j][3]) for i, j in zip(*np.nonzero(may))]
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["a", "b"])

    schema = "a long, b long, seam int, side int, place int, id long, grp string, v binary, r double, pass int"
    got = stored(map_arrow(_sorted(balls, numbers, _ranges(spark, rows * len(numbers), window)), scan, schema), "near-balls")
    ends = got.where("seam IS NOT NULL").select("seam", "side", "place", "id", "grp", "v", "r", "pass").repartition(partitions(spark), "seam").sortWithinPartitions("seam", "side", "place")
    return got.where("a IS NOT NULL").select("a", "b").unionByName(stored(map_arrow(ends, seams, "a long, b long"), "seams"))


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Of a symmetric matrix of links, so many that its components stay."""
    left, out = np.ones(len(linked), bool), []
    while left.any():
        todo = [int(left.argmax())]
        left[todo] = False
        while todo:
            i = todo.pop()
            new = np.flatnonzero(linked[i] & left)
            left[new] = False
            out += [(i, j) for j in new.tolist()]
            todo += new.tolist()
    return out


def _compared(x: np.ndarray, rx: np.ndarray, y: np.ndarray, ry: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(linked whole, open) for each pair of balls; vectors by themselves are linked by their cosine and never open."""
    cosine, radii, angle = x @ y.T, rx[:, None] + ry, math.acos(threshold)
    apart = np.arccos(np.clip(cosine, -1, 1))
    single = radii == 0
    whole = np.where(single, cosine >= threshold, apart + radii <= angle - SLACK)
    return whole, ~whole & ~single & (apart - radii <= angle + SLACK)


def _tiles(rows: DataFrame, judge: Callable[[tuple, list[tuple], list[tuple]], list[tuple]]) -> DataFrame:
    """kind, a, b: judge(key, rows of side 0, rows of side 1) for each tile of rows(k1, k2, i, j, side, id, v, r, n)."""
    key = ["k1", "k2", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch | None:
            if out := judge(last, [x for x in held if not x[4]], [x for x in held if x[4]]):
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64()))], ["kind", "a", "b"])
            return None

        held, last = [], None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[:4] != last and held:
                    if (got := done()) is not None:
                        yield got
                    held = []
                last = row[:4]
                held.append(row)
        if held and (got := done()) is not None:
            yield got

    dealt = rows.select(*key, "side", "id", "v", "r", "n").repartition(partitions(rows.sparkSession), *key).sortWithinPartitions(*key)
    return stored(map_arrow(dealt, run, "kind int, a long, b long"), "tiles")


def _arrays(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return np.array([x[5] for x in rows]), np.frombuffer(b"".join(x[6] for x in rows)).reshape(len(rows), -1), np.array([x[7] for x in rows]), np.array([x[8] for x in rows])


COUNT, LINK, OPEN = 0, 1, 2


def complete(balls: DataFrame, comp: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """kind, a, b for the balls of each component: COUNT (ball, linked vectors in other balls), LINK (two balls), OPEN (two balls whose
    members must be compared). A component of k balls is k / tile parts, and each two parts are a tile."""
    of = balls.join(comp, "id")
    parts = of.groupBy("comp").agg(F.ceil(F.count("*") / tile).alias("parts"))
    of = of.join(parts, "comp").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    rows = of.withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.select(F.col("comp").alias("k1"), F.lit(0).cast("long").alias("k2"), F.least("part", "x").alias("i"), F.greatest("part", "x").alias("j"), (F.col("part") > F.col("x")).alias("side"), "id", "v", "r", "n")

    def judge(key: tuple, one: list[tuple], other: list[tuple]) -> list[tuple]:
        same = key[2] == key[3]
        if not one or not same and not other:
            return []
        ids, x, r, n = _arrays(one)
        jds, y, s, m = (ids, x, r, n) if same else _arrays(other)
        whole, open_ = _compared(x, r, y, s, threshold)
        if same:
            np.fill_diagonal(whole, False)
            open_ &= np.tri(len(ids), k=-1, dtype=bool)
            links, names = whole, ids
        else:
            names, k = np.concatenate([ids, jds]), len(ids)
            links = np.zeros((len(names),) * 2, bool)
            links[:k, k:], links[k:, :k] = whole, whole.T
        sums = [(ids, whole @ m)] if same else [(ids, whole @ m), (jds, n @ whole)]
        out = [(COUNT, a, c) for who, what in sums for a, c in zip(who.tolist(), what.tolist()) if c]
        out += [(LINK, int(names[a]), int(names[b])) for a, b in forest(links)]
        return out + [(OPEN, int(ids[a]), int(jds[b])) for a, b in zip(*np.nonzero(open_))]

    return _tiles(rows, judge)


def _members(open_: DataFrame, balls: DataFrame, members: DataFrame, threshold: float, tile: int) -> DataFrame:
    """kind, a, b: COUNT (vector, linked vectors) and LINK (two balls) from comparing the members(ball, id, v) of the balls of each open
    pair, in tiles."""
    sizes = balls.select("id", F.ceil(F.col("n") / tile).alias("parts"))
    pairs = open_.join(sizes.toDF("a", "pa"), "a").join(sizes.toDF("b", "pb"), "b").select("a", "b", "pa", "pb")

    def side(ball: str, mine: str, theirs: str, which: int) -> DataFrame:
        own = F.pmod(F.xxhash64("id"), F.col(mine))
        met = pairs.join(members.withColumnRenamed("ball", ball), ball).withColumn("own", own).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col(theirs) - 1)))
        i, j = ("own", "x") if not which else ("x", "own")
        return met.select(F.col("a").alias("k1"), F.col("b").alias("k2"), F.col(i).alias("i"), F.col(j).alias("j"), F.lit(bool(which)).alias("side"), "id", "v", F.lit(0.0).alias("r"), F.lit(1).cast("long").alias("n"))

    def judge(key: tuple, one: list[tuple], other: list[tuple]) -> list[tuple]:
        if not one or not other:
            return []
        (ids, x, r, _), (jds, y, s, _) = _arrays(one), _arrays(other)
        linked, _ = _compared(x, r, y, s, threshold)
        out = [(COUNT, a, c) for who, what in ((ids, linked.sum(1)), (jds, linked.sum(0))) for a, c in zip(who.tolist(), what.tolist()) if c]
        return out + [(LINK, key[0], key[1])] * bool(linked.any())

    return _tiles(side("a", "pa", "pb", 0).unionByName(side("b", "pb", "pa", 1)), judge)


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors(vec_id, label, embedding).

    Two rows are linked if their labels are equal and their vectors, of one length, have a cosine of at least `threshold` (above 0) in
    double precision. A row whose label, vec_id or vector is null, whose vector is empty or zero, or holds a null or non-finite number,
    is linked with nothing: n_links 0, its vec_id as component_id, kept. Rows that repeat a vec_id are vectors each, and count as each
    other's links where their vectors are linked. No rows: no rows. Other columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("grp"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = stored(rows.withColumn("id", F.monotonically_increasing_id()), "vectors")
    units = stored(_units(rows.where("grp IS NOT NULL AND vec_id IS NOT NULL")), "units")
    balls, size, moves = units, units.count(), []
    for k in range(BALL_PASSES):
        balls, moved = _gathered(balls, -1 - k & 0xFFFF, threshold)
        moves.append(moved)
        before, size = size, balls.count()
        if size * 20 > before * 19:  # another would hardly gather more
            break
    largest = balls.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    near, passes = None, passes_for(largest, threshold, window, miss)
    for first in range(0, passes, AT_ONCE):
        found = near_balls(balls, list(range(first, min(passes, first + AT_ONCE))), size, threshold, window)
        near = found if near is None else near.unionByName(found)
    got = complete(balls, components(near), threshold, tile)
    # The ball of each first leader: few rows move, and a large group has a leader in each range it spans.
    leaders = units.join(moves[0], "id", "left_anti").select("id", F.col("id").alias("ball"))
    for moved in moves[1:]:
        leaders = leaders.join(moved.select(F.col("id").alias("ball"), F.col("leader").alias("to")), "ball", "left").select("id", F.coalesce("to", "ball").alias("ball"))
    first_of = units.select("id", "v").join(moves[0], "id", "left").select("id", "v", F.coalesce("leader", "id").alias("first"))
    open_ = got.where(F.col("kind") == OPEN).select("a", "b").distinct()
    wanted = stored(open_.select(F.col("a").alias("ball")).union(open_.select("b")).distinct(), "open-balls")
    if wanted.isEmpty():
        single = got.where("false")
    else:
        members = first_of.join(leaders.join(wanted, "ball", "left_semi").select(F.col("id").alias("first"), "ball"), "first").select("ball", "id", "v")
        single = _members(open_, balls, stored(members, "members"), threshold, tile)
    sums = lambda df: df.where(F.col("kind") == COUNT).groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("links"))
    comp = components(got.unionByName(single).where(F.col("kind") == LINK).select("a", "b"))
    placed = balls.select("id", "n", "least").join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = placed.groupBy("comp").agg(F.min("least").alias("component"))
    of_ball = placed.join(least, "comp").join(sums(got), "id", "left").select(F.col("id").alias("ball"), "component", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    of_first = leaders.join(of_ball, "ball").select(F.col("id").alias("first"), "component", "links")
    of_row = first_of.drop("v").join(of_first, "first").join(sums(single).withColumnRenamed("links", "more"), "id", "left").select("id", "component", (F.col("links") + F.coalesce("more", F.lit(0))).alias("n_links"))
    out = rows.select("id", "vec_id").join(of_row, "id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


#: Every pair of a label, and components by repeated least labels.
ORACLE = """
WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS MATERIALIZED (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
c(r, x) AS (SELECT a, a FROM l UNION SELECT c.r, l.b FROM c JOIN l ON c.x = l.a),
m AS (SELECT c.r, min(vec_id) AS m FROM c JOIN v ON v.r = c.x GROUP BY c.r), n AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(m, vec_id) AS component_id, coalesce(coalesce(m, vec_id) = vec_id, true) AS kept FROM v LEFT JOIN m USING (r) LEFT JOIN n USING (r)
"""

QUERIES = {"op11_embedding_dedup": op11_embedding_dedup}
ORACLES = {"op11_embedding_dedup": ORACLE}
