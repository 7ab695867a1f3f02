"""Exact top-k by inner product over KD-trees, one for each shard of vectors.

Median splits of a bounded sample deal the vectors to cells, so that a shard's vectors lie close together; a cell of more rows
than a shard takes is several shards. Each shard's vectors are split at medians of the widest dimension into leaves with tight
bounding boxes. Of a leaf only those queries look at the points whose kth score its bound (the largest inner product any point of
the box can have) reaches. The kth score is propagated: each block of queries, all of one cell, first searches a shard of its own
cell, and takes the scores found there along from tree to tree. Trees and query blocks are binary rows of bounded size. A task takes
some blocks and some trees and lets those meet where the cell's tight box is reached; it reads both, so neither is ever copied to a
shuffle for each of the other, broadcast or sent to the driver.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverlog.llm.common import hash01, map_arrow, prepare, stored, table

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 512, 256
#: A task meets so many bytes of trees, and so many blocks of queries.
TREE_BYTES, BLOCKS = 8 << 20, 8
#: Components in the sample that places the cells' splits, and rows of it in a cell at least.
SAMPLE_VALUES, SAMPLE_ROWS = 1 << 20, 8


def _dump(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _load(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as z:
        return dict(z)


def build_tree(points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """order of points, leaf offsets, and the leaves' tight boxes lo, hi."""
    leaves, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) > leaf_rows and points.shape[1]:
            part = points[rows]
            widths = part.max(0) - part.min(0)
            axis = int(widths.argmax())
            if widths[axis] > 0:  # else all points are equal, and one leaf holds them
                half = len(rows) // 2
                order = np.argpartition(part[:, axis], half)
                todo += [rows[order[half:]], rows[order[:half]]]
                continue
        leaves.append(rows)
    order = np.concatenate(leaves)
    offsets = np.cumsum([0, *map(len, leaves)])
    lo = np.stack([points[x].min(0) for x in leaves])
    hi = np.stack([points[x].max(0) for x in leaves])
    return order, offsets, lo, hi


def build_splits(points: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Median splits of the widest dimension into about `cells` cells of at least SAMPLE_ROWS points: for each node its axis (-1: a
    cell), the value from which on points go to the second child, and its first child, or the cell's number."""
    axis, value, child, todo, done = [0], [0], [0], [(0, np.arange(len(points)), cells)], 0
    while todo:
        node, rows, want = todo.pop()
        part = points[rows]
        wide = int((part.max(0) - part.min(0)).argmax()) if part.size else 0
        if want < 2 or len(rows) < 2 * SAMPLE_ROWS or not part.size or part[:, wide].min() == part[:, wide].max():
            axis[node], child[node] = -1, done
            done += 1
            continue
        x = part[:, wide]
        at = np.sort(x)[len(x) // 2]
        at = at if at > x.min() else x[x > at].min()
        axis[node], value[node], child[node] = wide, at, len(axis)
        for side, n in ((x < at, want // 2), (x >= at, want - want // 2)):
            todo.append((len(axis), rows[side], n))
            for y in (axis, value, child):
                y.append(0)
    return np.array(axis), np.array(value, np.int64), np.array(child)


def cell_of(points: np.ndarray, splits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    axis, value, child = splits
    node = np.zeros(len(points), np.int64)
    while (inner := np.flatnonzero(axis[node] >= 0)).size:
        at = node[inner]
        node[inner] = child[at] + (points[inner, axis[at]] >= value[at])
    return child[node]


def _bounds(asked: np.ndarray, lo: np.ndarray, hi: np.ndarray, kind: type) -> np.ndarray:
    """The largest inner product with any point of each box."""
    wide = object if kind is object else np.float64
    return np.maximum(asked, 0).astype(wide) @ hi.astype(wide).T + np.minimum(asked, 0).astype(wide) @ lo.astype(wide).T


def reached(queries: dict[str, np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which boxes may hold a point that reaches each query's tau."""
    kind = _exact(np.concatenate([lo, hi]), queries["points"])
    return (_bounds(queries["points"], lo, hi, kind) >= queries["tau"][:, None]).astype(bool)


def _exact(points: np.ndarray, queries: np.ndarray) -> type:
    """The cheapest number type whose sums of products are exact."""
    top = lambda x: max(-int(x.min(initial=0)), int(x.max(initial=0)))
    most = top(points) * top(queries) * max(1, points.shape[1])
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def _narrow(points: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them all."""
    low, high = int(points.min(initial=0)), int(points.max(initial=0))
    return points.astype(next(x for x in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(x).min <= low and high <= np.iinfo(x).max))


class Best:
    """The k best points found for each query of a block, as far as they reach its tau, which rises with them."""

    def __init__(self, queries: dict[str, np.ndarray], k: int):
        self.queries, self.k, self.tau, self.held, self.n = queries, k, queries["tau"].astype(object), [], 0
        self.most = 16 * k * len(self.tau) + (1 << 16)

    def search(self, tree: dict[str, np.ndarray]) -> None:
        kind = _exact(tree["points"], self.queries["points"])
        points, asked, own = tree["points"].astype(kind), self.queries["points"].astype(kind), self.queries["rows"]
        bounds = _bounds(asked, tree["lo"], tree["hi"], kind)
        exact = np.float64 if kind is not object and all(float(x) == x for x in self.tau) else object
        tau = self.tau.astype(exact)
        for leaf in np.argsort(-bounds.max(0, initial=-np.inf), kind="stable"):
            near = np.flatnonzero((bounds[:, leaf] >= tau).astype(bool))
            if not near.size:
                continue
            a, b = tree["offsets"][leaf], tree["offsets"][leaf + 1]
            scores, least = asked[near] @ points[a:b].T, tau[near]
            if b - a > self.k + 1:  # its k + 1 best, of which one may be the query itself
                least = np.maximum(least, np.partition(scores, b - a - self.k - 1, axis=1)[:, b - a - self.k - 1].astype(exact))
            which, at = np.nonzero((scores >= least[:, None]).astype(bool))
            one, score, row = near[which], scores[which, at], tree["rows"][a:b][at]
            other = row != own[one]
            self.held.append((one[other], tree["ids"][a:b][at][other], row[other], score[other]))
            self.n += int(other.sum())
            if self.n > self.most:
                self._keep()
                tau = self.tau.astype(exact)
        self._keep()

    def _keep(self) -> None:
        one, ids, rows, scores = self.found()
        self.held, self.n = [(one, ids, rows, scores)], len(one)
        full = np.flatnonzero(np.bincount(one, minlength=len(self.tau)) == self.k)
        kth = scores[np.searchsorted(one, full, side="right") - 1]
        self.tau[full] = [max(x, int(y)) for x, y in zip(self.tau[full], kth)]

    def found(self) -> tuple[np.ndarray, ...]:
        """Each found point's query, vec_id, row and score: by query, then best first."""
        if not self.held:
            return *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0)
        one, ids, rows, scores = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((rows, ids, -scores, one))
        one = one[order]
        place = np.arange(len(one)) - np.searchsorted(one, one)
        order, one = order[place < self.k], one[place < self.k]
        return one, ids[order], rows[order], scores[order]


def _points(t: pa.Table) -> np.ndarray:
    flat = t.column("v").combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1).astype(np.int64)


def _clip(score) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of vectors(vec_id, embedding) that is_query picks, against all other rows.

    A component x counts as floor(64 * x). Vectors null or with null or non-finite components take no part. Only vectors of
    equal length are compared. Rows are told apart by row, not by vec_id: rows that repeat a vec_id are queries and candidates
    each. Ties go to the smaller vec_id. Scores beyond a long are cut to its range. No rows or no queries: no result.
    """
    spark = vectors.sparkSession
    prepare(spark)
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    ints = F.transform("embedding", lambda x: F.floor(F.lit(64) * x.cast("double")).cast("long"))
    rows = stored(vectors.where(fine & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.monotonically_increasing_id().alias("row"), ints.alias("v"), is_query.alias("asks"), F.size("embedding").alias("dim")), "vectors")
    counts = rows.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    if not counts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    chance = min(1.0, SAMPLE_VALUES / max(1, counts["dim"]) / counts["n"])
    sample = rows.where(hash01(F.col("row"), "splits") < chance).select("dim", "v").toArrow()
    splits = {}
    for dim in np.unique(sample.column("dim").to_numpy()).tolist():
        points = _points(sample.filter(pa.compute.equal(sample.column("dim"), dim)))
        splits[dim] = build_splits(points, -(-int(len(points) / chance) // shard_rows))
    del sample
    dealing = spark.sparkContext.broadcast(splits)  # fewer nodes than sampled rows

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            dims, cells = t.column("dim").to_numpy(), np.zeros(t.num_rows, np.int64)
            for dim in np.unique(dims):
                if dim in dealing.value:
                    which = np.flatnonzero(dims == dim)
                    cells[which] = cell_of(_points(t.take(which)), dealing.value[dim])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells)], [*b.schema.names, "cell"])

    dealt = stored(map_arrow(rows, deal, "vec_id long, row long, v array<long>, asks boolean, dim int, cell long"), "dealt-vectors")
    sizes = dealt.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.count_if("asks").alias("q"))
    share = lambda n, most: F.greatest(F.lit(1), F.ceil(n / F.lit(float(most)))).cast("long")
    sizes = sizes.select("dim", "cell", share(F.col("n"), 2 * shard_rows).alias("shards"), share(F.col("q"), QUERY_ROWS).alias("blocks"))
    part = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("long")
    placed = dealt.join(sizes, ["dim", "cell"])
    group = pa.schema([("dim", pa.int32()), ("cell", pa.int64()), ("part", pa.int64())])

    def tree(t: pa.Table) -> pa.Table:
        points = _points(t)
        order, offsets, lo, hi = build_tree(points)
        raw = _dump(points=_narrow(points[order]), ids=t.column("vec_id").to_numpy()[order], rows=t.column("row").to_numpy()[order], offsets=offsets, lo=lo, hi=hi)
        box = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (lo.min(0), hi.max(0))]
        return pa.Table.from_arrays([*(t.column(c).slice(0, 1).cast(group.field(c).type) for c in group.names), pa.array([raw], pa.binary()), *box], [*group.names, "tree", "lo", "hi"])

    def block(t: pa.Table) -> pa.Table:
        raw = _dump(points=_narrow(_points(t)), ids=t.column("vec_id").to_numpy(), rows=t.column("row").to_numpy(), tau=np.full(t.num_rows, -np.inf))
        return pa.Table.from_arrays([*(t.column(c).slice(0, 1).cast(kind) for c, kind in (("dim", pa.int32()), ("cell", pa.int64()), ("home", pa.int64()))), pa.array([raw], pa.binary())], ["dim", "cell", "part", "queries"])

    trees = stored(placed.withColumn("part", part("shards")).groupBy("dim", "cell", "part").applyInArrow(tree, "dim int, cell long, part long, tree binary, lo array<long>, hi array<long>"), "trees")
    asked = placed.where("asks").withColumn("block", part("blocks")).withColumn("home", F.pmod("block", "shards"))
    asked = asked.groupBy("dim", "cell", "block").applyInArrow(block, "dim int, cell long, part long, queries binary")
    # Boxes of the cells of sampled dimensions: at most SAMPLE_VALUES / SAMPLE_ROWS components. Others are always reached.
    sides = trees.where(F.col("dim").isin(list(splits))).select("dim", "cell", F.posexplode(F.arrays_zip("lo", "hi")).alias("i", "x")).groupBy("dim", "cell", "i").agg(F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi"))
    boxes: dict[int, dict[str, np.ndarray]] = {}
    for dim, of_dim in sides.toPandas().groupby("dim"):
        of_dim = of_dim.sort_values(["cell", "i"])
        boxes[int(dim)] = {"cell": of_dim["cell"].to_numpy()[::dim], **{c: of_dim[c].to_numpy(np.int64).reshape(-1, dim) for c in ("lo", "hi")}}
    shared = spark.sparkContext.broadcast(boxes)

    seeds = pa.schema([("queries", pa.binary()), ("reached", pa.list_(pa.int64()))])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks with the kth scores of their home, and the keys of the cells whose boxes any of their queries reaches."""
        for b in batches:
            for dim, queries, raw in zip(*(b.column(c).to_pylist() for c in ("dim", "queries", "tree"))):
                q, known = _load(queries), shared.value.get(dim)
                if raw is not None:
                    best = Best(q, k)
                    best.search(_load(raw))
                    q["tau"] = np.array([x if float(x) == x else y for x, y in zip(best.tau, q["tau"])], np.float64)
                cells = known["cell"][reached(q, known["lo"], known["hi"]).any(0)].tolist() if known else [0]
                yield pa.RecordBatch.from_pydict({"queries": [_dump(**q)], "reached": [[(dim << 32) + c for c in cells]]}, schema=seeds)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of each block, whose trees come one after the other, among all trees of this task."""
        last, best = None, None
        for b in batches:
            for i in range(b.num_rows):
                queries = b.column(0)[i].as_py()
                if queries != last:
                    if best is not None:
                        yield rows_of(best)
                    last, best = queries, Best(_load(queries), k)
                best.search(_load(b.column(1)[i].as_py()))
        if best is not None:
            yield rows_of(best)

    def rows_of(best: Best) -> pa.RecordBatch:
        one, ids, at, scores = best.found()
        columns = best.queries["ids"][one], best.queries["rows"][one], ids, at, np.array([_clip(s) for s in scores], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["query_id", "query_row", "vec_id", "row", "score"])

    # Spark takes trees and blocks for small, as their files are packed: merged here, else they might be broadcast.
    blocks = stored(asked.join(trees.hint("merge"), ["dim", "cell", "part"], "left").select("dim", "queries", "tree").mapInArrow(first, "queries binary, reached array<long>"), "query-blocks")
    n, size = blocks.count(), trees.agg(F.sum(F.length("tree"))).first()[0]
    wide = -(-size // TREE_BYTES)
    long = min(max(n, 1), max(-(-n // BLOCKS), -(-2 * spark.sparkContext.defaultParallelism // wide)))
    keyed = trees.select((F.shiftleft(F.col("dim").cast("long"), 32) + F.col("cell")).alias("key"), "tree").repartition(wide)
    pairs = blocks.repartition(long).join(keyed.hint("shuffle_replicate_nl"), F.array_contains("reached", F.col("key")))
    found = pairs.select("queries", "tree").mapInArrow(rest, "query_id long, query_row long, vec_id long, row long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

QUERIES = {"op5_topk_search": op5_topk_search}
ORACLES = {"op5_topk_search": ORACLE}
