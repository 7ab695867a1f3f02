"""Shared pieces of the training-data operators: reading, shared-folder tables, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverlog.sources.folders import drop, scratch

#: Bytes of one Arrow batch handed to a Python worker, so a worker's memory does not depend on row sizes.
ARROW_BATCH_BYTES = 4 << 20
#: Bytes of a text whose words are looked at at once.
WORD_BYTES = 1 << 20
#: Deletes a query's shuffle files as soon as it has ended; else they stay until the driver collects its garbage.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)
#: What a Python worker keeps between tasks, by owner.
_kept: dict[str, dict] = {}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, what: str, outlives: bool = False, group: int | None = None) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, survives lost executors, and has known sizes. Within passing() it
    goes at the end of that, unless it outlives it. Its files have row groups of about `group` bytes, if given."""
    path = scratch(df.sparkSession, what)
    if (tables := _passing.get()) is not None and not outlives:
        tables.append(path)
    (df.write if group is None else df.write.option("parquet.block.size", group)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables stored within are deleted at the end, shuffle files after each query: only what is stored to outlive it may be read later."""
    before, mark = spark.conf.get(SHUFFLES_END, None), _passing.set(tables := [])
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        _passing.reset(mark)
        spark.conf.unset(SHUFFLES_END) if before is None else spark.conf.set(SHUFFLES_END, before)
        for path in tables:
            drop(spark, path)


@contextmanager
def split(spark: SparkSession, size: int) -> Iterator[None]:
    """What is computed within reads files in parts of `size` bytes, where their row groups are as small: for aggregations whose tables
    in memory grow with a part."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def prepare(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def kept(owner: str) -> dict:
    """What owner keeps in this worker, until a task of map_arrow runs here that isn't owner's."""
    return _kept.setdefault(owner, {})


def let_go(but: str | None = None) -> None:
    """Frees what other owners have kept: Spark reuses its workers, so it would add to the memory of all later operators."""
    gone = [x for owner, x in _kept.items() if owner != but and x]
    for x in gone:
        x.clear()
    if gone:
        gc.collect()
        with suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, owner: str | None = None) -> DataFrame:
    """df through f, batch by batch; owner names what f keeps in the worker with kept()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(owner)
        return f(batches)

    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, as a lambda's variable. (A column used inside another lambda can be
    inlined there by the optimizer and then be computed again for each element.)"""
    return F.element_at(F.transform(F.array(value), body), 1)


def hash01(c: Column, seed: str) -> Column:
    """A repeatable number in [0, 1) for a key."""
    return F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: A-Z lower-cased; digits, letters and all bytes of characters beyond ASCII kept; the rest are spaces.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def word_runs(raw: bytes | None, part: int | None = None) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, lists of them in order, each of about `part` bytes of it: what is held does not grow with the text.
    A text without any gives nothing."""
    part, at = part or WORD_BYTES, 0
    while raw and at < len(raw):
        piece = raw[at : at + part].translate(_WORD_BYTES)
        at += len(piece)
        while at < len(raw) and piece[-1] != 32:  # on to the end of the last word
            more = raw[at : at + 4096].translate(_WORD_BYTES)
            end = more.find(b" ")
            more = more if end < 0 else more[: end + 1]
            piece += more
            at += len(more)
        if words := piece.split():
            yield words


def numbered(df: DataFrame, order: list[Column | str], name: str, within: int | None = None) -> DataFrame:
    """df with its place from 1 in a total order of its rows (null beyond `within`), by sorted ranges: no task holds all rows. The last
    of `order` should tell any two rows apart, so that no range is one key's."""
    spark = df.sparkSession
    placed = stored(df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "places")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    # One row a range: few, whatever df holds.
    ends = placed.groupBy("_part").agg(F.count("*").alias("n"))
    before = ends.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at") - F.shiftleft(F.col("_part"), 33) + 1
    got = placed.join(F.broadcast(before), "_part").withColumn(name, place if within is None else F.when(place <= within, place))
    return got.drop("_at", "_part", "_before")
