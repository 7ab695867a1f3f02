"""Detections over a stream: event-time sessions by gap, closed by a watermark, and flags held over neighbouring rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def stream_sessions(df: DataFrame, by: list[str], ts: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """by, a, b (first and last time, micros), n for each session; works on batch and streaming frames alike.

    Rows exactly gap apart share a session, as in the batch operator; gap is in whole microseconds.
    """
    w = df.withWatermark(ts, late) if df.isStreaming else df
    got = w.groupBy(*by, F.session_window(ts, gap).alias("w")).agg(F.unix_micros(F.min(ts)).alias("a"), F.unix_micros(F.max(ts)).alias("b"), F.count("*").alias("n"))
    return got.drop("w")


#: State is kept for so many buckets of groups, not for each group: a call to Python and its state cost far more than a group's few rows.
BUCKETS = 1024


def _by_buckets(df: DataFrame, by: list[str], ts: str, row: str, late: str, **more: Column) -> DataFrame:
    """df(_bucket, by as strings, ts, t, row, has, and more) with its watermark. As strings and without nulls: in pandas, long integers
    beside nulls would become fractions. Rows without `has` only move the watermark; they are dropped in the tasks, as a filter here
    would be moved before it."""
    names = [F.col(c).cast("string").alias(f"by{i}") for i, c in enumerate(by)]
    has = (F.col(row).isNotNull() & F.col(ts).isNotNull()).alias("has")
    zero = F.lit(0).cast("long")
    return df.withWatermark(ts, late).select(F.pmod(F.hash(*by), F.lit(BUCKETS)).alias("_bucket"), *names, ts, F.coalesce(F.unix_micros(ts), zero).alias("t"), F.coalesce(F.col(row).cast("long"), zero).alias("row"), has, *[x.alias(c) for c, x in more.items()])


def hold_stream(df: DataFrame, by: list[str], ts: str, row: str, flag: str, window: int, late: str = "10 minutes") -> DataFrame:
    """by, row, held: whether any row of the group within window // 2 rows is flagged, as in detect.hold_any, on a stream of
    df(by, ts, row, flag 0, 1 or null, which is 0), where row is a long that tells rows apart. Rows of null `row` only move the watermark.

    A row is given out once window // 2 later rows of its group are there, or else when the watermark passes the group's last row. Of a
    group, window - 1 rows stay as state. Within a micro-batch rows come in any order, as its files may; a row that arrives behind given
    out ones is an error, as their windows would have been others; one that is `late` behind the newest of all groups is dropped by the
    watermark, so `late` must cover how far groups run apart. Groups are dealt to BUCKETS, whose rows of one micro-batch meet in one task.
    """
    if window < 1 or window % 2 == 0:
        raise ValueError("the window must be odd and at least 1")
    half = window // 2
    names = [f"by{i}" for i in range(len(by))]
    fields = [*names, "t", "row", "flag", "given"]

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame(dict(zip(fields, state.get if state.exists else [[] for _ in fields]))).astype({"t": "int64", "row": "int64", "flag": "int64", "given": "bool"})
        new = [] if state.hasTimedOut else [p.loc[p["has"], [*names, "t", "row", "flag"]].assign(given=False) for p in parts]
        rows = pd.concat([held.assign(old=True), *(p.assign(old=False) for p in new)], ignore_index=True)
        if not len(rows):
            return
        rows["group"] = rows.groupby(names, dropna=False, sort=False).ngroup()
        rows = rows.sort_values(["group", "t", "row"], ignore_index=True)
        group, given = rows["group"].to_numpy(), rows["given"].to_numpy(bool)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[first, len(group)])
        if (behind := (group[1:] == group[:-1]) & given[1:] & ~given[:-1]).any():
            raise ValueError(f"a row of {tuple(rows[names].iloc[np.flatnonzero(behind)[0]])} arrives behind rows given out")
        last = rows["t"].to_numpy()[first + size - 1] // 1000
        over = np.logical_and.reduceat(rows["old"].to_numpy(bool), first) & (last + 1 < state.getCurrentWatermarkMs())
        stop = np.where(over, size, np.maximum(np.add.reduceat(given.astype(np.int64), first), size - half))
        place = np.arange(len(group)) - np.repeat(first, size)
        flags = rows["flag"].to_numpy(np.int64)
        out = flags.copy()
        for d in range(1, half + 1):
            same = group[d:] == group[:-d]
            np.maximum(out[d:], np.where(same, flags[:-d], 0), out=out[d:])
            np.maximum(out[:-d], np.where(same, flags[d:], 0), out=out[:-d])
        give = (place < np.repeat(stop, size)) & ~given
        yield rows.loc[give, [*names, "row"]].assign(held=out[give].astype(np.int32))
        stays = ~np.repeat(over, size) & (place >= np.repeat(stop, size) - half)
        if not stays.any():
            state.remove()
            return
        left = rows[stays].assign(given=(given | give)[stays])
        state.update(tuple([None if x is None or x != x else x for x in left[c].tolist()] for c in fields))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), int(last[~over].min())) + 1)

    rows = _by_buckets(df, by, ts, row, late, flag=F.coalesce(F.col(flag).cast("long"), F.lit(0).cast("long")))
    out = ", ".join(f"{c} string" for c in names) + ", row long, held int"
    kept = ", ".join(f"{c} array<string>" for c in names) + ", t array<long>, row array<long>, flag array<long>, given array<boolean>"
    got = rows.groupBy("_bucket").applyInPandasWithState(step, out, kept, "append", GroupStateTimeout.EventTimeTimeout)
    return _as_before(got, df, by).select(*by, F.col("row").alias(row), "held")


def _as_before(got: DataFrame, df: DataFrame, by: list[str]) -> DataFrame:
    """The groups' columns under their names and in their types."""
    return got.select(*[F.col(f"by{i}").cast(df.schema[c].dataType).alias(c) for i, c in enumerate(by)], *got.columns[len(by) :])


class _HeldBoxes(StatefulProcessor):
    """Rows of a bucket's groups in state, each group's from the first that a row not yet given out still looks back at; a list of packs
    of rows, as a row for itself would cost a call.

    Input is only kept, as a group's rows of a micro-batch may come in several calls and in any order. Each call sets a timer at the
    first end of a group's rows; when the watermark passes it, all rows below are there and in their final order, and those whose later
    neighbours are leave. Then the next end is the timer.
    """

    FIELDS = ("t", "row", "boxes", "given")

    def __init__(self, names: list[str], half: int):
        self.names, self.half = names, half

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.packs = handle.getListState("packs", ", ".join(f"{c} array<string>" for c in self.names) + ", t array<long>, row array<long>, boxes array<string>, given array<boolean>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ends: dict[tuple, int] = {}
        packs = []
        for part in rows:
            part = part[part["has"]]
            if len(part):
                texts = [[None if x is None or x != x else x for x in part[c].tolist()] for c in self.names]
                pack = *texts, part["t"].tolist(), part["row"].tolist(), part["boxes"].tolist(), [False] * len(part)
                packs.append(Row(*self.names, *self.FIELDS)(*pack))
                for k, t in zip(zip(*texts), pack[len(texts)]):
                    ends[k] = max(t, ends.get(k, t))
        if packs:
            self.packs.appendList(packs)
            self._wake(ends.values(), timerValues)
        return iter(())

    def _wake(self, ends, timerValues) -> None:
        self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs(), min(ends) // 1000) + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.packs.exists():
            return
        groups: dict[tuple, list[tuple]] = {}
        for pack in self.packs.get():
            n = len(self.names)
            for i, x in enumerate(zip(*pack[n:])):
                groups.setdefault(tuple(c[i] for c in pack[:n]), []).append(x)
        now, out, left = timerValues.getCurrentWatermarkInMs(), [], []
        ends: list[int] = []
        for k, rows in groups.items():
            rows.sort(key=lambda x: x[:2])
            done, final = sum(x[3] for x in rows), sum(x[0] // 1000 < now for x in rows)
            stop = len(rows) if final == len(rows) else max(done, final - self.half)
            # Arrays of JSON as texts, without their brackets.
            inner = [x[2][1:-1] for x in rows]
            out += [(*k, rows[i][1], f"[{','.join(filter(None, inner[max(0, i - self.half) : i + self.half + 1]))}]") for i in range(done, stop)]
            if stop < len(rows):
                left += [(*k, *rows[i][:3], i < stop) for i in range(max(0, stop - self.half), len(rows))]
                ends.append(rows[-1][0])
        if left:
            self.packs.put([Row(*self.names, *self.FIELDS)(*map(list, zip(*left)))])
            self._wake(ends, timerValues)
        else:
            self.packs.clear()
        if out:
            yield pd.DataFrame(dict(zip([*self.names, "row", "boxes"], map(list, zip(*out)))))

    def close(self) -> None:
        pass


def use_stateful_processors(spark: SparkSession) -> None:
    """Streams with processors of their own keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def hold_boxes_stream(df: DataFrame, by: list[str], ts: str, row: str, boxes: str, window: int, late: str = "10 minutes") -> DataFrame:
    """by, row, boxes: the boxes of the group's rows within window // 2 rows, as detect.hold_boxes has them, on a stream of
    df(by, ts, row, boxes array<array<double>>), where row is a long that tells rows apart. Null boxes are none; rows of null `row` only move the watermark.

    Rows stand in order of ts, then row, whatever order they come in. A row leaves once the watermark has passed its window // 2 later
    rows, or the group's last row; so a pause that the watermark passes ends the windows of the rows before it. Rows that come `late`
    behind the newest of all groups are dropped. Of a group, the rows since the watermark and window - 1 before stay as state;
    groups are dealt to BUCKETS.
    """
    if window < 1 or window % 2 == 0:
        raise ValueError("the window must be odd and at least 1")
    kind = df.schema[boxes].dataType.simpleString()
    rows = _by_buckets(df, by, ts, row, late, boxes=F.to_json(F.coalesce(boxes, F.array().cast(kind))))
    names = [f"by{i}" for i in range(len(by))]
    schema = ", ".join(f"{c} string" for c in names) + ", row long, boxes string"
    got = rows.groupBy("_bucket").transformWithStateInPandas(_HeldBoxes(names, window // 2), schema, "Append", "EventTime")
    return _as_before(got, df, by).select(*by, F.col("row").alias(row), F.from_json("boxes", kind).alias("boxes"))


def run_once(out: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs all that is there into parquet files at path and stops; what they hold."""
    q = out.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return out.sparkSession.read.schema(out.schema).parquet(path)
