"""Detections: thresholds, sampling, trimming, channel and file summaries, and the detector interface."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverlog.functions import wire
from riverlog.operators.joins import first_match


class Detector(Protocol):
    """frame (h, w, 3 uint8) -> n x 5 float array: x1, y1, x2, y2, score. A `batch` method may take many frames."""

    def __call__(self, frame: np.ndarray) -> np.ndarray: ...


class BrightBoxDetector:
    """A stand-in for tests, not a face detector: one box around pixels of 250 or more, scored by their share of it."""

    def __call__(self, frame: np.ndarray) -> np.ndarray:
        y, x = np.nonzero(frame.min(axis=2) >= 250)
        if not len(x):
            return np.zeros((0, 5), np.float32)
        box = x.min(), y.min(), x.max() + 1, y.max() + 1
        return np.array([[*box, len(x) / ((box[2] - box[0]) * (box[3] - box[1]))]], np.float32)

    def batch(self, frames: list[np.ndarray]) -> list[np.ndarray]:
        return [self(f) for f in frames]


def parse_overrides(text: str) -> list[tuple[str, float]]:
    """"wrist:0.9,head:0.8" -> pairs; a part without a value is an error."""
    out = []
    for part in filter(None, (x.strip() for x in text.split(","))):
        name, sep, number = part.rpartition(":")
        if not sep or not name:
            raise ValueError(f"no value in {part!r}")
        out.append((name, float(number)))
    return out


def threshold(topic: Column, default: float, overrides: list[tuple[str, float]], strict_default: bool = False) -> Column:
    """A topic's threshold. Unless strict_default, a lower override lowers the default of all other topics too."""
    floor = default if strict_default or not overrides else min(default, *(v for _, v in overrides))
    return first_match(topic, overrides, floor)


def indexed(df: DataFrame, by: list[str], order: list[str], name: str = "idx") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)


def indexed_by_cells(df: DataFrame, by: list[str], order: list[str], cell: int, name: str = "idx") -> DataFrame:
    """As indexed(), where order starts with a number: rows are counted in its cells of that width, cells before are added up from the
    counts alone, so a task holds a cell of a group and not the group."""
    on = [*by, "_cell"]
    rows = df.withColumn("_cell", F.floor(F.col(order[0]) / F.lit(cell)).cast("long"))
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy(*on).orderBy(*order)) - 1
    return rows.withColumn(name, place).join(before, on).withColumn(name, F.col(name) + F.col("_before")).drop("_cell", "_before").select(*df.columns, name)


def strided(df: DataFrame, by: list[str], order: list[str], stride: int) -> DataFrame:
    """Every stride-th row of a group, from the first; the index counts all rows."""
    rows = indexed(df, by, order)
    return rows if stride <= 1 else rows.where(F.col("idx") % stride == 0)


def head(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of a group; each task passes on no more than n rows of one."""
    first = df.withColumn("idx", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("idx") <= n)
    return first.withColumn("idx", F.col("idx") - 1)


def from_first_keyframe(df: DataFrame, by: list[str], t: str, is_key: Column) -> DataFrame:
    """Rows from a group's first keyframe on; groups without one stay whole and are flagged no_keyframe."""
    first = df.groupBy(*by).agg(F.min(F.when(is_key, F.col(t))).alias("_first"))
    met = _beside(df, first, by)
    return met.withColumn("no_keyframe", F.col("_first").isNull()).where(F.col("_first").isNull() | (F.col(t) >= F.col("_first"))).drop("_first")


def _beside(df: DataFrame, sums: DataFrame, by: list[str]) -> DataFrame:
    """df with the columns of its group's row in sums; a null in `by` is a value."""
    names = {c: f"_of_{c}" for c in by}
    return df.join(sums.withColumnsRenamed(names), [df[c].eqNullSafe(F.col(n)) for c, n in names.items()]).drop(*names.values())


def channel_summary(df: DataFrame, by: list[str], t: str, hit: Column, stride: int = 1) -> DataFrame:
    """messages, checked rows, rows with detections, start, end; fps as (n - 1) / span and the hold stride / fps, in micros."""
    span = F.max(t) - F.min(t)
    got = df.groupBy(*by).agg(F.count("*").alias("messages"), F.count_if(hit).alias("with_hits"), F.min(t).alias("start_t"), F.max(t).alias("end_t"), span.alias("span"))
    fps = F.when(F.col("span") > 0, (F.col("messages") - 1) * 1e6 / F.col("span")).otherwise(0.0)
    return got.withColumn("checked", F.ceil(F.col("messages") / stride)).withColumn("fps", fps).withColumn("hold_us", F.when((F.col("span") > 0) & (F.col("messages") > 1), F.floor(stride * F.col("span") / (F.col("messages") - 1))).otherwise(0).cast("long"))


def modal(df: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """A group's most frequent value; of equally frequent ones the first seen."""
    n = df.groupBy(*by, value).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
    return n.groupBy(*by).agg(F.max_by(value, F.struct(F.col("n"), (-F.col("first_seen")).alias("f"))).alias(value), F.count("*").alias("kinds"))


def calibrate(df: DataFrame, by: list[str], score: str, levels: list[float]) -> DataFrame:
    """Rows at or above each level, in one pass."""
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(score) >= x).alias(f"n{i}") for i, x in enumerate(levels)])
    return counts.select(*by, F.explode(F.array(*[F.struct(F.lit(float(x)).alias("level"), F.col(f"n{i}").alias("survivors")) for i, x in enumerate(levels)])).alias("s")).select(*by, "s.*")


def hold_any(df: DataFrame, by: list[str], t: str, flag: Column, window: int) -> Column:
    """Whether any row within window // 2 rows is flagged; the window is odd."""
    return F.max(flag.cast("int")).over(_around(by, t, window))


def hold_boxes(df: DataFrame, by: list[str], order: list[str], boxes: str, window: int) -> Column:
    """The boxes of all rows within window // 2 rows, by row: what is to be masked in a frame so that no box flickers. Null: no boxes."""
    return F.flatten(F.collect_list(boxes).over(_around(by, order, window)))


def hold_majority(df: DataFrame, by: list[str], t: str, flag: Column, window: int) -> Column:
    """Whether more than half of the rows at hand are flagged; fewer are at hand at the edges."""
    w = _around(by, t, window)
    return (F.sum(flag.cast("int")).over(w) > F.floor(F.count(F.lit(1)).over(w) / 2)).cast("int")


def _around(by: list[str], t: str | list[str], window: int):
    if window < 1 or window % 2 == 0:
        raise ValueError("the window must be odd and at least 1")
    return Window.partitionBy(*by).orderBy(*([t] if isinstance(t, str) else t)).rowsBetween(-(window // 2), window // 2)


def swap_payload(source: DataFrame, new: DataFrame, by: list[str], order: list[str], value: str, cell: int | None = None, field: int | None = None) -> DataFrame:
    """source with new's value put in by place within the group; status says where one side has more rows. A null is a value too.

    With cell, places are counted in cells of order's first column. With field, value is a protobuf message, and new's value goes into
    that field of it; all its other bytes stay. A null message or a null value for a field gives null.
    """
    place = (lambda df: indexed_by_cells(df, by, order, cell)) if cell else (lambda df: indexed(df, by, order))
    a = place(source).withColumn("_here", F.lit(True))
    b = place(new).select(*by, "idx", F.col(value).alias("_v"), F.lit(True).alias("_new"))
    met = a.join(b, [*by, "idx"], "full")
    status = F.when(F.col("_here").isNull(), "extra").when(F.col("_new").isNull(), "missing").otherwise("swapped")
    put = F.col("_v") if field is None else _spliced(field)(value, "_v")
    return met.withColumn("status", status).withColumn(value, F.when(F.col("_new"), put).otherwise(F.col(value))).drop("_v", "_here", "_new")


def _spliced(field: int):
    @F.pandas_udf("binary")
    def put(message: pd.Series, new: pd.Series) -> pd.Series:
        return pd.Series([None if m is None or v is None else wire.splice(bytes(m), field, bytes(v)) for m, v in zip(message, new)], dtype=object)

    return put


def excerpt(df: DataFrame, by: list[str], topic: str, order: list[str], video: Column, n: int) -> DataFrame:
    """The first messages of each recording: of its video topics as many as the shortest has, n at most; of the others those up to the
    last time of the first n video messages. `order` starts with the time; a recording without video gives nothing."""
    t = order[0]
    rows = indexed(df, [*by, topic], order).withColumn("_video", video)
    first = rows.where(F.col("_video") & (F.col("idx") < n)).groupBy(*by, topic).agg(F.count("*").alias("k"), F.max(t).alias("last"))
    ends = first.groupBy(*by).agg(F.min("k").alias("_common"), F.max("last").alias("_cutoff"))
    inside = F.when(F.col("_video"), F.col("idx") < F.col("_common")).otherwise(F.col(t) <= F.col("_cutoff"))
    return rows.join(ends, by).where(inside).drop("_video", "_common", "_cutoff")


def lock_step(df: DataFrame, by: list[str], topic: str, order: list[str], value: str) -> DataFrame:
    """by, idx, frames: the idx-th rows of all topics together, by topic; topics with fewer rows drop out."""
    rows = indexed(df, [*by, topic], order)
    return rows.groupBy(*by, "idx").agg(F.array_sort(F.collect_list(F.struct(F.col(topic).alias("topic"), F.col(value).alias("value")))).alias("frames"))


def detection_summary(found: DataFrame, spans: DataFrame, by: list[str]) -> DataFrame:
    """Per channel of found(by, boxes): frames, the most boxes in one, the longest short side of a box in whole pixels, and the time of
    spans(by, a, b)."""
    side = F.array_max(F.transform("boxes", lambda b: F.least(b["x2"].cast("int") - b["x1"].cast("int"), b["y2"].cast("int") - b["y1"].cast("int"))))
    got = found.groupBy(*by).agg(F.count("*").alias("frames_with_faces"), F.coalesce(F.max(F.size("boxes")), F.lit(0)).alias("max_faces_in_frame"), F.coalesce(F.max(side), F.lit(0)).alias("largest_face_px"))
    return got.join(spans.groupBy(*by).agg(F.sum(F.col("b") - F.col("a")).alias("face_time")), by, "left").na.fill(0, ["face_time"])


#: Detectors that live as long as their worker, by what makes them.
_living: dict[str, Detector] = {}


def _detector(factory: Callable[[], Detector], made_by: str | None) -> Detector:
    """A new detector, or that of the worker: this function is found by its name there, and so is what it keeps."""
    if made_by is None:
        return factory()
    key = f"{made_by} {task_device()}"
    if key not in _living:
        _living[key] = factory()
    return _living[key]


def gpu_profile(gpus_an_executor: int = 1, tasks_a_gpu: int = 1) -> ResourceProfile:
    """For detect_frames: executors with GPUs, each shared by so many tasks. The cluster's discovery of GPUs must be set up."""
    executors = ExecutorResourceRequests().resource("gpu", gpus_an_executor)
    return ResourceProfileBuilder().require(executors).require(TaskResourceRequests().resource("gpu", 1 / tasks_a_gpu)).build


def task_device() -> str:
    """The device that Spark gave this task, for a detector's factory: "cuda:N", or "cpu" where it gave none."""
    task = TaskContext.get()
    gpu = task.resources().get("gpu") if task else None
    return f"cuda:{gpu.addresses[0]}" if gpu else "cpu"


def detect_frames(frames: DataFrame, keys: list[str], factory: Callable[[], Detector], profile: ResourceProfile | None = None, per_worker: bool = False) -> DataFrame:
    """keys, boxes array<struct<x1, y1, x2, y2, score>> for each row of frames(keys, height, width, pixels: rows of 3-byte pixels).

    Each task makes one detector; with per_worker, each Python worker and device does, for all tasks it runs. Where a detector has
    `batch`, the frames of an Arrow batch go to it together. A null height, width or pixels gives null boxes; other sizes than
    height * width * 3 are an error. profile: where the tasks run, for instance gpu_profile().
    """
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frames.select(*keys).schema.fields)
    names = ("x1", "y1", "x2", "y2", "score")
    kind = pa.list_(pa.struct([(c, pa.float64()) for c in names]))
    made_by = hashlib.sha256(cloudpickle.dumps(factory)).hexdigest() if per_worker else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = _detector(factory, made_by)
        many = getattr(detector, "batch", None) or (lambda images: [detector(x) for x in images])
        for b in batches:
            sizes = [b.column(i).to_pylist() for i in range(b.num_columns - 3, b.num_columns)]
            whole = [i for i, x in enumerate(zip(*sizes)) if None not in x]
            images = [np.frombuffer(sizes[2][i], np.uint8).reshape(sizes[0][i], sizes[1][i], 3) for i in whole]
            boxes: list = [None] * b.num_rows
            for i, found in zip(whole, many(images) if images else []):
                boxes[i] = [dict(zip(names, map(float, x))) for x in found]
            yield pa.RecordBatch.from_arrays([*b.columns[:-3], pa.array(boxes, kind)], [*keys, "boxes"])

    return frames.select(*keys, "height", "width", "pixels").mapInArrow(run, f"{out}, boxes array<struct<x1:double,y1:double,x2:double,y2:double,score:double>>", profile=profile)
