"""One picture a tick of all feeds' frames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverlog.operators import boxes


def compose(frames: DataFrame, by: list[str], slot: str, feeds: int, cols: int, tile: tuple[int, int], blank: int = 24) -> DataFrame:
    """by, height, width, pixels for each group of frames(by, slot, height, width, pixels): the frames of one tick, each in the place of
    its slot from 0, resized to tile (height, width); `blank` where none is. The rows of a tick meet in one task: `feeds` at most.

    Null pixels are a blank place. Of several frames in one slot the one of the greatest pixels stays; slots out of range are an error.
    """
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frames.select(*by).schema.fields)
    held = frames.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(slot).cast("int").alias("slot"), F.col("pixels").alias("pixels"), F.col("height").alias("height"), F.col("width").alias("width")))).alias("tiles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for tiles in b.column(len(by)).to_pylist():
                places: list[np.ndarray | None] = [None] * feeds
                for x in tiles:
                    if not 0 <= x["slot"] < feeds:
                        raise ValueError(f"slot {x['slot']} of {feeds}")
                    if x["pixels"] is not None:
                        places[x["slot"]] = np.frombuffer(x["pixels"], np.uint8).reshape(x["height"], x["width"], 3)
                out.append(boxes.compose(places, cols, *tile, blank))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([x.shape[0] for x in out], pa.int32()), pa.array([x.shape[1] for x in out], pa.int32()), pa.array([x.tobytes() for x in out], pa.binary())], [*by, "height", "width", "pixels"])

    return held.select(*by, "tiles").mapInArrow(run, f"{kinds}, height int, width int, pixels binary")
