"""Files as rows: what a folder holds, digests by bounded reads, and containers probed without reading their media."""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from riverlog.sources.folders import file_system

#: Bytes read at once.
CHUNK = 1 << 20
#: Endings of container files, and names of their boxes: fixed values.
CONTAINERS = (".mp4", ".m4v", ".mov")
PARENTS = {b"moov", b"trak", b"mdia", b"minf", b"stbl"}
CONTAINER = "file string, status string, codec string, width int, height int, rotation int, frames long, timescale long, duration long, fps double, bytes long"


def listed(path: str, endings: tuple[str, ...] = ("",)) -> list[tuple[str, int]]:
    """(path, bytes) of the files of a folder itself, by name, or of a file."""
    fs, at = file_system(path)
    info, prefix = fs.get_file_info(at), path.rstrip("/")
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    return sorted((f"{prefix}/{x.base_name}", x.size) for x in fs.get_file_info(pafs.FileSelector(at)) if x.type == pafs.FileType.File and x.base_name.endswith(endings) and not x.base_name.startswith((".", "_")))


def each_file(spark: SparkSession, files: list[tuple[str, int]], one: Callable[[BinaryIO, str, int], tuple], schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """one(open file, name, bytes) for each file, in tasks of about as many files each; the list of names is all the driver holds."""
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for uri, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, at = file_system(uri)
                with fs.open_input_file(at) as f:
                    rows.append(one(f, uri.rsplit("/", 1)[-1], size))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names)

    return spark.createDataFrame(files, "path string, bytes long").repartition(max(1, min(len(files), 1024))).mapInArrow(run, schema)


def digest_files(spark: SparkSession, path: str, endings: tuple[str, ...] = ("",)) -> DataFrame:
    """file, bytes, sha256 of each file, whatever its size: a task holds CHUNK bytes of it at a time."""

    def one(f: BinaryIO, name: str, size: int) -> tuple:
        total = hashlib.sha256()
        while part := f.read(CHUNK):
            total.update(part)
        return name, size, total.hexdigest()

    return each_file(spark, listed(path, endings), one, "file string, bytes long, sha256 string", [pa.string(), pa.int64(), pa.string()])


def boxes(f: BinaryIO, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(name, first byte of its content, end) of the boxes between two places; only their heads are read."""
    while start + 8 <= end:
        f.seek(start)
        head = f.read(16)
        size, name, skip = *struct.unpack(">I4s", head[:8]), 8
        if size == 1:
            if len(head) < 16:
                raise ValueError("a box's head is cut off")
            size, skip = struct.unpack(">Q", head[8:16])[0], 16
        size = end - start if size == 0 else size
        if size < skip or start + size > end:
            raise ValueError(f"box {name!r} does not fit its place")
        yield name, start + skip, start + size
        start += size


def probe_container(f: BinaryIO, size: int) -> dict | None:
    """codec, width, height, rotation, frames, timescale and duration of a container's first video track; None where it has none.

    rotation is how far a player turns the frames, to the left, as 0, 90, 180 or 270. Sizes are the coded ones. Boxes are gone through by
    their heads, and of the leaves only what is asked for is read: neither the media nor tables of samples.
    """

    def read(at: int, form: str) -> tuple:
        f.seek(at)
        raw = f.read(struct.calcsize(form))
        if len(raw) < struct.calcsize(form):
            raise ValueError("a box is cut off")
        return struct.unpack(form, raw)

    def track(start: int, end: int, out: dict) -> dict:
        for name, a, b in boxes(f, start, end):
            if name in PARENTS:
                track(a, b, out)
            elif name == b"tkhd":
                wide = read(a, ">B")[0] == 1
                one, two = read(a + (52 if wide else 40), ">ii")
                out["rotation"] = round(-math.degrees(math.atan2(two, one)) / 90) * 90 % 360
            elif name == b"mdhd":
                out["timescale"], out["duration"] = read(a + 20, ">IQ") if read(a, ">B")[0] == 1 else read(a + 12, ">II")
            elif name == b"hdlr":
                out["kind"] = read(a + 8, ">4s")[0]
            elif name == b"stsd" and read(a + 4, ">I")[0]:
                out["codec"] = read(a + 12, ">4s")[0].decode("latin-1")
                out["width"], out["height"] = read(a + 8 + 32, ">HH")
            elif name == b"stsz":
                out["frames"] = read(a + 8, ">I")[0]
        return out

    for name, a, b in boxes(f, 0, size):
        if name == b"moov":
            for inner, c, d in boxes(f, a, b):
                if inner == b"trak" and (found := track(c, d, {})).pop("kind", None) == b"vide":
                    return found
    return None


def probe_containers(spark: SparkSession, path: str) -> DataFrame:
    """CONTAINER: a row for each container file of a folder; status is ok, no video, or what is wrong with the file."""

    def one(f: BinaryIO, name: str, size: int) -> tuple:
        try:
            x = probe_container(f, size)
        except ValueError as e:
            return name, f"broken: {e}", *[None] * 8, size
        if x is None:
            return name, "no video", *[None] * 8, size
        fps = x["frames"] * x["timescale"] / x["duration"] if x.get("duration") and x.get("frames") is not None else None
        return name, "ok", *(x.get(c) for c in ("codec", "width", "height", "rotation", "frames", "timescale", "duration")), fps, size

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    return each_file(spark, listed(path, CONTAINERS), one, CONTAINER, [kinds[c.split(" ")[1]] for c in CONTAINER.split(", ")])


def container(width: int, height: int, rotation: int, frames: int, timescale: int, duration: int, codec: str = "avc1", media: int = 0) -> bytes:
    """A container of one video track with so many bytes of media, for made-up files."""
    box = lambda name, *parts: struct.pack(">I4s", 8 + sum(map(len, parts)), name) + b"".join(parts)
    turn = {0: (1, 0, 0, 1), 90: (0, -1, 1, 0), 180: (-1, 0, 0, -1), 270: (0, 1, -1, 0)}[rotation]
    matrix = b"".join(struct.pack(">i", x) for x in (turn[0] << 16, turn[1] << 16, 0, turn[2] << 16, turn[3] << 16, 0, 0, 0, 1 << 30))
    entry = struct.pack(">I4s6xH16xHHII4xH32xHh", 86, codec.encode(), 1, width, height, 72 << 16, 72 << 16, 1, 24, -1)
    table = box(b"stbl", box(b"stsd", struct.pack(">II", 0, 1), entry), box(b"stsz", struct.pack(">III", 0, 1, frames)))
    inside = box(b"mdia", box(b"mdhd", struct.pack(">IIIIIHH", 0, 0, 0, timescale, duration, 0, 0)), box(b"hdlr", struct.pack(">II4s12x", 0, 0, b"vide"), b"\x00"), box(b"minf", table))
    track = box(b"trak", box(b"tkhd", struct.pack(">IIIIII8xHHHH", 7, 0, 0, 1, 0, duration, 0, 0, 0, 0), matrix, struct.pack(">II", width << 16, height << 16)), inside)
    return box(b"ftyp", b"isom\x00\x00\x02\x00") + struct.pack(">I4sQ", 1, b"mdat", 16 + media) + b"\x00" * media + box(b"moov", track)
