"""MCAP logs from the public format description: records, chunks, indexes, and a recovery scan."""

from __future__ import annotations

import functools
import io
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import zstandard

#: Fixed values of the format.
MAGIC = b"\x89MCAP0\r\n"
HEADER, FOOTER, SCHEMA, CHANNEL, MESSAGE, CHUNK, MESSAGE_INDEX, CHUNK_INDEX = 1, 2, 3, 4, 5, 6, 7, 8
#: Names of the kinds of records, for counting them.
NAMES = {1: "header", 2: "footer", 3: "schema", 4: "channel", 5: "message", 6: "chunk", 7: "message_index", 8: "chunk_index", 9: "attachment", 10: "attachment_index", 11: "statistics", 12: "metadata", 13: "metadata_index", 14: "summary_offset", 15: "data_end"}
ATTACHMENT, ATTACHMENT_INDEX, STATISTICS, METADATA, METADATA_INDEX, SUMMARY_OFFSET, DATA_END = 9, 10, 11, 12, 13, 14, 15


_MESSAGE = struct.Struct("<BQHIQQ")


class Corrupt(ValueError):
    """A record that contradicts others, unlike one that is merely cut off."""


@dataclass
class Schema:
    id: int
    name: str
    encoding: str
    data: bytes


@dataclass
class Channel:
    id: int
    schema_id: int
    topic: str
    encoding: str
    metadata: dict[str, str] = field(default_factory=dict)


@dataclass
class Message:
    channel_id: int
    sequence: int
    log_time: int
    publish_time: int
    data: bytes


@dataclass
class Attachment:
    log_time: int
    create_time: int
    name: str
    media_type: str
    data: bytes


@dataclass
class Metadata:
    name: str
    values: dict[str, str]


class _In:
    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.raw):
            raise EOFError("cut-off record")
        self.at += n
        return self.raw[self.at - n : self.at]

    def num(self, kind: str) -> int:
        return struct.unpack("<" + kind, self.take(struct.calcsize("<" + kind)))[0]

    def bytes_(self, kind: str = "I") -> bytes:
        return self.take(self.num(kind))

    def text(self) -> str:
        return self.bytes_().decode()

    def pairs(self, one) -> dict:
        inner, out = _In(self.bytes_()), {}
        while inner.at < len(inner.raw):
            k, v = one(inner)
            out[k] = v
        return out


def _text(s: str) -> bytes:
    raw = s.encode()
    return struct.pack("<I", len(raw)) + raw


def _record(op: int, body: bytes) -> bytes:
    return struct.pack("<BQ", op, len(body)) + body


def parse(op: int, body: bytes):
    x = _In(body)
    if op == SCHEMA:
        return Schema(x.num("H"), x.text(), x.text(), x.bytes_())
    if op == CHANNEL:
        return Channel(x.num("H"), x.num("H"), x.text(), x.text(), x.pairs(lambda y: (y.text(), y.text())))
    if op == MESSAGE:
        return Message(x.num("H"), x.num("I"), x.num("Q"), x.num("Q"), x.raw[x.at :])
    if op == ATTACHMENT:
        return Attachment(x.num("Q"), x.num("Q"), x.text(), x.text(), x.bytes_("Q"))
    if op == METADATA:
        return Metadata(x.text(), x.pairs(lambda y: (y.text(), y.text())))
    raise ValueError(f"no parser for record {op}")


def put(x: Attachment | Metadata) -> tuple[int, bytes]:
    """(kind, body) of such a record, as Writer.copy takes it."""
    if isinstance(x, Attachment):
        body = struct.pack("<QQ", x.log_time, x.create_time) + _text(x.name) + _text(x.media_type) + struct.pack("<Q", len(x.data)) + x.data
        return ATTACHMENT, body + struct.pack("<I", zlib.crc32(body))
    pairs = b"".join(_text(k) + _text(v) for k, v in x.values.items())
    return METADATA, _text(x.name) + struct.pack("<I", len(pairs)) + pairs


def _put(x: Schema | Channel | Message) -> bytes:
    if isinstance(x, Schema):
        return _record(SCHEMA, struct.pack("<H", x.id) + _text(x.name) + _text(x.encoding) + struct.pack("<I", len(x.data)) + x.data)
    if isinstance(x, Channel):
        meta = b"".join(_text(k) + _text(v) for k, v in x.metadata.items())
        return _record(CHANNEL, struct.pack("<HH", x.id, x.schema_id) + _text(x.topic) + _text(x.encoding) + struct.pack("<I", len(meta)) + meta)
    return _record(MESSAGE, struct.pack("<HIQQ", x.channel_id, x.sequence, x.log_time, x.publish_time) + x.data)


@functools.cache
def _zstd() -> zstandard.ZstdCompressor:
    """One for all chunks and logs of a worker: its tables cost more than a small log does."""
    return zstandard.ZstdCompressor()


class Writer:
    def __init__(self, out: BinaryIO, chunk_bytes: int = 1 << 20, compression: str = "zstd"):
        if compression not in ("", "zstd", "lz4"):
            raise ValueError(f"compression {compression!r} can't be written here")
        self.out, self.limit, self.compression, self.at = out, chunk_bytes, compression, 0
        self.schemas: dict[int, Schema] = {}
        self.channels: dict[int, Channel] = {}
        self.counts: dict[int, int] = {}
        self.chunks: list[bytes] = []
        self.extra: list[bytes] = []
        self.n_meta = self.n_attached = 0
        self.low = self.high = None
        self._write(MAGIC + _record(HEADER, _text("") + _text("riverlog")))
        self._begin()

    def _write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def _begin(self) -> None:
        self.part, self.size, self.index, self.span = [], 0, {}, None

    def add(self, x: Schema | Channel | Message) -> None:
        if isinstance(x, Schema):
            self.schemas[x.id] = x
        elif isinstance(x, Channel):
            if x.schema_id and x.schema_id not in self.schemas:
                raise Corrupt(f"channel {x.id} has unknown schema {x.schema_id}")
            self.channels[x.id] = x
        else:
            self.message(x.channel_id, x.sequence, x.log_time, x.publish_time, x.data)
            return
        self._append(_put(x))

    def message(self, channel_id: int, sequence: int, log_time: int, publish_time: int, data: bytes) -> None:
        if channel_id not in self.channels:
            raise Corrupt(f"message of unknown channel {channel_id}")
        if not (0 <= sequence < 1 << 32 and 0 <= log_time < 1 << 64 and 0 <= publish_time < 1 << 64):
            raise ValueError(f"sequence {sequence} must fit 32 bits, and times {log_time}, {publish_time} 64, without a sign")
        self.counts[channel_id] = self.counts.get(channel_id, 0) + 1
        self.index.setdefault(channel_id, []).append((log_time, self.size))
        span = self.span
        if span is None:
            self.span = log_time, log_time
        elif not span[0] <= log_time <= span[1]:
            self.span = min(span[0], log_time), max(span[1], log_time)
        self._append(_MESSAGE.pack(MESSAGE, 22 + len(data), channel_id, sequence, log_time, publish_time) + data)

    def _append(self, raw: bytes) -> None:
        self.part.append(raw)
        self.size += len(raw)
        if self.size >= self.limit:
            self._flush()

    def copy(self, op: int, body: bytes) -> None:
        """A metadata or attachment record as it is."""
        self._flush()
        self.n_meta += op == METADATA
        self.n_attached += op == ATTACHMENT
        self._write(_record(op, body))

    def _flush(self) -> None:
        if not self.part:
            return
        raw = b"".join(self.part)
        packed = raw
        if self.compression:
            packed = _zstd().compress(raw) if self.compression == "zstd" else pa.Codec("lz4").compress(raw, asbytes=True)
        low, high = self.span or (0, 0)
        start = self.at
        self._write(_record(CHUNK, struct.pack("<QQQI", low, high, len(raw), zlib.crc32(raw)) + _text(self.compression) + struct.pack("<Q", len(packed)) + packed))
        length, offsets = self.at - start, b""
        first = self.at
        for channel, rows in sorted(self.index.items()):
            offsets += struct.pack("<HQ", channel, self.at)
            body = b"".join(struct.pack("<QQ", *r) for r in rows)
            self._write(_record(MESSAGE_INDEX, struct.pack("<HI", channel, len(body)) + body))
        self.chunks.append(_record(CHUNK_INDEX, struct.pack("<QQQQI", low, high, start, length, len(offsets)) + offsets + struct.pack("<Q", self.at - first) + _text(self.compression) + struct.pack("<QQ", len(packed), len(raw))))
        if self.span:
            self.low = low if self.low is None else min(self.low, low)
            self.high = high if self.high is None else max(self.high, high)
        self._begin()

    def close(self) -> None:
        self._flush()
        self._write(_record(DATA_END, struct.pack("<I", 0)))
        start = self.at
        counts = b"".join(struct.pack("<HQ", *x) for x in sorted(self.counts.items()))
        stats = struct.pack("<QHIIIIQQI", sum(self.counts.values()), len(self.schemas), len(self.channels), self.n_attached, self.n_meta, len(self.chunks), self.low or 0, self.high or 0, len(counts)) + counts
        self._write(b"".join(map(_put, [*self.schemas.values(), *self.channels.values()])) + _record(STATISTICS, stats) + b"".join(self.chunks))
        self._write(_record(FOOTER, struct.pack("<QQI", start, 0, 0)) + MAGIC)


@dataclass
class ChunkAt:
    low: int
    high: int
    offset: int
    length: int
    channels: frozenset[int]


@dataclass
class Summary:
    schemas: dict[int, Schema]
    channels: dict[int, Channel]
    chunks: list[ChunkAt]
    messages: int


def read_summary(f: BinaryIO) -> Summary:
    """Of a finished file; Corrupt if there is none."""
    f.seek(0, io.SEEK_END)
    size = f.tell()
    tail = 9 + 20 + len(MAGIC)
    if size < 2 * len(MAGIC) + tail:
        raise Corrupt("too short for a log")
    f.seek(size - tail)
    raw = f.read(tail)
    if raw[-len(MAGIC) :] != MAGIC or raw[0] != FOOTER:
        raise Corrupt("no footer: the log was not finished")
    start = struct.unpack_from("<Q", raw, 9)[0]
    if not start:
        raise Corrupt("no summary")
    f.seek(start)
    out = Summary({}, {}, [], 0)
    for op, body in records(io.BytesIO(f.read(size - tail - start))):
        if op == SCHEMA:
            s = parse(op, body)
            out.schemas[s.id] = s
        elif op == CHANNEL:
            c = parse(op, body)
            out.channels[c.id] = c
        elif op == STATISTICS:
            out.messages = struct.unpack_from("<Q", body)[0]
        elif op == CHUNK_INDEX:
            x = _In(body)
            low, high, at, length = (x.num("Q") for _ in range(4))
            out.chunks.append(ChunkAt(low, high, at, length, frozenset(x.pairs(lambda y: (y.num("H"), y.num("Q"))))))
    return out


def records(f: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """Records from where f stands; EOFError at a cut-off one."""
    while head := f.read(9):
        if len(head) < 9:
            if MAGIC.startswith(head) or head == MAGIC:
                return
            raise EOFError("cut-off record")
        if head[:8] == MAGIC:
            return
        op, n = struct.unpack("<BQ", head)
        body = f.read(n)
        if len(body) < n:
            raise EOFError("cut-off record")
        yield op, body
        if op == FOOTER:
            return


def open_chunk(body: bytes) -> bytes:
    x = _In(body)
    _, _, size, crc = x.num("Q"), x.num("Q"), x.num("Q"), x.num("I")
    how, raw = x.text(), x.bytes_("Q")
    try:
        if how == "zstd":
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
        elif how == "lz4":
            raw = pa.Codec("lz4").decompress(raw, decompressed_size=size, asbytes=True)
    except (zstandard.ZstdError, pa.ArrowException, OSError) as e:
        raise EOFError(f"a chunk can't be opened: {e}") from e
    if how not in ("", "zstd", "lz4"):
        raise NotImplementedError(f"chunks compressed with {how} can't be read here")
    if len(raw) != size or crc and zlib.crc32(raw) != crc:
        raise Corrupt("a chunk's checksum does not fit")
    return raw


def chunk_messages(f: BinaryIO, at: ChunkAt, channels: set[int] | None = None, low: int | None = None, high: int | None = None) -> Iterator[tuple[int, Message]]:
    """(place, message) of one chunk, by log time."""
    f.seek(at.offset)
    op, body = next(records(io.BytesIO(f.read(at.length))))
    found = []
    for k, (op, body) in enumerate(records(io.BytesIO(open_chunk(body)))):
        if op == MESSAGE and (channels is None or struct.unpack_from("<H", body)[0] in channels):
            m = parse(op, body)
            if (low is None or m.log_time >= low) and (high is None or m.log_time <= high):
                found.append((k, m))
    return iter(sorted(found, key=lambda x: (x[1].log_time, x[0])))


@dataclass
class Found:
    """Messages of an opened chunk: numbers as arrays, and where their data lie in it."""

    raw: bytes
    place: np.ndarray
    channel: np.ndarray
    sequence: np.ndarray
    log_time: np.ndarray
    publish_time: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def picked(self, rows: np.ndarray) -> Found:
        return Found(self.raw, *(x[rows] for x in (self.place, self.channel, self.sequence, self.log_time, self.publish_time, self.start, self.end)))


def find_messages(f: BinaryIO, at: ChunkAt) -> Found:
    """Of one chunk, in its order. Only record heads are gone through one by one; fields are taken out of all messages at once."""
    f.seek(at.offset)
    op, body = next(records(io.BytesIO(f.read(at.length))))
    raw = open_chunk(body)
    begins, ends, places, i, k = [], [], [], 0, 0
    while i < len(raw):
        end = i + 9 + int.from_bytes(raw[i + 1 : i + 9], "little")
        if raw[i] == MESSAGE:
            begins.append(i)
            ends.append(end)
            places.append(k)
        i, k = end, k + 1
    if i != len(raw):
        raise Corrupt("a chunk ends within a record")
    begin, data = np.array(begins, np.int64), np.frombuffer(raw, np.uint8)
    take = lambda skip, kind: data[begin[:, None] + np.arange(skip, skip + np.dtype(kind).itemsize)].reshape(-1).view(kind).astype(np.int64)
    return Found(raw, np.array(places, np.int64), take(9, "<u2"), take(11, "<u4"), take(15, "<u8"), take(23, "<u8"), begin + 31, np.array(ends, np.int64))


def scan(f: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """All records in file order, chunks opened, without any index; stops before the first that can't be read."""
    f.seek(0)
    if f.read(len(MAGIC)) != MAGIC:
        raise Corrupt("not a log")
    try:
        for op, body in records(f):
            if op == CHUNK:
                yield from records(io.BytesIO(open_chunk(body)))
            else:
                yield op, body
    except EOFError:
        return


def repair(source: BinaryIO, out: BinaryIO) -> dict:
    """A finished log of all that can be read, attachments and metadata with it; contradictions are raised, not swallowed."""
    w, kinds, n = Writer(out), {}, 0
    low = high = None
    ended = True
    for op, body in scan(source):
        kinds[op] = kinds.get(op, 0) + 1
        if op in (SCHEMA, CHANNEL, MESSAGE):
            x = parse(op, body)
            if isinstance(x, Message):
                n += 1
                low = x.log_time if low is None else min(low, x.log_time)
                high = x.log_time if high is None else max(high, x.log_time)
            w.add(x)
        elif op in (METADATA, ATTACHMENT):
            w.copy(op, body)
        elif op == DATA_END:
            ended = False
            break
    w.close()
    return {"messages": n, "channels": len(w.channels), "schemas": len(w.schemas), "start": low, "end": high, "records": kinds, "ended_early": ended}
