"""The "mcap" data source: spark.read.format("mcap").load(folder or file), df.write.format("mcap").save(folder).

Options for reading: path; records = messages | channels | statistics | records; mode = indexed | sequential; payload = true | false;
only = keyframes; first = n; split_bytes; broken = error | skip, for channels. Small files share a task, large ones are several, by where their chunks begin; files are opened in tasks
alone. Filters on topic, schema_name and log_time reach the chunk index. records = records has a row for each record of any kind up to the
end of a log's data. only = keyframes gives video messages that hold a keyframe: in field 3 of the payload where the channel's encoding is
protobuf, else in the payload itself. first = n stops once it has n messages of each channel, the chunks taken by their first times.

Options for writing: compression = zstd | lz4 | none; split; folders = true | false.

folders = true, when writing and when reading: the logs stand in folders of the folder, of LOGS_A_FOLDER logs at most, which tasks list. So the
driver knows the folders alone, where there are too many logs for one list. Such a folder is written once; a name is one log's among all.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from riverlog.functions import video, wire
from riverlog.sources import files, mcap
from riverlog.sources.folders import file_system, scratch

MESSAGES = "file string, topic string, schema_name string, schema_encoding string, schema_data binary, message_encoding string, metadata map<string,string>, channel_id int, ordinal long, sequence long, log_time long, publish_time long, data binary"
CHANNELS = "file string, channel_id int, topic string, message_encoding string, schema_id int, schema_name string, metadata map<string,string>"
STATISTICS = "file string, status string, messages long, channels int, chunks int"
RECORDS = "file string, ordinal long, kind string, bytes long, channel_id int, topic string, schema_id int, schema_name string, log_time long, name string, media_type string, metadata map<string,string>, content binary"
SCHEMAS = {"messages": MESSAGES, "channels": CHANNELS, "statistics": STATISTICS, "records": RECORDS}
SPLIT_BYTES, FILES_A_TASK = 64 << 20, 256
#: Logs in a folder that tasks write, and folders' tasks at most in a read of folders.
LOGS_A_FOLDER, FOLDER_TASKS = 256, 4096
BATCH_ROWS, BATCH_BYTES = 8192, 4 << 20
#: A log takes so many rows of a batch as Python values at once.
LOG_ROWS = 256
_KINDS = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "map<string,string>": pa.map_(pa.string(), pa.string())}
ARROW = {k: pa.schema([(c.split(" ")[0], _KINDS[c.split(" ")[1]]) for c in s.split(", ")]) for k, s in SCHEMAS.items()}
#: Schema name of video messages: fixed value.
VIDEO = "foxglove.CompressedVideo"


def _array(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array([list(x.items()) if isinstance(x, dict) else x for x in values] if pa.types.is_map(kind) else values, kind)


def keyframes(spark: SparkSession, path: str) -> DataFrame:
    """Video messages of the logs at path that hold a keyframe; the others do not leave the reader."""
    return spark.read.format("mcap").option("only", "keyframes").load(path)


def _listed(path: str) -> list[tuple[str, int]]:
    fs, at = file_system(path)
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    prefix = path.rstrip("/")
    return sorted((f"{prefix}/{x.base_name}", x.size) for x in fs.get_file_info(pafs.FileSelector(at)) if x.type == pafs.FileType.File and x.base_name.endswith(".mcap"))


def _files(path: str) -> list[str]:
    return [f for f, _ in _listed(path)]


def _open(path: str):
    fs, at = file_system(path)
    return fs.open_input_file(at)


def _folders(path: str) -> list[str]:
    fs, at = file_system(path)
    prefix = path.rstrip("/")
    return sorted(f"{prefix}/{x.base_name}" for x in fs.get_file_info(pafs.FileSelector(at)) if x.type == pafs.FileType.Directory and not x.base_name.startswith((".", "_")))


class Piece(InputPartition):
    """(file, first byte, end byte) of each part of a log that a task reads; (folder, None, None): all its logs."""

    def __init__(self, parts: list[tuple[str, int, int]]):
        self.parts = parts


class McapReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.what, self.mode = options["path"], options.get("records", "messages"), options.get("mode", "indexed")
        self.payload, self.split_bytes = options.get("payload", "true").lower() == "true", int(options.get("split_bytes", SPLIT_BYTES))
        self.folders = options.get("folders", "false").lower() == "true"
        self.only = options.get("only")
        if self.only not in (None, "keyframes") or self.only and (self.what != "messages" or self.mode == "sequential"):
            raise ValueError("only = keyframes goes with messages by index")
        self.broken = options.get("broken", "error")
        self.first = int(options.get("first", 0))
        self.topics: set[str] | None = None
        self.schemas: set[str] | None = {VIDEO} if self.only else None
        self.low: int | None = None
        self.high: int | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            kind, name = type(f), f.attribute[0] if self.what == "messages" and len(f.attribute) == 1 else None
            if name in ("topic", "schema_name") and kind in (EqualTo, In):
                wanted, own = {f.value} if kind is EqualTo else set(f.value), "topics" if name == "topic" else "schemas"
                held = getattr(self, own)
                setattr(self, own, wanted if held is None else held & wanted)
            elif name == "log_time" and kind in (GreaterThan, GreaterThanOrEqual):
                low = f.value + (kind is GreaterThan)
                self.low = low if self.low is None else max(self.low, low)
            elif name == "log_time" and kind in (LessThan, LessThanOrEqual):
                high = f.value - (kind is LessThan)
                self.high = high if self.high is None else min(self.high, high)
            else:
                yield f

    def partitions(self) -> list[Piece]:
        if self.folders:
            found = [(f, None, None) for f in _folders(self.path)]
            most = max(1, -(-len(found) // FOLDER_TASKS))
            return [Piece(found[i : i + most]) for i in range(0, len(found), most)] or [Piece([])]
        out, held, size = [], [], 0
        whole = self.what != "messages" or self.mode == "sequential" or self.first
        logs = _listed(self.path)
        most = min(FILES_A_TASK, max(16, len(logs) // 256))  # few logs are few tasks' work, but not one task's
        for file, n in logs:
            step = max(1, n if whole else self.split_bytes)
            for a in range(0, max(1, n), step):
                held.append((file, a, min(n, a + step)))
                size += min(n, a + step) - a
                if size >= self.split_bytes or len(held) >= most:
                    out.append(Piece(held))
                    held, size = [], 0
        return [*out, Piece(held)] if held or not out else out

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        """Arrow batches of about BATCH_ROWS rows or BATCH_BYTES of payload."""
        held, rows, size = [], 0, 0
        for b in self._batches(piece):
            held.append(b)
            rows += b.num_rows
            size += b.nbytes
            if rows >= BATCH_ROWS or size >= BATCH_BYTES:
                yield pa.concat_batches(held)
                held, rows, size = [], 0, 0
        if held:
            yield pa.concat_batches(held)

    def _batches(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        schema = ARROW[self.what]
        parts = ((file, a, b) if b is not None else (f, 0, max(1, n)) for file, a, b in piece.parts for f, n in (_listed(file) if b is None else [(file, b)]))
        for file, a, b in parts:
            name = file.rsplit("/", 1)[-1]
            with _open(file) as f:
                if self.what == "messages" and self.mode != "sequential":
                    yield from self._chunks(f, name, a, b)
                    continue
                rows, size = [], 0
                for row in self._rows(f, name):
                    rows.append(row)
                    size += len(row[-1]) if isinstance(row[-1], bytes) else 0
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([_array(c, k.type) for c, k in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([_array(c, k.type) for c, k in zip(zip(*rows), schema)], schema=schema)

    def _wanted(self, s: mcap.Summary) -> list[mcap.Channel]:
        name = lambda c: s.schemas[c.schema_id].name if c.schema_id else None
        return [c for c in s.channels.values() if (self.topics is None or c.topic in self.topics) and (self.schemas is None or name(c) in self.schemas)]

    def _chunks(self, f, name: str, a: int, b: int) -> Iterator[pa.RecordBatch]:
        """Messages of the chunks that begin between bytes a and b of a log, each chunk's by log time."""
        s = mcap.read_summary(f)
        channels = self._wanted(s)
        every, numbers = len(channels) == len(s.channels), np.array([c.id for c in channels], np.int64)
        schema = [s.schemas.get(c.schema_id) if c.schema_id else None for c in channels]
        of_channel = [[name] * len(channels), [c.topic for c in channels], *([getattr(x, y) if x else None for x in schema] for y in ("name", "encoding", "data")), [c.encoding for c in channels], [c.metadata for c in channels], numbers.tolist()]
        fixed = [_array(v, k.type) for v, k in zip(of_channel, ARROW["messages"])]
        sorter = np.argsort(numbers)
        wanted = dict.fromkeys(numbers.tolist(), self.first or 1)
        for i, at in sorted(enumerate(s.chunks), key=lambda x: x[1].low) if self.first else enumerate(s.chunks):
            if self.first and at.channels and at.channels.isdisjoint(wanted) or not a <= at.offset < b or not every and at.channels.isdisjoint(numbers.tolist()) or self.low is not None and at.high < self.low or self.high is not None and at.low > self.high:
                continue
            m = mcap.find_messages(f, at)
            if unknown := set(np.unique(m.channel).tolist()) - set(s.channels):
                raise mcap.Corrupt(f"message of unknown channel {min(unknown)}")
            keep = np.ones(len(m.place), bool) if every else np.isin(m.channel, numbers)
            if self.low is not None:
                keep &= m.log_time >= self.low
            if self.high is not None:
                keep &= m.log_time <= self.high
            m = m.picked(np.flatnonzero(keep))
            m = m.picked(np.lexsort((m.place, m.log_time)))
            if self.only:
                m = m.picked(np.array([k for k, (c, x, y) in enumerate(zip(m.channel.tolist(), m.start.tolist(), m.end.tolist())) if _is_key(m.raw[x:y], s.channels[c].encoding)], np.int64))
            if self.first:
                rows = []
                for k, c in enumerate(m.channel.tolist()):
                    if c in wanted:
                        rows.append(k)
                        wanted[c] -= 1
                        if not wanted[c]:
                            del wanted[c]
                m = m.picked(np.array(rows, np.int64))
            if not len(m.place):
                continue
            which = pa.array(sorter[np.searchsorted(numbers, m.channel, sorter=sorter)])
            data = pa.array([m.raw[x:y] for x, y in zip(m.start.tolist(), m.end.tolist())], pa.binary()) if self.payload else pa.nulls(len(m.place), pa.binary())
            yield pa.RecordBatch.from_arrays([*(c.take(which) for c in fixed), *map(pa.array, ((i << 32) + m.place, m.sequence, m.log_time, m.publish_time)), data], schema=ARROW["messages"])
            if not wanted:
                return

    def _rows(self, f, name: str) -> Iterator[tuple]:
        if self.what == "statistics":
            try:
                s = mcap.read_summary(f)
                yield name, "ok", s.messages, len(s.channels), len(s.chunks)
            except ValueError as e:
                yield name, f"broken: {e}", None, None, None
        elif self.what == "channels":
            try:
                s = mcap.read_summary(f)
            except ValueError:
                if self.broken == "skip":
                    return
                raise
            for c in s.channels.values():
                yield name, c.id, c.topic, c.encoding, c.schema_id, s.schemas[c.schema_id].name if c.schema_id else None, c.metadata
        else:
            schemas, channels = {}, {}
            for k, (op, body) in enumerate(mcap.scan(f)):
                x = mcap.parse(op, body) if op in (mcap.SCHEMA, mcap.CHANNEL, mcap.MESSAGE, mcap.ATTACHMENT, mcap.METADATA) else None
                if op == mcap.SCHEMA:
                    schemas[x.id] = x
                elif op == mcap.CHANNEL:
                    if x.schema_id and x.schema_id not in schemas:
                        raise mcap.Corrupt(f"channel {x.id} has unknown schema {x.schema_id}")
                    channels[x.id] = x
                elif op == mcap.MESSAGE and x.channel_id not in channels:
                    raise mcap.Corrupt(f"message of unknown channel {x.channel_id}")
                if self.what == "records":
                    yield self._record(name, k, op, body, x, channels, schemas)
                    if op == mcap.DATA_END:
                        return
                elif op == mcap.MESSAGE:
                    c = channels[x.channel_id]
                    s = schemas.get(c.schema_id)
                    if (self.topics is None or c.topic in self.topics) and (self.schemas is None or (s and s.name) in self.schemas) and (self.low is None or x.log_time >= self.low) and (self.high is None or x.log_time <= self.high):
                        yield name, c.topic, s and s.name, s and s.encoding, s and s.data, c.encoding, c.metadata, c.id, k, x.sequence, x.log_time, x.publish_time, x.data if self.payload else None

    def _record(self, file: str, k: int, op: int, body: bytes, x, channels: dict, schemas: dict) -> tuple:
        c = channels[x.channel_id] if op == mcap.MESSAGE else x if op == mcap.CHANNEL else None
        s = x if op == mcap.SCHEMA else schemas.get(c.schema_id) if c and c.schema_id else None
        content = x.data if self.payload and op in (mcap.MESSAGE, mcap.SCHEMA, mcap.ATTACHMENT) else None
        meta = x.values if op == mcap.METADATA else x.metadata if op == mcap.CHANNEL else None
        return file, k, mcap.NAMES.get(op, f"unknown {op}"), len(body), c and c.id, c and c.topic, s and s.id, s and s.name, getattr(x, "log_time", None), x.name if op in (mcap.ATTACHMENT, mcap.METADATA) else None, x.media_type if op == mcap.ATTACHMENT else None, meta, content


def _is_key(data: bytes, encoding: str) -> bool:
    codec = "h264"
    if encoding == "protobuf":
        fields = wire.fields(data)
        data, codec = fields.get(3, b""), fields.get(4, b"h264").decode("utf-8", "replace")
    return bool(data) and wire.is_keyframe(data, codec)


class Wrote(WriterCommitMessage):
    """A task's own folder aside: so many numbered folders of logs, and a file of the logs' names in order."""

    def __init__(self, own: str, folders: int):
        self.own, self.folders = own, folders


def file_name(value: object) -> str:
    """A split value as the name of a file, without the ending; characters that would lead elsewhere are written as %XX."""
    if value is None:
        raise ValueError("a row has no value to name its log by")
    return re.sub(r"[/\\%:\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))


class McapWriter(DataSourceArrowWriter):
    """One file for each non-empty partition, or with the option `split` for each value of that column, by which partitions are then
    sorted. Files are written aside and moved into place when all tasks are done. A log of a taken name is an error when appending.

    The driver gets a task's folder from it, not the names of its logs, and goes through those a folder at a time."""

    def __init__(self, options: dict, overwrite: bool, names: list[str]):
        self.path, self.overwrite, self.names = options["path"].rstrip("/"), overwrite, names
        self.compression, self.split = options.get("compression", "zstd"), options.get("split")
        self.compression = "" if self.compression == "none" else self.compression
        self.folders, self.aside = options.get("folders", "false").lower() == "true", f".{uuid.uuid4().hex}.part"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Wrote:
        fs, root = file_system(self.path)
        own = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:8]}"
        at, names, name, log = f"{root}/{self.aside}/{own}", set(), None, None
        folders = logs = size = 0
        try:
            for b in batches:
                for wanted, part in self._split(b, own):
                    if wanted != name:
                        if log is not None:
                            log.close()
                            size += log.writer.at
                        if wanted in names:
                            raise ValueError(f"rows of one {self.split} are not together: repartition and sort by it")
                        if not folders or logs >= LOGS_A_FOLDER or size >= SPLIT_BYTES:
                            fs.create_dir(f"{at}/{folders:05d}", recursive=True)
                            folders, logs, size = folders + 1, 0, 0
                        names.add(wanted)
                        name, logs = wanted, logs + 1
                        log = _Log(fs.open_output_stream(f"{at}/{folders - 1:05d}/{wanted}.mcap"), self.compression)
                    log.add(part)
            if log is not None:
                log.close()
                with fs.open_output_stream(f"{at}/names") as f:
                    f.write(b"".join(sorted(x.encode() + b"\n" for x in names)))
        except BaseException:
            if folders:
                fs.delete_dir(at)
            raise
        return Wrote(own, folders)

    def _split(self, b: pa.RecordBatch, own: str) -> Iterator[tuple[str, pa.RecordBatch]]:
        """(name, rows that belong to it) in order."""
        if not b.num_rows:
            return
        b = b.rename_columns(self.names)
        if not self.split:
            yield own, b
            return
        values, a = [file_name(x) for x in b.column(b.schema.get_field_index(self.split)).to_pylist()], 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[a]:
                yield values[a], b.slice(a, i - a)
                a = i

    def commit(self, messages: list[Wrote]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        done = [m for m in messages if m and m.folders]
        there = {x.base_name for x in fs.get_file_info(pafs.FileSelector(root)) if x.base_name.endswith(".mcap") or self.folders and x.type == pafs.FileType.Directory and not x.base_name.startswith((".", "_"))}
        gone, last, wrong = set(there), None, None
        if self.folders and there and not self.overwrite:
            wrong = FileExistsError(f"{root} holds logs already, and folders of logs are written once")
        for name in heapq.merge(*(_lines(fs, f"{root}/{self.aside}/{m.own}/names") for m in done)):
            log = f"{name.decode()}.mcap"
            if log in gone and not self.overwrite:
                wrong = wrong or FileExistsError(f"there is a log {root}/{log} already")
            if name == last:
                wrong = wrong or ValueError(f"rows of one {self.split} are not together: repartition and sort by it")
            if wrong:
                break
            gone.discard(log)
            last = name
        if wrong:
            self.abort(messages)
            raise wrong
        with ThreadPoolExecutor(16) as pool:
            for at, to in ((f"{root}/{self.aside}/{m.own}/{k:05d}", f"{root}/{m.own}-{k:05d}") for m in done for k in range(m.folders)):
                if self.folders and fs.type_name in ("local", "hdfs"):
                    fs.move(at, to)
                    continue
                to = to if self.folders else root
                fs.create_dir(to, recursive=True)
                list(pool.map(lambda x: fs.move(x.path, f"{to}/{x.base_name}"), fs.get_file_info(pafs.FileSelector(at))))  # noqa: B023
            if self.overwrite:
                list(pool.map(lambda x: fs.delete_file(f"{root}/{x}") if x.endswith(".mcap") else fs.delete_dir(f"{root}/{x}"), gone))
        self.abort(messages)

    def abort(self, messages: list[Wrote]) -> None:
        """What is aside goes, also that of tasks that failed."""
        fs, root = file_system(self.path)
        if fs.get_file_info(f"{root}/{self.aside}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.aside}")


def _lines(fs: pafs.FileSystem, path: str, part: int = 1 << 14) -> Iterator[bytes]:
    """A file's lines, some of them held at a time and the file open for those alone: there is one for each task."""
    at, rest, raw = 0, b"", b"\n"
    while raw:
        with fs.open_input_file(path) as f:
            f.seek(at)
            raw = f.read(part)
        at += len(raw)
        *lines, rest = (rest + raw).split(b"\n")
        yield from lines


class _Log:
    """A log that takes rows of Arrow batches; schemas and channels are numbered as they come."""

    def __init__(self, out, compression: str):
        self.out, self.writer, self.channels, self.schemas = out, mcap.Writer(out, compression=compression), {}, {}

    def add(self, rows: pa.RecordBatch) -> None:
        for i in range(0, rows.num_rows, LOG_ROWS):
            self._add(rows.slice(i, LOG_ROWS))

    def _add(self, rows: pa.RecordBatch) -> None:
        n, at = rows.num_rows, {c: i for i, c in enumerate(rows.schema.names)}
        column = lambda c: rows.column(at[c]).to_pylist() if c in at else repeat(None, n)
        meta = (tuple(sorted(dict(m or ()).items())) for m in column("metadata")) if "metadata" in at else repeat((), n)
        keys = zip(column("topic"), column("schema_name"), column("schema_encoding"), column("schema_data"), column("message_encoding"), meta, column("channel_id"))
        put, known = self.writer.message, self.channels
        for key, sequence, log_time, published, data in zip(keys, column("sequence"), column("log_time"), column("publish_time"), column("data")):
            number = known.get(key)
            if number is None:
                number = self._channel(key)
            put(number, sequence or 0, log_time, log_time if published is None else published, data or b"")

    def _channel(self, key: tuple) -> int:
        topic, name, encoding, data, message_encoding, meta, _ = key
        schema = 0
        if name is not None:
            schema = self.schemas.get(key[1:4], 0)
            if not schema:
                schema = self.schemas[key[1:4]] = len(self.schemas) + 1
                self.writer.add(mcap.Schema(schema, name, encoding or "", data or b""))
        number = self.channels[key] = len(self.channels) + 1
        self.writer.add(mcap.Channel(number, schema, topic, message_encoding or "", dict(meta)))
        return number

    def close(self) -> None:
        self.writer.close()
        self.out.close()


class McapDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mcap"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("records", "messages")]

    def reader(self, schema) -> McapReader:
        return McapReader(self.options)

    def writer(self, schema, overwrite: bool) -> McapWriter:
        return McapWriter(self.options, overwrite, schema.names)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(McapDataSource)


def scan_status(spark: SparkSession, path: str, copy_unreadable: bool = True) -> DataFrame:
    """file, status, reason: what a run over a folder of logs has to do with each. "scan": it has video channels. "copied": it is whole and
    has none, so it may pass as it is. "copied_unscanned": it can't be read, and nothing says what is in it ("error", unless such logs are to
    be copied)."""
    read = spark.read.format("mcap")
    video = read.option("records", "channels").option("broken", "skip").load(path).where(F.col("schema_name") == VIDEO).select("file").distinct().withColumn("_video", F.lit(True))
    met = read.option("records", "statistics").load(path).join(video, "file", "left")
    bad = F.col("status") != "ok"
    status = F.when(bad, "copied_unscanned" if copy_unreadable else "error").when(F.col("_video"), "scan").otherwise("copied")
    return met.select("file", status.alias("status"), F.when(bad, F.col("status")).when(F.col("_video").isNull(), "no video channels").alias("reason"))


def pass_through(spark: SparkSession, path: str, target: str, copy_unreadable: bool = True) -> DataFrame:
    """file, status, reason, bytes, sha256: copies the logs of a folder that scan_status() says may pass, byte by byte, and reports all of
    them; those not copied have no digest. A file is written aside and moved into place when whole; a taken name is an error."""
    statuses = scan_status(spark, path, copy_unreadable)
    wanted = {r["file"] for r in statuses.where("status LIKE 'copied%'").select("file").collect()}  # a list of names
    there = {f.rsplit("/", 1)[-1] for f, _ in files.listed(target)} if file_system(target)[0].get_file_info(file_system(target)[1]).type == pafs.FileType.Directory else set()
    if taken := sorted(wanted & there):
        raise FileExistsError(f"{target} holds {taken[0]}")

    def copy(f, name: str, size: int) -> tuple:
        fs, root = file_system(target.rstrip("/"))
        fs.create_dir(root, recursive=True)
        part, total = f"{root}/.{uuid.uuid4().hex}.part", hashlib.sha256()
        try:
            with fs.open_output_stream(part) as out:
                while chunk := f.read(files.CHUNK):
                    total.update(chunk)
                    out.write(chunk)
            fs.move(part, f"{root}/{name}")
        except BaseException:
            fs.delete_file(part)
            raise
        return name, size, total.hexdigest()

    copied = files.each_file(spark, [x for x in _listed(path) if x[0].rsplit("/", 1)[-1] in wanted], copy, "file string, bytes long, sha256 string", [pa.string(), pa.int64(), pa.string()])
    kept = scratch(spark, "copies")
    copied.write.parquet(kept)  # copies are made once, however often the result is read
    return statuses.join(spark.read.schema(copied.schema).parquet(kept), "file", "left")


def stream_sizes(spark: SparkSession, path: str, first: int = 8) -> DataFrame:
    """file, topic, channel_id, codec, width, height of each video channel, by the first parameter set in its first messages; null sizes
    where those have none."""
    kinds = pa.schema([("file", pa.string()), ("topic", pa.string()), ("channel_id", pa.int32()), ("log_time", pa.int64()), ("ordinal", pa.int64()), ("codec", pa.string()), ("width", pa.int32()), ("height", pa.int32())])

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for encoding, data in zip(b.column(5).to_pylist(), b.column(6).to_pylist()):
                fields = wire.fields(data) if encoding == "protobuf" else {3: data}
                codec = wire.codec_name(fields.get(4, b"h264").decode("utf-8", "replace"))
                found.append((codec, *(video.frame_size(fields.get(3, b""), codec) or (None, None))))
            more = zip(*found) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *(pa.array(c, k.type) for c, k in zip(more, list(kinds)[5:]))], schema=kinds)

    rows = spark.read.format("mcap").option("first", first).load(path).where(F.col("schema_name") == VIDEO)
    sized = rows.select("file", "topic", "channel_id", "log_time", "ordinal", "message_encoding", "data").mapInArrow(size, "file string, topic string, channel_id int, log_time long, ordinal long, codec string, width int, height int")
    when = F.when(F.col("width").isNotNull(), F.struct("log_time", "ordinal"))
    best = sized.groupBy("file", "topic", "channel_id").agg(F.min_by(F.struct("width", "height"), when).alias("s"), F.min_by("codec", F.struct("log_time", "ordinal")).alias("codec"))
    return best.select("file", "topic", "channel_id", "codec", "s.width", "s.height")


def repair_folder(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Repairs the logs at source into the folder target, each in a task of its own: file, status, messages, channels, start_t, end_t, ended_early.

    A log is written aside, reopened through its new index and moved into place only if that counts as many messages; one without
    any message leaves no file. status: ok, empty, or the error. Files that stand in target already are an error, before any work.
    """
    fs, root = file_system(target.rstrip("/"))
    there = {x.base_name for x in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))}
    files = _files(source)  # a list of names
    if taken := sorted(there & {f.rsplit("/", 1)[-1] for f in files}):
        raise FileExistsError(f"{target} holds {taken[0]}")
    out = pa.schema([("file", pa.string()), ("status", pa.string()), ("messages", pa.int64()), ("channels", pa.int32()), ("start_t", pa.int64()), ("end_t", pa.int64()), ("ended_early", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([_repaired(path, target.rstrip("/"))], schema=out)

    listed = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, min(len(files), 4096)), "path")
    done = listed.mapInArrow(run, "file string, status string, messages long, channels int, start_t long, end_t long, ended_early boolean")
    kept = scratch(spark, "repairs")
    done.write.parquet(kept)  # repairs run once, however often the result is read
    return spark.read.schema(done.schema).parquet(kept)


def _repaired(path: str, target: str) -> dict:
    name = path.rsplit("/", 1)[-1]
    fs, root = file_system(target)
    fs.create_dir(root, recursive=True)
    part = f"{root}/.{uuid.uuid4().hex}.part"
    try:
        with _open(path) as f, fs.open_output_stream(part) as out:
            got = mcap.repair(f, out)
        if got["messages"]:
            with fs.open_input_file(part) as f:
                if (n := mcap.read_summary(f).messages) != got["messages"]:
                    raise mcap.Corrupt(f"{n} of {got['messages']} messages in the new index")
            fs.move(part, f"{root}/{name}")
        else:
            fs.delete_file(part)
        return {"file": name, "status": "ok" if got["messages"] else "empty", "messages": got["messages"], "channels": got["channels"], "start_t": got["start"], "end_t": got["end"], "ended_early": got["ended_early"]}
    except (ValueError, NotImplementedError) as e:
        fs.delete_file(part)
        return {"file": name, "status": f"broken: {e}"}
