"""Token-ID output: ids in fixed-width bits, in shard files with block offsets.

A shard file holds blocks of `block_tokens` ids, each id in the fewest bits that hold the vocabulary, each block padded to
whole bytes; then an index: document ids, running token counts and block offsets; then a fixed-length trailer. A reader
finds any token by its block's offset and unpacks a block with numpy at once.

    b"RVTK" version  | block 0 | block 1 | ... | doc ids i8 | ends i8 | block offsets i8 | n_docs n_null n_tokens n_blocks bits block_tokens index_at b"RVTK"

The first n_null documents have no id.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverlog.llm import tokens
from riverlog.llm.common import map_arrow, partitions, prepare, scratch, stored, table
from riverlog.sources.folders import file_system

MAGIC, TRAILER = b"RVTK\x02\0\0\0", struct.Struct("<7q8s")
BLOCK_TOKENS = 1 << 16
END_ID = 1
#: The documents of one shard, on average.
SHARD_DOCS = 16_384
#: Bytes of ids that a reader hands on at once, or one document's.
READ_BYTES = 2 << 20


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids in `bits` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    grid = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(grid.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype("<u4")
    grid = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return grid.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class ShardWriter:
    """Appends documents; only one block and the index are in memory."""

    def __init__(self, out, bits: int, block_tokens: int = BLOCK_TOKENS):
        self.out, self.bits, self.block_tokens = out, bits, block_tokens
        self.at, self.total, self.held = len(MAGIC), 0, []
        self.n_held = 0
        self.n_null = 0
        self.docs: list[int] = []
        self.ends: list[int] = []
        self.offsets: list[int] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Documents without an id come first."""
        if doc_id is None:
            if len(self.docs) > self.n_null:
                raise ValueError("documents without an id come first")
            self.n_null += 1
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id does not fit {self.bits} bits")
        self.docs.append(doc_id or 0)
        self.total += len(ids)
        self.ends.append(self.total)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block_tokens:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        cut = len(ids) if last else len(ids) - len(ids) % self.block_tokens
        for i in range(0, cut, self.block_tokens):
            raw = pack(ids[i : min(cut, i + self.block_tokens)], self.bits)
            self.offsets.append(self.at)
            self.out.write(raw)
            self.at += len(raw)
        self.held = [ids[cut:]]
        self.n_held = len(ids) - cut

    def close(self) -> None:
        self._flush(True)
        for x in (self.docs, self.ends, self.offsets):
            self.out.write(np.array(x, "<i8").tobytes())
        self.out.write(TRAILER.pack(len(self.docs), self.n_null, self.total, len(self.offsets), self.bits, self.block_tokens, self.at, MAGIC))


class ShardReader:
    """Random access by token or document; `file` is seekable."""

    def __init__(self, file):
        self.file = file
        file.seek(0, io.SEEK_END)
        size = file.tell()
        if size < len(MAGIC) + TRAILER.size:
            raise ValueError("not a whole token file")
        file.seek(size - TRAILER.size)
        n_docs, self.n_null, self.n_tokens, n_blocks, self.bits, self.block_tokens, self.index_at, magic = TRAILER.unpack(file.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a whole token file")
        file.seek(self.index_at)
        index = np.frombuffer(file.read(8 * (2 * n_docs + n_blocks)), "<i8")
        self.docs, self.ends, self.offsets = index[:n_docs], index[n_docs : 2 * n_docs], index[2 * n_docs :]
        self._block: tuple[int, np.ndarray] | None = None

    def block(self, b: int) -> np.ndarray:
        if self._block is None or self._block[0] != b:
            end = self.offsets[b + 1] if b + 1 < len(self.offsets) else self.index_at
            self.file.seek(int(self.offsets[b]))
            raw = self.file.read(int(end - self.offsets[b]))
            self._block = b, unpack(raw, self.bits, min(self.block_tokens, self.n_tokens - b * self.block_tokens))
        return self._block[1]

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids from start to stop, from only the blocks that hold them."""
        parts, b = [], start // self.block_tokens
        while b * self.block_tokens < stop:
            at = b * self.block_tokens
            parts.append(self.block(b)[max(0, start - at) : stop - at])
            b += 1
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")

    def document(self, i: int) -> np.ndarray:
        return self.tokens(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


def write_tokens(docs: DataFrame, out: str, vocabulary: str, bits: int | None = None, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Writes the encoded texts of docs(doc_id, text) to shard files in the shared folder `out`, in ascending doc_id order
    over the shards, and returns the manifest: shard, n_docs, n_tokens, file.

    Only doc_id and text are read; other columns do not matter. A null text is empty and gets the end id alone. Rows that
    repeat a doc_id are kept, each as a document, in an order that their texts fix; documents without a doc_id come first. No
    rows: no files. A lost task is run again and writes its file anew under the same name, moved into place when whole.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    prepare(spark)
    if bits is None:
        bits = max(1, (Tokenizer.from_file(vocabulary).get_vocab_size() - 1).bit_length())
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("h"))
    n = max(1, -(-docs.count() // shard_docs), min(partitions(spark), 4096))
    # A hash splits the rows of a doc_id that very many rows repeat.
    ordered = docs.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text", F.spark_partition_id().alias("shard"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, end = tokens.encoder(vocabulary), None, np.array([END_ID], "<u4").tobytes()
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                shard = b.column(2)[0].as_py()
                f, root = file_system(out)
                f.create_dir(root, recursive=True)
                name = f"{root}/shard-{shard:08d}.rvtk"
                part = f"{name}.{struct.unpack('<Q', np.random.default_rng().bytes(8))[0]:016x}.part"
                sink = f.open_output_stream(part)
                writer = ShardWriter(sink, bits)
            for doc_id, raw in zip(b.column(0).to_pylist(), encoder.encode_all(b.column(1).to_pylist())):
                writer.add(doc_id, np.frombuffer(raw + end, "<u4"))
        if writer is not None:
            writer.close()
            sink.close()
            f.move(part, name)
            yield pa.RecordBatch.from_pylist([{"shard": shard, "n_docs": len(writer.docs), "n_tokens": writer.total, "file": f"{out}/shard-{shard:08d}.rvtk"}], schema=pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("file", pa.string())]))

    return stored(map_arrow(ordered, write, "shard int, n_docs long, n_tokens long, file string", tokens.OWNER), "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Each document of the files: doc_id, start (ids of all documents before it), ids (binary, little-endian u4)."""
    # One row a shard: few, whatever the corpus holds.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    spread = placed.repartition(max(1, min(manifest.count(), 4096)), "shard").select("file", "before")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f, path = file_system(uri)
                with f.open_input_file(path) as file:
                    r = ShardReader(file)
                    starts = first + np.concatenate([[0], r.ends[:-1]]).astype(np.int64)[: len(r.ends)]
                    ids = pa.array(r.docs, mask=np.arange(len(r.docs)) < r.n_null)
                    at = 0
                    while at < len(r.docs):
                        stop = max(at + 1, int(np.searchsorted(r.ends, (r.ends[at - 1] if at else 0) + READ_BYTES // 4, "right")))
                        raw = [r.document(j).astype("<u4").tobytes() for j in range(at, stop)]
                        yield pa.RecordBatch.from_arrays([ids[at:stop], pa.array(starts[at:stop]), pa.array(raw, pa.binary())], ["doc_id", "start", "ids"])
                        at = stop

    return map_arrow(spread, read, "doc_id long, start long, ids binary")


def digest(read: DataFrame) -> DataFrame:
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_tokens(table(spark, sf_dir, "documents"), scratch(spark, "tokens"), tokens.default_vocabulary())
    return digest(read_tokens(manifest))


QUERIES = {"op1_token_output": op1_token_output}
ORACLES: dict[str, str] = {}
