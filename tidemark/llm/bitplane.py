"""Token-ID output (4): bit-plane shuffled id files with a chunk index.

A shard file holds the ids of a doc_id range in ascending doc_id order, in chunks of
``CHUNK_IDS`` ids.  A chunk is transposed into 32 bit planes (plane b: bit b of every
id), each compressed by itself with zstandard; planes that are all zero take no bytes.
The footer holds the chunk index (place, ids, bytes of each plane) and the document
index (doc_id, ids), so a reader fetches any range without the rest of the file.

    "TMBP1\\n" | planes of chunk 0 | ... | footer (zstandard, JSON) | its length, 8 bytes | "TMBP1\\n"

Tasks write shards straight into the shared checkpoint folder, under a name of their
own per attempt; the manifest, written by Spark, names the files of the attempts that
succeeded, so a lost executor leaves at most a file that nothing refers to.

Cases: null and empty texts have the end id alone; a null doc_id comes first; rows that
repeat a doc_id stay apart, in any order; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, read_table
from tidemark.llm.packing import END_ID, tokenizer_path
from tidemark.llm.tokens import LOWER_PARTS, shared_encoder
from tidemark.session import scratch_path

WORD_BPE = "word_bpe_49k.json"
CHUNK_IDS = 1 << 16
MAGIC = b"TMBP1\n"
#: Text bytes that one shard should hold, about.
SHARD_BYTES = 48 << 20

MANIFEST = "shard long, path string, n_docs long, n_ids long"
DOCUMENTS = "doc_id long, shard long, local_start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray) -> list[bytes]:
    """The 32 bit planes of unsigned 32-bit ids; b"" for a plane of zeros."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    planes = []
    for k in range(4):
        column = np.ascontiguousarray(raw[:, k])
        used = int(np.bitwise_or.reduce(column)) if len(column) else 0
        for b in range(8):
            planes.append(np.packbits(column & (1 << b), bitorder="little").tobytes() if used >> b & 1 else b"")
    return planes


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    raw = np.zeros((n, 4), np.uint8)
    for k in range(4):
        column = np.zeros(n, np.uint8)
        for b, plane in enumerate(planes[8 * k : 8 * k + 8]):
            if plane:
                column |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little") << np.uint8(b)
        raw[:, k] = column
    return raw.reshape(-1).view("<u4")


def file_system(path: str):
    """File system and path of a URI or an absolute path."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class ShardWriter:
    def __init__(self, path: str, level: int = 3) -> None:
        import zstandard

        system, at = file_system(path)
        self.out = system.open_output_stream(at)
        self.out.write(MAGIC)
        self.at = len(MAGIC)
        self.packer = zstandard.ZstdCompressor(level=level)
        self.pending: list[bytes] = []
        self.waiting = 0  # ids in pending
        self.chunks: list[list] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.pending.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= CHUNK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        data = np.frombuffer(b"".join(self.pending), "<u4")
        whole = len(data) if last else len(data) // CHUNK_IDS * CHUNK_IDS
        for at in range(0, whole, CHUNK_IDS):
            ids = data[at : min(at + CHUNK_IDS, whole)]
            planes = [self.packer.compress(p) if p else b"" for p in to_planes(ids)]
            self.out.write(b"".join(planes))
            self.chunks.append([self.at, len(ids), [len(p) for p in planes]])
            self.at += sum(map(len, planes))
        self.pending = [data[whole:].tobytes()]
        self.waiting = len(data) - whole

    def close(self) -> None:
        self._flush(True)
        footer = self.packer.compress(
            json.dumps({"chunks": self.chunks, "doc_ids": self.doc_ids, "lengths": self.lengths}).encode()
        )
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()


class ShardReader:
    def __init__(self, path: str) -> None:
        import zstandard

        system, at = file_system(path)
        self.file = system.open_input_file(at)
        self.unpacker = zstandard.ZstdDecompressor()
        size, tail = self.file.size(), len(MAGIC) + 8
        end = self.file.read_at(tail, size - tail)
        if end[8:] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is not an id file")
        n = int.from_bytes(end[:8], "little")
        footer = json.loads(self.unpacker.decompress(self.file.read_at(n, size - tail - n)))
        self.chunk_index, self.doc_ids, self.lengths = footer["chunks"], footer["doc_ids"], footer["lengths"]

    def chunk(self, k: int) -> np.ndarray:
        at, n, sizes = self.chunk_index[k]
        data, planes, to = self.file.read_at(sum(sizes), at), [], 0
        for size in sizes:
            planes.append(self.unpacker.decompress(data[to : to + size]) if size else b"")
            to += size
        return from_planes(planes, n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the shard; reads the chunks they lie in."""
        first, last = start // CHUNK_IDS, (start + n - 1) // CHUNK_IDS
        if n <= 0:
            return np.empty(0, "<u4")
        data = np.concatenate([self.chunk(k) for k in range(first, last + 1)])
        return data[start - first * CHUNK_IDS :][:n]


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, lead: str = "", parts: str = "") -> DataFrame:
    """Encode and write ``docs`` below ``folder``; the manifest (MANIFEST), written by Spark.

    ``path`` is the tokenizer file, ``lead`` and ``parts`` as in ``Encoder``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end, writer = shared_encoder(path, lead, parts), np.array([end_id], "<u4").tobytes(), None
        shard = TaskContext.get().partitionId()
        name = f"{folder}/ids-{shard:06d}-{uuid.uuid4().hex}.bp"
        for batch in batches:
            if batch.num_rows == 0:
                continue
            writer = writer or ShardWriter(name)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(t or "" for t in batch.column(1).to_pylist())):
                writer.add(doc_id, ids + end)
        if writer:
            writer.close()
            row = [[shard], [name], [len(writer.lengths)], [sum(writer.lengths)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                ["shard", "path", "n_docs", "n_ids"],
            )

    system, at = file_system(folder)
    system.create_dir(at, recursive=True)
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).collect()[0]
    shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-((size["b"] or 0) + 64 * size["n"]) // SHARD_BYTES))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id")
    )
    return cut(ordered.mapInArrow(run, MANIFEST), "id-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Documents of the files that ``manifest`` names, from their ids (DOCUMENTS)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = ShardReader(path)
                sums, crc, doc, left, k = [], 0, 0, 0, 0
                lengths = reader.lengths
                left = lengths[0] if lengths else 0
                for k in range(len(reader.chunk_index)):
                    data = memoryview(reader.chunk(k).tobytes())
                    at, n = 0, len(data) // 4
                    while at < n:
                        take = min(left, n - at)
                        crc = zlib.crc32(data[4 * at : 4 * (at + take)], crc)
                        at, left = at + take, left - take
                        if not left:
                            sums.append(crc)
                            crc, doc = 0, doc + 1
                            left = lengths[doc] if doc < len(lengths) else 0
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.doc_ids, pa.int64()),
                        pa.array(np.full(len(lengths), shard)),
                        pa.array(starts),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "shard", "local_start", "n_tokens", "ids_crc32"],
                )

    files = max(1, manifest.count())
    return manifest.select("shard", "path").repartition(files, "shard").mapInArrow(run, DOCUMENTS)


def op4_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    manifest = write_ids(docs, scratch_path(spark, "ids"), tokenizer_path(WORD_BPE), parts=LOWER_PARTS)
    # one row per file: where each shard starts in the whole
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = manifest.select(F.col("shard").alias("s"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return (
        read_documents(manifest)
        .join(base, F.col("shard") == F.col("s"))
        .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
    )
