"""Token ids in fixed-width bit-packed files.

File, little endian: magic, width in bits, ids a block, number of ids, number of documents; a table of documents
(doc_id, index of its first id; a null doc_id is the least int64); a table of block offsets in bytes; the blocks, each
packed with the least significant bit first and padded to a byte. The width is the fewest bits that hold the vocabulary.
A block decodes by itself with a few numpy operations, so any range of ids is read at random.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, shared_path, tidy
from .tokens import default_vocabulary, encoder

MAGIC = b"TLBITS01"
BLOCK = 4096  #: ids a block
FILE_IDS = 4 << 20  #: a file is closed when it has this many ids
NULL_ID = -(1 << 63)
HEAD = np.dtype([("magic", "S8"), ("width", "<u4"), ("block", "<u4"), ("ids", "<u8"), ("docs", "<u8")])
DOC = np.dtype([("doc_id", "<i8"), ("first", "<u8")])


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """ids as width bits each, least significant first."""
    ids = np.ascontiguousarray(ids, "<u4")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits, bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype("<u4")
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def write_file(docs: list[tuple[int | None, np.ndarray]], width: int, block: int = BLOCK) -> bytes:
    """The bytes of a file that holds each (doc_id, ids)."""
    sizes = np.array([len(ids) for _, ids in docs], "<u8")
    ids = np.concatenate([ids for _, ids in docs]) if docs else np.zeros(0, "<u4")
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    table = np.zeros(len(docs), DOC)
    table["doc_id"] = [NULL_ID if d is None else d for d, _ in docs]
    table["first"] = np.cumsum(sizes) - sizes
    blocks = [pack_bits(ids[i : i + block], width) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    head = np.array([(MAGIC, width, block, len(ids), len(docs))], HEAD)
    return b"".join([head.tobytes(), table.tobytes(), offsets.tobytes(), *blocks])


class PackedIds:
    """A file's documents and ids, decoded block by block on demand."""

    def __init__(self, data: bytes) -> None:
        self.head = np.frombuffer(data, HEAD, 1)[0]
        if self.head["magic"] != MAGIC:
            raise ValueError("not a file of packed ids")
        self.width, self.block, self.n = int(self.head["width"]), int(self.head["block"]), int(self.head["ids"])
        self.table = np.frombuffer(data, DOC, int(self.head["docs"]), HEAD.itemsize)
        at = HEAD.itemsize + self.table.nbytes
        self.offsets = np.frombuffer(data, "<u8", -(-self.n // self.block) + 1, at)
        self.data, self.base = data, at + self.offsets.nbytes

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop, from the blocks that hold them only."""
        if not 0 <= start <= stop <= self.n:
            raise IndexError((start, stop))
        if start == stop:
            return np.zeros(0, "<u4")
        first, last = start // self.block, -(-stop // self.block)
        part = [unpack_bits(self.data[self.base + int(self.offsets[b]) : self.base + int(self.offsets[b + 1])], min(self.block, self.n - b * self.block), self.width) for b in range(first, last)]
        return np.concatenate(part)[start - first * self.block : stop - first * self.block]

    def bounds(self, k: int) -> tuple[int, int]:
        return int(self.table["first"][k]), int(self.table["first"][k + 1]) if k + 1 < len(self.table) else self.n

    def document(self, k: int) -> np.ndarray:
        return self.ids(*self.bounds(k))


def _store(folder: str):
    """The shared folder as a pyarrow file system, so any store that pyarrow knows will do."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


_MANIFEST = pa.schema([("file", pa.string()), ("part", pa.int64()), ("seq", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode docs into files of `folder` in ascending doc_id order; returns the written manifest (file, part, seq, n_docs, n_ids).

    A file belongs to one attempt of one task; the manifest names those of the attempts that counted.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        enc = encoder(vocabulary)
        width = width_of(max(enc.vocabulary, end_id + 1))
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        end = np.array([end_id], "<u4").tobytes()
        held: list[tuple[int | None, np.ndarray]] = []
        n = seq = 0

        def close() -> pa.RecordBatch:
            nonlocal held, n, seq
            name = f"ids-{part:06d}-{seq:06d}-{attempt}.bits"
            with store.open_output_stream(f"{base}/{name}") as f:
                f.write(write_file(held, width))
            out = pa.RecordBatch.from_pylist([{"file": name, "part": part, "seq": seq, "n_docs": len(held), "n_ids": n}], _MANIFEST)
            held, n, seq = [], 0, seq + 1
            return out

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(enc.encode(t.as_py() or "") + end, "<u4")
                held.append((k.as_py(), ids.astype("<u2") if width <= 16 else ids))
                n += len(ids)
                if n >= FILE_IDS:
                    yield close()
        if held:
            yield close()

    source = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # Rows that share an id, or have none, are ordered by a hash of the text, so that a hot id is dealt over several files too.
    keyed = source.withColumns({"h": F.xxhash64("text"), "s": F.spark_partition_id()})
    ordered = keyed.repartitionByRange(partitions(docs.sparkSession), "doc_id", "h", "s").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    return materialize(ordered.mapInArrow(tidy(encode), "file string, part long, seq long, n_docs long, n_ids long"), "ids-manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_stream(f"{base}/{name}") as f:
                    packed = PackedIds(f.read())
                every = packed.ids(0, packed.n)
                bounds = [packed.bounds(k) for k in range(len(packed.table))]
                idents = [None if d == NULL_ID else d for d in packed.table["doc_id"].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(idents, pa.int64()),
                        pa.array([before + a for a, _ in bounds], pa.int64()),
                        pa.array([b - a for a, b in bounds], pa.int64()),
                        pa.array([zlib.crc32(every[a:b].tobytes()) for a, b in bounds], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One small row a file, so the running sum over all of them is light in one task.
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).cast("long").alias("before"))
    return files.repartition(partitions(manifest.sparkSession)).mapInArrow(tidy(decode), "doc_id long, start long, n_tokens long, ids_crc32 long")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, folder: str | None = None, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of every document and read them back: doc_id, start, n_tokens, ids_crc32, one row per row of docs.

    Null text counts as empty and has the end id only. Null doc_ids come first; rows that repeat a doc_id are ordered by
    a hash of the text. Other columns are ignored, whatever their names. An empty table gives no files and an empty result.
    """
    vocabulary = vocabulary or default_vocabulary()
    folder = folder or shared_path(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, folder, vocabulary, end_id, ident, text), folder)
