"""Exact duplicates by Patricia-trie owners.

Map tasks insert whole texts into a local compressed radix trie, so a text with any number of copies leaves a task once;
over its budget, a trie lets its largest subtrees go. What is left is dealt to owners by length and content hash. An owner
inserts all texts of its partition into one trie, in the order of their bytes, so whatever lies left of the current text
is complete: over the budget those subtrees are emitted and freed. Terminals keep the extreme identifier and the number of
rows. What has to go to disk is spilled by Spark's external sort, so no private temporary files are needed and a lost
executor costs only its tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, fresh, materialize, one_row_each, partitions, skewed_lookup, text_bytes, tidy, with_text_key

BUDGET = 64 << 20  #: bytes that a trie holds before it lets go of subtrees, its nodes included
NODE = 400  #: bytes of a node with its terminal, besides its label
BATCH = 8 << 20  #: bytes of text that are emitted at once


class PatriciaTrie:
    """Compressed radix trie of byte strings; a terminal keeps [largest id or None, rows]. A node is [label, children, terminal]."""

    __slots__ = ("held", "root")

    def __init__(self) -> None:
        self.root: list = [b"", None, None]
        self.held = 0

    def insert(self, key: bytes, ident: int | None, rows: int = 1) -> None:
        node, at, end = self.root, 0, len(key)
        while at < end:
            child = node[1].get(key[at]) if node[1] else None
            if child is None:
                child = [key[at:], None, None]
                if node[1] is None:
                    node[1] = {}
                node[1][key[at]] = child
                self.held += end - at + NODE
                node = child
                break
            label = child[0]
            if key.startswith(label, at):
                at += len(label)
                node = child
                continue
            same = common_prefix(label, key, at)
            upper = [label[:same], {label[same]: child}, None]
            child[0] = label[same:]
            node[1][key[at]] = upper
            self.held += NODE
            node = upper
            at += same
        if node[2] is None:
            node[2] = [ident, rows]
        else:
            last = node[2]
            last[1] += rows
            if ident is not None and (last[0] is None or ident > last[0]):
                last[0] = ident

    def items(self) -> Iterator[tuple[bytes, list]]:
        yield from subtree(b"", self.root)

    def release(self, keep: int) -> Iterator[tuple[bytes, list]]:
        """Takes out the largest subtrees below the root until `keep` bytes are held at most; gives what they had."""
        children = self.root[1] or {}
        sizes = {c: sum(len(n[0]) + NODE for n in nodes(child)) for c, child in children.items()}
        for c in sorted(sizes, key=lambda c: (-sizes[c], c)):
            if self.held <= keep:
                break
            self.held -= sizes[c]
            yield from subtree(b"", children.pop(c))

    def finished(self, key: bytes) -> Iterator[tuple[bytes, list]]:
        """Takes out all but the path to `key`, the last text in order of bytes; gives what that had."""
        node, path, at = self.root, b"", 0
        while True:
            if at < len(key) and node[2] is not None:
                yield path, node[2]
                node[2] = None
            on = key[at] if at < len(key) else None
            for c in [c for c in (node[1] or {}) if c != on]:
                yield from subtree(path, node[1].pop(c))
            if on is None:
                break
            node = node[1][on]
            path += node[0]
            at = len(path)
        self.held = sum(len(n[0]) + NODE for n in nodes(self.root))


def nodes(node: list) -> Iterator[list]:
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        if node[1]:
            stack.extend(node[1].values())


def subtree(before: bytes, node: list) -> Iterator[tuple[bytes, list]]:
    """The texts of a subtree and their terminals."""
    stack = [(before, node)]
    while stack:
        before, (label, children, last) = stack.pop()
        path = before + label
        if last is not None:
            yield path, last
        if children:
            stack.extend((path, child) for child in children.values())


def common_prefix(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of label and key[at:], by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == key[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _digest(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def _in_batches(found: Iterator[tuple[bytes, list]], make) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for text, (ident, n) in found:
        rows.append((text, ident, n))
        held += len(text) + 100
        if held > BATCH:
            yield make(rows)
            rows, held = [], 0
    if rows:
        yield make(rows)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct text of a task, as far as the budget goes."""
    trie = PatriciaTrie()
    for batch in batches:
        for ident, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            trie.insert(text.translate(LOWER_AZ), ident)
            if trie.held > BUDGET:
                yield from _in_batches(trie.release(BUDGET // 2), _batch)
    yield from _in_batches(trie.items(), _batch)


_TEXTS = pa.schema([("len", pa.int64()), ("hash", pa.binary()), ("text", pa.binary()), ("ident", pa.int64()), ("n", pa.int64())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    rows = [(len(text), _digest(text)[:8], text, ident, n) for text, ident, n in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _TEXTS, strict=True)], schema=_TEXTS)


_CLASSES = pa.schema([("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _class_batch(rows: list[tuple]) -> pa.RecordBatch:
    rows = [(_digest(text).hex(), ident, n) for text, ident, n in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CLASSES, strict=True)], schema=_CLASSES)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One trie for all texts of a partition, which come in order of their bytes."""
    trie = PatriciaTrie()
    for batch in batches:
        for text, ident, n in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            trie.insert(text, ident, n)
            if trie.held > BUDGET:
                yield from _in_batches(trie.finished(text), _class_batch)
    yield from _in_batches(trie.items(), _class_batch)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [hashlib.sha256(t.translate(LOWER_AZ)).hexdigest() for t in text_bytes(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.string())], names=["doc_id", "text_sha256"])


def text_classes(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each distinct text after lower-casing A-Z: text_sha256, keep_id (largest id), group_size."""
    spark = docs.sparkSession
    source = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = source.mapInArrow(tidy(_collapse), "len long, hash binary, text binary, ident long, n long")
    owned = texts.repartition(partitions(spark), "len", "hash").select("text", "ident", "n").sortWithinPartitions("text")
    return owned.mapInArrow(tidy(_own), "text_sha256 string, keep_id long, group_size long")


def exact_dedup(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and empty texts are equal to each
    other. The row with the largest id stays. A null id is below all others; rows that repeat an id and a text count in
    group_size and are kept or dropped alike. Other columns of docs are ignored, whatever their names. An empty table
    gives an empty result.
    """
    classes = materialize(text_classes(docs, ident, text), "text-classes")
    source = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = source.mapInArrow(tidy(_digests), "doc_id long, text_sha256 string")
    out = skewed_lookup(rows, classes, "text_sha256", "group_size", F.col("doc_id"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each text, all columns kept: that of the largest id; a row without an id where no copy has one.

    Of rows that repeat an id and a text, the one whose columns have the least hash stays; an id that repeats with other
    texts is no matter. Null counts as the empty text. An empty table gives an empty result.
    """
    key = fresh("_key", docs.columns)
    kept = text_classes(docs, ident, text).select(F.concat_ws(":", "text_sha256", F.col("keep_id").cast("string")).alias(key))
    keyed = with_text_key(docs, key, lambda t: hashlib.sha256(t.translate(LOWER_AZ)).hexdigest(), ident, text)
    return one_row_each(keyed, key).join(kept, key, "left_semi").select(docs.columns)
