"""Jaccard join of documents on word n-grams, vertically partitioned.

The global n-gram order puts rare n-grams first: a count sketch of fixed size over all documents gives each n-gram a
level, and the order is (level, hash). An n-gram is then one 64-bit key whose value is its place in the order.

* Two sets that reach the similarity share an n-gram among the first n - ceil(0.75 n) + 1 of each. The order is cut into
  fragments, those of very frequent n-grams once more by set; each fragment gets the part of those prefixes that falls
  into it and lists the sets of every n-gram there.
* Short lists are paired in full; in longer ones the most central set, that with the largest share of its prefix in long
  lists, is paired with the others. These pairs are verified: full sets are cut into fragments of the order too, each
  counts its partial overlap of a pair, and the counts are summed per pair.
  Before that, the sizes of a pair's parts in many fragments bound its partial overlaps: the sum of the smaller ones.
* What is linked so far forms components. The pairs of longer lists that lie in different components are verified as
  well, and so no link between components is lost, while dense groups never have all of their pairs made. A list of many
  sets is cut by their sizes and hashes, and its parts meet in cells of bounded size.

Copies with equal sets are one class from the start, so a text with any number of copies costs no pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HASHES, LOWER_AZ, fresh, in_chunks, materialize, one_row_each, partitions, skewed_lookup, text_bytes, tidy, with_text_key
from .components import connected_components

WORDS = 5  #: words of an n-gram
NUM, DEN = 3, 4  #: least similarity, 0.75
CELL_BITS = 22  #: the sketch has 2 ** CELL_BITS cells, whatever the input
BLOCKS = 64  #: blocks that the sketch is summed in
LEVEL_BITS = 6
SHORT = 4  #: lists up to this length are paired in full at once
SEGMENTS = 4  #: fragments that full sets are cut into to count overlaps
TEAM = 256  #: pairs of one set that are counted together
BITMAP_BITS = 24  #: the filter of documents whose sets are needed has 2 ** BITMAP_BITS bits, whatever the input
SEEN = 150_000  #: sets that a task remembers to leave out copies
CHUNK = 2 << 20  #: bytes of text whose n-grams are made at once
FINE, COARSE, LARGE = 1024, 256, 1024  #: fragments whose sizes bound overlaps, for sets over LARGE and for others
FLUSH = 1 << 18  #: entries that a task holds before it emits them
LIST = 1 << 16  #: documents of an n-gram from which the fragment of its list is cut by set
CELL = 1024  #: sets of a list that meet in a cell, from either side
STRIP = 128  #: sets that are compared with all others of a cell at once
SIGN_BITS = 1024  #: bits of a set's parities, which bound overlaps in cells
CLASHES = 10_000  #: sets whose 64-bit numbers meet, at most; beyond it the join refuses
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; with fewer words the whole sequence is one n-gram."""
    counts, flat = [], []
    get = HASHES.__getitem__
    for text in texts:
        words = text.translate(LOWER_AZ).split()
        counts.append(len(words))
        flat.append(np.fromiter(map(get, words), np.uint64, len(words)))
    w = np.concatenate(flat) if flat else np.zeros(0, np.uint64)
    n = len(w) - WORDS + 1
    grams = np.zeros(max(0, n), np.uint64)
    for k in range(WORDS):
        grams += w[k : k + len(grams)] * _ODD[k]
    grams = _mix(grams)
    out, at = [], 0
    for c in counts:
        if c >= WORDS:
            h = np.sort(grams[at : at + c - WORDS + 1])
            if len(h) > 1:
                h = h[np.concatenate([[True], h[1:] != h[:-1]])]
        elif c:
            h = _mix((w[at : at + c] * _ODD[:c]).sum(dtype=np.uint64, keepdims=True) + np.uint64(c))
        else:
            h = np.zeros(0, np.uint64)
        out.append(h)
        at += c
    return out


def _signature(h: np.ndarray) -> str:
    """128 bits of a set in hex."""
    return xxhash.xxh3_128_hexdigest(h.tobytes())


def _number(signature: str, renamed: dict[str, int]) -> int:
    """The first 64 bits as a signed number, or the one given to a set whose number another one has."""
    got = renamed.get(signature)
    return int(np.uint64(int(signature[:16], 16)).astype(np.int64)) if got is None else got


def _parities(h: np.ndarray) -> bytes:
    """Whether the n-grams in each of SIGN_BITS ranges of the hash are odd in number. Sets differ by as many n-grams as bits, at least."""
    bits = SIGN_BITS.bit_length() - 1
    return np.packbits(np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=SIGN_BITS) & 1).tobytes()


def _sizes(h: np.ndarray) -> bytes | None:
    """How many n-grams of a set fall into each of equal ranges of the hash; None where that doesn't fit."""
    if not len(h):
        return None
    bits = (FINE if len(h) > LARGE else COARSE).bit_length() - 1
    c = np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return c.astype("<u2").tobytes() if c.max() < 65536 else None


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose parts are large enough for the overlap they need. Columns a, b, n_a, n_b, sizes of a, sizes of b, chunk."""
    for batch in batches:
        n_a, n_b = batch.column(2).to_numpy().astype(np.int64), batch.column(3).to_numpy().astype(np.int64)
        most = np.minimum(n_a, n_b)
        for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5), strict=True)):
            x, y = x.as_py(), y.as_py()
            if x is None or y is None:
                continue
            x, y = np.frombuffer(x, "<u2").astype(np.int64), np.frombuffer(y, "<u2").astype(np.int64)
            if len(x) != len(y):
                x, y = x.reshape(COARSE, -1).sum(1), y.reshape(COARSE, -1).sum(1)
            most[i] = np.minimum(x, y).sum()
        yield batch.filter(pa.array(most >= needed(n_a, n_b))).select(["a", "b", "n_a", "n_b", "chunk"])


def needed(n_a, n_b):
    """Least overlap of sets of these sizes that reaches the similarity."""
    return -(-NUM * (n_a + n_b) // (NUM + DEN))


def prefix_length(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


_SURVEY = "kind int, doc_id long, n long, sig string, body string, sizes binary, bits binary, block int, part long, cells binary"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and at the end the task's sketch in blocks."""
    cells = np.zeros(1 << CELL_BITS, np.uint32)
    part = TaskContext.get().partitionId()
    types = {name: _ARROW[kind] for name, kind in (f.split() for f in _SURVEY.split(", "))}

    def batch(kind: int, columns: dict) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        columns = {"kind": [kind] * n} | columns
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in types.items()], names=list(types))

    seen = False
    for chunk in in_chunks(batches, "text", CHUNK):
        seen = True
        texts = text_bytes(chunk.column(1))
        sets = shingle_sets(texts)
        every = np.concatenate(sets)
        np.add.at(cells, (every >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
        each = [(len(h), _signature(h), _body(t), _sizes(h), _parities(h)) if len(h) else (0, None, None, None, None) for h, t in zip(sets, texts, strict=True)]
        yield batch(0, {"doc_id": chunk.column(0)} | dict(zip(("n", "sig", "body", "sizes", "bits"), zip(*each, strict=True), strict=True)))
    if seen:
        yield batch(1, {"block": list(range(BLOCKS)), "part": [part] * BLOCKS, "cells": [zlib.compress(c.tobytes(), 1) for c in np.split(cells, BLOCKS)]})


def _body(text: bytes) -> str | None:
    """128 bits of a text in hex; None without words."""
    return xxhash.xxh3_128_hexdigest(text) if text.strip() else None


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            got = np.frombuffer(zlib.decompress(data.as_py()), np.uint32).astype(np.uint64)
            sums[block] = np.minimum(sums[block] + got, 0xFFFFFFFF) if block in sums else got
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array([zlib.compress(c.astype(np.uint32).tobytes(), 1) for c in sums.values()], pa.binary())], names=["block", "cells"])


def _levels(survey: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The sketch's levels: how many quarters of a power of two each cell is above the mean, one byte a cell, fixed size; parts of a fragment by level."""
    n = partitions(survey.sparkSession)
    rows = survey.filter("kind = 1").select("block", "part", "cells")
    some = rows.repartition(n, "block", F.pmod("part", F.lit(64))).select("block", "cells").mapInArrow(tidy(_add_blocks), "block int, cells binary")
    sums = some.repartition(min(n, BLOCKS), "block").mapInArrow(tidy(_add_blocks), "block int, cells binary")
    cells = np.zeros((BLOCKS, (1 << CELL_BITS) // BLOCKS), np.uint32)
    for r in sums.toLocalIterator():
        cells[r["block"]] = np.frombuffer(zlib.decompress(bytes(r["cells"])), np.uint32)
    flat = cells.ravel().astype(float)
    unit = max(1.0, 1.5 * flat.mean())
    levels = np.clip(np.ceil(np.log2(np.maximum(flat, 1) / unit) * 4), 0, (1 << LEVEL_BITS) - 1).astype(np.uint8)
    # Level 0 and the last hold what is below or above as well.
    most = [0 if level == 0 else flat.max(initial=0) if level == (1 << LEVEL_BITS) - 1 else unit * 2 ** (level / 4) for level in range(1 << LEVEL_BITS)]
    return levels, np.clip(np.ceil(np.array(most) / LIST), 1, 1 << 20).astype(np.int64)


def _keys(h: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The set in the global order: each n-gram as its place, (level, hash)."""
    level = levels[(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort((level << np.uint64(64 - LEVEL_BITS)) | (h >> np.uint64(LEVEL_BITS)))


ENTRY = np.dtype([("key", "<u8"), ("cls", "<i8"), ("n", "<i4"), ("pos", "<i4")])


def _prefixes(shared, fragments: int):
    """Map tasks: the prefixes of each distinct set, cut at the pivots of the order, and frequent n-grams' by set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, parts, renamed = shared.value
        held: list[np.ndarray] = []
        n, seen = 0, set()

        def emit() -> pa.RecordBatch:
            every = np.concatenate(held)
            # Pivots cut every level of the order into equal ranges.
            inside = (every["key"] << np.uint64(LEVEL_BITS)) >> np.uint64(40)
            level = (every["key"] >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)
            fragment = level * fragments + ((inside.astype(np.int64) * fragments) >> 24)
            part = (every["cls"].astype(np.uint64) >> np.uint64(11)) % parts[level].astype(np.uint64)
            order = np.lexsort((part, fragment))
            every, fragment, part = every[order], fragment[order], part[order].astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], (fragment[1:] != fragment[:-1]) | (part[1:] != part[:-1])]))
            ends = np.append(starts[1:], len(every))
            cut = parts[level[order][starts]] > 1
            return pa.RecordBatch.from_arrays([pa.array(fragment[starts], pa.int64()), pa.array(part[starts], pa.int64()), pa.array(cut), pa.array([every[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())], names=["fragment", "part", "cut", "entries"])

        for chunk in in_chunks(batches, "text", CHUNK):
            for h in shingle_sets(text_bytes(chunk.column(0))):
                if not len(h):
                    continue
                cls = _number(_signature(h), renamed)
                if cls in seen:
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(cls)
                p = prefix_length(len(h))
                e = np.empty(p, ENTRY)
                e["key"], e["cls"], e["n"], e["pos"] = _keys(h, levels)[:p], cls, len(h), np.arange(p)
                held.append(e)
                n += p
                if n > FLUSH:
                    yield emit()
                    held, n = [], 0
        if n:
            yield emit()

    return run


def _passes(n_a, p_a, n_b, p_b):
    """Length and position filters at a shared n-gram; a pair that reaches the similarity passes at its first one."""
    need = needed(n_a, n_b)
    rest = np.minimum(n_a - p_a, n_b - p_b)
    return (rest >= need) & (np.minimum(n_a, n_b) * DEN >= np.maximum(n_a, n_b) * NUM)


def passing(n_a: Column, p_a: Column, n_b: Column, p_b: Column) -> Column:
    """The same as an expression."""
    need = F.floor((NUM * (n_a + n_b).cast("long") + (NUM + DEN - 1)) / F.lit(NUM + DEN))
    return (F.least(n_a - p_a, n_b - p_b) >= need) & (F.least(n_a, n_b) * DEN >= F.greatest(n_a, n_b) * NUM)


_PAIRED = "kind int, a long, b long, n_a int, n_b int, key long, pos int"


def _pair_batch(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> pa.RecordBatch:
    """Pairs, each once."""
    order = np.lexsort((b, a))
    a, b, n_a, n_b = a[order], b[order], n_a[order], n_b[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    n = int(new.sum())
    return pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array(a[new], pa.int64()), pa.array(b[new], pa.int64()), pa.array(n_a[new].astype(np.int32)), pa.array(n_b[new].astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())], names=[f.split()[0] for f in _PAIRED.split(", ")])


def _list_batches(e: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The sets of long lists, a row each: a is the set, n_a its size."""
    for i in range(0, len(e), FLUSH):
        x = e[i : i + FLUSH]
        n = len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.array(x["cls"]), pa.nulls(n, pa.int64()), pa.array(x["n"]), pa.nulls(n, pa.int32()), pa.array(x["key"].astype(np.int64)), pa.array(x["pos"])], names=[f.split()[0] for f in _PAIRED.split(", ")])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments: the pairs of short lists (kind 0) and the entries of longer lists (kind 1). Rows come sorted by fragment and part.

    Where a fragment is cut by set, a list may go on in another part, so all of its entries are given as of a longer one.
    """
    at, held = None, []

    def finish(cut: bool) -> Iterator[pa.RecordBatch]:
        e = np.concatenate(held)
        e = e[np.lexsort((e["cls"], e["key"]))]
        new = np.concatenate([[True], (e["key"][1:] != e["key"][:-1]) | (e["cls"][1:] != e["cls"][:-1])])
        e = e[new]  # copies that met from several tasks
        if cut:
            yield from _list_batches(e)
            return
        starts = np.flatnonzero(np.concatenate([[True], e["key"][1:] != e["key"][:-1]]))
        sizes = np.diff(np.append(starts, len(e)))
        many = sizes > 1
        if not many.any():
            return
        e = e[np.repeat(many, sizes)]
        sizes = sizes[many]
        starts = np.cumsum(sizes) - sizes
        first = np.repeat(starts, sizes)
        place = np.arange(len(e)) - first
        found = []
        for step in range(SHORT - 1):
            right = np.flatnonzero((place > step) & (np.repeat(sizes, sizes) <= SHORT))
            left = first[right] + step
            if len(right):
                good = _passes(*(e[c][x].astype(np.int64) for x in (left, right) for c in ("n", "pos")))
                left, right = left[good], right[good]
                found.append((e["cls"][left], e["cls"][right], e["n"][left], e["n"][right]))
        if sum(len(f[0]) for f in found):
            yield _pair_batch(*map(np.concatenate, zip(*found, strict=True)))
        yield from _list_batches(e[np.repeat(sizes > SHORT, sizes)])

    for batch in batches:
        for *mine, cut, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            if held and mine + [cut] != at:
                yield from finish(at[-1])
                held = []
            at = mine + [cut]
            held.append(np.frombuffer(data.as_py(), ENTRY))
    if held:
        yield from finish(at[-1])


def cell_pairs(cls, n, pos, root, side, bits) -> Iterator[tuple]:
    """The pairs of a cell that may reach the similarity and lie in different components: a, b, n_a, n_b, strip by strip.

    Sides 0 and 1 meet each other, side 2 meets itself. bits are parities, a row each: where two sets differ in d of them,
    they share (n_a + n_b - d) / 2 n-grams at most; a product of matrices counts them.
    """
    order = np.argsort(n, kind="stable")
    cls, n, pos, root, side, bits = (x[order] for x in (cls, n, pos, root, side, bits))
    if len(n) < 2 or (root == root[0]).all():
        return
    signs = 1 - 2 * np.unpackbits(bits, axis=1).astype(np.float32)
    for i in range(0, len(n) - 1, STRIP):
        a = np.arange(i, min(i + STRIP, len(n) - 1))[:, None]
        b = np.arange(i + 1, np.searchsorted(n, n[a[-1, 0]] * DEN // NUM, "right"))[None, :]  # sorted by size: what the length filter leaves
        good = (b > a) & (root[a] != root[b]) & ((side[a] + side[b] == 1) | ((side[a] == 2) & (side[b] == 2)))
        if not good.any():
            continue
        good &= _passes(n[a], pos[a], n[b], pos[b])
        if not good.any():
            continue
        apart = (SIGN_BITS - signs[a[:, 0]] @ signs[b[0]].T) / 2
        x, y = np.nonzero(good & (n[a] + n[b] - apart >= 2 * needed(n[a], n[b])))
        x, y = a[x, 0], b[0, y]
        if len(x):
            swap = cls[x] > cls[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            yield cls[x], cls[y], n[x], n[y]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of cell, cls, n, pos, root, side, bits, sorted by cell."""
    held: list[list[np.ndarray]] = []
    out: list[tuple] = []
    n = 0

    def finish() -> Iterator[pa.RecordBatch]:
        nonlocal out, n
        for found in cell_pairs(*(np.concatenate(c) for c in zip(*held, strict=True))):
            out.append(found)
            n += len(found[0])
            if n > FLUSH:
                yield _pair_batch(*map(np.concatenate, zip(*out, strict=True)))
                out, n = [], 0

    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column(0).to_numpy()
        cols = [batch.column(i).to_numpy().astype(np.int64) for i in range(1, 6)]
        cols.append(np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint8).reshape(len(cell), SIGN_BITS // 8))
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        for a, b in zip(starts, [*starts[1:], len(cell)], strict=True):
            if held and cell[a] != at:
                yield from finish()
                held = []
            at = cell[a]
            held.append([c[a:b] for c in cols])
    if held:
        yield from finish()
    if n:
        yield _pair_batch(*map(np.concatenate, zip(*out, strict=True)))


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bit for the hash of each doc_id; of fixed size."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS))
    words = ids.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("bits"))
    got = words.toPandas()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[got["w"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).astype(np.uint64)
    return out


def _segments(shared):
    """The sets of the documents that the filter passes, in the order's keys, cut into SEGMENTS fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (levels, _, renamed), bits = shared.value
        for batch in batches:
            h = batch.column(2).to_numpy().astype(np.uint64)
            on = (bits[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1)
            for chunk in in_chunks(iter([batch.filter(pa.array(on.astype(bool)))]), "text", CHUNK):
                out: list[list] = [[], [], [], []]
                for doc_id, s in zip(chunk.column(0).to_pylist(), shingle_sets(text_bytes(chunk.column(1))), strict=True):
                    keys = _keys(s, levels)
                    where = ((keys << np.uint64(LEVEL_BITS)) >> np.uint64(48)).astype(np.int64) * SEGMENTS >> 16
                    for v in range(SEGMENTS):
                        for column, x in zip(out, (doc_id, _number(_signature(s), renamed) if len(s) else None, v, keys[where == v].tobytes()), strict=True):
                            column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["doc_id", "cls", "v", "keys"])

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a team sorted with the shared set first: the partial overlap of every pair in a fragment."""
    team, keys, last = None, None, None
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        a, chunk, v, b, n_a, n_b = (batch.column(i).to_pylist() for i in range(6))
        for i, data in enumerate(batch.column(6)):
            mine = (a[i], chunk[i], v[i])
            got = np.frombuffer(data.as_py(), np.uint64)
            if b[i] is None:
                team, keys, last = mine, got, None
                continue
            if mine == team and b[i] == last:
                continue  # a document that is there twice
            last = b[i]
            if mine != team:
                raise RuntimeError("a team without its shared set")
            # Both are sorted and distinct, so equal neighbours of the merged ones are shared.
            both = np.sort(np.concatenate([keys, got]), kind="stable")
            for column, x in zip(out, (a[i], b[i], n_a[i], n_b[i], int((both[1:] == both[:-1]).sum())), strict=True):
                column.append(x)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b", "n_a", "n_b", "shared"])


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, order: tuple) -> DataFrame:
    """The pairs that reach the similarity. pairs: a written table of a, b, n_a, n_b; order: levels, parts, renamed sets."""
    spark = pairs.sparkSession
    of = lambda c: classes.select(F.col("cls").alias(c), F.col("sizes").alias(f"s_{c}"))
    # The pairs of a set are dealt to teams, which have the shared set once each; a set with very many pairs has larger teams.
    size = F.greatest(F.lit(float(TEAM)), F.sqrt("deg"))
    teams = pairs.groupBy("a").agg(F.count("*").alias("deg")).select("a", "deg", F.ceil(F.col("deg") / size).cast("long").alias("teams"))
    dealt = skewed_lookup(pairs, materialize(teams, "join-teams"), "a", "deg", F.col("b"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("teams"))).drop("teams", "deg")
    heads = dealt.select("a", "chunk").distinct().join(of("a"), "a")
    sized = dealt.join(of("b"), "b").join(heads, ["a", "chunk"]).select("a", "b", "n_a", "n_b", "s_a", "s_b", "chunk")
    dealt = materialize(sized.mapInArrow(tidy(_bounded), "a long, b long, n_a int, n_b int, chunk long"), "join-bounded")
    none = F.lit(None)
    heads = dealt.select("a", "chunk").distinct().select(F.col("a").alias("cls"), "a", "chunk", none.cast("long").alias("b"), none.cast("int").alias("n_a"), none.cast("int").alias("n_b"))
    asked = dealt.select(F.col("b").alias("cls"), "a", "chunk", "b", "n_a", "n_b").union(heads)
    asked = materialize(asked.join(classes.select("cls", F.col("least").alias("doc_id")), "cls"), "join-asked")
    shared = spark.sparkContext.broadcast((order, _bitmap(asked.select("doc_id").distinct())))
    hashed = docs.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS)))
    sets = hashed.mapInArrow(tidy(_segments(shared)), "doc_id long, cls long, v int, keys binary")
    # The sets are moved twice only: to those who ask, and to their teams.
    team = ["a", "chunk", "v"]
    asked = asked.withColumnsRenamed({"cls": "_cls", "doc_id": "_id"})
    met = sets.join(asked, (F.col("cls") == F.col("_cls")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    counted = met.select(*team, "b", "n_a", "n_b", "keys")
    counted = counted.repartition(partitions(spark), *team).sortWithinPartitions(*team, F.asc_nulls_first("b"))
    parts = counted.mapInArrow(tidy(_overlaps), "a long, b long, n_a long, n_b long, shared long")
    sums = parts.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"))
    return sums.filter(F.col("shared") * DEN >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * NUM).select("a", "b")


def _numbered(classes: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Written classes with cls, a number each; and the numbers of the sets whose first 64 bits another set has."""
    classes = classes.withColumn("cls", F.conv(F.substring("sig", 1, 16), 16, -10).cast("long"))
    classes = materialize(classes, "join-classes")
    twice = classes.groupBy("cls").agg(F.count("*").alias("n"), F.min("sig").alias("stays")).filter("n > 1")
    found = classes.select("sig", "cls").join(twice.select("cls", "stays"), "cls").filter("sig <> stays").select("sig").limit(CLASHES + 1).collect()
    if len(found) > CLASHES:
        raise RuntimeError(f"more than {CLASHES} sets share their first 64 bits with another")
    renamed = {r["sig"]: int(np.uint64(xxhash.xxh3_64_intdigest(r["sig"].encode(), seed=1)).astype(np.int64)) for r in found}
    if renamed:
        pairs = [x for k, v in renamed.items() for x in (F.lit(k), F.lit(v))]
        classes = materialize(classes.withColumn("cls", F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("sig")), F.col("cls"))), "join-classes")
    return classes, renamed


def _cells_of(led: DataFrame, classes: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of lists whose sets lie in different components, dealt to cells: cell, cls, n, pos, root, side, bits.

    A list of up to CELL sets is a cell. A longer one is cut by size, so that only neighbours can be similar, and by hash.
    """
    rest = led.filter("cls <> lead").select("key", "cls", "n", "pos")  # the lead's pairs are verified
    rooted = rest.join(known, F.col("cls") == F.col("node"), "left").select("key", "cls", "n", "pos", F.coalesce("root", "cls").alias("root"))
    rooted = materialize(rooted.withColumn("band", F.floor(F.log("n") / F.lit(float(np.log(1.34)))).cast("int")), "join-rooted")
    bands = rooted.groupBy("key", "band").agg(F.count("*").alias("m"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    one, along = Window.partitionBy("key"), Window.partitionBy("key").orderBy("band")
    bands = bands.withColumns({"all": F.sum("m").over(one), "mixed": F.min("r0").over(one) != F.max("r1").over(one)})  # few bands a list
    parts = lambda m: F.ceil(m / F.lit(CELL)).cast("long")
    beside = lambda f, by: F.when(f("band").over(along) == F.col("band") + by, parts(f("m").over(along))).otherwise(0)
    bands = bands.withColumns({"own": parts(F.col("m")), "up": beside(F.lead, 1), "down": beside(F.lag, -1)}).filter("mixed")
    band_key = F.concat_ws(":", "key", "band")
    bands = materialize(bands.select(band_key.alias("of"), "m", "all", "own", "up", "down"), "join-bands")
    met = skewed_lookup(rooted.withColumn("of", band_key), bands, "of", "m", F.col("cls")).filter("m IS NOT NULL")
    g = F.pmod(F.xxhash64("cls"), F.col("own"))

    def cell(kind: int, band: Column, first: Column, second: Column, side: Column) -> Column:
        return F.struct(F.xxhash64("key", F.lit(kind), band, first, second).alias("cell"), side.cast("int").alias("side"))

    def over(n: str, make) -> Column:
        return F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(n) - 1, F.lit(0))), lambda i: i < F.col(n)), make)

    band = F.col("band")
    within = over("own", lambda i: cell(1, band, F.least(g, i), F.greatest(g, i), F.when(g == i, 2).otherwise((g > i).cast("int"))))
    above = over("up", lambda i: cell(2, band, g, i, F.lit(0)))
    below = over("down", lambda i: cell(2, band - 1, i, g, F.lit(1)))
    whole = F.array(cell(0, F.lit(0), F.lit(0), F.lit(0), F.lit(2)))
    dealt = met.select("cls", "n", "pos", "root", F.explode(F.when(F.col("all") <= CELL, whole).otherwise(F.concat(within, above, below))).alias("c"))
    signed = dealt.join(classes.select("cls", "bits"), "cls").select("c.cell", "cls", "n", "pos", "root", "c.side", "bits")
    return signed.repartition(partitions(led.sparkSession), "cell").sortWithinPartitions("cell")


def _joined(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For docs of doc_id and text, written tables: rows (doc_id, n_shingles, sig), sets (sig, n_docs, component_id) and the key of a text of each component."""
    spark = docs.sparkSession
    n = partitions(spark)
    survey = materialize(docs.mapInArrow(tidy(_survey), _SURVEY), "join-survey")
    rows = survey.filter("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "sig")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "body")).alias("first")
    classes = survey.filter("kind = 0 AND sig IS NOT NULL").groupBy("sig").agg(first, F.count("*").alias("n_docs"), F.first("sizes").alias("sizes"), F.first("bits").alias("bits"))
    classes, renamed = _numbered(classes.select("sig", "first", F.col("first.doc_id").alias("least"), "n_docs", "sizes", "bits"))
    order = (*_levels(survey), renamed)
    shared = spark.sparkContext.broadcast(order)
    entries = docs.select("text").mapInArrow(tidy(_prefixes(shared, 4 * n)), "fragment long, part long, cut boolean, entries binary")
    listed = entries.repartition(n, "fragment", "part").sortWithinPartitions("fragment", "part").mapInArrow(tidy(_lists), _PAIRED)
    listed = materialize(listed, "join-lists")

    distinct = lambda df: df.filter("kind = 0").select("a", "b", "n_a", "n_b").distinct()
    long = listed.filter("kind = 1").select("key", F.col("a").alias("cls"), F.col("n_a").alias("n"), "pos")
    share = F.count("*") / (F.first("n") - F.ceil(F.first("n") * NUM / DEN) + 1)
    scored = materialize(long.join(long.groupBy("cls").agg(share.alias("score")), "cls").select("key", "cls", "n", "pos", "score"), "join-scored")
    central = F.min(F.struct((-F.col("score")).alias("s"), "cls", "n", "pos")).alias("x")
    leads = scored.groupBy("key").agg(F.count("*").alias("m"), central).filter("m > 1")
    leads = materialize(leads.select("key", "m", F.col("x.cls").alias("lead"), F.col("x.n").alias("lead_n"), F.col("x.pos").alias("lead_pos")), "join-leads")
    led = materialize(skewed_lookup(scored.drop("score"), leads, "key", "m", F.col("cls")).filter("lead IS NOT NULL"), "join-led")
    close = passing(F.col("n"), F.col("pos"), F.col("lead_n"), F.col("lead_pos"))
    stars = led.filter((F.col("cls") != F.col("lead")) & close).select(F.col("lead").alias("a"), F.col("cls").alias("b"), F.col("lead_n").alias("n_a"), F.col("n").alias("n_b"))
    pairs = materialize(distinct(listed).union(stars.distinct()).distinct(), "join-pairs")
    links = materialize(_verified(pairs, docs, classes, order), "join-links")
    known = connected_components(links)
    rest = materialize(distinct(_cells_of(led, classes, known).mapInArrow(tidy(_cells), _PAIRED)), "join-rest")
    if not rest.isEmpty():
        known = connected_components(links.union(_verified(rest, docs, classes, order)))

    places = classes.join(known, F.col("cls") == F.col("node"), "left").select("sig", "n_docs", "first", F.coalesce("root", "cls").alias("place"))
    firsts = materialize(places.groupBy("place").agg(F.min("first").alias("rep"), F.count("*").alias("sets")), "join-firsts")
    found = materialize(skewed_lookup(places, firsts, "place", "sets", F.col("sig")).select("sig", "n_docs", F.col("rep.doc_id").alias("component_id")), "join-components")
    return rows, found, firsts.select(F.concat_ws(":", "rep.body", F.col("rep.doc_id").cast("string")).alias("key"))


def _plain(docs: DataFrame, ident: str, text: str) -> DataFrame:
    return docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def ngram_join(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Words are what stands between ASCII white space after lower-casing A-Z; a set is that of distinct 5-word n-grams, or
    the whole sequence as one where there are fewer words. Documents whose sets have a Jaccard similarity of 0.75 or more
    are linked; component_id is the smallest doc_id that links reach. A text without words, or null, has no n-grams and
    links with nothing. Sets are compared by 58-bit hashes in their order, and equal ones found by 128 bits. Null doc_ids
    link but give no component_id of their own; rows that repeat a doc_id with other texts link each by its own text.
    Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    rows, found, _ = _joined(_plain(docs, ident, text))
    out = skewed_lookup(rows, found, "sig", "n_docs", F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each component, all columns kept: that of the smallest doc_id, or one without where all are null.

    Where the smallest doc_id has several texts in the component, that of the least text hash stays; of rows that repeat
    an id and a text, the one whose columns have the least hash. Rows without words all stay. An empty table gives an
    empty result.
    """
    _, _, reps = _joined(_plain(docs, ident, text))
    key = fresh("_key", docs.columns)
    keyed = one_row_each(with_text_key(docs, key, _body, ident, text), key)
    kept = reps.select(F.col("key").alias(key), F.lit(True).alias(f"{key}_kept"))
    return keyed.join(kept, key, "left").filter(F.col(f"{key}_kept") | F.col(key).startswith("~")).select(docs.columns)
