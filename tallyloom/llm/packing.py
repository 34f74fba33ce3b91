"""Best-fit packing of token sequences into bins of several permitted lengths.

Pieces are packed longest first. A piece goes to the open bin with the least room that still holds it; where there is none,
the bin size is opened that costs least for a token, given what is left to fill it; in the end each bin shrinks to the
least permitted size that holds its contents. Sequences are dealt to groups of bounded size by a hash, and groups are packed
independently, so packing has no serial part; with GROUP pieces in each, the waste of unfilled last bins is negligible.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions, tidy
from .tokens import default_vocabulary, encoder

CAPACITIES = (256, 512, 1024, 2048, 4096)  #: permitted lengths in tokens
OVERHEAD = 32  #: what a bin costs besides its tokens
SQUARE = 1 / 16384  #: what a pair of its tokens costs
GROUP = 20_000  #: pieces that are packed together, about
MOST = 4 * GROUP  #: and at most
COPIES = 1 << 16  #: equal rows that are made at once


def cost(capacity: int) -> float:
    return capacity + OVERHEAD + SQUARE * capacity * capacity


class Packer:
    """Place pieces longest first; sizes() are the final capacities."""

    def __init__(self, capacities: Sequence[int], total: int) -> None:
        self.capacities = sorted(capacities)
        self.rest = total  #: tokens not placed yet
        self.rooms: list[list[int]] = [[] for _ in range(self.capacities[-1] + 1)]
        self.open = 0  #: bit r is set where a bin has room r
        self.used: list[int] = []
        self.size: list[int] = []

    def place(self, n: int) -> tuple[int, int]:
        """The bin of a piece of n tokens, and its place there."""
        fits = self.open >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            bins = self.rooms[room]
            b = bins.pop()
            if not bins:
                self.open ^= 1 << room
        else:
            able = self.capacities[bisect_left(self.capacities, n) :]
            room = min(able, key=lambda c: (cost(c) / min(c, max(self.rest, n)), c))
            b = len(self.used)
            self.used.append(0)
            self.size.append(room)
        at = self.used[b]
        self.used[b] += n
        self.rest -= n
        if room > n:
            self.rooms[room - n].append(b)
            self.open |= 1 << (room - n)
        return b, at

    def sizes(self) -> list[int]:
        return [self.capacities[bisect_left(self.capacities, u)] for u in self.used]


def _lengths(vocabulary: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            bodies = [xxhash.xxh3_64_intdigest(t.encode()) - (1 << 63) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.int64()), pa.array([enc.count(t) + end for t in texts], pa.int64())], names=["doc_id", "body", "n_tokens"])

    return run


_PACKED = "doc_id long, piece long, start long, n_tokens long, bin_id long, bin_start long, bin_size long, bin_used long"


def _pack(capacities: Sequence[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group, longest first; after MOST pieces of a group, new bins are opened for the rest."""
        group, held, before = None, [], 0

        def finish() -> Iterator[pa.RecordBatch]:
            nonlocal before
            packer = Packer(capacities, sum(x[3] for x in held))
            placed = [packer.place(x[3]) for x in held]
            sizes = packer.sizes()
            before += len(sizes)
            for k in range(0, len(held), 50_000):
                part, where = held[k : k + 50_000], placed[k : k + 50_000]
                first = (group << 32) + before - len(sizes)
                columns = [*zip(*part, strict=True), [first + b for b, _ in where], [at for _, at in where], [sizes[b] for b, _ in where], [packer.used[b] for b, _ in where]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in _PACKED.split(", ")])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for g, *x in zip(*columns, strict=True):
                if held and (g != group or len(held) >= MOST):
                    yield from finish()
                    held = []
                if g != group:
                    group, before = g, 0
                held.append(tuple(x))
        if held:
            yield from finish()

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, capacities: Sequence[int] = CAPACITIES, ident: str = "doc_id", text: str = "text", end: int = 1) -> DataFrame:
    """One row for each piece of each row of docs: doc_id, piece, start, n_tokens, bin_id, bin_start, bin_size, bin_used.

    A document is its tokens and `end` end tokens, so null and empty texts have those only. One longer than the largest
    capacity is cut into pieces of that length and a rest; start is where a piece begins in the document, bin_start where
    in its bin. Repeated rows are packed each. The same rows
    give the same bins, however they are dealt over files. Other columns are ignored, whatever their names; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    most = max(capacities)
    source = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    lengths = materialize(source.mapInArrow(tidy(_lengths(vocabulary, end)), "doc_id long, body long, n_tokens long"), "pack-lengths")
    # Rows that repeat an id and a text are alike: they are counted and made again, so they are dealt like all others.
    rows = lengths.groupBy("doc_id", "body", F.col("n_tokens").alias("all")).agg(F.count("*").alias("n"))
    runs = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))).alias("run"))
    first = F.col("run") * COPIES
    copies = runs.select("doc_id", "body", "all", F.explode(F.sequence(first, F.least(first + COPIES, F.col("n")) - 1)).alias("copy"))
    cuts = F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("all") - 1, F.lit(0)) / most))
    pieces = copies.select("*", F.explode(cuts).alias("piece"))
    pieces = pieces.withColumn("start", F.col("piece") * most).withColumn("n_tokens", F.least(F.lit(most), F.col("all") - F.col("start"))).filter("n_tokens > 0")
    total = lengths.agg(F.sum(F.ceil(F.col("n_tokens") / most))).first()[0] or 0
    groups = max(1, -(-total // GROUP))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "body", "copy", "piece"), F.lit(groups)))
    n = min(groups, max(partitions(spark), 1) * 4)
    sorted_ = dealt.repartition(n, "group").sortWithinPartitions("group", F.desc("n_tokens"), "doc_id", "body", "piece", "copy")
    return sorted_.select("group", "doc_id", "piece", "start", "n_tokens").mapInArrow(tidy(_pack(capacities)), _PACKED)
