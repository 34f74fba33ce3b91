"""Benchmark decontamination by greedy string tiling.

A Bloom filter of fixed size holds the seeds, all runs of MATCH words of the benchmark and the whole of shorter items;
documents without a hit are done with. The others' seeds are joined with those of the items, which gives the pairs worth
tiling. A pair is tiled on whole texts: running Karp-Rabin hashes find the longest run of words that both have outside of
all tiles, its occurrences are marked, and so on with shorter ones. An item leaks when tiles cover COVERAGE of its words,
in whatever order they stand in the document; one shorter than a tile leaks where it stands as a whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import HASHES, fresh, in_chunks, materialize, partitions, skewed_lookup, text_bytes, tidy

MATCH = 5  #: words of the shortest tile
COVERAGE = 0.5  #: share of an item's words in tiles from which it leaks
FILTER_BITS = 24  #: the seed filter has 2 ** FILTER_BITS bits, whatever the benchmark
SHIFTS = (0, 20, 40)  #: a seed's bits start at these places of its hash
TEAM = 256  #: items of a document that are tiled together
#: Letters and digits, lower-cased A-Z; all other ASCII divides words, and other characters are split before.
_CLEAN = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Blocks of scripts that put no spaces between words (Thai and Lao, Burmese, Khmer, the Tai scripts, Balinese, Javanese, kana, Han, Yi).
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF)]
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(MATCH)], np.uint64)


class _Splits(dict):
    """Code point to what stands for it where words are split."""

    def __missing__(self, point: int) -> str:
        c, kind = chr(point), unicodedata.category(chr(point))
        if point < 128:
            to = c
        elif kind == "Me" or (kind == "Cf" and point != 0x200B) or 0xFE00 <= point <= 0xFE0F or 0xE0100 <= point <= 0xE01EF:
            to = ""  # soft hyphens, joiners, selectors: they don't show
        elif not (c.isalnum() or kind in ("Mn", "Mc")):
            to = " "
        else:
            to = f" {c} " if any(a <= point <= b for a, b in _UNSPACED) else c
        self[point] = to
        return to


_SPLITS = _Splits()


def words_of(text: bytes) -> np.ndarray:
    if not text.isascii():
        chars = text.decode("utf-8", "replace")
        if any(_SPLITS[ord(c)] != c for c in set(chars)):
            text = chars.translate(_SPLITS).encode()
    words = text.translate(_CLEAN).split()
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def seeds_of(words: np.ndarray, size: int = MATCH) -> np.ndarray:
    """The Karp-Rabin hash of every window of size words, MATCH at most."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += words[k : k + n] * _POWERS[k]
    return (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


class _Running:
    """Karp-Rabin hashes of all windows of any length over words, of which some are taken; `at` is where the words stand."""

    def __init__(self, words: np.ndarray, at: np.ndarray) -> None:
        n = len(words)
        self.words, self.at, self.taken = words, at, np.zeros(n, bool)
        with np.errstate(over="ignore"):
            one = np.ones(1, np.uint64)
            power = np.cumprod(np.concatenate([one, np.full(n, _BASE, np.uint64)]), dtype=np.uint64)
            self.back = np.cumprod(np.concatenate([one, np.full(n, _BACK, np.uint64)]), dtype=np.uint64)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:n], dtype=np.uint64)])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the windows of neighbouring words that are free."""
        n = len(self.words) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        used = np.concatenate([[0], np.cumsum(self.taken)])
        k = np.flatnonzero((used[size:] == used[:n]) & (self.at[size - 1 :] - self.at[:n] == size - 1))
        return k, (self.sums[k + size] - self.sums[k]) * self.back[k]


def tile(item: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (length, place in item, place in doc), longest first, then by place in item and doc.

    Takes memory in proportion to both texts, however often their words repeat.
    """
    near = np.flatnonzero(np.isin(seeds_of(doc), seeds_of(item)))
    if not len(near):
        return []
    within = np.zeros(len(doc) + 1, np.int64)  # words of the document that some seed covers: no tile has others
    np.add.at(within, near, 1)
    np.add.at(within, near + MATCH, -1)
    at = np.flatnonzero(np.cumsum(within)[:-1] > 0)
    a, b = _Running(item, np.arange(len(item))), _Running(doc[at], at)
    tiles: list[tuple[int, int, int]] = []

    def shared(size: int) -> bool:
        return bool(np.isin(a.windows(size)[1], b.windows(size)[1]).any())

    most = min(len(item), len(at))
    while most >= MATCH and shared(MATCH):
        low = MATCH
        while low < most:
            mid = (low + most + 1) // 2
            low, most = (mid, most) if shared(mid) else (low, mid - 1)
        places, hashes = b.windows(low)
        order = np.argsort(hashes, kind="stable")
        places, hashes = places[order], hashes[order]
        ahead: dict[int, int] = {}  # by hash, the first occurrence that may be free
        for p, h in zip(*a.windows(low), strict=True):
            if a.taken[p : p + low].any():
                continue
            start, end = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            k = max(ahead.get(int(h), 0), int(start))
            while k < end and (b.taken[places[k] : places[k] + low].any() or (b.words[places[k] : places[k] + low] != item[p : p + low]).any()):
                k += 1
            ahead[int(h)] = k
            if k < end:
                d = int(places[k])
                a.taken[p : p + low] = b.taken[d : d + low] = True
                tiles.append((low, int(p), int(at[d])))
        most = low - 1
    return tiles


def coverage(item: np.ndarray, doc: np.ndarray) -> float:
    n = len(item)
    if 0 < n < MATCH:  # no tile: the whole item or nothing
        return float(len(doc) >= n and np.all([doc[k : len(doc) - n + 1 + k] == item[k] for k in range(n)], axis=0).any())
    return sum(n for n, _, _ in tile(item, doc)) / len(item) if len(item) else 0.0


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ident, text in zip(batch.column(0), text_bytes(batch.column(1)), strict=True):
            words = words_of(text)
            seeds = np.unique(seeds_of(words, min(MATCH, max(1, len(words)))))
            if len(seeds):
                key = xxhash.xxh3_128_hexdigest(words.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([ident.as_py()], pa.int64()), pa.array([len(words)], pa.int64()), pa.array([words.tobytes()], pa.binary()), pa.array([seeds.astype(np.int64).tolist()], pa.list_(pa.int64()))], names=["item", "item_id", "n_words", "words", "seeds"])


def _seed_filter(items: DataFrame) -> np.ndarray:
    """One byte-packed array of fixed size; words of 64 bits are put together on the executors."""
    mask = (1 << FILTER_BITS) - 1
    seed = items.select(F.explode("seeds").alias("s"))
    bits = seed.select(F.explode(F.array(*[F.shiftrightunsigned("s", s).bitwiseAND(F.lit(mask)) for s in SHIFTS])).alias("b"))
    got = bits.groupBy(F.shiftright("b", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("x")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[got["w"].to_numpy(np.int64)] = got["x"].to_numpy(np.int64).astype(np.uint64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _hits(shared, sizes: list[int], at: int, lean: bool):
    """Appends a row number and the seeds of each document that the benchmark may have; `at` is the text's column, left out of other rows if `lean`.

    sizes: the lengths of the windows that the benchmark's seeds are of.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        row = TaskContext.get().partitionId() << 40
        for chunk in in_chunks(batches, at):
            seeds = []
            texts = text_bytes(chunk.column(at))
            for text in texts:
                words = words_of(text)
                s = np.concatenate([np.zeros(0, np.uint64), *[seeds_of(words, size) for size in sizes]])
                for shift in SHIFTS:
                    s = s[bits[((s >> np.uint64(shift)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)]]
                s = np.unique(s)
                seeds.append(s.astype(np.int64).tolist() if len(s) else None)
            n = chunk.num_rows
            columns, found = list(chunk.columns[:-2]), pa.array(seeds, pa.list_(pa.int64()))
            if lean:
                columns[at] = pa.array([t if s else None for t, s in zip(texts, seeds, strict=True)], pa.binary()).cast(columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(range(row, row + n), pa.int64()), found], names=chunk.schema.names)
            row += n

    return run


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of row, team, item, words, text sorted by row and team; a team begins with the document's text."""
    team, doc = None, None
    for batch in batches:
        row, teams, items, words, text = (batch.column(i) for i in range(5))
        out: list[list] = [[], [], []]
        for r, t, i, w, x in zip(row.to_pylist(), teams.to_pylist(), items.to_pylist(), words, text, strict=True):
            if i is None:
                team, doc = (r, t), words_of(x.as_py().encode())
                continue
            if (r, t) != team:
                raise RuntimeError("a team without its document")
            for column, value in zip(out, (r, i, coverage(np.frombuffer(w.as_py(), np.uint64), doc)), strict=True):
                column.append(value)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.float64())], names=["row", "item", "coverage"])


def _flagged(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, lean: bool) -> tuple[DataFrame, DataFrame, str, str]:
    """docs, written, with a row number and the seeds found; what leaks, by row: n_items, w (the worst); the names of both columns."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    every = materialize(bench.mapInArrow(tidy(_items), "item string, item_id long, n_words long, words binary, seeds array<long>"), "bench-items")
    # Items with the same words leak alike: they are searched for once.
    members = materialize(every.groupBy("item").agg(F.count("*").alias("copies"), F.min("item_id").alias("item_id")), "bench-members")
    items = materialize(every.drop("item_id").dropDuplicates(["item"]), "bench-distinct")
    shared = spark.sparkContext.broadcast(_seed_filter(items))
    window = F.least(F.col("n_words"), F.lit(MATCH))
    sizes = sorted(r[0] for r in items.select(window).distinct().collect())  # MATCH at most
    row, seeds = fresh("_row", docs.columns), fresh("_seeds", docs.columns)
    source = docs.withColumns({row: F.lit(0).cast("long"), seeds: F.lit(None).cast("array<long>")})
    schema = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in source.schema.fields])
    rows = materialize(source.mapInArrow(tidy(_hits(shared, sizes, docs.columns.index(text), lean)), schema), "bench-hits")
    hits = rows.filter(F.col(seeds).isNotNull()).select(F.col(row).alias("row"), F.col(text).cast("string").alias("text"), F.col(seeds).alias("seeds"))

    # A leak of an item needs `least` of its distinct seeds, so all but its least - 1 most common ones find it.
    each = items.select("item", "n_words", F.size("seeds").alias("n_seeds"), F.explode("seeds").alias("seed"))
    common = materialize(each.groupBy("seed").agg(F.count("*").alias("items")), "bench-common")
    rare = Window.partitionBy("item").orderBy("items", "seed")
    repeats = F.col("n_words") - window + 1 - F.col("n_seeds")  # windows that repeat another one of the item
    least = F.greatest(F.lit(1), F.ceil(F.col("n_words") * COVERAGE / MATCH) - repeats)
    index = skewed_lookup(each, common, "seed", "items", F.col("item")).withColumn("k", F.row_number().over(rare)).filter(F.col("k") <= F.col("n_seeds") - least + 1)
    index = materialize(index.select("seed", "item"), "bench-index")
    found = hits.select("row", F.explode("seeds").alias("seed"))
    asked = found.groupBy("seed").agg(F.count("*").alias("n")).join(index.groupBy("seed").agg(F.count("*").alias("m")), "seed")
    asked = materialize(asked.select("seed", (F.col("n") * F.col("m")).alias("load")), "bench-loads")
    total = asked.agg(F.sum("load")).first()[0] or 0
    loaded = materialize(skewed_lookup(index, asked, "seed", "load", F.col("item")).filter("load IS NOT NULL"), "bench-asked")
    met = skewed_lookup(found, loaded, "seed", "load", F.col("row"), total)
    pairs = materialize(met.filter("item IS NOT NULL").select("row", "item").distinct(), "bench-pairs")

    per_item = pairs.groupBy("item").agg(F.count("*").alias("n"))
    words = materialize(items.join(per_item, "item").select("item", "n", "words"), "bench-words")
    full = skewed_lookup(pairs, words, "item", "n", F.col("row")).drop("n")
    # A document's items are dealt to teams; each gets its text once, ahead of them.
    per_row = materialize(pairs.groupBy("row").agg(F.count("*").alias("of_row"), F.ceil(F.count("*") / TEAM).cast("long").alias("teams")), "bench-rows")
    full = skewed_lookup(full, per_row, "row", "of_row", F.col("item"))
    none = F.lit(None)
    full = full.select("row", F.pmod(F.xxhash64("item"), F.col("teams")).alias("team"), "item", "words", none.cast("string").alias("text"))
    heads = hits.join(per_row, "row").select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("teams") - 1)).alias("team"), none.cast("string").alias("item"), none.cast("binary").alias("words"), "text")
    dealt = full.union(heads).repartition(partitions(spark), "row", "team").sortWithinPartitions("row", "team", F.asc_nulls_first("item"))
    tiled = dealt.mapInArrow(tidy(_tiled), "row long, item string, coverage double")
    tiled = materialize(tiled, "bench-tiled")
    named = materialize(members.join(tiled.groupBy("item").agg(F.count("*").alias("n")), "item"), "bench-named")
    tiled = skewed_lookup(tiled, named, "item", "n", F.col("row"))
    worst = F.min(F.struct((-F.col("coverage")).alias("c"), F.col("item_id").isNull().alias("no"), "item_id"))
    n_items = F.sum(F.when(F.col("coverage") >= COVERAGE, F.col("copies")).otherwise(0))
    return rows, tiled.groupBy(F.col("row").alias(row)).agg(n_items.alias("n_items"), worst.alias("w")), row, seeds


def decontaminate(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_items (items that leak into it), worst_item, coverage (the largest), contaminated.

    Words are runs of letters and digits with their marks, lower-cased A-Z; in scripts without spaces every character is a
    word. Items with fewer than MATCH words leak where all their words stand in a row, also those of one word; null texts
    count as empty, and items without words leak nowhere. coverage is over the pairs that could leak, 0 where there are none; of items
    with the same coverage the smallest id is worst, and one without id last. Repeated rows are judged alike; other columns are ignored, whatever
    their names. An empty table on either side gives no contaminated rows.
    """
    source = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows, leaks, row, _ = _flagged(source, benchmark, "text", item, item_text, True)
    out = rows.select(row, "doc_id").join(leaks, row, "left")
    n = F.coalesce("n_items", F.lit(0))
    return out.select("doc_id", n.alias("n_items"), F.when(n > 0, F.col("w.item_id")).alias("worst_item"), F.coalesce(-F.col("w.c"), F.lit(0.0)).alias("coverage"), (n > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs that no benchmark item leaks into, all columns kept; each row is judged by its own text, whatever its id.

    Rows without text are clean, and so are all rows where the benchmark is empty. An empty table gives an empty result.
    """
    rows, leaks, row, seeds = _flagged(docs, benchmark, text, item, item_text, False)
    bad = leaks.filter("n_items > 0").select(row)
    near = rows.filter(F.col(seeds).isNotNull()).join(bad, row, "left_anti")
    return rows.filter(F.col(seeds).isNull()).unionByName(near).select(docs.columns)
