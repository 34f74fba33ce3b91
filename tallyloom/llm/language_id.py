"""Language identification: known words first, then shorter and shorter character n-grams.

The model holds, for each language, log relative frequencies of its most frequent words and of the character n-grams of
its words. A text's score in a language is the sum over its words: a known word adds its own log frequency; an unseen word
is covered from the left by the longest known n-gram at each place, n-grams shrinking down to one character; a character
no language knows adds the same to all. Each word weighs the same, whichever way it is scored.
"""

from __future__ import annotations

import functools
import math
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import tidy

SAMPLE_DOCS = 4000  #: parameter of the fit: labelled documents of each language, the same bound at every size of input
LANGUAGES = 10_000  #: parameter of the fit: labels that are learnt, the most frequent ones; more than there are languages
WORDS, WORDS_EACH = 1_000_000, 40_000  #: parameters of the fit: known words of all languages, and of each at most
GRAMS, GRAMS_EACH = 500_000, 20_000  #: likewise for n-grams of each length
LONGEST = 4  #: characters of the longest n-gram
UNKNOWN = "und"
MEMO = 200_000  #: words whose rows a worker keeps,
MEMO_BYTES = 64 << 20  #: and the bytes that these take, at most
PART = 50_000  #: words of a text that are scored at once
LEAST_SCORE = 0.4  #: below it a filter rejects


_RUN = re.compile(r"[^\W\d_]+")


@functools.cache
def _numbers() -> dict[int, str]:
    """Characters that only count as numbers, such as fractions, to spaces; digits of any script are none of them."""
    return {i: " " for i, c in enumerate(map(chr, range(sys.maxunicode + 1))) if c.isalnum() and not c.isalpha() and not c.isdecimal()}


class Table:
    """Log relative frequencies of keys, in those languages that have them; `absent` is that of a key a language doesn't have."""

    def __init__(self, counts: list[dict[str, int]]) -> None:
        keys = sorted(set().union(*counts))
        self.at = {k: i for i, k in enumerate(keys)}
        total = np.array([sum(c.values()) for c in counts], float) + 0.5 * len(keys)
        self.absent = np.log(0.5 / total).astype(np.float32)
        rows = np.array([self.at[k] for c in counts for k in c], np.int64)
        lang = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
        value = np.log((np.array([n for c in counts for n in c.values()], float) + 0.5) / total[lang]).astype(np.float32)
        order = np.lexsort((lang, rows))
        self.lang, self.value = lang[order].astype(np.int32), value[order]
        self.first = np.searchsorted(rows[order], np.arange(len(keys) + 1))

    def row(self, key: str) -> np.ndarray | None:
        """The key's log frequency in every language; None if no language has it."""
        i = self.at.get(key)
        if i is None:
            return None
        out, own = self.absent.copy(), slice(self.first[i], self.first[i + 1])
        out[self.lang[own]] = self.value[own]
        return out


@dataclass
class Model:
    languages: list[str]
    words: Table | None
    grams: list[Table]  #: by length, from 1 on

    def unseen(self, word: str) -> np.ndarray:
        """Mean log frequency of the longest known n-grams that cover the word."""
        total, n, at = np.zeros(len(self.languages)), 0, 0
        marked = f"_{word}_"
        while at < len(marked):
            for size in range(min(LONGEST, len(marked) - at), 0, -1):
                got = self.grams[size - 1].row(marked[at : at + size])
                if got is not None:
                    total += got
                    break
            else:
                size = 1
            n, at = n + 1, at + size
        return total / n


def tokens(text: str) -> list[str]:
    """Runs of letters in lower case."""
    if not text.isascii() and any(ord(c) in _numbers() for c in set(text)):
        text = text.translate(_numbers())
    return _RUN.findall(text.lower())


def fit(counts: dict[str, dict[str, int]]) -> Model:
    """counts: language to its frequent words and their numbers."""
    languages = sorted(k for k, c in counts.items() if c)
    if not languages:
        return Model([], None, [])
    grams: dict[str, dict[int, Counter]] = {k: defaultdict(Counter) for k in languages}
    for lang in languages:
        for word, n in counts[lang].items():
            marked = f"_{word}_"
            for size in range(1, LONGEST + 1):
                for i in range(len(marked) - size + 1):
                    grams[lang][size][marked[i : i + size]] += n
    each = min(GRAMS_EACH, max(1, GRAMS // len(languages)))
    most = lambda table: dict(sorted(table.items(), key=lambda x: (-x[1], x[0]))[:each])
    return Model(languages, Table([counts[k] for k in languages]), [Table([most(grams[k][size]) for k in languages]) for size in range(1, LONGEST + 1)])


class _Rows(dict):
    """Word to the row of `table` with its log frequencies."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.most = max(1, min(MEMO, MEMO_BYTES // (4 * len(model.languages))))
        self.table = np.zeros((min(1024, self.most), len(model.languages)), np.float32)

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        known = self.model.words.row(word)
        self.table[at] = self.model.unseen(word) if known is None else known
        self[word] = at
        return at


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.rows = model, _Rows(model) if model.languages else None

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its posterior; (und, 0) without letters."""
        words = tokens(text or "")
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.languages))
        step = min(PART, self.rows.most)
        for start in range(0, len(words), step):
            part = words[start : start + step]
            if len(self.rows) + len(part) > self.rows.most:
                self.rows = _Rows(self.model)
            at = np.fromiter(map(self.rows.__getitem__, part), np.int64, len(part))
            total += self.rows.table[at].sum(axis=0, dtype=float)
        total /= math.sqrt(len(words))  # words of a text depend on each other
        best = int(np.argmax(total))
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def held_out(ident: Column) -> Column:
    """True for the fold that nothing is learnt from."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def emit() -> Iterator[pa.RecordBatch]:
        for lang, table in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(table), pa.string()), pa.array(table.keys(), pa.string()), pa.array(table.values(), pa.int64())], names=["lang", "word", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts[lang].update(tokens(text.as_py()))
            if sum(map(len, counts.values())) > 500_000:
                yield from emit()
    yield from emit()


def train(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on at most SAMPLE_DOCS labelled documents of each language outside the held-out fold, those of least id hash.

    The ids alone give each language a hash below which about that many lie, so only the sample's texts are read on.
    Words are counted on the executors; the driver gets each language's most frequent ones, WORDS altogether at most. Each
    of the LANGUAGES most frequent labels is learnt, in equal shares of WORDS and GRAMS.
    """
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.withColumn("h", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(1 << 40)))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return fit({})
    below = docs.sparkSession.createDataFrame([(r["lang"], int(min(1.0, 1.5 * SAMPLE_DOCS / r["count"]) * (1 << 40))) for r in sizes], "lang string, below long")
    near = rows.filter(F.col("text").isNotNull()).join(F.broadcast(below), "lang").filter("h < below")  # LANGUAGES rows at most
    order = Window.partitionBy("lang").orderBy("h", "doc_id", F.xxhash64("text"))
    sample = near.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= SAMPLE_DOCS).select("lang", "text")
    words = sample.repartition(16).mapInArrow(tidy(_count), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    each = min(WORDS_EACH, max(1, WORDS // len(sizes)))
    top = words.withColumn("k", F.row_number().over(most)).filter(F.col("k") <= each).select("lang", "word", "n")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for r in top.toPandas().itertuples(index=False):
        counts[r.lang][r.word] = int(r.n)
    return fit(counts)


def identify(docs: DataFrame, model: Model | None = None, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score.

    The text alone decides; lang is read to train only, and not at all where a model is given. Null texts and those
    without letters give und with score 0, as does every text when nothing could be learnt. Ties go to the language that
    sorts first. A null doc_id isn't held out. Repeated rows are scored alike; other columns are ignored, whatever their
    names; an empty table gives an empty result. Labels beyond the LANGUAGES most frequent, and words and n-grams beyond
    the model's shares, aren't learnt: parameters of the fit.
    """
    model = model or train(docs, ident, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            got = [scorer.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g for g, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    source = docs.select(F.col(ident).cast("long").alias("doc_id"), held_out(F.col(ident)).alias("held_out"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(tidy(score), "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of docs whose language is known with a score of LEAST_SCORE or more; all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, ident, text, lang))
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            got = [scorer.predict(t.as_py()) for t in batch.column(at)]
            yield batch.filter(pa.array([g != UNKNOWN and s >= LEAST_SCORE for g, s in got], pa.bool_()))

    return docs.mapInArrow(tidy(keep), docs.schema)
