"""Quality by co-training: a view of the text and one of the page's metadata teach each other.

Both views are linear classifiers over hashed features: words and their shapes in one, source, language and stated
length in the other. They start from labels; in every round each scores all unlabelled documents outside the held-out fold and hands the
other those that it is most confident of and hasn't handed over yet. Features are written once and read in every round. On labels kept aside the views' scores are calibrated and weighed against each other; the combination scores
all documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_chunks, materialize, one_row_each, tidy

LABELLED = 6000  #: labelled documents that are trained on at most, at every size of input
ROUNDS = 3
HANDED = 600  #: documents of either pseudo-label that a view hands over in a round at most
BUCKETS = 32  #: groups that the tasks' candidates are dealt to
CONFIDENT = 0.95
KEPT = 0.5  #: score from which a document is kept
WORD_CELLS, SHAPE_CELLS, STAT_CELLS, META_CELLS = 1 << 15, 1 << 12, 1 << 6, 1 << 10
MEMO = 300_000
_SHAPE = [(re.compile(r"[^\W\d_]+"), lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "Aa" if m[0][0].isupper() else "a"), (re.compile(r"\d+"), lambda m: "0")]


def _cell(value: str, cells: int) -> int:
    return zlib.crc32(value.encode("utf-8", "surrogatepass")) % cells


def shape(word: str) -> str:
    """Letters, digits and marks of a word, runs of letters and digits as one."""
    for pattern, to in _SHAPE:
        word = pattern.sub(to, word)
    return word[:12]


class _Cells(dict):
    """Word to its cell of the text view's features: word cells, then shape cells."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= MEMO:
            self.clear()
        got = self[word] = (_cell(word.lower(), WORD_CELLS), WORD_CELLS + _cell(shape(word), SHAPE_CELLS))
        return got


_CELLS = _Cells()


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Cells and their shares of the text's words; two more cells say how often words repeat next to each other and at all."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    at = np.fromiter((c for w in words for c in _CELLS[w]), np.int64, 2 * len(words))
    cells, counts = np.unique(at, return_counts=True)
    word = at[::2]
    n = len(words)
    beside = int(10 * (word[1:] == word[:-1]).mean()) if n > 1 else 0
    once = int(10 * len(np.unique(word)) / n)
    first = WORD_CELLS + SHAPE_CELLS
    stats = [first + beside, first + 16 + once + (16 if n > 50 else 0)]
    return np.append(cells, stats).astype(np.int32), np.append(counts / n, [1.0, 1.0]).astype(np.float32)


def meta_features(source: str | None, lang: str | None, n: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the page's metadata: source, language and length, whose logarithm is cut into steps."""
    size = "n=" if n is None else f"n={int(2 * math.log2(max(n, 0) + 1))}"
    values = [f"s={source}", f"l={lang}", size]
    cells = np.unique([_cell(v, META_CELLS) for v in values])
    return cells.astype(np.int32), np.ones(len(cells), np.float32)


class Linear:
    """Logistic regression on sparse rows, by full-batch steps of Adam."""

    def __init__(self, cells: int, l2: float) -> None:
        self.w, self.b, self.l2 = np.zeros(cells), 0.0, l2

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, steps: int = 80, rate: float = 0.5) -> Linear:
        if not len(y):
            return self
        col = np.concatenate([c for c, _ in rows]) if rows else np.zeros(0, np.int64)
        val = np.concatenate([v for _, v in rows])
        row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))  # both classes weigh the same
        m, v, mb, vb = np.zeros_like(self.w), np.zeros_like(self.w), 0.0, 0.0
        self.w, self.b = np.zeros_like(self.w), 0.0
        for t in range(1, steps + 1):
            z = np.bincount(row, val * self.w[col], len(rows)) + self.b
            g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
            gw = np.bincount(col, val * g[row], len(self.w)) + self.l2 * self.w
            gb = g.sum()
            m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            self.w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
            self.b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
        return self

    def score(self, row: tuple[np.ndarray, np.ndarray]) -> float:
        return float(self.w[row[0]] @ row[1]) + self.b


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class CoTrained:
    """The two views and their calibrated combination."""

    def __init__(self) -> None:
        self.text = Linear(WORD_CELLS + SHAPE_CELLS + STAT_CELLS, 1e-6)
        self.meta = Linear(META_CELLS, 1e-3)
        self.mix = np.array([0.0, 1.0, 0.0])  #: bias, weight of the text's score, of the metadata's
        self.alone = np.array([[0.0, 1.0], [0.0, 1.0]])  #: bias and slope of either view's own calibration
        self.given: dict[str, dict[str, int]] = {"text": {}, "meta": {}}  #: pseudo-labels that a view was handed, by document

    def fit(self, rows: list[dict]) -> CoTrained:
        """rows: text, meta (features), y (1 or 0), aside (kept for calibration), to (the view a pseudo-label is for, else None)."""
        aside = [r for r in rows if r["to"] is None and r["aside"]]
        for name, model in (("text", self.text), ("meta", self.meta)):
            train = [r for r in rows if r["to"] == name or (r["to"] is None and not r["aside"])]
            model.fit([r[name] for r in train], np.array([r["y"] for r in train], float))
        y = np.array([r["y"] for r in aside], float)
        if 0 < y.sum() < len(y):
            s = np.array([[self.text.score(r["text"]), self.meta.score(r["meta"])] for r in aside])
            self.alone = np.array([calibrate(s[:, [k]], y) for k in range(2)])
            self.mix = calibrate(s, y)
        return self

    def margins(self, tc: list[bytes], tv: list[bytes], mc: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The views' scores of written features, many documents at once."""

        def dot(view: Linear, cells: list[bytes], values: np.ndarray | None) -> np.ndarray:
            at = np.frombuffer(b"".join(cells), np.uint16)
            row = np.repeat(np.arange(len(cells)), [len(c) // 2 for c in cells])
            w = view.w[at]
            return np.bincount(row, w if values is None else w * values, len(cells)) + view.b

        return dot(self.text, tc, np.frombuffer(b"".join(tv), np.float32)), dot(self.meta, mc, None)

    def scores(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        alone = [sigmoid(self.alone[k][0] + self.alone[k][1] * z) for k, z in enumerate((a, b))]
        return alone[0], alone[1], sigmoid(self.mix[0] + self.mix[1] * a + self.mix[2] * b)


def calibrate(scores: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bias and weights of a logistic regression on few columns, by Newton's steps."""
    x = np.column_stack([np.ones(len(y)), scores])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - 0.1 * w)
    return w


_FEATURES = "row long, doc_id long, held_out boolean, y int, aside boolean, h long, tc binary, tv binary, mc binary"


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        for chunk in in_chunks(iter([batch]), "text"):
            text, *meta = (chunk.column(i).to_pylist() for i in range(5, 9))
            t = [text_features(x) for x in text]
            m = [meta_features(*x)[0] for x in zip(*meta, strict=True)]
            cells = [[f[0].astype(np.uint16).tobytes() for f in t], [f[1].tobytes() for f in t], [c.astype(np.uint16).tobytes() for c in m]]
            n = len(text)
            yield pa.RecordBatch.from_arrays([pa.array(range(row, row + n), pa.int64()), *[chunk.column(i) for i in range(5)], *[pa.array(c, pa.binary()) for c in cells]], names=[f.split()[0] for f in _FEATURES.split(", ")])
            row += n


_TRAINING = ["doc_id", "y", "aside", "tc", "tv", "mc", "to"]


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for batch in batches for r in batch.to_pylist()]
    rows.sort(key=lambda r: (r["to"] or "", r["doc_id"] is None, r["doc_id"] or 0, r["tc"], r["mc"]))
    data = []
    for r in rows:
        meta = np.frombuffer(r["mc"], np.uint16)
        data.append({"text": (np.frombuffer(r["tc"], np.uint16), np.frombuffer(r["tv"], np.float32)), "meta": (meta, np.ones(len(meta), np.float32)), "y": r["y"], "aside": r["aside"], "to": r["to"]})
    m = CoTrained().fit(data)
    values = [m.text.w.astype(np.float32).tobytes(), m.meta.w.astype(np.float32).tobytes(), np.array([m.text.b, m.meta.b, *m.mix, *m.alone.ravel()]).tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=["text", "meta", "rest"])


_PICKS = "to string, y int, sure double, h long, key string, row long"


def _surest(model, most: int):
    """A task's `most` surest documents for either view and label, each once and without those handed over before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: CoTrained = model.value
        best: dict[tuple[str, int], list[tuple]] = {(to, y): [] for to in m.given for y in (1, 0)}
        bar = dict.fromkeys(best, CONFIDENT)

        def prune(k: tuple[str, int]) -> None:
            once = {}
            for r in sorted(best[k]):
                if len(once) < most:
                    once.setdefault(r[2], r)
            best[k] = list(once.values())
            if len(once) == most:
                bar[k] = -best[k][-1][0]

        for batch in batches:
            row, ident, h, tc, tv, mc = (batch.column(i).to_pylist() for i in range(6))
            a, b = m.margins(tc, tv, mc)
            for to, z in (("meta", a), ("text", b)):
                p = sigmoid(z)
                for y, sure in ((1, p), (0, 1 - p)):
                    k = to, y
                    for i in np.flatnonzero(sure >= bar[k]).tolist():
                        key = f"~{row[i]}" if ident[i] is None else str(ident[i])
                        if key not in m.given[to]:
                            best[k].append((-float(sure[i]), h[i], key, row[i]))
                    if len(best[k]) > 4 * most:
                        prune(k)
        for k in best:
            prune(k)
        out = [(*k, -s, h, key, row) for k, rows in best.items() for s, h, key, row in rows]
        kinds = [pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=[f.split()[0] for f in _PICKS.split(", ")])

    return run


def _handed(features: DataFrame, model: CoTrained) -> DataFrame:
    """What the views hand over in a round: HANDED documents at most for either view and label, out of all unlabelled ones."""
    shared = features.sparkSession.sparkContext.broadcast(model)
    pool = features.filter("y IS NULL AND NOT held_out").select("row", "doc_id", "h", "tc", "tv", "mc")
    first = F.min(F.struct((-F.col("sure")).alias("s"), "h", "row")).alias("r")
    each = pool.mapInArrow(tidy(_surest(shared, HANDED)), _PICKS).groupBy("to", "y", "key").agg(first)
    each = each.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)))
    for group in (["to", "y", "bucket"], ["to", "y"]):  # the last step gets BUCKETS * HANDED rows a group at most
        each = each.withColumn("k", F.row_number().over(Window.partitionBy(*group).orderBy("r", "key"))).filter(F.col("k") <= HANDED)
    return materialize(each.select("to", "y", "key", F.col("r.row").alias("row")), "co-picks")


def held_out(ident):
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def featured(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", length: str = "n_chars", label: str = "quality") -> DataFrame:
    """The written features of all rows; y is set for the LABELLED labels of least id hash, the same bound at every size of input."""
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), held_out(F.col(ident)).alias("held_out"), F.col(text).cast("string").alias("text"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.col(length).cast("long").alias("length"))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    y = labels.select(F.col(ident).cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
    y = y.groupBy("doc_id").agg(F.avg("y").alias("y")).filter("y <> 0.5").select("doc_id", F.when(F.col("y") > 0.5, 1).otherwise(0).alias("y"))
    y = materialize(y.orderBy(h, "doc_id").limit(LABELLED), "co-labels")  # at most LABELLED small rows: broadcast
    aside = F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(5)) == 0
    known = rows.join(F.broadcast(y), "doc_id", "left").select("doc_id", "held_out", "y", aside.alias("aside"), h.alias("h"), "text", "source", "lang", "length")
    return materialize(known.mapInArrow(tidy(_featured), _FEATURES), "co-features")


def train(features: DataFrame) -> CoTrained:
    """Fit on the labelled rows, then ROUNDS times also on what the views hand each other."""
    known = features.filter("y IS NOT NULL").withColumn("to", F.lit(None).cast("string")).select(_TRAINING)
    data = materialize(one_row_each(known, "doc_id"), "co-labelled")
    model = CoTrained()
    if data.isEmpty():
        return model
    for turn in range(ROUNDS + 1):
        given, model = model.given, CoTrained()
        got = data.repartition(1).mapInArrow(tidy(_train), "text binary, meta binary, rest binary").first()
        model.text.w, model.meta.w = np.frombuffer(got["text"], np.float32).astype(float), np.frombuffer(got["meta"], np.float32).astype(float)
        rest = np.frombuffer(got["rest"])
        model.text.b, model.meta.b, model.mix, model.alone, model.given = float(rest[0]), float(rest[1]), rest[2:5], rest[5:9].reshape(2, 2), given
        if turn == ROUNDS:
            break
        picks = _handed(features, model)
        found = picks.collect()  # at most 4 * HANDED
        if not found:
            break
        for r in found:
            model.given[r["to"]][r["key"]] = r["y"]
        more = features.drop("y").join(F.broadcast(picks), "row").select(_TRAINING)
        data = data.unionByName(materialize(more, "co-handed"))
    return model


def score_quality(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", length: str = "n_chars", label: str = "quality") -> DataFrame:
    """One row per row of docs: doc_id, held_out, text_score, meta_score, score, kept.

    Scores are probabilities of good quality from 0 to 1, either view's and the combination; kept from KEPT on. held_out
    marks documents whose labels nothing learnt from. Null texts count as empty and are scored by what remains; null
    sources, languages and lengths are values of their own. A labelled id with several texts is learnt by the one whose
    features have the least hash. Labels that contradict each other evenly, or are null, aren't used;
    without any, all scores are 0.5 and all rows are kept. Repeated rows are scored alike; other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """
    features = featured(docs, labels, ident, text, source, lang, length, label)
    model = docs.sparkSession.sparkContext.broadcast(train(features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            got = m.scores(*m.margins(*(batch.column(i).to_pylist() for i in range(2, 5))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(v, pa.float64()) for v in got], pa.array(got[2] >= KEPT, pa.bool_())], names=["doc_id", "held_out", "text_score", "meta_score", "score", "kept"])

    rows = features.select("doc_id", "held_out", "tc", "tv", "mc")
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, text_score double, meta_score double, score double, kept boolean")
