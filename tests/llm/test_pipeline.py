"""The pipeline's stages against brute force, each on what its predecessor kept."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F
from test_operators import LOW, near_copies, plain_join, plain_tiling

import corpus_pipeline
from tallyloom.llm import language_id, packing, tokens

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"


def documents():
    w = ITEM.split()
    texts = [f"plain document number {i} about {'cats dogs birds fish'.split()[i % 4]} and nothing else of note w{i} x{i} y{i}" for i in range(40)]
    texts += ["Same words exactly here", "same WORDS exactly here", "12345 !!!", "", None]
    texts += near_copies(12, 80, 2, 5) + [f"quote: {ITEM} end", " ".join(w[7:] + ["between"] + w[:7])] + ["word " * 9000]
    return [(i, t, "en" if i % 3 else "de", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").translate(LOW))


def leaks(text):
    item, doc = words(ITEM), words(text)
    names = {x: i for i, x in enumerate(dict.fromkeys(item + doc))}
    tiles = plain_tiling([names[x] for x in item], [names[x] for x in doc])
    return sum(t[0] for t in tiles) >= 0.5 * len(item)


def test_stages(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scorer = language_id.Scorer(language_id.train(docs))
    text = {r[0]: r[1] for r in rows}

    want = [set(), set(), set(), set()]
    want[0] = {i for i, t in text.items() if scorer.predict(t)[0] != "und" and scorer.predict(t)[1] >= language_id.LEAST_SCORE}
    last = {}
    for i in sorted(want[0]):
        last[(text[i] or "").translate(LOW)] = i
    want[1] = set(last.values())
    order = sorted(want[1])
    want[2] = {order[c] for _, c in plain_join([text[i] for i in order])}
    want[3] = {i for i in want[2] if not leaks(text[i])}
    assert len({len(w) for w in want}) == 4  # every stage has something to do

    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        got = {r.doc_id: tuple(r) for r in docs.collect()}
        assert set(got) == want[k], name
        assert all(got[i] == rows[i] for i in got)

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    enc = tokens.encoder(tokens.default_vocabulary())
    for i in want[3]:
        assert sum(r.n_tokens for r in packed if r.doc_id == i) == enc.count(text[i]) + 1
    assert {r.doc_id for r in packed} == want[3]
    ends = {}
    for r in packed:
        ends[r.bin_id] = ends.get(r.bin_id, 0) + r.n_tokens
        assert r.bin_used <= r.bin_size and r.bin_size in packing.CAPACITIES
    assert all(r.bin_used == ends[r.bin_id] for r in packed)
    assert np.all([len(corpus_pipeline.STAGES) == 5, [n for n, _ in corpus_pipeline.STAGES][0] == "language_id"])


def kept_rows(stage, rows):
    """What a stage keeps of (doc_id, text, tag), row by row; which of rows with the same id and text stays is left open."""
    last = lambda group: max(group, key=lambda r: (r[0] is not None, r[0] or 0))
    if stage == "exact_dedup":
        groups = {}
        for r in rows:
            groups.setdefault((r[1] or "").translate(LOW), []).append(r)
        return [last(g)[:2] for g in groups.values()]
    if stage == "ngram_join":
        texts = list({(r[0], r[1]) for r in rows})
        groups, out = {}, []
        for (i, t), (n, c) in zip(texts, plain_join([t for _, t in texts]), strict=True):
            if n:
                groups.setdefault(c, []).append((i, t))
            else:
                out += [(i, t)] * sum(r[:2] == (i, t) for r in rows)
        return out + [min(g, key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh3_128_hexdigest(r[1]))) for g in groups.values()]
    return [r[:2] for r in rows if not leaks(r[1])]


def test_stages_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, repeated rows, no text, columns that clash: each stage against brute force on its predecessor's rows."""
    w = ITEM.split()
    copies = near_copies(8, 60, 2, 9)
    texts = ["the plain words of a page", "THE plain words of a page", "the plain words of a page", *copies, *copies[:3], f"see {ITEM}", f"see {ITEM}!", " ".join(w[7:] + ["and"] + w[:7]), None, "", "1 2 3", "short text", "short text"]
    ids = [5, 5, None, *range(5, 14), None, 5, 5, 5, None, 3, None, None, 2, None, None]
    rows = [(i, t, f"row{k}") for k, (i, t) in enumerate(zip(ids, texts, strict=True))] + [(5, "the plain words of a page", "again"), (13, copies[8], "again")]
    make = lambda r: spark.createDataFrame(r, "doc_id long, text string, tag string").withColumns({c: F.lit("clash") for c in ("row", "n", "keep_id", "_key", "_row", "_seeds", "sig", "key", "lang")})
    spark.createDataFrame([(1, ITEM), (1, ITEM), (None, "no such thing anywhere")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = make(rows)
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        got = [tuple(r)[:3] for r in got.collect()]
        plain = (lambda r: (r[0], (r[1] or "").translate(LOW))) if name == "exact_dedup" else (lambda r: r[:2])
        assert sorted(map(plain, got), key=str) == sorted(map(plain, kept_rows(name, rows)), key=str), name
        assert set(got) <= set(rows) and len(set(got)) == len(got)
        rows = sorted(got, key=str)
    packed = corpus_pipeline.STAGES[-1][1](spark, make(rows), str(tmp_path)).collect()
    assert sorted((r.doc_id for r in packed), key=str) == sorted((r[0] for r in rows), key=str)


def test_stages_on_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).isEmpty()
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
