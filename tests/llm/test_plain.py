"""Text operators against plain versions of their whole method, and the odd cases of each."""

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import regex
import xxhash
from pyspark.sql import functions as F
from test_operators import BASE, LONG, ODD, empty, holds, plain_secrets, table

from tallyloom.llm import bit_packing, chat_format, co_training, common, language_id, packing, pii, secret_scan, tokens

# -- personal data ------------------------------------------------------------------------------------------------------


def plain_terms(kind, s):
    d = re.sub("[^0-9]", "", s)
    last = re.search("([A-Za-z0-9-]+)$", s)
    last = last[1].lower() if last else ""
    if kind == "ip":
        a, b = (str(int(x)) for x in s.split(".")[:2])
        return [f"{a}.{b}", a]
    word = s.split(" ") + [""] * 3
    return {"email": [last], "email_masked": [last], "card": [d[:1]], "phone": [d[:3], d[:2], d[:1]], "ssn": [s, d[:1]], "iban": [s[:2]], "phone_local": [d[:3], d[:1]], "name": [word[1], word[2]]}[kind]


def plain_pii(texts):
    """Spans with added ones by the method's definition: votes, expectation-maximisation, naive Bayes, overlaps."""
    table = {(k, t): v for k, sides in pii.GAZETTEER.items() for v, terms in zip((1, 0), sides, strict=True) for t in terms.split()}
    spans = []  # row, kind, a, b, votes, features
    for row, text in enumerate(texts):
        text = text or ""
        base = [(m.start(), m.end(), k, m[0]) for k, p in BASE for m in re.finditer(p, text) if holds(k, m[0])]
        added = [(m.start(), m.end(), k, m[0]) for k, p in pii.ADDED.items() for m in regex.finditer(p, text)]
        added = [x for x in added if not any(x[0] < b[1] and b[0] < x[1] for b in base)]
        for a, b, kind, s in base + added:
            left, right = text[max(0, a - pii.CONTEXT) : a], text[b : b + 1]
            # What stands between two matches of a kind is all that the labelers see.
            before = [m.end() for m in regex.finditer(dict(BASE).get(kind) or pii.ADDED[kind], text) if m.end() <= a]
            left = text[max([0, a - pii.CONTEXT, *before]) : a]
            strict = 1 if kind in dict(BASE) else int(bool(regex.search(pii.STRICT[kind], s)))
            known = next((table[kind, t] for t in plain_terms(kind, s) if (kind, t) in table), -1)
            cue = 1 if regex.search(pii.CUES[kind], left.lower()) else 0 if regex.search(pii.AGAINST, left.lower()) else -1
            edge = 0 if regex.search(r"[\p{L}\p{N}]", left[-1:]) or regex.search(r"[\p{L}\p{N}]", right) else 1
            word = re.search(r"(\S*)\s*$", left.lower(), re.A)[1]
            cell = np.int64(np.uint64(xxhash.xxh64_intdigest(word.encode(), seed=42)).astype(np.int64)) % pii.WORD_CELLS
            votes = (strict, known, cue, edge)
            features = [f"v{i}:{v}" for i, v in enumerate(votes)] + [f"n{min(len(s), 40)}", f"w{cell}", "r" + ("s" if re.match(r"\s", right, re.A) else "e" if right == "" else "p")]
            spans.append((row, kind, a, b, votes, features))
    odds = {}
    for kind in {s[1] for s in spans}:
        n = collections.Counter(s[4] for s in spans if s[1] == kind)
        prior, true, false = 0.5, [0.8] * 4, [0.3] * 4

        def posterior(v, prior, true, false):
            t, f = prior, 1 - prior
            for x, p, q in zip(v, true, false, strict=True):
                t, f = (t * p, f * q) if x == 1 else (t * (1 - p), f * (1 - q)) if x == 0 else (t, f)
            return t / (t + f)

        for _ in range(pii.ROUNDS):
            p = {v: c * posterior(v, prior, true, false) for v, c in n.items()}
            q = {v: c - p[v] for v, c in n.items()}
            rate = lambda w, j, mean: (sum(w[v] for v in n if v[j] == 1) + 10 * mean) / (sum(w[v] for v in n if v[j] >= 0) + 10)
            prior, true, false = (sum(p.values()) + 5) / (sum(n.values()) + 10), [rate(p, j, 0.8) for j in range(4)], [rate(q, j, 0.3) for j in range(4)]
        own = [(posterior(s[4], prior, true, false), s) for s in spans if s[1] == kind]
        tp, tq = sum(p for p, _ in own), sum(1 - p for p, _ in own)
        sums = collections.defaultdict(lambda: [0.0, 0.0])
        for p, s in own:
            for f in s[5]:
                sums[f][0] += p
                sums[f][1] += 1 - p
        for _, s in own:
            odds[s[:4]] = math.log((tp + 1) / (tq + 1)) + sum(math.log((sums[f][0] + 1) / (tp + 8)) - math.log((sums[f][1] + 1) / (tq + 8)) for f in s[5])
    out = [[] for _ in texts]
    for s in spans:
        if s[1] in dict(BASE):
            out[s[0]].append((s[2], pii.KINDS.index(s[1]), s[3]))
    for s in sorted((s for s in spans if s[1] not in dict(BASE) and odds[s[:4]] > 0), key=lambda s: (-round(odds[s[:4]], 6), s[2], pii.KINDS.index(s[1]))):
        if not any(k >= len(BASE) and a < s[3] and s[2] < b for a, k, b in out[s[0]]):
            out[s[0]].append((s[2], pii.KINDS.index(s[1]), s[3]))
    return [",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(x)) for x in out]


def private_texts():
    rng = np.random.default_rng(0)
    out = []
    for i in range(60):
        out.append(f"Please call our telephone ({200 + i}) 555-{2000 + i} today, ssn {219 + i}-09-{1000 + i} here, mail a{i}@b.org now")
        out.append(f"Dear Mr John Smith{i % 3 * 'x'}, from Dr Anna Weber (at) home; iban DE89 3704 0044 0532 0130 {i % 10}0 or konto, write jane{i} (at) example{i} (dot) com")
        out.append(f"section 4.0.{i}.1 of the license, part 555-123-{1000 + i}, Dr John Smith(at)example.com and 10.0.0.{i} server {rng.integers(1, 200)}.1.2.3")
    return out


def test_added_spans_are_those_of_the_method(spark):
    texts = private_texts() + ["", None, "Mr Who", "phone 212 555 0199 212-555-0198"]
    texts += texts[:5]  # repeated rows
    got = {r.doc_id: r.spans for r in pii.find_pii(table(spark, texts)).collect()}
    want = plain_pii(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert {k for w in want for k in pii.ADDED if f"{k}:" in w} >= {"ssn", "phone_local", "name", "email_masked"}
    assert got[0] == got[len(texts) - 5]


def test_a_gazetteer_of_ones_own_is_joined(spark, monkeypatch):
    texts = private_texts()
    terms = spark.createDataFrame([("name", "Anna", 0), ("name", "Anna", 1), ("ssn", "2", 1), ("nonsense", "x", 1)], "kind string, term string, vote int")
    first = sorted(r.spans for r in pii.find_pii(table(spark, texts), terms=terms).collect())
    monkeypatch.setattr(pii, "GAZETTEER_MOST", 2)  # too large to be broadcast
    assert sorted(r.spans for r in pii.find_pii(table(spark, texts), terms=terms).collect()) == first


# -- token ids ----------------------------------------------------------------------------------------------------------


def test_ids_of_hot_and_missing_doc_ids(spark):
    """Rows of one id or none are dealt over files; every row is there, starts follow each other, nulls come first."""
    texts = [f"text number {i % 7}" for i in range(300)] + ["", None]
    ids = [None] * 100 + [5] * 150 + list(range(10, 62))
    got = bit_packing.pack_documents(table(spark, texts, ids)).orderBy("start").collect()
    enc = tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    crc = lambda t: zlib.crc32(enc.encode(t or "") + b"\0\0\0\0")
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in got) == collections.Counter((i, crc(t)) for i, t in zip(ids, texts, strict=True))
    assert [r.doc_id for r in got] == sorted(ids, key=lambda i: -1 if i is None else i)
    assert got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))


# -- quality ------------------------------------------------------------------------------------------------------------


def plain_cells(text):
    words = (text or "").split()
    if not words:
        return {}
    cell = lambda v, n: zlib.crc32(v.encode()) % n
    out = collections.Counter()
    for w in words:
        out[cell(w.lower(), co_training.WORD_CELLS)] += 1 / len(words)
        out[co_training.WORD_CELLS + cell(co_training.shape(w), co_training.SHAPE_CELLS)] += 1 / len(words)
    ids = [cell(w.lower(), co_training.WORD_CELLS) for w in words]
    first = co_training.WORD_CELLS + co_training.SHAPE_CELLS
    beside = int(10 * sum(a == b for a, b in zip(ids, ids[1:], strict=False)) / (len(ids) - 1)) if len(ids) > 1 else 0
    out[first + beside] = 1.0
    out[first + 16 + int(10 * len(set(ids)) / len(ids)) + (16 if len(ids) > 50 else 0)] = 1.0
    return dict(out)


def plain_fit(rows, y, l2, steps=80, rate=0.5):
    """Logistic regression by Adam, cell by cell."""
    cells = sorted({c for r in rows for c in r})
    w, m, v, b, mb, vb = dict.fromkeys(cells, 0.0), dict.fromkeys(cells, 0.0), dict.fromkeys(cells, 0.0), 0.0, 0.0, 0.0
    side = [0.5 / max(1, sum(x == k for x in y)) for k in (0, 1)]
    for t in range(1, steps + 1):
        g = [side[int(k)] * (1 / (1 + math.exp(-max(-30, min(30, sum(w[c] * x for c, x in r.items()) + b)))) - k) for r, k in zip(rows, y, strict=True)]
        gw = {c: l2 * w[c] for c in cells}
        for r, e in zip(rows, g, strict=True):
            for c, x in r.items():
                gw[c] += x * e
        for c in cells:
            m[c], v[c] = 0.9 * m[c] + 0.1 * gw[c], 0.99 * v[c] + 0.01 * gw[c] ** 2
            w[c] -= rate * (m[c] / (1 - 0.9**t)) / (math.sqrt(v[c] / (1 - 0.99**t)) + 1e-8)
        gb = sum(g)
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        b -= rate * (mb / (1 - 0.9**t)) / (math.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return lambda r: sum(w.get(c, 0.0) * x for c, x in r.items()) + b


def test_co_training_is_that_of_the_method(spark, monkeypatch):
    """Rounds, exchange, calibration and scores by definition, on a table whose documents are all clearly told apart."""
    monkeypatch.setattr(co_training, "HANDED", 10**6)
    monkeypatch.setattr(co_training, "CONFIDENT", 0.9)
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(words, 8)) + (" !!! ###" if i % 3 == 0 else ""), "en" if i % 2 else None, f"s{i % 3 == 0}" if i % 5 else "both", None if i == 7 else 20 + i % 40) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = {i: int(i % 3 > 0) for i in range(60)}
    got = {r.doc_id: r for r in co_training.score_quality(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int")).collect()}

    fold = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in rows}
    aside = {r.doc_id: r.a for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(5)) == 0).alias("a")).collect()}
    text = {i: plain_cells(t) for i, t, *_ in rows}
    size = lambda n: "n=" if n is None else f"n={int(2 * math.log2(n + 1))}"
    meta = {i: {zlib.crc32(v.encode()) % co_training.META_CELLS: 1.0 for v in (f"s={s}", f"l={g}", size(n))} for i, _, g, s, n in rows}
    known = {i: y for i, y in labels.items() if not fold[i]}
    given = {"text": {}, "meta": {}}
    for turn in range(co_training.ROUNDS + 1):
        views = {}
        for name, cells, l2 in (("text", text, 1e-6), ("meta", meta, 1e-3)):
            train = [(cells[i], y) for i, y in known.items() if not aside[i]] + [(cells[i], y) for i, y in given[name].items()]
            views[name] = plain_fit([c for c, _ in train], [y for _, y in train], l2)
        if turn == co_training.ROUNDS:
            break
        for i, *_ in rows:
            if i not in known and not fold[i]:
                for to, z in (("meta", views["text"](text[i])), ("text", views["meta"](meta[i]))):
                    p = 1 / (1 + math.exp(-max(-30, min(30, z))))
                    if i not in given[to] and max(p, 1 - p) >= 0.9:
                        given[to][i] = int(p >= 0.9)
    held = [i for i in known if aside[i]]
    s = np.array([[views["text"](text[i]), views["meta"](meta[i])] for i in held])
    mix = co_training.calibrate(s, np.array([known[i] for i in held], float))
    assert sum(map(len, given.values())) > 50
    for i, *_ in rows:
        z = mix[0] + mix[1] * views["text"](text[i]) + mix[2] * views["meta"](meta[i])
        assert abs(got[i].score - 1 / (1 + math.exp(-z))) < 0.02 and got[i].held_out == fold[i], i


def test_co_training_of_odd_rows(spark):
    """Repeated labelled ids with other texts and repeated rows train and score the same, in whatever order they come."""
    docs = table(spark, ["good words here", "bad !!! ###", "good words here", "other text", LONG, None], [1, 2, 1, 1, 4, None])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 1)], "doc_id long, quality int")
    a, b = (sorted((str(r) for r in co_training.score_quality(d, labels).collect())) for d in (docs.repartition(1), docs.repartition(4, "text")))
    assert a == b and len(a) == 6


# -- packing ------------------------------------------------------------------------------------------------------------


def plain_pack(sizes, capacities):
    """Longest first into the tightest open bin; else the bin that costs least for what may fill it."""
    bins, rest = [], sum(sizes)
    for n in sorted(sizes, reverse=True):
        fits = [b for b in bins if b[1] - b[0] >= n]
        if fits:
            best = min(b[1] - b[0] for b in fits)
            b = [b for b in fits if b[1] - b[0] == best][-1]
        else:
            b = [0, min((c for c in capacities if c >= n), key=lambda c: (packing.cost(c) / min(c, max(rest, n)), c))]
            bins.append(b)
        b[0] += n
        rest -= n
    return sorted((b[0], min(c for c in capacities if c >= b[0])) for b in bins)


def test_bins_are_those_of_the_method(spark, monkeypatch):
    """Ties, repeated rows, long texts and null ids; the same bins however the rows are dealt over files."""
    texts = [f"word{i % 60} " * (i % 45 * 5) for i in range(200)] + [LONG, LONG, None, "", "same", "same", "same"]
    ids = [None if i % 9 == 0 else i % 150 for i in range(len(texts))]
    ids[-3:] = [7, 7, 7]
    enc = tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = []
    for t in texts:
        n = enc.count(t or "") + 1
        sizes += [packing.CAPACITIES[-1]] * (n // packing.CAPACITIES[-1]) + ([n % packing.CAPACITIES[-1]] if n % packing.CAPACITIES[-1] else [])
    found = []
    for n in (1, 7):
        rows = packing.pack(table(spark, texts, ids).repartition(n)).collect()
        assert collections.Counter(r.doc_id for r in rows if r.piece == 0) == collections.Counter(ids)
        assert sorted(r.n_tokens for r in rows) == sorted(sizes)
        used = {r.bin_id: (r.bin_used, r.bin_size) for r in rows}
        found.append(sorted(used.values()))
        assert sum(u for u, _ in used.values()) == sum(sizes)
    assert found[0] == found[1] == plain_pack(sizes, packing.CAPACITIES)


def test_a_group_has_bounded_pieces(monkeypatch):
    monkeypatch.setattr(packing, "MOST", 10)
    import pyarrow as pa

    n = 35
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ([3] * n, range(n), [0] * n, [0] * n, [100] * n)], names=["group", "doc_id", "piece", "start", "n_tokens"])
    rows = [r for b in packing._pack((256, 512))(iter([batch])) for r in b.to_pylist()]
    own = collections.defaultdict(int)
    for r in rows:
        own[r["bin_id"]] += r["n_tokens"]
    assert len(rows) == n and all(r["bin_used"] == own[r["bin_id"]] for r in rows) and {r["bin_id"] >> 32 for r in rows} == {3}


# -- secrets ------------------------------------------------------------------------------------------------------------


def test_verdicts_are_those_of_the_corpus(spark):
    """Owners and repositories counted one by one, over repeated rows, null and hot repositories, and very long texts."""
    wide, two, mine, dull = "token=widelycopied123", "secret=heldbytwo99aX", "password=Zx81kQp0Lm", "password=aaaaaaaa"
    long = "filler text " * 30_000 + mine
    rows = [(wide, f"org{i % 5}/r{i}") for i in range(30)] + [(two, "a/x"), (two, "a/y"), (two, "b/x"), (f"{mine} {dull}", None), (mine, None), (mine, None), (long, None), ("", "a/x"), (None, None)]
    rows += [("AKIA" + "Q7W3" * 4 + " " + "deadbeef" * 4 + f" {wide}", "hot/one")] * 50
    df = spark.createDataFrame([(i, t, r) for i, (t, r) in enumerate(rows)], "doc_id long, text string, source string").withColumn("marks", F.lit("clash"))
    places = collections.defaultdict(set)
    spans = {}
    for i, (t, r) in enumerate(rows):
        base = secret_scan.base_spans(t or "")
        spans[i] = sorted(base + [x for x in secret_scan.added_spans(t or "", []) if not any(x[0] < b[2] and b[0] < x[2] for b in base)])
        for x in spans[i]:
            places[x[3]].add(((r or "").split("/")[0], r or ""))
    for r in secret_scan.scan_secrets(df).collect():
        want = []
        for x in spans[r.doc_id]:
            owners = len({o for o, _ in places[x[3]]})
            random = secret_scan.bits(x[3]) >= secret_scan.LIVE_BITS
            want.append(f"{secret_scan.render([x])}:" + ("example" if owners >= secret_scan.WIDE_OWNERS else "shared" if owners > 1 else "live" if random else "owned"))
        values = {x[3] for x in spans[r.doc_id]}
        assert r.verdicts == ",".join(want), r.doc_id
        assert r.most_repos == max((len(places[v]) for v in values), default=0)
        assert r.n_owned == sum(len({o for o, _ in places[v]}) == 1 for v in values)
    verdicts = {r.doc_id: r.verdicts for r in secret_scan.scan_secrets(df).collect()}
    assert verdicts[0].endswith(":example") and verdicts[30].endswith(":shared") and verdicts[33].split(",")[0].endswith(":live") and verdicts[33].endswith(":owned")


def test_added_spans_against_many_base_spans():
    """Linear in their number; the plain rule says which added spans meet a base one."""
    mixed = [f"token=abcdef{i}{'' if i % 4 else 'Q'} {'token=' * (i % 5 == 0)}{base64.b64encode(hashlib.sha256(str(i).encode()).digest()).decode()[:40]}" for i in range(1500)]
    text = " ".join(mixed)
    base, every = secret_scan.base_spans(text), secret_scan.added_spans(text, [])
    assert len(base) == 1800 and len(every) > 1000
    assert secret_scan.added_spans(text, base) == [x for x in every if not any(x[0] < b[2] and b[0] < x[2] for b in base)] != every
    assert plain_secrets(text) == secret_scan.render(base)


# -- languages ----------------------------------------------------------------------------------------------------------


def plain_language(train, text):
    """Word-first backoff by its definition: log relative frequencies, one by one."""
    letters = lambda t: ["".join(g) for g in regex.findall(r"\p{L}+", (t or "").lower())]
    langs = sorted({g for g, _ in train})
    counts = {g: collections.Counter(w for h, t in train if h == g for w in letters(t)) for g in langs}
    langs = [g for g in langs if counts[g]]
    grams = {g: [collections.Counter() for _ in range(language_id.LONGEST)] for g in langs}
    for g in langs:
        for w, n in counts[g].items():
            for size in range(1, language_id.LONGEST + 1):
                for i in range(len(w) + 3 - size):
                    grams[g][size - 1][f"_{w}_"[i : i + size]] += n
    logs = lambda tables, key: [math.log((t[key] + 0.5) / (sum(t.values()) + 0.5 * len(set().union(*tables)))) for t in tables]
    words = letters(text)
    if not words or not langs:
        return "und", 0.0
    total = [0.0] * len(langs)
    for w in words:
        if any(w in counts[g] for g in langs):
            each = logs([counts[g] for g in langs], w)
        else:
            marked, at, n, each = f"_{w}_", 0, 0, [0.0] * len(langs)
            while at < len(marked):
                size = next((k for k in range(min(language_id.LONGEST, len(marked) - at), 0, -1) if any(marked[at : at + k] in grams[g][k - 1] for g in langs)), 0)
                if size:
                    each = [a + b for a, b in zip(each, logs([grams[g][size - 1] for g in langs], marked[at : at + size]), strict=True)]
                at, n = at + max(1, size), n + 1
            each = [x / n for x in each]
        total = [a + b for a, b in zip(total, each, strict=True)]
    total = [x / math.sqrt(len(words)) for x in total]
    best = max(total)
    return langs[total.index(best)], 1 / sum(math.exp(x - best) for x in total)


def test_language_scores_are_those_of_the_method(spark):
    rng = np.random.default_rng(5)
    say = lambda parts: " ".join("".join(rng.choice(parts, 2)) for _ in range(6))
    kinds = {"aa": ["la", "mi", "to"], "bb": ["krz", "szy", "to"], "cc": ["ñan", "éla", "mi"], "twin": ["krz", "szy", "to"]}
    rows = [(g, say(parts)) for g, parts in kinds.items() if g != "twin" for _ in range(12)] + [("lost", "½ ²"), ("lost", "")]
    rows += [("zz", t) for g, t in rows if g == "bb"]  # learns the same as bb: ties go to bb
    texts = [t for _, t in rows] + ["lamimi krzto", "½ ² ①", "Ⅷ 12 !", "xqxq", "", None, "ñan", "to " * 60_000]
    langs = [g for g, _ in rows] + [None] * 8
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2][: len(texts)]
    df = spark.createDataFrame(list(zip(ids, texts, langs, strict=True)), "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(df).collect()}
    for i, t in zip(ids, texts, strict=True):
        if t != texts[-1]:
            want = plain_language(rows, t)
            assert got[i].lang_pred == want[0] and abs(got[i].score - want[1]) < 1e-4, t
    assert {got[i].lang_pred for i, g in zip(ids, langs, strict=True) if g == "bb"} == {"bb"}
    assert [got[i].lang_pred for i in ids[-7:-5]] == ["und", "und"]


def test_many_languages_share_the_model(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MEMO_BYTES", 1 << 12)
    counts = {f"l{k:03d}": {f"{chr(97 + k % 26)}{chr(97 + k // 26)}word{j}": 1 + j for j in range(5)} for k in range(300)}
    scorer = language_id.Scorer(language_id.fit(counts))
    assert scorer.predict("bcword1 bcword2 bcword4 bcword0")[0] == "l053" and scorer.rows.most == 3


# -- chats --------------------------------------------------------------------------------------------------------------


def test_turns_that_share_a_number(spark):
    """Thousands of turns with one number, repeated rows and very long texts: parts stay bounded and nothing is lost."""
    n = 2 * chat_format.CHUNK + 40
    rows = [(1, 3, "user", f"t{i}") for i in range(n)] * 2 + [(1, 1, "user", LONG), (1, 900, "assistant", "last")] + [(2, 3, "user", f"t{i}") for i in range(n)] + [(2, 1, "user", LONG)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_format.format_chats(df).orderBy("conv_id", "part").collect()
    assert {r.conv_id for r in got} == {1}  # the second is a prefix of the first
    assert [(r.part, r.turn_from) for r in got] == [(0, 0), (1, 256), (2, 512), (3, n + 1)]
    assert all(r.rendered.count("<|end|>") <= chat_format.CHUNK for r in got) and got[0].n_turns == n + 2
    text = "".join(r.rendered for r in got)
    assert text.startswith(f"<|user|>\n{LONG}<|end|>") and text.endswith("last<|end|>\n") and all(f"\nt{i}<" in text for i in range(n))


# -- shared -------------------------------------------------------------------------------------------------------------


def test_lookups_deal_hot_keys_out(spark):
    left = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    sizes = left.groupBy("k").agg(F.count("*").alias("n")).filter("k IS NOT NULL").withColumn("v", F.concat(F.lit("v"), "k"))
    got = common.skewed_lookup(left, common.materialize(sizes, "t"), "k", "n", F.col("id"))
    assert got.count() == 5000 and got.filter("NOT (v <=> concat('v', k))").isEmpty() and got.filter("k IS NULL AND v IS NOT NULL").isEmpty()


def test_no_private_folder_on_a_cluster(spark):
    import pytest

    class Context:
        master = "spark://far:7077"

    class Session:
        sparkContext, conf = Context(), type("C", (), {"get": staticmethod(lambda k, d: None)})

    with pytest.raises(RuntimeError):
        common.shared_dir(Session())


def test_scratch_removes_what_was_made(spark):
    with common.scratch(spark) as keep:
        common.materialize(spark.range(3), "gone")
        kept = common.materialize(spark.range(4), "kept", keep)
        gone = [p for p in common._MADE if p not in keep][-1]
    assert kept.count() == 4 and not spark._jvm.java.io.File(gone.replace("file://", "")).exists()


def test_tables_without_rows_and_odd_rows(spark):
    odd = table(spark, ODD + ODD, [None if i % 5 == 0 else i % 7 for i in range(2 * len(ODD))])
    assert secret_scan.scan_secrets(odd).count() == pii.find_pii(odd).count() == 2 * len(ODD)
    for df in (secret_scan.scan_secrets(empty(spark)), pii.find_pii(empty(spark)), language_id.identify(empty(spark)), packing.pack(empty(spark))):
        assert df.isEmpty()
