"""Secret candidates, and how widely the corpus copies each.

Every candidate's value is hashed; hashes are aggregated over the whole corpus by distinct repositories and owners. A value
that many owners have is an example from some manual; one that a single owner has, and that looks random, may be live.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, skewed_lookup, tidy

# The patterns and limits of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ["assign", "access", "hex", "key_block", "random"]
KEYWORDS = ("password", "passwd", "secret", "token", "api")

# Kinds that the method adds.
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
RANDOM = re.compile(r"[A-Za-z0-9+/_-]{32,}")
RANDOM_BITS = 4.0  #: bits a character of a random-looking value
LIVE_BITS = 2.5  #: bits a character from which a value of one owner looks live
WIDE_OWNERS = 3  #: owners from which a value is an example

_HEX_RUN = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_WORD_RUN = bytes(120 if b < 128 and (chr(b).isalnum() or chr(b) in "+/_-") else 32 for b in range(256))


def bits(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, rank of the kind, end, value) of the base kinds, sorted."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    if b"x" * 24 in text.encode().translate(_HEX_RUN):
        out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def added_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Private key blocks, and long tokens of mixed letters and digits that look random; none that meets a base span."""
    out = []
    if "-----BEGIN " in text:
        out += [(m.start(), 3, m.end(), m[0]) for m in KEY_BLOCK.finditer(text)]
    if b"x" * 32 in text.encode().translate(_WORD_RUN):
        for m in RANDOM.finditer(text):
            v = m[0]
            if any(c.isdigit() for c in v) and any(c.isupper() for c in v) and any(c.islower() for c in v) and bits(v) >= RANDOM_BITS:
                out.append((m.start(), 4, m.end(), v))
    # base is sorted by start: of those that start before a span ends, the one that ends last decides.
    starts, last = [b[0] for b in base], list(accumulate((b[2] for b in base), max))
    met = lambda x: (k := bisect_left(starts, x[2])) > 0 and last[k - 1] > x[0]
    return [x for x in out if not met(x)]


def render(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


_SCANNED = "row long, doc_id long, repo string, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, marks array<struct<span:string,value:int>>, values array<struct<value:int,hash:string,random:boolean>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    names = [f.split()[0] for f in _SCANNED.split(", ")]
    mark = pa.list_(pa.struct([("span", pa.string()), ("value", pa.int32())]))
    value = pa.list_(pa.struct([("value", pa.int32()), ("hash", pa.string()), ("random", pa.bool_())]))
    types = [pa.int64()] * 2 + [pa.string()] * 2 + [pa.int64()] * 3 + [pa.string()] * 2 + [mark, value]
    for batch in batches:
        out: list[list] = [[] for _ in types]
        for doc_id, repo, owner, text in zip(*(batch.column(i) for i in range(4)), strict=True):
            t = text.as_py() or ""
            base = base_spans(t)
            every = sorted(base + added_spans(t, base))
            kinds = Counter(k for _, k, _, _ in base)
            number = {v: i for i, v in enumerate(dict.fromkeys(x[3] for x in every))}
            marks = [{"span": render([x]), "value": number[x[3]]} for x in every]
            values = [{"value": i, "hash": hashlib.sha256(v.encode()).hexdigest(), "random": bits(v) >= LIVE_BITS} for v, i in number.items()]
            fields = (row, doc_id.as_py(), repo.as_py(), owner.as_py(), kinds[0], kinds[1], kinds[2], hashlib.sha256(render(base).encode()).hexdigest(), render(every), marks, values)
            for column, x in zip(out, fields, strict=True):
                column.append(x)
            row += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)


def scan_secrets(docs: DataFrame, ident: str = "doc_id", text: str = "text", repo: str = "source", owner: Column | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans, verdicts, n_example, n_owned, n_live, most_repos.

    The counts and base_sha256 are those of the base kinds; spans also has what the method adds. verdicts says of each span
    what the corpus makes of its value, as kind:start:end:verdict: example (WIDE_OWNERS owners or more have it), live (one
    owner has it and it looks random), owned (one owner, not random), shared (what is between). n_example, n_owned (live
    ones too) and n_live count the document's distinct values, most_repos is the largest number of repositories one is in.
    `owner` defaults to what stands before the first slash of `repo`. Null text counts as empty and gives no spans; a
    null repo is a repository of its own. Repeated rows give equal rows; other columns are ignored, whatever their names;
    an empty table gives an empty result.
    """
    place = F.coalesce(F.col(repo).cast("string"), F.lit(""))
    who = owner if owner is not None else F.substring_index(place, "/", 1)
    source = docs.select(F.col(ident).cast("long").alias("doc_id"), place.alias("repo"), who.alias("owner"), F.col(text).cast("string").alias("text"))
    found = materialize(source.mapInArrow(tidy(_scan), _SCANNED), "secret-scan")
    values = found.filter(F.size("values") > 0).select("row", "repo", "owner", F.inline("values"))
    # Rows of a value are first reduced to one for each owner and repository, on the map side too.
    places = values.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    owners = places.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
    spread = materialize(owners.groupBy("hash").agg(F.sum("n").alias("n"), F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners")), "secret-spread")
    known = skewed_lookup(values.select("row", "value", "hash", "random"), spread, "hash", "n", F.col("row"))
    one, wide = F.col("n_owners") == 1, F.col("n_owners") >= WIDE_OWNERS
    verdict = F.when(wide, "example").when(one & F.col("random"), "live").when(one, "owned").otherwise("shared")
    said = F.transform(F.array_sort(F.collect_list(F.struct("value", verdict.alias("verdict")))), lambda x: x["verdict"]).alias("said")  # one for each value of a text
    by_row = known.groupBy("row").agg(F.count_if(wide).alias("n_example"), F.count_if(one).alias("n_owned"), F.count_if(one & F.col("random")).alias("n_live"), F.max("n_repos").alias("most_repos"), said)
    out = found.drop("values", "repo", "owner").join(by_row, "row", "left").drop("row")
    verdicts = F.array_join(F.transform("marks", lambda m: F.concat_ws(":", m["span"], F.get("said", m["value"]))), ",")
    out = out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", F.coalesce(verdicts, F.lit("")).alias("verdicts"), "n_example", "n_owned", "n_live", "most_repos")
    return out.fillna(0, ["n_example", "n_owned", "n_live", "most_repos"])
