"""Personal data by weak supervision.

Regex, gazetteer, context and edge labelers vote on candidate spans, the gazetteer by a table that their terms are joined with; expectation-maximisation over the table of vote
patterns estimates how reliable each labeler is for each kind; its posteriors are the soft labels that train the final span
classifier, a naive Bayes over votes, shape and context. Base spans are always kept; what the classifier accepts of the
other kinds is added. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

# The base kinds in the order they are listed in. The patterns match what the plain ones match, in linear
# time: runs start where no run goes on, \G being where the last match ended, and possessive groups don't recurse.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = {
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])",
    "phone_local": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "email_masked": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{1,63}\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z]{2,24}",
    "name": r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame)\.?\x20\p{Lu}\p{L}{1,30}(?:\x20\p{Lu}\p{L}{1,30})?",
}
KINDS = [*BASE, *ADDED]
STRICT = {
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){3,7}$",
    "phone_local": r"^\(?[2-9][0-9]{2}\)?[\x20.-][2-9][0-9]{2}[\x20.-][0-9]{4}$",
    "email_masked": r"(\[at\]|\(at\)).*(\[dot\]|\(dot\))",
    "name": r"\x20\p{Lu}\p{L}+\x20\p{Lu}\p{L}+$",
}
#: The terms of the gazetteer that speak for a kind, and those that speak against it.
GAZETTEER = {
    "email": ("com org net edu gov int info io eu de at ch fr be es mx uk us ca it nl pl pt se no dk fi br ar cl co jp kr cn in au nz", "png jpg jpeg gif svg js css py txt invalid test local localhost"),
    "ip": (" ".join(map(str, range(1, 224))), "0 10 127 192.168 169.254 " + " ".join(map(str, range(224, 256)))),
    "card": ("3 4 5 6", "0 1 2 7 8 9"),
    "phone": ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 351 353 358 380 420 421 971 972", "0"),
    "ssn": ("0 1 2 3 4 5 6 7 8", "9 123-45-6789 078-05-1120"),
    "iban": ("AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LI LT LU LV MT NL NO PL PT RO SE SI SK", ""),
    "phone_local": ("2 3 4 5 6 7 8 9", "000 111 123"),
    "email_masked": ("com org net edu gov io de fr es uk", "example test"),
    "name": (
        "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew Kenneth George Kevin Brian Edward Peter Mary Patricia Jennifer Linda Elizabeth Barbara Susan"
        " Jessica Sarah Karen Nancy Lisa Margaret Sandra Ashley Emily Emma Anna Laura Julia Hans Klaus Jürgen Wolfgang Stefan Andreas Matthias Martin Karl Heinrich Ursula Monika Petra Sabine Claudia Heike Jean Pierre"
        " Michel Philippe Alain Jacques François Nicolas Marie Nathalie Isabelle Sylvie Catherine Martine Sophie Camille José Antonio Manuel Francisco Juan Javier Carlos Miguel Luis Pedro Carmen María Maria Ana Isabel"
        " Dolores Pilar Teresa Lucía Elena",
        "Street Road Avenue Inc Who Bank House Strange",
    ),
}
GAZETTEER_MOST = 200_000  #: terms of a gazetteer up to which it is broadcast
CUES = {
    "email": r"mail|contact|write|reply",
    "ip": r"\bip\b|address|host|server|client|login",
    "card": r"card|visa|master|amex|credit|payment|karte|tarjeta|carte",
    "phone": r"tel|phone|call|fax|mobil|whatsapp",
    "ssn": r"ssn|social|security",
    "iban": r"iban|bank|account|konto|cuenta|compte",
    "phone_local": r"tel|phone|call|fax|mobil|whatsapp",
    "email_masked": r"mail|contact|write|reply",
    "name": r"dear|by|from|sincerely|signed|author|with",
}
AGAINST = r"version|license|release|section|page|isbn|order|invoice|part\b|no\.$|§"
VOTES = ["regex", "gazetteer", "context", "edge"]
CONTEXT = 40  #: characters before a span that the context labeler sees
WORD_CELLS = 64  #: cells that the word before a span is hashed to
ROUNDS = 20  #: rounds of expectation-maximisation
BLOCK = 256


def _placed(found: Column, pieces: Column, rank: int) -> Column:
    """Spans of the matches `found`, which stand between `pieces`, in code points; blocks keep it linear in their number."""
    one = F.transform(found, lambda s, i: F.struct(F.length(F.get(pieces, i)).alias("g"), s.alias("s"), F.substring(F.get(pieces, i), -CONTEXT, CONTEXT).alias("l"), F.substring(F.get(pieces, i + 1), 1, 1).alias("r")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")), lambda b: F.slice(one, b * BLOCK + 1, F.lit(BLOCK)))
    kind = "struct<kind:int,a:int,b:int,s:string,l:string,r:string>"

    def add(st: Column, e: Column) -> Column:
        a = st["at"] + e["g"]
        span = F.struct(F.lit(rank).alias("kind"), a.alias("a"), (a + F.length(e["s"])).alias("b"), e["s"].alias("s"), e["l"].alias("l"), e["r"].alias("r"))
        return F.struct((a + F.length(e["s"])).alias("at"), F.concat(st["out"], F.array(span.cast(kind))).alias("out"))

    def add_block(acc: Column, block: Column) -> Column:
        empty = F.struct(acc["at"].alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        inner = F.aggregate(block, empty, add)
        return F.get(F.transform(F.array(inner), lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).alias("out"))), F.lit(0))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    placed = F.flatten(F.aggregate(blocks, start, add_block)["out"])
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast(f"array<{kind}>"))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substr(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(each, F.lit(0), lambda acc, x: acc + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _holds(kind: Column, s: Column) -> Column:
    """What a base match must satisfy; spans of other kinds hold."""
    d = _digits(s)
    octets = F.forall(F.transform(F.split(s, r"\."), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")), lambda x: (F.length(x) <= 3) & (F.substring(x, 1, 3).cast("int") <= 255))
    n = F.length(d)
    card = F.when((n >= 14) & (n <= 19), _luhn(d)).otherwise(False)
    at = KINDS.index
    return F.when(kind == at("ip"), octets).when(kind == at("card"), card).when(kind == at("phone"), (n >= 10) & (n <= 15)).otherwise(True)


def _candidates(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """row, doc_id and all candidate spans of every text, with what stands around them. A written table."""
    t = F.col("_t")
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    digit = F.rlike(t, F.lit("[0-9]"))
    gates = {
        "email": F.contains(t, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(t, F.lit("+")), "ssn": digit, "iban": digit, "phone_local": digit,
        "email_masked": F.contains(t, F.lit("at]")) | F.contains(t, F.lit("at)")), "name": F.rlike(t, F.lit(r"(Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame)\.?\x20\p{Lu}")),
    }
    patterns = BASE | ADDED
    none = F.array().cast("array<string>")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", "doc_id", "_t", *[F.when(gates[k], F.regexp_extract_all(t, F.lit(p), F.lit(0))).otherwise(none).alias(f"m_{k}") for k, p in patterns.items()])
    rows = rows.select("row", "doc_id", *[f"m_{k}" for k in patterns], *[F.when(F.size(f"m_{k}") > 0, F.split(t, p, -1)).otherwise(none).alias(f"p_{k}") for k, p in patterns.items()])
    spans = F.concat(*[_placed(F.col(f"m_{k}"), F.col(f"p_{k}"), i) for i, k in enumerate(KINDS)])
    return materialize(rows.select("row", "doc_id", spans.alias("spans")), "pii-candidates")


def _by_kind(table: dict[str, str], of) -> Column:
    return reduce(lambda acc, k: F.when(F.col("kind") == KINDS.index(k), of(table[k])).otherwise(acc), table, F.lit(None))


def gazetteer(spark: SparkSession) -> DataFrame:
    """The table of fixed terms: kind, term, vote (1 for the kind, 0 against it)."""
    return spark.createDataFrame([(kind, term, vote) for kind, sides in GAZETTEER.items() for vote, terms in zip((1, 0), sides, strict=True) for term in terms.split()], "kind string, term string, vote int")


def _terms() -> Column:
    """The terms of a span that the gazetteer may have, three at most; the first that it has decides."""
    s, d = F.col("s"), _digits(F.col("s"))
    number = lambda part: F.regexp_replace(F.split_part(s, F.lit("."), F.lit(part)), "^0+(?=[0-9])", "")
    last = F.lower(F.regexp_extract(s, r"([A-Za-z0-9-]+)$", 1))
    word = lambda i: F.split_part(s, F.lit(" "), F.lit(i))
    of = {
        "email": [last], "ip": [F.concat_ws(".", number(1), number(2)), number(1)], "card": [F.substring(d, 1, 1)], "phone": [F.substring(d, 1, 3), F.substring(d, 1, 2), F.substring(d, 1, 1)],
        "ssn": [s, F.substring(d, 1, 1)], "iban": [F.substring(s, 1, 2)], "phone_local": [F.substring(d, 1, 3), F.substring(d, 1, 1)], "email_masked": [last], "name": [word(2), word(3)],
    }
    return reduce(lambda acc, k: F.when(F.col("kind") == KINDS.index(k), F.array(*of[k])).otherwise(acc), of, F.array().cast("array<string>"))


def _known(spans: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds `known`, the gazetteer's vote on each span or null."""
    number = reduce(lambda acc, k: F.when(F.col("kind") == k, KINDS.index(k)).otherwise(acc), KINDS, F.lit(None))
    table = terms.select(number.cast("int").alias("_k"), F.col("term").cast("string").alias("_term"), F.col("vote").cast("int").alias("_vote")).filter("_k IS NOT NULL")
    table = table.groupBy("_k", "_term").agg(F.min("_vote").alias("_vote"))
    if terms.limit(GAZETTEER_MOST + 1).count() <= GAZETTEER_MOST:
        table = F.broadcast(table)
    spans = spans.withColumn("_terms", _terms())
    for i in range(3):
        side = table.withColumnsRenamed({"_k": f"_k{i}", "_term": f"_t{i}", "_vote": f"_vote{i}"})
        spans = spans.join(side, (F.col("kind") == F.col(f"_k{i}")) & (F.get("_terms", F.lit(i)) == F.col(f"_t{i}")), "left").drop(f"_k{i}", f"_t{i}")
    return spans.withColumn("known", F.coalesce(*[f"_vote{i}" for i in range(3)])).drop("_terms", *[f"_vote{i}" for i in range(3)])


def _voted(found: DataFrame, terms: DataFrame) -> DataFrame:
    """One row a span that holds, base kinds and those that meet none of them: votes (1 for, 0 against, -1 none) and features."""
    spans = found.filter(F.size("spans") > 0).select("row", F.inline("spans")).filter(_holds(F.col("kind"), F.col("s")))
    base = F.col("kind") < len(BASE)
    before = Window.partitionBy("row").orderBy("a", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(F.desc("a"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumns({"x": F.max(F.when(F.col("kind") < len(BASE), F.col("b"))).over(before), "y": F.min(F.when(F.col("kind") < len(BASE), F.col("a"))).over(after)})
    spans = spans.filter(base | ((F.coalesce("x", F.lit(0)) <= F.col("a")) & (F.coalesce("y", F.lit(1 << 30)) >= F.col("b"))))
    spans = _known(spans.drop("x", "y"), terms)
    s, left = F.col("s"), F.lower("l")
    strict = F.when(base, 1).otherwise(F.coalesce(_by_kind(STRICT, lambda p: F.rlike(s, F.lit(p)).cast("int")), F.lit(-1)))
    context = F.coalesce(_by_kind(CUES, lambda p: F.when(F.rlike(left, F.lit(p)), 1).when(F.rlike(left, F.lit(AGAINST)), 0).otherwise(-1)), F.lit(-1))
    edge = F.when(F.rlike(F.substring("l", -1, 1), F.lit(r"[\p{L}\p{N}]")) | F.rlike(F.col("r"), F.lit(r"[\p{L}\p{N}]")), 0).otherwise(1)
    spans = spans.withColumn("v", F.array(strict, F.coalesce("known", F.lit(-1)), context, edge))
    word = F.pmod(F.xxhash64(F.regexp_extract(left, r"(\S*)\s*$", 1)), F.lit(WORD_CELLS))
    shape = [F.concat(F.lit("n"), F.least(F.length(s), F.lit(40))), F.concat(F.lit("w"), word), F.concat(F.lit("r"), F.when(F.rlike("r", F.lit(r"^\s")), "s").when(F.col("r") == "", "e").otherwise("p"))]
    votes = [F.concat(F.lit(f"v{i}:"), F.get("v", F.lit(i))) for i in range(len(VOTES))]
    return materialize(spans.select("row", "kind", "a", "b", "v", F.array(*votes, *shape).alias("features")), "pii-votes")


def reliabilities(voted: DataFrame) -> DataFrame:
    """By expectation-maximisation, a row for each kind and vote pattern: kind, v, posterior, prior, for_true, for_false.

    A kind has at most 3 ** 4 patterns, so its table is one short array; the rounds are one fold over it.
    """
    counted = voted.groupBy("kind", "v").agg(F.count("*").cast("double").alias("n"))
    tables = counted.groupBy("kind").agg(F.collect_list(F.struct("v", "n")).alias("t"))
    sides = len(VOTES)

    def posterior(st: Column, v: Column) -> Column:
        def side(rates: Column) -> Column:
            each = F.zip_with(v, rates, lambda x, q: F.when(x == 1, q).when(x == 0, 1 - q).otherwise(1.0))
            return F.aggregate(each, F.lit(1.0), lambda acc, x: acc * x)

        true, false = st["prior"] * side(st["for_true"]), (1 - st["prior"]) * side(st["for_false"])
        return true / (true + false)

    def add(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)

    def round_(st: Column, _: Column) -> Column:
        scored = F.transform(F.col("t"), lambda x: F.struct(x["v"].alias("v"), (x["n"] * posterior(st, x["v"])).alias("p"), (x["n"] * (1 - posterior(st, x["v"]))).alias("q")))

        def fit(scored: Column) -> Column:
            def rate(field: str, j: int, mean: float) -> Column:
                hit = add(F.transform(scored, lambda x: F.when(F.get(x["v"], F.lit(j)) == 1, x[field]).otherwise(0.0)))
                cast = add(F.transform(scored, lambda x: F.when(F.get(x["v"], F.lit(j)) >= 0, x[field]).otherwise(0.0)))
                return (hit + 10 * mean) / (cast + 10)

            p, q = add(F.transform(scored, lambda x: x["p"])), add(F.transform(scored, lambda x: x["q"]))
            return F.struct(((p + 5) / (p + q + 10)).alias("prior"), F.array(*[rate("p", j, 0.8) for j in range(sides)]).alias("for_true"), F.array(*[rate("q", j, 0.3) for j in range(sides)]).alias("for_false"))

        return F.get(F.transform(F.array(scored), fit), F.lit(0))

    start = F.struct(F.lit(0.5).alias("prior"), F.array(*[F.lit(0.8)] * sides).alias("for_true"), F.array(*[F.lit(0.3)] * sides).alias("for_false"))
    fitted = tables.select("kind", "t", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_).alias("m"))
    return fitted.select("kind", "m", F.explode("t").alias("x")).select("kind", "x.v", posterior(F.col("m"), F.col("x.v")).alias("posterior"), "m.prior", "m.for_true", "m.for_false")


def classifier(voted: DataFrame, known: DataFrame) -> DataFrame:
    """Naive Bayes on the soft labels, a row for each kind: kind, bias, weights (feature to log odds).

    Features are few whatever the corpus: votes, lengths up to 40, WORD_CELLS cells, three edges.
    """
    soft = voted.join(F.broadcast(known.select("kind", "v", "posterior")), ["kind", "v"])
    each = soft.select("kind", "posterior", F.explode("features").alias("f"))
    sums = each.groupBy("kind", "f").agg(F.sum("posterior").alias("p"), F.sum(1 - F.col("posterior")).alias("q"))
    totals = soft.groupBy("kind").agg(F.sum("posterior").alias("tp"), F.sum(1 - F.col("posterior")).alias("tq"))
    odds = sums.join(F.broadcast(totals), "kind")
    odds = odds.withColumn("w", F.log((F.col("p") + 1) / (F.col("tp") + 8)) - F.log((F.col("q") + 1) / (F.col("tq") + 8)))
    weights = odds.groupBy("kind").agg(F.map_from_entries(F.collect_list(F.struct("f", "w"))).alias("weights"))
    return weights.join(totals, "kind").select("kind", F.log((F.col("tp") + 1) / (F.col("tq") + 1)).alias("bias"), "weights")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["a"].cast("string"), x["b"].cast("string"))), ",")


def _apart(accepted: DataFrame) -> DataFrame:
    """Of accepted added spans that overlap, those of better odds: row, x (a, kind, b)."""
    order = Window.partitionBy("row").orderBy("a", "kind")
    fresh = F.coalesce(F.col("a") >= F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = accepted.withColumn("new", fresh.cast("long")).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # A run of spans that overlap each other is short: those of one kind never do.
    each = F.struct((-F.round("odds", 6)).alias("o"), "a", "kind", "b")
    sorted_ = runs.groupBy("row", "run").agg(F.array_sort(F.collect_list(each)).alias("all"))
    none = F.array().cast("array<struct<a:int,kind:int,b:int>>")

    def add(acc: Column, e: Column) -> Column:
        one = F.array(F.struct(e["a"].alias("a"), e["kind"].alias("kind"), e["b"].alias("b")))
        return F.when(F.exists(acc, lambda k: (k["a"] < e["b"]) & (e["a"] < k["b"])), acc).otherwise(F.concat(acc, one))

    return sorted_.select("row", F.explode(F.aggregate("all", none, add)).alias("x"))


def find_pii(docs: DataFrame, ident: str = "doc_id", text: str = "text", terms: DataFrame | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and base_sha256 are those of the base kinds; spans has base ones and those that the classifier adds, by start
    and then kind, in code points. An added span meets no base span; of added ones that overlap, those stay that the
    classifier is surer of. `terms` is the gazetteer (kind, term, vote); by default that of the fixed terms. Null text
    counts as empty and has no spans. Repeated rows give equal rows; other columns are ignored, whatever their names; an
    empty table gives an empty result.
    """
    found = _candidates(docs, ident, text)
    voted = _voted(found, terms if terms is not None else gazetteer(docs.sparkSession))
    known = materialize(reliabilities(voted), "pii-reliabilities")
    model = materialize(classifier(voted, known), "pii-classifier")  # one row a kind
    scored = voted.join(F.broadcast(model), "kind", "left")
    odds = F.aggregate("features", F.col("bias"), lambda acc, f: acc + F.coalesce(F.try_element_at(F.col("weights"), f), F.lit(0.0)))
    base = F.col("kind") < len(BASE)
    accepted = scored.filter(~base).withColumn("odds", odds).filter("odds > 0").select("row", "a", "kind", "b", "odds")
    stay = voted.filter(base).select("row", F.struct("a", "kind", "b").alias("x")).unionByName(_apart(accepted))
    lists = stay.groupBy("row").agg(F.array_sort(F.collect_list("x")).alias("all"))
    kept = lists.withColumn("base", F.filter("all", lambda x: x["kind"] < len(BASE)))
    count = lambda i: F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long")
    kept = kept.select("row", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"), (F.size("all") - F.size("base")).cast("long").alias("n_added"))
    out = found.select("row", "doc_id").join(kept, "row", "left").drop("row")
    nothing = F.sha2(F.lit(""), 256)
    return out.fillna(0, [f"n_{k}" for k in BASE] + ["n_added"]).withColumns({"base_sha256": F.coalesce("base_sha256", nothing), "spans": F.coalesce("spans", F.lit(""))})
