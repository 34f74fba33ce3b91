"""Chat rendering of maximal conversations.

Services log a conversation again after every turn, so most logged conversations are prefixes of longer ones. A rolling
hash of (position, role, text) identifies each prefix; an anti join drops conversations that some longer one continues.
A conversation is handled in chunks of CHUNK turn numbers, each rendered in parts of CHUNK turns at most, so one of any
length is spread over tasks. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

CHUNK = 256  #: turn numbers a chunk, and turns a part
OPEN, CLOSE = "<|", "|>"
END = "<|end|>"


def _keyed(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, chunk, turn, role, text and two hashes of role and text; turns without a number come last, in hash order."""
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", "role", F.lit("2"))})
    unnumbered = F.lit(1 << 58) + F.shiftright("h1", 52).cast("long")
    return rows.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK).cast("long"), unnumbered))


def _positions(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their rank in the chunk, repeated rows once; chunks with part, offset and the conversation's length."""
    order = Window.partitionBy("conv_id", "chunk").orderBy(F.asc_nulls_last("turn"), "h1", "h2")
    one = keyed.withColumn("before", F.lag(F.struct("turn", "h1", "h2")).over(order))
    one = one.filter(~F.col("before").eqNullSafe(F.struct("turn", "h1", "h2"))).drop("before")
    ranked = materialize(one.withColumn("r", F.row_number().over(order)), "chat-turns")
    chunks = ranked.groupBy("conv_id", "chunk").agg(F.max("r").cast("long").alias("n"))
    along = Window.partitionBy("conv_id").orderBy("chunk")
    chunks = chunks.select(
        "conv_id",
        "chunk",
        "n",
        (F.sum(F.ceil(F.col("n") / CHUNK)).over(along) - F.ceil(F.col("n") / CHUNK)).alias("part"),
        (F.sum("n").over(along) - F.col("n")).alias("turn_from"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    return ranked, materialize(chunks, "chat-chunks")


def _prefixes(ranked: DataFrame, chunks: DataFrame) -> DataFrame:
    """conv_id, n_turns, pos and the 128 bits that stand for turns 1 to pos."""
    rows = ranked.drop("role", "text").join(chunks, ["conv_id", "chunk"]).withColumn("pos", F.col("turn_from") + F.col("r"))
    rows = rows.withColumns({"p1": F.xxhash64("pos", "h1", "h2"), "p2": F.xxhash64("h2", "h1", "pos")})
    inside = Window.partitionBy("conv_id", "chunk").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"p1": F.expr("bit_xor(p1)").over(inside), "p2": F.expr("bit_xor(p2)").over(inside)})
    last = rows.filter("r = n").select("conv_id", "chunk", "p1", "p2")
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("conv_id", "chunk", F.expr("bit_xor(p1)").over(before).alias("c1"), F.expr("bit_xor(p2)").over(before).alias("c2")).filter("c1 IS NOT NULL")
    out = rows.join(carried, ["conv_id", "chunk"], "left")
    return out.select("conv_id", "n_turns", "pos", F.col("p1").bitwiseXOR(F.coalesce("c1", F.lit(0))).alias("p1"), F.col("p2").bitwiseXOR(F.coalesce("c2", F.lit(0))).alias("p2"))


def maximal_conversations(ranked: DataFrame, chunks: DataFrame) -> DataFrame:
    """conv_id and n_copies of each conversation that none continues; of equal ones, the smallest id."""
    prefixes = _prefixes(ranked, chunks)
    whole = prefixes.filter("pos = n_turns").groupBy("pos", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    part = prefixes.filter("pos < n_turns").select("pos", "p1", "p2").distinct()
    return whole.join(part, ["pos", "p1", "p2"], "left_anti").select("conv_id", "n_copies")


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each part of a maximal conversation: conv_id, part, turn_from, n_turns, n_copies, rendered.

    A conversation is the sequence of its (role, text) by turn; it goes when it is a proper prefix of another, and of
    equal ones the smallest conv_id stays, n_copies of them all. A part holds the turns of one chunk of CHUNK turn
    numbers, from position turn_from on, so shorter conversations have part 0 only; a chunk whose turns share numbers has
    a part for every CHUNK of them. Rows without conv_id are left out; null roles and texts count as empty; turns without
    a number come last; repeated rows count once; turns that share a number are ordered by a hash. A marker inside a role
    or text is broken up, so it can't be forged. Other columns are ignored, whatever their names. An empty table gives an
    empty result.
    """
    ranked, chunks = _positions(_keyed(turns, conv, turn, role, text))
    stay = maximal_conversations(ranked, chunks)
    safe = lambda c: F.replace(F.col(c), F.lit(OPEN), F.lit("< |"))
    shown = F.concat(F.lit(OPEN), safe("role"), F.lit(f"{CLOSE}\n"), safe("text"), F.lit(f"{END}\n"))
    placed = ranked.join(chunks.drop("n").join(stay, "conv_id"), ["conv_id", "chunk"])
    further = F.floor((F.col("r") - 1) / CHUNK).cast("long")
    placed = placed.withColumns({"part": F.col("part") + further, "turn_from": F.col("turn_from") + further * CHUNK})
    # A part has CHUNK turns at most.
    out = placed.groupBy("conv_id", "part", "turn_from", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(F.struct("r", shown.alias("s")))).alias("said"))
    return out.select("conv_id", "part", "turn_from", "n_turns", "n_copies", F.array_join(F.transform("said", lambda x: x["s"]), "").alias("rendered"))
