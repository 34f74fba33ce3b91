"""The queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bit_packing import pack_documents
from .chat_format import format_chats
from .co_training import score_quality
from .common import UPPER, table
from .decontaminate import decontaminate
from .exact_dedup import exact_dedup
from .language_id import identify
from .ngram_join import ngram_join
from .packing import pack
from .pii import find_pii
from .secret_scan import scan_secrets


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op3_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_pii": op2_pii,
    "op3_bit_packing": op3_bit_packing,
    "op4_co_training": op4_co_training,
    "op5_decontaminate": op5_decontaminate,
    "op6_packing": op6_packing,
    "op7_secret_scan": op7_secret_scan,
    "op8_language_id": op8_language_id,
    "op9_ngram_join": op9_ngram_join,
    "op10_chat_format": op10_chat_format,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)
    """,
    "op10_chat_format": r"""
        WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        s AS (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n_turns,
                     list({'role': role, 'text': text}) OVER (w ROWS UNBOUNDED PRECEDING) AS said FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
        whole AS (SELECT said, min(conv_id) AS conv_id, count(*) AS n_copies, any_value(n_turns) AS n_turns FROM s WHERE pos = n_turns GROUP BY said),
        stay AS (SELECT * FROM whole WHERE said NOT IN (SELECT said FROM s WHERE pos < n_turns))
        SELECT k.conv_id, 0::BIGINT AS part, 0::BIGINT AS turn_from, k.n_turns, k.n_copies,
               string_agg('<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10), '' ORDER BY pos) AS rendered
        FROM stay k JOIN s ON s.conv_id = k.conv_id GROUP BY k.conv_id, k.n_turns, k.n_copies
    """,
}
