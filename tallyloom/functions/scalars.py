"""Column expressions shared by the operators; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def id_text(c: Column | str) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def number(c: Column | str) -> Column:
    """A number, 0 for null or junk."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def category(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(UNKNOWN))


def tolerant_date(c: Column | str) -> Column:
    """A timestamp, null for junk."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.try_cast("timestamp_ntz"), F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz"))


def truthy(c: Column | str) -> Column:
    """true, 1, yes, in any case, and the number 1."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.lower(F.trim(c.cast("string")))
    return F.coalesce(text.isin("true", "1", "yes", "1.0"), F.lit(False))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole elapsed days, rounded down, so sub-day times count as well."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def iso_text(c: Column) -> Column:
    """A time as ISO 8601 text, to the second."""
    return F.date_format(c.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss")


def segment(region: str = "region", end_use: str = "end_use") -> Column:
    return F.concat_ws("_", category(region), category(end_use))


def decay(age_days: Column, rate: float) -> Column:
    return F.exp(-F.lit(rate) * F.greatest(age_days, F.lit(0)))


def rule_reason(a: str, b: str, support: str, confidence: str, lift: str) -> Column:
    return F.format_string("%s → %s (support=%.3f, confidence=%.3f, lift=%.2f)", F.col(a), F.col(b), F.col(support), F.col(confidence), F.col(lift))


def fallback_reason(l2: str, affinity: str) -> Column:
    return F.format_string("Category-affinity fallback: %s affinity=%.2f", F.col(l2), F.col(affinity))


def percent_text(c: Column) -> Column:
    return F.concat(F.bround(c * 100, 0).cast("int").cast("string"), F.lit("%"))


def price_text(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_string("%.2f", c))


def safe_name(c: Column) -> Column:
    """A segment's name as part of a file name."""
    return F.replace(F.replace(c, F.lit(" "), F.lit("_")), F.lit("/"), F.lit("-"))


def lookup(mapping: dict[str, list[str]], key: Column) -> Column:
    """A literal map's value for key, an empty array where there is none."""
    items = [x for k, v in mapping.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))]
    return F.coalesce(F.try_element_at(F.create_map(*items), key), F.array().cast("array<string>"))
