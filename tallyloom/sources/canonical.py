"""Raw tables in canonical form: ids as text, tolerant dates and numbers, unknown categories, one price column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import category, id_text, number, tolerant_date, truthy

#: Names under which a price may come, in order of preference.
PRICE_NAMES = ("unit_price", "price", "list_price", "unit_cost", "sale_price")
CATEGORIES = ("brand", "l2_category", "l3_category", "functionality")


def require(df: DataFrame, columns: set[str], what: str) -> DataFrame:
    missing = columns - set(df.columns)
    if missing:
        raise ValueError(f"{what} lacks {sorted(missing)}")
    return df


def price_column(df: DataFrame) -> str | None:
    return next((c for c in PRICE_NAMES if c in df.columns), None)


def _or_unknown(df: DataFrame, name: str):
    return (category(name) if name in df.columns else F.lit("Unknown")).alias(name)


def customers(df: DataFrame) -> DataFrame:
    require(df, {"customer_id"}, "customers")
    optional = [c for c in ("customer_name", "customer_type", "city", "state") if c in df.columns]
    return df.select(id_text("customer_id").alias("customer_id"), _or_unknown(df, "region"), _or_unknown(df, "end_use"), *optional)


def products(df: DataFrame) -> DataFrame:
    """in_stock is true throughout where the column is missing."""
    require(df, {"product_id"}, "products")
    price = price_column(df)
    optional = [c for c in ("product_name",) if c in df.columns]
    return df.select(
        id_text("product_id").alias("product_id"), *[_or_unknown(df, c) for c in CATEGORIES], (truthy("in_stock") if "in_stock" in df.columns else F.lit(True)).alias("in_stock"),
        *([number(price).alias("product_price")] if price else []), *optional,
    )


def invoices(df: DataFrame) -> DataFrame:
    """Rows with a valid date."""
    require(df, {"customer_id", "product_id", "quantity", "invoice_date"}, "invoices")
    price = price_column(df)
    out = df.select(
        *([id_text("invoice_id").alias("invoice_id")] if "invoice_id" in df.columns else []), id_text("customer_id").alias("customer_id"), id_text("product_id").alias("product_id"),
        number("quantity").alias("quantity"), tolerant_date("invoice_date").alias("invoice_date"), *([number(price).alias("unit_price")] if price else []),
    )
    return out.filter(F.col("invoice_date").isNotNull())


def invalid_dates(df: DataFrame) -> DataFrame:
    """How many rows the date filter drops."""
    return df.agg(F.count("*").alias("rows"), F.count_if(tolerant_date("invoice_date").isNull()).alias("invalid"))


def feedback(df: DataFrame) -> DataFrame | None:
    """Canonical feedback, or None where a required column is missing; the product may be called recommended_product."""
    if "product_id" not in df.columns and "recommended_product" in df.columns:
        df = df.withColumnRenamed("recommended_product", "product_id")
    if {"customer_id", "product_id", "rating"} - set(df.columns):
        return None
    text = lambda c: (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
    when = tolerant_date("feedback_date") if "feedback_date" in df.columns else F.lit(None).cast("timestamp_ntz")
    order = F.col("feedback_id") if "feedback_id" in df.columns else F.lit(0)
    return df.select(id_text("customer_id").alias("customer_id"), id_text("product_id").alias("product_id"), text("rating"), text("reason_code"), text("sentiment"), when.alias("feedback_date"), order.cast("long").alias("feedback_id"))
