"""Purchase sessions with a gap taken from the data, and their decay weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.scalars import days_between, decay

SHORTEST, LONGEST, DEFAULT = 7, 90, 30


def purchase_gaps(invoices: DataFrame, grain: str = "row") -> DataFrame:
    """customer_id, invoice_date, gap_days to the row before; grain date takes distinct dates."""
    rows = invoices.select("customer_id", "invoice_date")
    rows = rows.distinct() if grain == "date" else rows
    before = F.lag("invoice_date").over(Window.partitionBy("customer_id").orderBy("invoice_date"))
    return rows.withColumn("gap_days", days_between(F.col("invoice_date"), before))


def basket_window(invoices: DataFrame, config: EngineConfig) -> DataFrame:
    """One row, window_days: the median of the customers' median gaps, rounded half to even, within 7 and 90; 30 without gaps."""
    if config.window_days > 0:
        return invoices.sparkSession.range(1).select(F.lit(config.window_days).cast("long").alias("window_days"))
    medians = purchase_gaps(invoices, config.gap_grain).filter("gap_days IS NOT NULL").groupBy("customer_id").agg(F.median("gap_days").alias("m"))
    half_even = F.bround(F.median("m"), 0).cast("long")
    bounded = F.greatest(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.col("w")))
    return medians.agg(half_even.alias("w")).select(F.when(F.col("w").isNull(), DEFAULT).otherwise(bounded).cast("long").alias("window_days"))


def sessionise(invoices: DataFrame, window: DataFrame) -> DataFrame:
    """Invoice rows with basket_id and basket_date, the session's last date. A gap of window_days stays in the session."""
    order = Window.partitionBy("customer_id").orderBy("invoice_date")
    rows = invoices.crossJoin(F.broadcast(window))  # one row
    gap = days_between(F.col("invoice_date"), F.lag("invoice_date").over(order))
    rows = rows.withColumn("_new", F.when(gap.isNull() | (gap > F.col("window_days")), 1).otherwise(0))
    rows = rows.withColumn("session_no", F.sum("_new").over(order))  # ties have gap 0, so the range frame is right
    rows = rows.withColumn("basket_id", F.concat_ws("_", "customer_id", "session_no"))
    return rows.withColumn("basket_date", F.max("invoice_date").over(Window.partitionBy("customer_id", "session_no"))).drop("_new", "window_days")


def baskets(sessions: DataFrame) -> DataFrame:
    """A row a session: dates, rows and distinct products."""
    return sessions.groupBy("customer_id", "basket_id").agg(F.min("invoice_date").alias("first_date"), F.max("invoice_date").alias("basket_date"), F.count("*").alias("n_rows"), F.count_distinct("product_id").alias("n_products"))


def with_decay(rows: DataFrame, ref: DataFrame, config: EngineConfig) -> DataFrame:
    """weight = exp(-decay_lambda * age), the age of basket_date in days, at least 0."""
    age = days_between(F.col("ref_date"), F.col("basket_date"))
    return rows.crossJoin(F.broadcast(ref)).withColumn("weight", decay(age, config.decay_lambda)).drop("ref_date")
