"""The order tables of the test data as canonical customers, products, invoices and feedback."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import stage

LATEST = 1000  #: orders among which the last invoice date is looked for first

#: The reasons that feedback events are given, by event number.
REASONS = ("good_fit", "price_too_high", "not_relevant", "high_potential", "other")


@dataclass(frozen=True)
class Canonical:
    customers: DataFrame
    products: DataFrame
    invoices: DataFrame
    feedback: DataFrame


def last_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row, ref_date: the last invoice date, from the lines of the latest orders; from all lines where those orders have none with a part."""
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    orders, parts = t("orders").select("o_orderkey", "o_orderdate"), t("part").select("p_partkey")  # an inner join with parts: a semi-join would be made first, over all lines
    latest = F.broadcast(orders.orderBy(F.desc("o_orderdate")).limit(LATEST))
    for some in (latest, orders):
        lines = t("lineitem").select("l_orderkey", "l_partkey").join(some, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
        found = stage(lines.agg(F.max("o_orderdate").alias("ref_date")), "last-date")
        if found.first()["ref_date"] is not None:
            break
    return found


def load(spark: SparkSession, sf_dir: str) -> Canonical:
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # nation and region have 25 and 5 rows by definition.
    places = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    customers = t("customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        "region",
        F.col("c_mktsegment").alias("end_use"),
        F.when(F.col("c_acctbal") < 0, "Small").when(F.col("c_acctbal") < 5000, "Medium").otherwise("Large").alias("customer_type"),
    )
    number = F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")
    parts = t("part").select(
        "p_partkey",
        F.concat("p_brand", F.lit("/"), "p_type").alias("product_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("l2_category"),
        F.concat("p_type", F.lit("-"), (number % 4).cast("string")).alias("l3_category"),
        F.concat(F.lit("F"), (number % 5).cast("string")).alias("functionality"),
        (number != 20).alias("in_stock"),
        "p_retailprice",
    )
    product_keys = ["product_id", "brand", "l2_category", "l3_category", "functionality", "in_stock"]
    products = parts.groupBy(*product_keys).agg(F.round(F.avg("p_retailprice"), 2).alias("product_price"))
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(parts.select("p_partkey", "product_id"), F.col("l_partkey") == F.col("p_partkey"))
    invoices = lines.select(
        F.col("o_orderkey").cast("string").alias("invoice_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        "product_id",
        F.col("l_quantity").cast("double").alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        (F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).alias("unit_price"),
    )
    # The catalogue of brands and types is small by construction, so it may be numbered in one task; Spark decides how to join it.
    numbered = products.select("product_id").withColumn("k", (F.row_number().over(Window.orderBy("product_id")) - 1).cast("long"))
    size = products.agg(F.count("*").alias("n_products"))
    kind = F.col("event_type")
    events = t("events").join(F.broadcast(size)).withColumn("k", F.col("event_id") % F.col("n_products"))
    codes = F.array(*[F.lit(r) for r in REASONS])
    feedback = events.join(numbered, "k").select(
        F.col("user_id").cast("string").alias("customer_id"),
        "product_id",
        F.when(kind == "purchase", "High").when(kind.isin("click", "view"), "Medium").when(kind == "error", "Low").otherwise("unknown").alias("rating"),
        F.when(kind == "view", F.get(codes, (F.col("event_id") % len(REASONS)).cast("int"))).alias("reason_code"),
        F.when(kind == "click", "positive").alias("sentiment"),
        F.col("ts").alias("feedback_date"),
        F.col("event_id").alias("feedback_id"),
    )
    return Canonical(customers, products, invoices, feedback)


def surrogate_clusters(basket: DataFrame, per_segment: int = 3) -> DataFrame:
    """A cluster for each customer of the basket that SQL can give as well: by the number in its id."""
    k = (F.col("customer_id").cast("long") % per_segment).cast("string")
    return basket.select("customer_id", "segment").distinct().select("customer_id", F.concat_ws("_", "segment", k).alias("cluster_id"), "segment")
