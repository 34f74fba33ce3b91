"""Checks of recommendations, and reports about them for people."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.scalars import lookup, percent_text, price_text
from .rank import FALLBACK

# Categories that customers of an end use are expected to buy. Here by market segment of the order tables.
EXPECTED = {
    "AUTOMOBILE": ["STANDARD", "SMALL"],
    "BUILDING": ["MEDIUM", "LARGE"],
    "FURNITURE": ["ECONOMY", "STANDARD"],
    "HOUSEHOLD": ["PROMO", "ECONOMY"],
    "MACHINERY": ["LARGE", "MEDIUM"],
}
HIGH_SCORE, MEDIUM_SCORE, HIGH_CONFIDENCE, MEDIUM_CONFIDENCE = 0.4, 0.3, 0.5, 0.3
REQUIRED = {"customer_id", "recommended_product", "segment", "cluster_id", "score", "support", "confidence", "lift", "rank"}


def check_columns(recs: DataFrame) -> None:
    if missing := REQUIRED - set(recs.columns):
        raise ValueError(f"recommendations lack {sorted(missing)}")


def invariants(recs: DataFrame, basket: DataFrame, config: EngineConfig) -> DataFrame:
    """check, violations: 0 for each that holds."""
    check_columns(recs)
    by_rule = F.col("trigger_product") != FALLBACK
    single = recs.agg(
        (F.count("*") == 0).cast("long").alias("not_empty"), F.count_if((F.col("rank") < 1) | (F.col("rank") > config.top_k)).alias("rank_range"),
        F.count_if(by_rule & ((F.col("support") < config.min_support) | (F.col("confidence") < config.min_confidence) | (F.col("lift") < config.min_lift))).alias("thresholds"),
    )
    many = recs.groupBy("customer_id").agg(F.count("*").alias("n"), F.max("rank").alias("m"), F.min("rank").alias("l"))
    counts = many.agg(F.count_if(F.col("n") > config.top_k).alias("at_most_top_k"), F.count_if((F.col("l") != 1) | (F.col("m") != F.col("n"))).alias("rank_dense"))
    twice = recs.groupBy("customer_id", "recommended_product").count().filter("count > 1").agg(F.count("*").alias("duplicates"))
    bought = recs.join(basket.select("customer_id", F.col("product_id").alias("recommended_product")).distinct(), ["customer_id", "recommended_product"], "left_semi").agg(F.count("*").alias("already_bought"))
    home = basket.select("customer_id", F.col("segment").alias("home")).distinct()
    alien = recs.join(home, "customer_id").filter("segment <> home").agg(F.count("*").alias("segment_isolation"))
    rows = [df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).cast("long").alias("violations")) for c in df.columns])).alias("x")).select("x.*") for df in (single, counts, twice, bought, alien)]
    return reduce(DataFrame.unionByName, rows)


def coverage(recs: DataFrame, basket: DataFrame) -> DataFrame:
    covered = recs.select("customer_id").distinct().withColumn("_c", F.lit(1))
    people = basket.select("customer_id").distinct().join(covered, "customer_id", "left").agg(F.count("*").alias("n_customers"), F.count("_c").alias("n_covered"))
    by_rule = F.col("trigger_product") != FALLBACK
    means = recs.agg(F.round(F.avg(F.when(by_rule, F.col("support"))), 6).alias("avg_support"), F.round(F.avg(F.when(by_rule, F.col("confidence"))), 6).alias("avg_confidence"))
    return people.crossJoin(F.broadcast(means)).withColumn("coverage", F.round(F.col("n_covered") / F.nullif(F.col("n_customers"), F.lit(0)), 6))


def describe_group_sizes(df: DataFrame, key: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of rows by key."""
    n = df.groupBy(key).agg(F.count("*").cast("double").alias("n"))
    q = F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = n.agg(F.count("*").alias("count"), F.round(F.avg("n"), 6).alias("mean"), F.round(F.stddev_samp("n"), 6).alias("std"), F.min("n").alias("min"), q.alias("q"), F.max("n").alias("max"))
    return out.select("count", "mean", "std", "min", *[F.get("q", F.lit(i)).alias(c) for i, c in enumerate(("q25", "q50", "q75"))], "max")


def enrich(recs: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Recommendations with the names and attributes of product, trigger and customer."""
    p = products.select(F.col("product_id").alias("recommended_product"), F.col("brand").alias("recommended_brand"), F.col("l2_category").alias("recommended_category"), "product_price")
    t = products.select(F.col("product_id").alias("trigger_product"), F.col("brand").alias("trigger_brand"), F.col("l2_category").alias("trigger_category"))
    out = recs.drop("l2_category", "l3_category").join(p, "recommended_product", "left").join(t, "trigger_product", "left")
    return out.join(customers.select("customer_id", "customer_name", "region", "end_use", "customer_type"), "customer_id", "left").withColumn("confidence_text", percent_text(F.col("confidence")))


def sample_customers(recs: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """The n customers of least digest with the seed: a sample that is the same every time."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), "customer_id"))
    return recs.select("customer_id").distinct().orderBy(draw, "customer_id").limit(n)


def customer_profiles(enriched: DataFrame) -> DataFrame:
    """A row a customer with recommendations: who it is, its segment and cluster."""
    who = ["customer_name", "region", "end_use", "customer_type", *[c for c in ("city", "state") if c in enriched.columns], "segment", "cluster_id"]
    return enriched.groupBy("customer_id").agg(*[F.min(c).alias(c) for c in who], F.count("*").alias("n_recommendations"))


def top_products(basket: DataFrame, top: int = 5) -> DataFrame:
    """Per customer, the products it bought most of."""
    order = Window.partitionBy("customer_id").orderBy(F.desc("total_quantity"), "product_id")
    rows = basket.select("customer_id", "product_id", "l2_category", "l3_category", "total_quantity")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)


def category_totals(basket: DataFrame, top: int = 5) -> DataFrame:
    """Per customer, its leading categories by quantity."""
    sums = basket.groupBy("customer_id", "l2_category").agg(F.sum("total_quantity").alias("total_quantity"), F.sum("purchase_frequency").alias("purchase_frequency"))
    order = Window.partitionBy("customer_id").orderBy(F.desc("total_quantity"), "l2_category")
    return sums.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)


def category_match(enriched: DataFrame) -> DataFrame:
    """Per customer: which recommended categories its end use is expected to buy."""
    got = enriched.groupBy("customer_id", "end_use").agg(F.array_sort(F.collect_set("recommended_category")).alias("recommended"))
    match = F.array_intersect("recommended", lookup(EXPECTED, F.col("end_use")))
    return got.select("customer_id", "end_use", F.array_join("recommended", ",").alias("recommended"), F.array_join(match, ",").alias("matched"), (F.size(match) > 0).alias("categories_match"))


def customer_quality(recs: DataFrame) -> DataFrame:
    s = recs.groupBy("customer_id").agg(F.round(F.avg("score"), 6).alias("avg_score"), F.round(F.max("score"), 6).alias("max_score"), F.round(F.min("score"), 6).alias("min_score"), F.round(F.avg("confidence"), 6).alias("avg_confidence"))
    tier = lambda c, high, mid: F.when(F.col(c) >= high, "High").when(F.col(c) >= mid, "Medium").otherwise("Low")
    return s.withColumns({"quality": tier("avg_score", HIGH_SCORE, MEDIUM_SCORE), "confidence_tier": tier("avg_confidence", HIGH_CONFIDENCE, MEDIUM_CONFIDENCE)})


def quality_distribution(quality: DataFrame) -> DataFrame:
    sums = quality.groupBy("quality").agg(F.count("*").alias("n"))
    return sums.crossJoin(F.broadcast(quality.agg(F.count("*").alias("all")))).select("quality", "n", F.round(F.col("n") / F.col("all") * 100, 2).alias("percent"))


def sample_analysis(enriched: DataFrame, basket: DataFrame, n: int = 10) -> DataFrame:
    """The sampled customers: profile, what they bought most by category and product, scores, tier and whether categories fit."""
    picked = sample_customers(enriched, n)
    some, bought = (df.join(F.broadcast(picked), "customer_id", "left_semi") for df in (enriched, basket))  # n rows
    listed = lambda df, name, shown: df.groupBy("customer_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", shown.alias("s")))), lambda x: x["s"]), "; ").alias(name))
    units = F.concat(F.lit(": "), F.col("total_quantity").cast("long").cast("string"), F.lit(" units"))
    kinds = listed(category_totals(bought), "bought_categories", F.concat(F.col("l2_category"), units, F.lit(" ("), F.col("purchase_frequency").cast("string"), F.lit(" purchases)")))
    products = listed(top_products(bought), "bought_products", F.concat(F.col("product_id"), units))
    out = customer_profiles(some)
    for part in (category_match(some).drop("end_use"), customer_quality(some)):
        out = out.join(part, "customer_id")
    for part in (kinds, products):
        out = out.join(part, "customer_id", "left")
    return out


def sales_report(enriched: DataFrame, n: int | None = 10) -> DataFrame:
    """Recommendations as a sales person reads them; of n sampled customers, or of all."""
    rows = enriched if n is None else enriched.join(sample_customers(enriched, n), "customer_id", "left_semi")
    return rows.select(
        F.col("customer_name").alias("customer"), F.col("region").alias("location"), F.col("end_use").alias("business_type"), F.col("rank").cast("long").alias("rank"), "recommended_product", F.col("recommended_brand").alias("brand"),
        F.col("recommended_category").alias("category"), price_text(F.col("product_price")).alias("price"), F.col("recommended_qty").cast("long").alias("suggested_qty"), F.col("confidence_text").alias("confidence"), F.col("reason").alias("why"),
    )


def preview(report: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of a report."""
    return report.orderBy("customer", "rank", "recommended_product").limit(n)
