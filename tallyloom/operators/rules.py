"""Directed association rules inside clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..sources.files import stage
from .basket import recency_scope, reference_date
from .sessions import basket_window, sessionise, with_decay

GROUP = ["segment", "cluster_id"]


def basket_products(invoices: DataFrame, clusters: DataFrame, config: EngineConfig) -> DataFrame:
    """Distinct (segment, cluster, basket, product) with the basket's weight; customers without a cluster are left out."""
    scope = recency_scope(invoices, config).drop("ref_date") if config.mining_cutoff else invoices
    sessions = with_decay(sessionise(scope, basket_window(scope, config)), reference_date(scope), config)
    rows = sessions.join(clusters.select("customer_id", "cluster_id", "segment"), "customer_id")
    return rows.groupBy(*GROUP, "basket_id", "product_id").agg(F.max("weight").alias("weight"))


def cluster_totals(items: DataFrame, config: EngineConfig) -> DataFrame:
    """Baskets of each cluster and the least frequency of a rule's first product."""
    totals = items.select(*GROUP, "basket_id").distinct().groupBy(*GROUP).agg(F.count("*").alias("total_baskets"))
    least = F.ceil(F.greatest(F.col("total_baskets") * F.lit(config.min_freq_ratio), F.lit(float(config.min_abs_freq)))).cast("long")
    return totals.withColumn("min_freq", least)


def product_frequency(items: DataFrame) -> DataFrame:
    return items.groupBy(*GROUP, "product_id").agg(F.count("*").alias("product_freq"))


def pair_counts(items: DataFrame) -> DataFrame:
    """Baskets with both products, in both directions, and the sum of their weights."""
    b = items.select("basket_id", F.col("product_id").alias("product_b"))
    pairs = items.withColumnRenamed("product_id", "product_a").join(b, "basket_id").filter("product_a <> product_b")
    return pairs.groupBy(*GROUP, "product_a", "product_b").agg(F.count("*").alias("pair_freq"), F.sum("weight").alias("weighted_pair_freq"))


def rule_metrics(items: DataFrame, config: EngineConfig) -> DataFrame:
    """Confidence, support, weighted support and lift of every pair."""
    freq = product_frequency(items)
    a = freq.select(*GROUP, F.col("product_id").alias("product_a"), "product_freq")
    b = freq.select(*GROUP, F.col("product_id").alias("product_b"), F.col("product_freq").alias("freq_b"))
    m = pair_counts(items).join(a, [*GROUP, "product_a"]).join(b, [*GROUP, "product_b"]).join(cluster_totals(items, config), GROUP)
    total = F.col("total_baskets").cast("double")
    confidence = F.col("pair_freq") / F.col("product_freq")
    return m.select(
        *GROUP, "product_a", "product_b", "pair_freq", "product_freq", confidence.alias("confidence"), (F.col("pair_freq") / total).alias("support"),
        (F.col("weighted_pair_freq") / total).alias("weighted_support"), F.coalesce(F.round(confidence / F.nullif(F.col("freq_b") / total, F.lit(0.0)), 4), F.lit(0.0)).alias("lift"), "min_freq",
    )


def association_rules(items: DataFrame, config: EngineConfig) -> DataFrame:
    """Rules whose first product is frequent enough and whose lift is min_lift or more."""
    m = rule_metrics(items, config)
    return m.filter((F.col("product_freq") >= F.col("min_freq")) & (F.col("lift") >= config.min_lift)).drop("min_freq")


def mine(invoices: DataFrame, clusters: DataFrame, config: EngineConfig) -> DataFrame:
    return association_rules(stage(basket_products(invoices, clusters, config), "items"), config)  # read five times


def impossible_rules(rules: DataFrame) -> DataFrame:
    """Rules that break an invariant; none may."""
    most = 1 + 1e-9
    return rules.filter((F.col("confidence") > most) | (F.col("support") > most) | (F.col("weighted_support") > F.col("support") + 1e-9))


def rule_summary(rules: DataFrame) -> DataFrame:
    return rules.agg(F.count("*").alias("n_rules"), F.count_distinct("segment").alias("n_segments"), F.count_distinct("cluster_id").alias("n_clusters"), F.min("lift").alias("min_lift"), F.max("lift").alias("max_lift"), F.round(F.min("confidence"), 6).alias("min_confidence"), F.round(F.max("confidence"), 6).alias("max_confidence"))
