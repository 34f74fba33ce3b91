"""Scored recommendations: rules first, category affinity where they don't suffice, best top_k of each customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.scalars import UNKNOWN, clip, fallback_reason, rule_reason
from ..sources.files import stage

FALLBACK = "fallback"


def in_stock_products(basket: DataFrame) -> DataFrame:
    """Distinct products in stock; all of them where the column is missing."""
    return (basket.filter("in_stock") if "in_stock" in basket.columns else basket).select("product_id").distinct()


def quantity_lookup(basket: DataFrame) -> DataFrame:
    """Per customer and product: the usual quantity of an order, at least 1."""
    each = F.col("total_quantity") / F.greatest(F.col("purchase_frequency"), F.lit(1))
    return basket.groupBy("customer_id", "product_id").agg(F.greatest(F.lit(1), F.bround(F.median(each), 0).cast("int")).alias("qty"))


def affinity(basket: DataFrame, category: str, measure: str, name: str) -> DataFrame:
    """The share of each category in a customer's measure; 0 where the customer has none."""
    sums = basket.groupBy("customer_id", category).agg(F.sum(measure).cast("double").alias("_x"))
    total = F.sum("_x").over(Window.partitionBy("customer_id"))
    return sums.select("customer_id", category, F.coalesce(F.col("_x") / F.nullif(total, F.lit(0.0)), F.lit(0.0)).alias(name))


def l3_affinity(basket: DataFrame) -> DataFrame:
    return affinity(basket, "l3_category", "purchase_frequency", "l3_share")


def l2_affinity(basket: DataFrame) -> DataFrame:
    return affinity(basket, "l2_category", "total_quantity", "l2_affinity")


def segment_popularity(basket: DataFrame) -> DataFrame:
    return basket.groupBy("segment", "product_id").agg(F.sum("purchase_frequency").alias("popularity"))


def recency_score(basket: DataFrame) -> DataFrame:
    return basket.groupBy("customer_id").agg((1 / (1 + F.avg("recency_days"))).alias("recency_score"))


def categories(basket: DataFrame) -> DataFrame:
    return basket.groupBy("product_id").agg(F.min("l2_category").alias("l2_category"), F.min("l3_category").alias("l3_category"))


def lift_norm(lift: Column, config: EngineConfig) -> Column:
    return clip((lift - 1) / (config.max_lift_normalise - 1), 0.0, 1.0)


def rule_score(config: EngineConfig) -> Column:
    c, s, l, r = config.weights
    return c * clip(F.col("confidence"), 0.0, 1.0) + s * clip(F.col("weighted_support"), 0.0, 1.0) + l * lift_norm(F.col("lift"), config) + r * clip(F.col("recency_score"), 0.0, 1.0)


def rule_candidates(basket: DataFrame, clusters: DataFrame, rules: DataFrame, config: EngineConfig) -> DataFrame:
    """Rules of a customer's cluster that start from a bought product and lead to one in stock that isn't."""
    kept = rules.filter((F.col("support") >= config.min_support) & (F.col("confidence") >= config.min_confidence) & (F.col("lift") >= config.min_lift))
    kept = kept.join(in_stock_products(basket).withColumnRenamed("product_id", "product_b"), "product_b", "left_semi")
    bought = basket.select("customer_id", "product_id").distinct()
    own = bought.withColumnRenamed("product_id", "product_a").join(clusters.select("customer_id", "segment", "cluster_id"), "customer_id")
    met = own.join(kept, ["segment", "cluster_id", "product_a"])
    return met.join(bought.withColumnRenamed("product_id", "product_b"), ["customer_id", "product_b"], "left_anti")


def scored_candidates(candidates: DataFrame, basket: DataFrame, config: EngineConfig) -> DataFrame:
    """Candidates with score, the share of their fine category added by a small margin."""
    c = candidates.join(recency_score(basket), "customer_id").join(categories(basket).withColumnRenamed("product_id", "product_b"), "product_b", "left")
    c = c.withColumns({"l2_category": F.coalesce("l2_category", F.lit(UNKNOWN)), "l3_category": F.coalesce("l3_category", F.lit(UNKNOWN))})
    c = c.join(l3_affinity(basket), ["customer_id", "l3_category"], "left")
    score = rule_score(config) + F.coalesce("l3_share", F.lit(0.0)) * config.l3_tiebreak_margin
    return c.withColumn("score", F.least(score, F.lit(1.0)) if config.cap_score else score)


def association_recommendations(scored: DataFrame, basket: DataFrame) -> DataFrame:
    """The best rule of each customer and product; equal scores go to the first trigger."""
    best = Window.partitionBy("customer_id", "product_b").orderBy(F.desc(F.round("score", 9)), "product_a")
    one = scored.withColumn("_k", F.row_number().over(best)).filter("_k = 1")
    one = one.join(quantity_lookup(basket).withColumnRenamed("product_id", "product_a"), ["customer_id", "product_a"], "left")
    return one.select(
        "customer_id", F.col("product_b").alias("recommended_product"), "cluster_id", "segment", "l2_category", "l3_category", F.col("product_a").alias("trigger_product"),
        "support", "confidence", "lift", "score", F.coalesce("qty", F.lit(1)).alias("recommended_qty"), rule_reason("product_a", "product_b", "support", "confidence", "lift").alias("reason"),
    )


def _prefix(rows: DataFrame, items: str, length: Column) -> DataFrame:
    """The first `length` items of a shelf, a row each: product_id, popularity, categories."""
    picked = rows.withColumn("_x", F.explode(F.slice(items, F.lit(1), length.cast("int")))).drop(items)
    return picked.select(*[c for c in picked.columns if c not in ("_x", "l2_category")], F.col("_x.product_id").alias("product_id"), (-F.col("_x.p")).alias("popularity"), "_x.l2_category", "_x.l3_category")


def fallback_recommendations(basket: DataFrame, clusters: DataFrame, already: DataFrame, config: EngineConfig) -> DataFrame:
    """For customers with fewer than top_k in `already`: products of their segment that are in stock and new to them.

    Ordered by affinity to the category and then popularity; only as many as are missing. A segment's products are kept as
    shelves, an array by popularity for each category, and a customer takes from each of its own categories what is missing
    and what it knows there already. Only those whose own categories don't suffice go along the whole segment, past what
    they know and their own categories.
    """
    have = already.groupBy("customer_id").agg(F.count("*").alias("n_have"))
    own = clusters.select("customer_id", "segment", "cluster_id").join(have, "customer_id", "left")
    own = own.withColumn("missing", config.top_k - F.coalesce("n_have", F.lit(0))).drop("n_have").filter("missing > 0")
    bought = basket.select("customer_id", "product_id").distinct()
    kinds = categories(basket)
    known = bought.union(already.select("customer_id", F.col("recommended_product").alias("product_id"))).distinct()
    known = stage(known.join(own.select("customer_id"), "customer_id", "left_semi").join(kinds.select("product_id", "l2_category"), "product_id"), "known")
    pool = segment_popularity(basket).join(in_stock_products(basket), "product_id", "left_semi").join(kinds, "product_id")
    item = F.struct((-F.col("popularity")).alias("p"), "product_id", "l2_category", "l3_category")
    # A shelf is as long as the catalogue at most.
    shelves = stage(pool.groupBy("segment", "l2_category").agg(F.array_sort(F.collect_list(item)).alias("shelf")), "shelves")
    aisles = shelves.groupBy("segment").agg(F.array_sort(F.flatten(F.collect_list("shelf"))).alias("aisle"))

    likes = l2_affinity(basket)
    mine = likes.filter(F.round("l2_affinity", 9) > 0).select("customer_id", "l2_category")
    met = own.join(mine, "customer_id").join(known.groupBy("customer_id", "l2_category").agg(F.count("*").alias("n_known")), ["customer_id", "l2_category"], "left")
    met = met.join(shelves, ["segment", "l2_category"])
    near = _prefix(met.select(*own.columns, "l2_category", "shelf", "n_known"), "shelf", F.col("missing") + F.coalesce("n_known", F.lit(0))).drop("n_known")
    near = near.join(known.select("customer_id", "product_id"), ["customer_id", "product_id"], "left_anti")
    got = near.groupBy("customer_id").agg(F.count("*").alias("n_near"))
    passed = met.groupBy("customer_id").agg(F.sum(F.size("shelf")).alias("n_mine"))
    short = own.join(got, "customer_id", "left").filter(F.coalesce("n_near", F.lit(0)) < F.col("missing")).drop("n_near")
    short = short.join(known.groupBy("customer_id").agg(F.count("*").alias("n_known")), "customer_id", "left").join(passed, "customer_id", "left")
    length = F.col("missing") + F.coalesce("n_known", F.lit(0)) + F.coalesce("n_mine", F.lit(0))
    far = _prefix(short.join(aisles, "segment"), "aisle", length).drop("n_known", "n_mine")
    far = far.join(known.select("customer_id", "product_id"), ["customer_id", "product_id"], "left_anti").join(mine, ["customer_id", "l2_category"], "left_anti")
    every = near.unionByName(far).join(likes, ["customer_id", "l2_category"], "left").withColumn("l2_affinity", F.coalesce("l2_affinity", F.lit(0.0)))
    order = Window.partitionBy("customer_id").orderBy(F.desc(F.round("l2_affinity", 9)), F.desc("popularity"), "product_id")
    every = every.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= F.col("missing"))
    zero = F.lit(0.0)
    return every.select(
        "customer_id", F.col("product_id").alias("recommended_product"), "cluster_id", "segment", "l2_category", "l3_category", F.lit(FALLBACK).alias("trigger_product"),
        zero.alias("support"), zero.alias("confidence"), zero.alias("lift"), (0.1 + F.col("l2_affinity")).alias("score"), F.lit(1).alias("recommended_qty"), fallback_reason("l2_category", "l2_affinity").alias("reason"),
    )


def top_k(recs: DataFrame, k: int, score: str = "score") -> DataFrame:
    """rank by score, rules before fallback and then by product among equals; the first k of each customer."""
    order = Window.partitionBy("customer_id").orderBy(F.desc(F.round(score, 9)), (F.col("trigger_product") == FALLBACK).cast("int"), "recommended_product")
    return recs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def with_fallback(assoc: DataFrame, basket: DataFrame, clusters: DataFrame, config: EngineConfig) -> DataFrame:
    """assoc filled up to top_k and ranked. assoc is read three times: write it first where it is dear."""
    return top_k(assoc.unionByName(fallback_recommendations(basket, clusters, assoc, config)), config.top_k)


def rank_recommendations(basket: DataFrame, clusters: DataFrame, rules: DataFrame, config: EngineConfig) -> DataFrame:
    scored = scored_candidates(rule_candidates(basket, clusters, rules, config), basket, config)
    return with_fallback(stage(association_recommendations(scored, basket), "assoc"), basket, clusters, config)


def summary(recs: DataFrame) -> DataFrame:
    by_rule = F.col("trigger_product") != FALLBACK
    return recs.agg(
        F.count("*").alias("n_recommendations"), F.count_distinct("customer_id").alias("n_customers"), F.count_distinct("recommended_product").alias("n_products"),
        F.count_distinct(F.when(by_rule, F.col("customer_id"))).alias("via_rules"), F.count_distinct(F.when(~by_rule, F.col("customer_id"))).alias("via_fallback"),
        F.round(F.min("score"), 6).alias("min_score"), F.round(F.max("score"), 6).alias("max_score"),
    )
