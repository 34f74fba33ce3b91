"""Sales feedback: weights, calibrated recommendations and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.scalars import iso_text
from .rank import top_k

# Reason codes that speak against and for a recommendation; the latter weigh like a medium rating without one.
NEGATIVE = ("not_relevant", "wrong_category", "already_have_contract", "customer_not_interested", "price_too_high", "out_of_territory", "competitor_product", "not_applicable", "poor_quality_signal")
POSITIVE = ("good_fit", "high_potential", "customer_interested", "complements_existing", "strong_affinity", "recommended_and_sold")


def _plain(name: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(name), F.lit(""))))


def weight(config: EngineConfig) -> Column:
    """By rating; a medium one by sentiment and then reason; 1 for what is unknown."""
    rating, sentiment, reason = _plain("rating"), _plain("sentiment"), _plain("reason_code")
    medium = F.when(sentiment == "positive", config.weight_med_pos).when(sentiment == "negative", config.weight_med_neg).when(reason.isin(*NEGATIVE), config.weight_med_neg).when(reason.isin(*POSITIVE), config.weight_med_pos).otherwise(config.weight_med_pos)
    return F.when(rating == "high", config.weight_high).when(rating == "low", config.weight_low).when(rating == "medium", medium).otherwise(F.lit(1.0))


def recent(feedback: DataFrame, config: EngineConfig, as_of: str | None = None) -> DataFrame:
    """Feedback without a date, or of the last feedback_recency_days before as_of (the last date by default)."""
    if as_of is None:
        dated = feedback.crossJoin(F.broadcast(feedback.agg(F.max("feedback_date").alias("_as_of"))))  # one row
    else:
        dated = feedback.withColumn("_as_of", F.lit(as_of).cast("timestamp_ntz"))
    first = F.col("_as_of") - F.make_dt_interval(F.lit(config.feedback_recency_days))
    return dated.filter(F.col("feedback_date").isNull() | (F.col("feedback_date") >= first)).drop("_as_of")


def weighted(feedback: DataFrame, config: EngineConfig) -> DataFrame:
    return feedback.withColumn("weight", weight(config))


def latest(weighted_feedback: DataFrame) -> DataFrame:
    """The last feedback of each customer and product; undated ones are oldest."""
    order = Window.partitionBy("customer_id", "product_id").orderBy(F.desc_nulls_last("feedback_date"), F.desc("feedback_id"))
    return weighted_feedback.withColumn("_k", F.row_number().over(order)).filter("_k = 1").drop("_k")


def calibrate(recs: DataFrame, feedback: DataFrame | None, config: EngineConfig, as_of: str | None = None) -> DataFrame:
    """Scores times weights, cut off and ranked anew; recs unchanged without feedback."""
    if feedback is None:
        return recs
    last = latest(weighted(recent(feedback, config, as_of), config)).select("customer_id", F.col("product_id").alias("recommended_product"), F.col("weight").alias("feedback_weight"))
    out = recs.drop("rank").join(last, ["customer_id", "recommended_product"], "left").withColumn("feedback_weight", F.coalesce("feedback_weight", F.lit(1.0)))
    out = out.withColumn("score", F.col("score") * F.col("feedback_weight")).filter(F.col("score") >= config.score_cutoff)
    return top_k(out, config.top_k)


def _rate(condition: Column) -> Column:
    return F.round(F.avg(condition.cast("double")), 4)


def overall(weighted_feedback: DataFrame, config: EngineConfig) -> DataFrame:
    rating = F.lower(F.coalesce("rating", F.lit("")))
    w = F.col("weight")
    return weighted_feedback.agg(
        F.count("*").alias("n"), _rate(w >= config.weight_med_pos).alias("acceptance_rate"), _rate(rating == "high").alias("high_rate"),
        _rate(w == config.weight_med_pos).alias("medium_positive_rate"), _rate(w == config.weight_med_neg).alias("medium_negative_rate"), _rate(rating == "low").alias("low_rate"),
    )


def by_group(weighted_feedback: DataFrame, recs: DataFrame, group: str, config: EngineConfig) -> DataFrame:
    """Number and acceptance by the recommendation's segment or category; feedback on nothing recommended is left out."""
    keyed = recs.groupBy("customer_id", F.col("recommended_product").alias("product_id")).agg(F.min(group).alias(group))
    met = weighted_feedback.join(keyed, ["customer_id", "product_id"]).filter(F.col(group).isNotNull())
    return met.groupBy(group).agg(F.count("*").alias("n"), _rate(F.col("weight") >= config.weight_med_pos).alias("acceptance_rate"))


def reasons(feedback: DataFrame) -> DataFrame:
    return feedback.groupBy(F.coalesce("reason_code", F.lit("not_provided")).alias("reason_code")).agg(F.count("*").alias("n"))


def suggestions(overall_rates: DataFrame, config: EngineConfig) -> DataFrame:
    """What acceptance suggests for the least confidence and the score cutoff; advice only."""
    a, cut = F.col("acceptance_rate"), config.score_cutoff
    low, high = a < 0.5, a > 0.8
    confidence = F.when(low, F.round(F.least(F.lit(0.2), 0.05 + (0.5 - a) * 0.3), 3)).when(high, F.round(F.greatest(F.lit(0.02), 0.05 - (a - 0.8) * 0.1), 3)).otherwise(0.05)
    cutoff = F.when(low, F.round(F.least(F.lit(0.2), F.lit(cut + 0.02)), 3)).when(high, F.round(F.greatest(F.lit(0.04), F.lit(cut - 0.01)), 3)).otherwise(cut)
    why = F.when(low, "acceptance is low: stricter thresholds").when(high, "acceptance is high: looser thresholds").otherwise("acceptance is fair: no change")
    return overall_rates.select(confidence.alias("min_confidence"), cutoff.alias("score_cutoff"), why.alias("rationale"))


def summary(feedback: DataFrame, recs: DataFrame, config: EngineConfig, generated_at: str, as_of: str | None = None) -> DataFrame:
    """All of it as one row of JSON. Groups are as many as segments, categories and codes."""
    w = weighted(recent(feedback, config, as_of), config)
    rates = overall(w, config)

    def mapped(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
        return df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), value)))).alias(name))

    pair = F.struct("n", "acceptance_rate")
    out = rates.select(F.struct(*rates.columns).alias("overall"))
    for part in (
        mapped(by_group(w, recs, "segment", config), "segment", pair, "by_segment"), mapped(by_group(w, recs, "l2_category", config), "l2_category", pair, "by_l2_category"),
        mapped(reasons(w), "reason_code", F.col("n"), "reason_code_distribution"), suggestions(rates, config).select(F.struct("min_confidence", "score_cutoff", "rationale").alias("threshold_suggestions")),
    ):
        out = out.crossJoin(F.broadcast(part))  # one row each
    return out.select(F.to_json(F.struct(iso_text(F.lit(generated_at)).alias("generated_at"), F.col("overall")["n"].alias("total_feedback_rows"), *out.columns)).alias("summary"))
