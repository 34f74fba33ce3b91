"""Streaming forms of sessions and feedback: the batch operators' semantics over unbounded input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators.feedback import weight


def session_gap(window_days: int) -> str:
    """A gap just short of window_days + 1, so rows window_days apart, counted in whole days, stay together."""
    return f"{window_days} days 23 hours 59 minutes 59 seconds 999 milliseconds 999 microseconds"


def event_sessions(events: DataFrame, window_days: int, late: str = "1 day", user: str = "user_id", ts: str = "ts") -> DataFrame:
    """user, first, last and number of events of each session; state is dropped once the watermark passes it.

    Works on a stream (append mode) and on a table alike.
    """
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("_ts", late)
    grouped = timed.groupBy(F.col(user), F.session_window("_ts", session_gap(window_days)).alias("w"))
    return grouped.agg(F.min("_ts").alias("first"), F.max("_ts").alias("last"), F.count("*").alias("n_events")).drop("w")


def feedback_updates(feedback: DataFrame, recs: DataFrame, config: EngineConfig) -> DataFrame:
    """Each arriving feedback with the recommendation it is about and the calibrated score: a stream joined with a table."""
    keyed = recs.select("customer_id", F.col("recommended_product").alias("product_id"), "segment", "score")
    met = feedback.join(keyed, ["customer_id", "product_id"])
    return met.withColumn("weight", weight(config)).withColumn("new_score", F.col("score") * F.col("weight"))


def acceptance_by_window(feedback: DataFrame, config: EngineConfig, length: str = "1 day", late: str = "2 days") -> DataFrame:
    """Number and acceptance of feedback in tumbling windows of its own time."""
    timed = feedback.withColumn("_ts", F.col("feedback_date").cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("_ts", late)
    good = (weight(config) >= config.weight_med_pos).cast("double")
    return timed.groupBy(F.window("_ts", length).alias("w")).agg(F.count("*").alias("n"), F.avg(good).alias("acceptance_rate")).select(F.col("w.start").alias("start"), "n", "acceptance_rate")


def to_parquet(stream: DataFrame, path: str, checkpoint: str):
    """Append a stream to Parquet, and stop when what is there has been read."""
    return stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
