"""Feature matrix of customers in long form, scaled within segments."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.scalars import days_between, segment
from ..sources.files import stage
from .basket import rfm_scores

#: Feature groups by name: column of the basket and prefix of the features.
PROPORTIONS = {"l2_qty": ("l2_category", "l2_"), "brand": ("brand", "brand_"), "functionality": ("functionality", "func_")}
RFM = ("rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score")
BUFFER = 65_536  #: rows of whole customers that a task makes features of at once
_CUSTOMERS = "customer_id string, has map<string,double>, last long, ref long, rfm_frequency long, spend double"


def proportions(basket: DataFrame, column: str, prefix: str, measure: str = "total_quantity") -> DataFrame:
    """segment, customer_id, feature, value: each category's share of the customer's measure; only those it has."""
    sums = basket.groupBy("segment", "customer_id", column).agg(F.sum(measure).alias("_x"))
    total = F.sum("_x").over(Window.partitionBy("segment", "customer_id"))
    return sums.select("segment", "customer_id", F.concat(F.lit(prefix), column).alias("feature"), F.coalesce(F.col("_x") / F.nullif(total, F.lit(0.0)), F.lit(0.0)).alias("value"))


def rfm_features(basket: DataFrame) -> DataFrame:
    one = basket.groupBy("segment", "customer_id").agg(*[F.max(c).alias(c) for c in RFM])
    return one.select("segment", "customer_id", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(c, F.lit(0.0)).alias("value")) for c in RFM])).alias("x")).select("segment", "customer_id", "x.feature", "x.value")


def raw_l2_features(basket: DataFrame) -> DataFrame:
    """Plain quantities by category, the older feature set."""
    return basket.groupBy("segment", "customer_id", F.concat(F.lit("l2_"), "l2_category").alias("feature")).agg(F.sum("total_quantity").alias("value"))


def feature_matrix(basket: DataFrame, config: EngineConfig) -> DataFrame:
    """All feature groups of the configuration in long form; a feature that is missing is 0."""
    out = None
    for name in config.feature_groups:
        if name == "rfm":
            part = rfm_features(basket) if set(RFM) <= set(basket.columns) else None
        elif name in PROPORTIONS:
            part = proportions(basket, *PROPORTIONS[name])
        else:
            raise ValueError(f"no feature group {name}")
        if part is not None:
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no features")
    return out


def feature_stats(matrix: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Mean and deviations of each feature over all customers of its segment, counting the absent as 0.

    sizes (segment, n) spares counting the customers.
    """
    sizes = matrix.groupBy("segment").agg(F.count_distinct("customer_id").alias("n")) if sizes is None else sizes
    # Sums of squares are taken around the mean of the values present, which keeps them accurate.
    sums = matrix.groupBy("segment", "feature").agg(F.sum("value").alias("s"), F.avg("value").alias("m"), F.var_pop("value").alias("v"), F.count("*").alias("k")).join(sizes, "segment")
    mean = F.col("s") / F.col("n")
    squares = F.col("k") * F.col("v") + F.col("k") * (F.col("m") - mean) * (F.col("m") - mean) + (F.col("n") - F.col("k")) * mean * mean
    pop = F.sqrt(F.greatest(squares, F.lit(0.0)) / F.col("n"))
    samp = F.when(F.col("n") > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (F.col("n") - 1)))
    return sums.select("segment", "feature", "n", mean.alias("mean"), pop.alias("std_pop"), samp.alias("std_samp"))


def zero_variance(stats: DataFrame) -> DataFrame:
    """Features that don't differ between the customers of a segment."""
    return stats.filter((F.col("n") > 1) & (F.coalesce("std_samp", F.lit(0.0)) < 1e-12)).select("segment", "feature")


def varying(stats: DataFrame) -> DataFrame:
    return stats.filter((F.col("n") <= 1) | (F.coalesce("std_samp", F.lit(0.0)) >= 1e-12))


def scaled_features(matrix: DataFrame) -> DataFrame:
    """(value - mean) / population deviation of the features that vary; rows of absent features aren't stored."""
    kept = varying(feature_stats(matrix))
    z = (F.col("value") - F.col("mean")) / F.coalesce(F.nullif("std_pop", F.lit(0.0)), F.lit(1.0))
    return matrix.join(kept, ["segment", "feature"]).select("segment", "customer_id", "feature", z.alias("value"))


def by_customer(matrix: DataFrame) -> DataFrame:
    """segment, customer_id, has: a map of the features that the customer has."""
    return matrix.groupBy("segment", "customer_id").agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("has"))


def customer_features(basket: DataFrame, config: EngineConfig) -> DataFrame:
    """by_customer(feature_matrix(basket, config)) with one exchange: a customer's rows meet once, whatever the groups.

    Rows that line_features() has made already stay as they are.
    """
    if "has" in basket.columns:
        return basket
    if unknown := set(config.feature_groups) - {"rfm", *PROPORTIONS}:
        raise ValueError(f"no feature group {sorted(unknown)[0]}")
    shares = [PROPORTIONS[name] for name in PROPORTIONS if name in config.feature_groups]
    scores = RFM if "rfm" in config.feature_groups and set(RFM) <= set(basket.columns) else ()
    if not shares:
        return by_customer(feature_matrix(basket, config))
    rows = basket.select("segment", "customer_id", *[c for c, _ in shares], "total_quantity", *scores).repartition("segment", "customer_id")
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.concat(F.lit(prefix), c).alias("feature")) for i, (c, prefix) in enumerate(shares)])
    long = rows.select("segment", "customer_id", "total_quantity", *scores, F.explode(each).alias("e"))
    sums = long.groupBy("segment", "customer_id", "e").agg(F.sum("total_quantity").alias("x"), *[F.max(c).alias(c) for c in scores])
    one = sums.groupBy("segment", "customer_id").agg(F.collect_list(F.struct("e.i", "e.feature", "x")).alias("xs"), *[F.max(c).alias(c) for c in scores])
    total = lambda i: F.aggregate("xs", F.lit(0.0), lambda acc, e: F.when(e["i"] == i, acc + F.coalesce(e["x"], F.lit(0.0))).otherwise(acc))
    one = one.withColumn("totals", F.array(*[total(i) for i in range(len(shares))]))
    share = lambda e: F.coalesce(e["x"] / F.nullif(F.get("totals", e["i"]), F.lit(0.0)), F.lit(0.0))
    has = F.transform("xs", lambda e: F.struct(e["feature"].alias("feature"), share(e).alias("value")))
    own = [F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(c, F.lit(0.0)).alias("value")) for c in scores])] if scores else []
    return one.select("segment", "customer_id", F.map_from_entries(F.concat(has, *own)).alias("has"))


def _customers(n_shares: int):
    """Rows sorted by customer_id (day, ref, q, s, features f0, f1 ...) as a row for each customer; no customer is in two tasks."""

    def rows(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        ids = table["customer_id"].chunk(0).dictionary_encode("encode")
        code = ids.indices.to_numpy()
        begins = np.flatnonzero(np.diff(code, prepend=-1))
        owner = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(code)))
        n = len(begins)
        q, s = (table[c].fill_null(0.0).to_numpy() for c in ("q", "s"))
        total = np.bincount(owner, q, n)
        owners, names, values = [], [], []
        for i in range(n_shares):
            feature = table[f"f{i}"].chunk(0).dictionary_encode()
            wide = len(feature.dictionary)
            key, at = np.unique(owner * wide + feature.indices.to_numpy(), return_inverse=True)
            owners.append(key // wide)
            names.append(feature.dictionary.take(pa.array(key % wide)))
            x, of = np.bincount(at, q, len(key)), total[owners[-1]]
            values.append(np.divide(x, of, out=np.zeros(len(x)), where=of != 0))
        own = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(own, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))]).astype(np.int32)
        keys = pa.concat_arrays(names).take(pa.array(order)) if names else pa.array([], pa.string())
        has = pa.MapArray.from_arrays(pa.array(ends), keys, pa.array(np.concatenate(values)[order] if values else np.empty(0)))
        day = table["day"].to_numpy()
        days, at = np.unique(day, return_inverse=True)
        frequency = np.bincount(np.unique(owner * len(days) + at) // len(days), minlength=n)
        none = np.bincount(owner, table["s"].is_valid().to_numpy(), n) == 0
        return pa.RecordBatch.from_arrays(
            [ids.dictionary.take(pa.array(code[begins])), has, *[pa.array(np.maximum.reduceat(x, begins)) for x in (day, table["ref"].to_numpy())], pa.array(frequency), pa.array(np.bincount(owner, s, n), mask=none)],
            names=[c.split()[0] for c in _CUSTOMERS.split(", ")],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = 0
        for batch in batches:
            held.append(batch)
            number += len(batch)
            ids = batch["customer_id"]
            if number >= BUFFER and len(batch) and ids[0].as_py() != ids[-1].as_py():
                cut = int(np.flatnonzero(np.diff(ids.dictionary_encode("encode").indices.to_numpy()))[-1]) + 1  # the last customer may go on
                yield rows(pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]))
                held, number = [batch.slice(cut)], len(batch) - cut
        if number:
            yield rows(pa.Table.from_batches(held))

    return run


def line_features(lines: DataFrame, customers: DataFrame, config: EngineConfig) -> DataFrame:
    """customer_features() of the market basket of these product_lines(), without making the basket.

    Lines are summed by day and product attributes before a customer's rows meet, so those are no more than its days and
    the catalogue make; customers are joined last, to a row each.
    """
    if unknown := set(config.feature_groups) - {"rfm", *PROPORTIONS}:
        raise ValueError(f"no feature group {sorted(unknown)[0]}")
    shares = [PROPORTIONS[name] for name in PROPORTIONS if name in config.feature_groups]
    daily = lines.groupBy("customer_id", "invoice_date", *[c for c, _ in shares]).agg(F.sum("quantity").cast("double").alias("q"), F.sum("line_spend").cast("double").alias("s"), F.max("ref_date").alias("ref"))
    daily = daily.select("customer_id", F.unix_micros(F.col("invoice_date").cast("timestamp")).alias("day"), F.unix_micros(F.col("ref").cast("timestamp")).alias("ref"), "q", "s", *[F.concat(F.lit(prefix), c).alias(f"f{i}") for i, (c, prefix) in enumerate(shares)])
    one = daily.repartition("customer_id").sortWithinPartitions("customer_id").mapInArrow(_customers(len(shares)), _CUSTOMERS)
    one = one.withColumn("rfm_recency", days_between(F.timestamp_micros("ref"), F.timestamp_micros("last")))
    # A customer listed several times has its lines once for each time, and is in all of its segments.
    who = customers.select("customer_id", segment().alias("segment")).groupBy("customer_id").agg(F.collect_set("segment").alias("segments"), F.count("*").alias("times"))
    segments = F.coalesce("segments", F.array(segment(F.lit(None), F.lit(None))))
    rows = one.join(who, "customer_id", "left").select(F.explode(segments).alias("segment"), "customer_id", "has", "rfm_recency", "rfm_frequency", (F.col("spend") * F.coalesce("times", F.lit(1))).alias("rfm_monetary"))
    rows = stage(rows, "line-features")
    if "rfm" in config.feature_groups:
        scores = [x for c in RFM for x in (F.lit(c), F.when(F.col("customer_id").isNotNull(), F.col(c)).otherwise(0.0))]
        rows = rfm_scores(rows).withColumn("has", F.map_concat("has", F.create_map(*scores)))
    return rows.select("segment", "customer_id", "has")


def entries(rows: DataFrame) -> DataFrame:
    """The matrix of by_customer() again."""
    return rows.select("segment", "customer_id", F.explode("has").alias("feature", "value"))


def dense(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """segment, customer_id, features (sorted names of the segment), values: dense raw vectors, one row a customer.

    rows are of by_customer(), kept the statistics of the features that vary; a segment in which none does has empty vectors.
    """
    names = kept.groupBy("segment").agg(F.array_sort(F.collect_list("feature")).alias("features"), F.map_from_entries(F.collect_list(F.struct("feature", "mean"))).alias("means"), F.map_from_entries(F.collect_list(F.struct("feature", "std_pop"))).alias("stds"))
    rows = rows.join(names, "segment", "left").withColumn("features", F.coalesce("features", F.array().cast("array<string>")))
    values = F.transform("features", lambda f: F.coalesce(F.try_element_at("has", f), F.lit(0.0)))
    pick = lambda m: F.transform("features", lambda f: F.element_at(m, f))
    return rows.select("segment", "customer_id", "features", values.alias("values"), pick("means").alias("means"), pick("stds").alias("stds"))


def vectors(matrix: DataFrame) -> DataFrame:
    """The dense vectors of a matrix in long form."""
    return dense(by_customer(matrix), varying(feature_stats(matrix)))
