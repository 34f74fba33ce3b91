"""Registered queries over the order tables: one for each operator, thin wrappers all."""

from __future__ import annotations

from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators import basket as B
from ..operators import cluster as C
from ..operators import features as X
from ..operators import feedback as D
from ..operators import rank as K
from ..operators import rules as R
from ..operators import serve as V
from ..operators import sessions as S
from ..operators import validate as A
from ..sources.files import new_folder, stage
from ..sources.star import last_date, load, surrogate_clusters

CONFIG = EngineConfig()
MIN_ORDERS = EngineConfig(min_order_count=4)
LEGACY = EngineConfig(n_init=10)  #: the older clustering starts each k-means ten times
STAGED = ("read_lines", "slim", "basket", "items", "rules", "assoc", "recs", "matrix", "models")
Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """What the queries build on, made when first asked for; tables that several steps read are written once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self.c, self._made = spark, sf_dir, load(spark, sf_dir), {}

    def _get(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = stage(make(), name) if name in STAGED else make()
        return self._made[name]

    canonical = property(lambda self: self.c)
    scoped = property(lambda self: self._get("scoped", lambda: B.recency_scope(self.c.invoices, CONFIG)))
    lines = property(lambda self: self._get("lines", lambda: B.enriched_lines(self.scoped, self.c.products, self.c.customers, CONFIG)))
    read_lines = property(lambda self: self._get("read_lines", lambda: B.basket_lines(self.c.invoices, self.c.products, self.c.customers, CONFIG)))  # for what reads them several times
    basket = property(lambda self: self._get("basket", lambda: B.market_basket(self.read_lines, CONFIG)))
    recent = property(lambda self: self._get("recent", lambda: B.recency_scope(self.c.invoices, CONFIG, last_date(self.spark, self.sf_dir))))
    fitting = property(lambda self: SimpleNamespace(c=self.c, basket=self._get("fit_basket", lambda: X.line_features(B.with_min_orders(B.product_lines(self.recent, self.c.products, CONFIG), CONFIG), self.c.customers, CONFIG))))  # for k-means: features without a basket
    slim = property(lambda self: self._get("slim", lambda: B.basket_core(self.lines)))
    clusters = property(lambda self: self._get("clusters", lambda: surrogate_clusters(self.slim)))
    sessions = property(lambda self: self._get("sessions", lambda: S.sessionise(self.c.invoices, S.basket_window(self.c.invoices, CONFIG))))
    items = property(lambda self: self._get("items", lambda: R.basket_products(self.c.invoices, self.clusters, CONFIG)))
    rules = property(lambda self: self._get("rules", lambda: R.association_rules(self.items, CONFIG)))
    candidates = property(lambda self: self._get("candidates", lambda: K.rule_candidates(self.slim, self.clusters, self.rules, CONFIG)))
    scored = property(lambda self: self._get("scored", lambda: K.scored_candidates(self.candidates, self.slim, CONFIG)))
    assoc = property(lambda self: self._get("assoc", lambda: K.association_recommendations(self.scored, self.slim)))
    recs = property(lambda self: self._get("recs", lambda: K.with_fallback(self.assoc, self.slim, self.clusters, CONFIG)))
    weighted = property(lambda self: self._get("weighted", lambda: D.weighted(D.recent(self.c.feedback, CONFIG), CONFIG)))
    calibrated = property(lambda self: self._get("calibrated", lambda: D.calibrate(self.recs, self.c.feedback, CONFIG)))
    matrix = property(lambda self: self._get("matrix", lambda: X.feature_matrix(self.basket, CONFIG)))
    enriched = property(lambda self: self._get("enriched", lambda: A.enrich(self.recs, self.c.products, self.c.customers)))
    models = property(lambda self: self._get("models", lambda: centroids(self)))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Floating columns at a fixed number of places, and whole numbers as long, so engines can be compared."""
    kinds = dict(df.dtypes)
    to = {"double": lambda c: F.round(c, places), "float": lambda c: F.round(c, places), "int": lambda c: F.col(c).cast("long")}
    return df.select(*[to[kinds[c]](c).alias(c) if kinds[c] in to else F.col(c) for c in df.columns])


def plain(df: DataFrame) -> DataFrame:
    """Dates as dates: the order tables have no times of day."""
    return df.select(*[F.to_date(c).alias(c) if c in ("invoice_date", "basket_date", "first_date") else F.col(c) for c in df.columns])


def session_windows(t: Tables) -> DataFrame:
    """Sessions by Spark's own window, with a gap just short of the basket window and a day."""
    rows = t.c.invoices.select("customer_id", F.col("invoice_date").cast("timestamp").alias("ts")).crossJoin(F.broadcast(S.basket_window(t.c.invoices, CONFIG)))  # one row
    gap = F.concat(F.col("window_days").cast("string"), F.lit(" days 23 hours 59 minutes 59 seconds 999 milliseconds 999 microseconds"))
    return rows.groupBy("customer_id", F.session_window("ts", gap).alias("w")).agg(F.to_date(F.min("ts")).alias("first_date"), F.to_date(F.max("ts")).alias("basket_date"), F.count("*").alias("n_rows")).drop("w")


def unvaried(t: Tables) -> DataFrame:
    """Features without variance among the buyers of one functionality: its own share is 1 for all of them."""
    one = t.slim.filter(F.col("functionality") == "F0")
    return X.zero_variance(X.feature_stats(X.proportions(one, "functionality", "func_").unionByName(X.proportions(one, "l2_category", "l2_"))))


def centroids(t: Tables) -> DataFrame:
    """Segment models by surrogate cluster: the mean of its customers' scaled features."""
    v = X.vectors(t.matrix).join(t.clusters.select("customer_id", "cluster_id"), "customer_id")
    z = F.transform(F.arrays_zip("values", "means", "stds"), lambda x: (x["values"] - x["means"]) / F.when(x["stds"] == 0, 1.0).otherwise(x["stds"]))
    each = v.select("segment", F.substring_index("cluster_id", "_", -1).cast("int").alias("label"), "features", "means", "stds", F.posexplode(z).alias("i", "z"))
    mean = each.groupBy("segment", "label", "i").agg(F.avg("z").alias("z"), F.first("features").alias("features"), F.first("means").alias("mean"), F.first("stds").alias("std"))
    return mean.groupBy("segment", "label").agg(F.first("features").alias("features"), F.first("mean").alias("mean"), F.first("std").alias("std"), F.transform(F.array_sort(F.collect_list(F.struct("i", "z"))), lambda x: x["z"]).alias("centroid"))


def purchase_vectors(t: Tables) -> DataFrame:
    return t.matrix.groupBy("segment", "customer_id").agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("purchase_vector"))


def nearest(t: Tables) -> DataFrame:
    return C.nearest_centroid(purchase_vectors(t), t.models).select("customer_id", "segment", F.col("label").cast("long").alias("label"))


def registry_cycle(t: Tables) -> DataFrame:
    """Three versions are registered, the newest of which is rejected; customers are assigned by what is loaded again."""
    folder = new_folder(t.spark, "registry")
    segments = t.slim.groupBy("segment").agg(F.count_distinct("customer_id").alias("n_customers"))
    for version, status, created in ((1, "Approved", "2024-01-01"), (2, "Approved", "2024-02-01"), (3, "Rejected", "2024-03-01")):
        entry = segments.select("segment", "n_customers", F.lit(version).alias("version"), F.lit(status).alias("status"), F.lit(created).cast("timestamp_ntz").alias("created_at"))
        C.register(t.models.withColumn("label", (F.col("label") + version - 1) % 3), entry, folder)
    version = C.latest_approved(C.load_registry(t.spark, folder))
    out = C.nearest_centroid(purchase_vectors(t), C.load_models(t.spark, folder))
    return out.crossJoin(F.broadcast(version)).select("customer_id", "segment", "label", "version")  # one row


def serve_requests(t: Tables) -> DataFrame:
    """JSON requests of seven kinds, some in batches, answered from stored recommendations or on the spot; failures stay with their item."""
    who = t.c.customers.select("customer_id").join(purchase_vectors(t), "customer_id", "left").withColumn("kind", (F.col("customer_id").cast("long") % 7).cast("int"))
    kind, stranger = F.col("kind"), F.concat(F.lit("x"), "customer_id")
    ident = F.when(kind == 0, F.col("customer_id")).when(kind == 5, "").otherwise(stranger)
    segment = F.when(kind.isin(1, 3), F.col("segment")).when(kind == 4, "nowhere")
    vector = F.when(kind.isin(1, 2, 4), F.col("purchase_vector"))
    one = F.to_json(F.struct(ident.alias("customer_id"), segment.alias("segment"), vector.alias("purchase_vector")))
    body = F.when(kind == 6, "{junk").when(kind.isin(0, 1), F.concat(F.lit('{"instances":['), one, F.lit(',{"customer_id":" "}]}'))).otherwise(one)
    out = V.answer(V.parse(who.select(F.col("customer_id").alias("request_no"), body.alias("body"))), t.recs, t.models)
    return out.select(F.col("request_no").alias("request"), F.col("item_no").cast("long").alias("item_no"), "source", "error", "cluster_id", F.coalesce(F.size("recommendations"), F.lit(0)).cast("long").alias("n_recommendations"))


def serve_lookup(t: Tables) -> DataFrame:
    """Requests of all customers and as many strangers, who have no segment."""
    known = t.c.customers.select("customer_id")
    asked = known.union(known.select(F.concat(F.lit("x"), "customer_id")))
    items = asked.select("customer_id", F.lit(None).cast("string").alias("segment"), F.lit(None).cast("map<string,double>").alias("purchase_vector"))
    model = t.slim.select("segment", F.lit(0).alias("label"), F.array().cast("array<string>").alias("features"), *[F.array().cast("array<double>").alias(c) for c in ("mean", "std", "centroid")]).distinct()
    out = V.answer(items, t.recs, model)
    return out.select("customer_id", "source", "error", "cluster_id", F.coalesce(F.size("recommendations"), F.lit(0)).cast("long").alias("n_recommendations"))


def fitted(t: Tables) -> DataFrame:
    return C.fit_clusters(t.basket, CONFIG)


def judged(t: Tables) -> DataFrame:
    """fitted() with the silhouette of the reference, for what shows it."""
    return C.fit_clusters(t.basket, CONFIG, "groups", "elbow", "euclidean")


def fitted_rules(t: Tables) -> DataFrame:
    """Rules inside the clusters that k-means finds, not the surrogate ones."""
    return R.mine(t.c.invoices, stage(C.customer_clusters(fitted(t.fitting)), "clusters"), CONFIG)


def legacy_k(t: Tables) -> DataFrame:
    return t.slim.groupBy("segment").agg(F.count_distinct("customer_id").alias("n_customers")).withColumn("k", C.sqrt_k(F.col("n_customers")))


RECS = ["customer_id", "recommended_product", "cluster_id", "segment", "l2_category", "l3_category", "trigger_product", "support", "confidence", "lift", "score", "recommended_qty", "reason", "rank"]
BY_NAME: dict[str, Callable[[Tables], DataFrame]] = {
    "market_basket": lambda t: t.basket,
    "basket_recency": lambda t: t.slim.select("customer_id", "product_id", "purchase_frequency", "recency_days"),
    "unmatched_audit": lambda t: B.unmatched(t.scoped, t.c.products, t.c.customers),
    "min_order_filter": lambda t: B.with_min_orders(t.lines, MIN_ORDERS).groupBy("customer_id").agg(F.count("*").alias("n_rows"), F.count_distinct("invoice_date").alias("n_dates")),
    "basket_summary": lambda t: B.summary(t.slim),
    "rfm": lambda t: B.rfm(t.lines),
    "rfm_scores": lambda t: B.rfm_scores(B.rfm(t.lines)),
    "price_band": lambda t: B.price_bands(t.lines).drop("mean_price"),
    "purchase_gaps": lambda t: S.purchase_gaps(t.c.invoices).groupBy("customer_id").agg(F.count("*").alias("n_rows"), F.sum("gap_days").alias("sum_gap"), F.max("gap_days").alias("max_gap")),
    "basket_window": lambda t: S.basket_window(t.c.invoices, CONFIG),
    "sessions": lambda t: S.baskets(t.sessions),
    "basket_dates": lambda t: t.sessions.select("customer_id", "basket_id", "basket_date").distinct(),
    "session_decay": lambda t: S.with_decay(t.sessions.select("customer_id", "basket_id", "basket_date").distinct(), B.reference_date(t.c.invoices), CONFIG),
    "session_window_native": session_windows,
    "product_basket_freq": lambda t: R.product_frequency(t.items),
    "cluster_totals": lambda t: R.cluster_totals(t.items, CONFIG).drop("min_freq"),
    "min_freq": lambda t: R.cluster_totals(t.items, CONFIG).select("segment", "cluster_id", "min_freq"),
    "basket_pairs": lambda t: R.pair_counts(t.items),
    "association_metrics": lambda t: R.rule_metrics(t.items, CONFIG),
    "association_rules": lambda t: t.rules,
    "rule_invariants": lambda t: R.impossible_rules(t.rules).agg(F.count("*").alias("violations")),
    "rule_summary": lambda t: R.rule_summary(t.rules),
    "l2_affinity": lambda t: K.l2_affinity(t.slim),
    "l3_affinity": lambda t: K.l3_affinity(t.slim),
    "segment_popularity": lambda t: K.segment_popularity(t.slim),
    "qty_lookup": lambda t: K.quantity_lookup(t.slim),
    "recency_score": lambda t: K.recency_score(t.slim),
    "in_stock": lambda t: K.in_stock_products(t.slim),
    "rule_candidates": lambda t: t.candidates.groupBy("customer_id", "product_b").agg(F.count("*").alias("n_rules"), F.max("lift").alias("max_lift")),
    "scored_candidates": lambda t: t.scored.groupBy("customer_id", "product_b").agg(F.max("score").alias("max_score"), F.min("score").alias("min_score")),
    "assoc_recs": lambda t: t.assoc,
    "fallback_recs": lambda t: K.fallback_recommendations(t.slim, t.clusters, t.assoc.limit(0), CONFIG),
    "topup_recs": lambda t: K.fallback_recommendations(t.slim, t.clusters, t.assoc, CONFIG),
    "recommendations": lambda t: t.recs.select(*RECS),
    "recommendation_summary": lambda t: K.summary(t.recs),
    "feedback_weights": lambda t: t.weighted.select("feedback_id", "customer_id", "product_id", "rating", "weight"),
    "feedback_latest": lambda t: D.latest(t.weighted).select("customer_id", "product_id", "feedback_id", "weight"),
    "calibrated_recs": lambda t: t.calibrated.select(*RECS, "feedback_weight"),
    "feedback_overall": lambda t: D.overall(t.weighted, CONFIG),
    "feedback_by_segment": lambda t: D.by_group(t.weighted, t.recs, "segment", CONFIG),
    "feedback_by_l2": lambda t: D.by_group(t.weighted, t.recs, "l2_category", CONFIG),
    "reason_distribution": lambda t: D.reasons(t.weighted),
    "threshold_suggestions": lambda t: D.suggestions(D.overall(t.weighted, CONFIG), CONFIG),
    "feedback_summary": lambda t: D.summary(t.c.feedback, t.recs, CONFIG, "2024-01-01T00:00:00"),
    "proportions_l2": lambda t: X.proportions(t.slim, "l2_category", "l2_"),
    "proportions_brand": lambda t: X.proportions(t.slim, "brand", "brand_"),
    "proportions_func": lambda t: X.proportions(t.slim, "functionality", "func_"),
    "feature_matrix_long": lambda t: t.matrix,
    "zero_variance": unvaried,
    "scaled_features": lambda t: X.scaled_features(t.matrix),
    "legacy_k": legacy_k,
    "kmeans_clusters": lambda t: C.customer_clusters(fitted(t.fitting)),
    "cluster_diagnostics": lambda t: C.diagnostics(judged(t.fitting)),
    "model_registry": lambda t: C.model_registry(judged(t.fitting), 1, "Approved", "2024-01-01").drop("feature_cols"),
    "legacy_clusters": lambda t: C.customer_clusters(C.fit_clusters(t.basket, LEGACY, "raw_l2", "sqrt")),
    "fitted_rules": fitted_rules,
    "nearest_centroid": nearest,
    "registry_cycle": registry_cycle,
    "serve_requests": serve_requests,
    "serve_lookup": serve_lookup,
    "recommendation_checks": lambda t: A.invariants(t.recs, t.slim, CONFIG),
    "enrich_recs": lambda t: t.enriched.select("customer_id", "recommended_product", "recommended_brand", "recommended_category", "trigger_brand", "trigger_category", "customer_name", "region", "end_use", "confidence_text"),
    "category_totals": lambda t: A.category_totals(t.slim),
    "category_match": lambda t: A.category_match(t.enriched),
    "customer_quality": lambda t: A.customer_quality(t.recs),
    "quality_distribution": lambda t: A.quality_distribution(A.customer_quality(t.recs)),
    "customer_profiles": lambda t: A.customer_profiles(t.enriched),
    "top_products": lambda t: A.top_products(t.slim),
    "sample_analysis": lambda t: A.sample_analysis(t.enriched, t.slim),
    "sales_report": lambda t: A.sales_report(t.enriched, None),
    "report_preview": lambda t: A.preview(A.sales_report(t.enriched, 10)),
    "group_size_describe": lambda t: A.describe_group_sizes(t.slim, "customer_id"),
    "coverage": lambda t: A.coverage(t.recs, t.slim),
}


#: Shares are ratios of whole numbers, which often end in a five at the seventh place: they keep nine.
SHARES = {"proportions_l2", "proportions_brand", "proportions_func", "feature_matrix_long", "scaled_features", "l2_affinity", "l3_affinity"}


def finished(name: str, t: Tables) -> DataFrame:
    return rounded(plain(BY_NAME[name](t)), 9 if name in SHARES else 6)


def _query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finished(name, Tables(spark, sf_dir))

    run.__name__ = name
    return run


QUERIES: dict[str, Query] = {name: _query(name) for name in BY_NAME}
