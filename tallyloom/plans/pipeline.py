"""A whole run: basket, clusters, rules, ranking, feedback; each stage written before the next reads it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators import basket, cluster, feedback, rank, rules, serve, validate
from ..sources import canonical, files


@dataclass(frozen=True)
class Result:
    basket: DataFrame
    clusters: DataFrame
    models: DataFrame
    rules: DataFrame
    recommendations: DataFrame
    final: DataFrame


class Engine:
    """Stages over canonical tables; stage outputs are Parquet below `workspace`, partitioned where later stages prune."""

    def __init__(self, spark: SparkSession, config: EngineConfig, workspace: str) -> None:
        self.spark, self.config, self.workspace = spark, config, workspace.rstrip("/")

    def _stage(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.workspace}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def run_files(self, feedback_path: str | None = None) -> Result:
        """The configuration's three files, and feedback if there is any."""
        c = self.config
        given = files.read_optional(self.spark, feedback_path)
        return self.run(
            canonical.customers(files.read_any(self.spark, c.input_customers)), canonical.products(files.read_any(self.spark, c.input_products)),
            canonical.invoices(files.read_any(self.spark, c.input_invoices)), None if given is None else canonical.feedback(given),
        )

    def run(self, customers: DataFrame, products: DataFrame, invoices: DataFrame, given: DataFrame | None = None, version: int = 1, created: str = "1970-01-01") -> Result:
        c = self.config
        files.require_rows(basket.recency_scope(invoices, c), "no purchases within the recency cutoff")
        lines = files.require_rows(self._stage("lines", basket.basket_lines(invoices, products, customers, c)), "no customer has orders enough")
        market = self._stage("market_basket", basket.market_basket(lines, c))
        files.require_rows(market, "the market basket is empty")
        fitted = self._stage("fitted", cluster.fit_clusters(market, c, "groups", "elbow", "euclidean"))
        clusters = self._stage("customer_clusters", files.require_rows(cluster.customer_clusters(fitted), "no customer was clustered"))
        models = self._stage("models", cluster.model_table(fitted))
        cluster.register(models, cluster.model_registry(fitted, version, c.model_approval_status, created), f"{self.workspace}/packages")
        mined = self._stage("associations", rules.mine(invoices, clusters, c))
        if not rules.impossible_rules(mined).isEmpty():
            raise ValueError("rules break an invariant")
        recs = self._stage("recommendations", rank.rank_recommendations(market, clusters, mined, c))
        final = self._stage("final", feedback.calibrate(recs, given, c))
        if given is not None:
            files.write_json(feedback.summary(given, recs, c, created), f"{self.workspace}/feedback_summary")
        return Result(market, clusters, models, mined, recs, final)

    def publish(self, result: Result) -> int:
        """Rules and final recommendations as sorted CSV; an empty list of recommendations is refused."""
        files.write_csv(result.rules.orderBy("segment", "cluster_id", F.desc("lift"), "product_a", "product_b"), f"{self.workspace}/out/associations")
        return files.publish(result.final, f"{self.workspace}/out/recommendations", "customer_id", "rank")

    def serve(self, bodies: DataFrame, result: Result) -> DataFrame:
        """Answers to requests by the stored recommendations and the newest approved models."""
        return serve.render(serve.answer(serve.parse(bodies), result.final, cluster.load_models(self.spark, f"{self.workspace}/packages")))

    def checks(self, result: Result) -> DataFrame:
        return validate.invariants(result.recommendations, result.basket, self.config)
