"""A whole run on generated data, and the streaming forms."""

import pytest
from pyspark.sql import functions as F

from tallyloom.config import EngineConfig
from tallyloom.plans.pipeline import Engine
from tallyloom.sources import canonical, files, generate
from tallyloom.streaming import sessions


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    data = {"c": generate.customers(spark, 60), "p": generate.products(spark, 40), "i": generate.invoices(spark, 1500, 60, 40)}
    for name, df in data.items():
        files.write_csv(df.withColumn("region", F.lit("North")).withColumn("end_use", F.lit("Hotel")) if name == "c" else df, f"{folder}/{name}.csv")
    config = EngineConfig(input_customers=f"{folder}/c.csv", input_products=f"{folder}/p.csv", input_invoices=f"{folder}/i.csv", n_init=2, max_k=4)
    engine = Engine(spark, config, f"{folder}/work")
    return engine, engine.run_files()


def test_run(result):
    engine, r = result
    assert r.basket.count() and r.rules.count() and r.recommendations.count()
    assert r.recommendations.groupBy("customer_id").count().filter("count > 5").isEmpty()
    assert engine.checks(r).filter("violations > 0").isEmpty()
    assert r.final.count() == r.recommendations.count()


def test_rules_are_symmetric(result):
    _, r = result
    back = r.rules.select(F.col("product_a").alias("product_b"), F.col("product_b").alias("product_a"), "cluster_id", F.col("support").alias("s2"), F.col("lift").alias("l2"))
    both = r.rules.join(back, ["cluster_id", "product_a", "product_b"])
    assert both.filter("abs(support - s2) > 1e-12 OR abs(lift - l2) > 0.0002").isEmpty()


def test_generated_data_repeats(spark):
    a, b = (generate.invoices(spark, 300).agg(F.sum(F.xxhash64(*generate.invoices(spark, 1).columns).cast("decimal(38,0)"))).first()[0] for _ in range(2))
    assert a == b
    assert canonical.products(generate.products(spark, 50)).filter("in_stock").count() > 30


def test_publish_refuses_nothing(spark, tmp_path):
    with pytest.raises(ValueError):
        files.publish(files.empty(spark, files.ASSOCIATIONS), str(tmp_path / "x"))
    assert files.publish(spark.range(3), str(tmp_path / "y"), "id") == 3
    assert files.find(spark, str(tmp_path), "part-*").count() == 3


def test_generated_customers_buy_what_their_end_use_prefers(spark):
    c, p, i = generate.customers(spark, 500), generate.products(spark, 300), generate.invoices(spark, 8000, 500, 300)
    lines = i.join(c, "customer_id").join(p.drop("unit_price"), "product_id")
    assert lines.count() == 8000
    shares = lines.groupBy("end_use", "l2_category").count().collect()
    for k, use in enumerate(generate.END_USES):
        own = {r["l2_category"]: r["count"] for r in shares if r.end_use == use}
        liked = [generate.CATEGORIES[(3 * k + generate.FAVOURITE_STEP * j) % 15] for j in range(6)]
        assert set(own) == set(liked) and max(own, key=own.get) in liked[:2]
    per = {r.customer_type: r.x for r in i.join(c, "customer_id").groupBy("customer_type").agg((F.count("*") / F.count_distinct("customer_id")).alias("x")).collect()}
    assert per["Small"] < per["Medium"] < per["Large"] < per["Enterprise"]
    kinds = {r.customer_type: r["count"] for r in c.groupBy("customer_type").count().collect()}
    assert kinds == {"Small": 200, "Medium": 150, "Large": 100, "Enterprise": 50}
    assert c.filter("customer_type = 'Small' AND credit_limit > 10000 OR customer_type = 'Enterprise' AND credit_limit < 200000").isEmpty()


def test_large_segments_are_clustered_apart(spark, monkeypatch):
    """A segment beyond the limit goes to the distributed form, with the same columns and the same clear groups."""
    from tallyloom.operators import cluster

    groups = [(f"c{g}_{k}", "big" if k < 20 else "small", f"p{g}", f"l{g}", f"b{g}", f"f{g}", 10.0 + k % 3) for g in range(3) for k in range(26)]
    basket = spark.createDataFrame(groups, "customer_id string, segment string, product_id string, l2_category string, brand string, functionality string, total_quantity double")
    config = EngineConfig(n_init=3, max_k=3, feature_groups=("l2_qty", "brand"))
    one = cluster.fit_clusters(basket, config)
    monkeypatch.setattr(cluster, "LARGE_SEGMENT", 30)
    two = cluster.fit_clusters(basket, config)
    assert two.schema == one.schema and two.count() == one.count() == 78
    parts = []
    for fitted in (one, two):
        rows = fitted.filter("segment = 'big'").collect()
        assert {r.k for r in rows} == {3} and {r.n_customers for r in rows} == {60} and all(r.silhouette > 0.9 for r in rows)
        parts.append({frozenset(r.customer_id for r in rows if r.label == k) for k in range(3)})
    assert parts[0] == parts[1]
    model = cluster.model_table(two)
    asked = two.select("segment", "customer_id", "label", F.create_map(F.concat(F.lit("l2_l"), F.substring("customer_id", 2, 1)), F.lit(1.0), F.concat(F.lit("brand_b"), F.substring("customer_id", 2, 1)), F.lit(1.0)).alias("purchase_vector"))
    assert cluster.nearest_centroid(asked.withColumnRenamed("label", "want"), model).filter("label <> want AND segment = 'big'").isEmpty()
    legacy = cluster.fit_clusters(basket, config, "raw_l2", "sqrt")
    assert legacy.filter("segment = 'big' AND k <> 4").isEmpty() and legacy.count() == 78


def test_a_run_serves_publishes_and_refuses(result, spark):
    engine, r = result
    assert engine.publish(r) == r.final.count()
    out = spark.read.csv(f"{engine.workspace}/out/recommendations", header=True)
    assert out.columns == r.final.columns and out.count() == r.final.count()
    known = r.final.first().customer_id
    bodies = spark.createDataFrame([(1, f'{{"customer_id": "{known}"}}'), (2, '{"customer_id": "new", "segment": "North_Hotel", "purchase_vector": {"rfm_recency_score": 0.5}}')], "request_no long, body string")
    got = {x.request_no: x.body for x in engine.serve(bodies, r).collect()}
    assert '"precomputed"' in got[1] and '"realtime_assignment"' in got[2]
    said = generate.feedback(r.recommendations).withColumn("feedback_id", F.monotonically_increasing_id())
    from tallyloom.operators import feedback

    assert said.select("rating").distinct().count() == 3
    assert feedback.calibrate(r.recommendations, said, engine.config).count() <= r.recommendations.count()
    files.write_json(feedback.summary(said, r.recommendations, engine.config, "2026-01-02"), f"{engine.workspace}/summary")
    import json

    (text,) = spark.read.text(f"{engine.workspace}/summary").collect()
    summary = json.loads(text.value)
    assert summary["generated_at"] == "2026-01-02T00:00:00" and summary["total_feedback_rows"] == summary["overall"]["n"] > 0
    empty = spark.createDataFrame([], "customer_id string, product_id string, quantity double, invoice_date timestamp_ntz, unit_price double")
    with pytest.raises(ValueError, match="cutoff"):
        engine.run(spark.createDataFrame([], "customer_id string, region string, end_use string"), canonical.products(generate.products(spark, 5)), empty)


def test_registry_keeps_versions(spark, tmp_path):
    from tallyloom.operators import cluster

    model = lambda x: spark.createDataFrame([("North / East_x y", 0, ["a"], [0.0], [1.0], [x])], "segment string, label int, features array<string>, mean array<double>, std array<double>, centroid array<double>")
    entry = lambda v, status, day: spark.createDataFrame([("North / East_x y", v, status, day)], "segment string, version int, status string, day string").select("segment", "version", "status", F.col("day").cast("timestamp_ntz").alias("created_at"))
    with pytest.raises(LookupError):
        cluster.register(model(0.0), entry(1, "Pending", "2024-01-01"), str(tmp_path))
        cluster.load_models(spark, str(tmp_path))
    cluster.register(model(1.0), entry(2, "Approved", "2024-01-02"), str(tmp_path))
    cluster.register(model(2.0), entry(3, "Rejected", "2024-01-03"), str(tmp_path))
    assert cluster.load_models(spark, str(tmp_path)).first().centroid == [1.0] and cluster.load_models(spark, str(tmp_path), 3).first().centroid == [2.0]
    assert (tmp_path / "models" / "version=2" / "model=North_-_East_x_y").exists()


def test_streamed_feedback(spark, tmp_path):
    """Feedback met with recommendations, and acceptance by day: the stream gives what the table gives."""
    config = EngineConfig()
    rows = spark.createDataFrame([("c1", "p1", "High", None, None, "2024-01-01 05:00:00"), ("c1", "p2", "Low", None, None, "2024-01-01 06:00:00"), ("c9", "p1", "Medium", "price_too_high", None, "2024-01-03 00:00:00"), ("c9", "p1", "High", None, None, "2024-03-01 00:00:00")], "customer_id string, product_id string, rating string, reason_code string, sentiment string, feedback_date string").withColumn("feedback_date", F.col("feedback_date").cast("timestamp_ntz"))
    recs = spark.createDataFrame([("c1", "p1", "s", 0.5), ("c9", "p1", "s", 0.2)], "customer_id string, recommended_product string, segment string, score double")
    rows.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    sessions.to_parquet(sessions.feedback_updates(stream(), recs, config), str(tmp_path / "a"), str(tmp_path / "ca")).awaitTermination(120)
    got = sorted((r.customer_id, r.weight, round(r.new_score, 6)) for r in spark.read.parquet(str(tmp_path / "a")).collect())
    assert got == [("c1", 1.3, 0.65), ("c9", 0.4, 0.08), ("c9", 1.3, 0.26)]
    sessions.to_parquet(sessions.acceptance_by_window(stream(), config), str(tmp_path / "b"), str(tmp_path / "cb")).awaitTermination(120)
    streamed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "b")).collect()}
    table = sorted(tuple(r) for r in sessions.acceptance_by_window(rows, config).collect())
    assert [x[1:] for x in table] == [(2, 0.5), (1, 0.0), (1, 1.0)] and streamed == set(table[:2])  # the last day may still get more


def test_streamed_sessions_match_the_table(spark, tmp_path):
    rows = spark.createDataFrame([(u, f"2024-01-{d:02d} 00:00:00") for u, days in ((1, (1, 8, 16)), (2, (3, 4))) for d in days], "user_id long, ts string").withColumn("ts", F.to_timestamp("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    late = spark.createDataFrame([(9, "2025-01-01 00:00:00")], "user_id long, ts string").withColumn("ts", F.to_timestamp("ts"))
    late.write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 100).parquet(str(tmp_path / "in"))
    sessions.to_parquet(sessions.event_sessions(stream, 7), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {tuple(r) for r in sessions.event_sessions(rows, 7).collect()}
    assert got == want and len(want) == 3
