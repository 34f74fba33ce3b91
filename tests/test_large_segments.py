"""Segments beyond what a task clusters: whole, by few passes, as good as the clustering in one task."""

import datetime

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyloom.config import EngineConfig
from tallyloom.operators import basket, cluster, features, large_cluster
from tallyloom.plans import queries
from tallyloom.sources import star


def shares(spark, segments, n=120, groups=4):
    """A basket in which customers of a group prefer its category, more or less."""
    rng = np.random.default_rng(1)
    rows = []
    for s in segments:
        for i in range(n):
            for j in range(groups):
                q = float(rng.integers(1, 5) + 20 * (i % groups == j))
                rows.append((f"{s}-{i}", s, f"l{j}", f"b{rng.integers(3)}", f"f{rng.integers(2)}", q))
    return spark.createDataFrame(rows, "customer_id string, segment string, l2_category string, brand string, functionality string, total_quantity double")


def scaled(spark, basket, config):
    from tallyloom.operators.features import feature_matrix, vectors

    rows = vectors(feature_matrix(basket, config)).orderBy("customer_id").collect()
    std = lambda r: np.where(np.array(r.stds) == 0, 1, r.stds)
    return {r.customer_id: (np.array(r["values"]) - r.means) / std(r) for r in rows}


def test_elbow_asks_for_no_more_than_it_needs():
    def inertias():
        yield from (100.0, 50.0, 48.0)
        raise AssertionError("a fit that nothing reads")

    assert cluster.pick_elbow(inertias(), 10) == 4
    assert cluster.pick_elbow(iter([100.0, 0.0, 0.0, 0.0]), 10) == 5


def test_the_whole_fit_of_large_segments_takes_few_jobs(spark, monkeypatch):
    """All starts and segments share their passes: jobs don't grow with either."""
    monkeypatch.setattr(cluster, "LARGE_SEGMENT", 100)
    config = EngineConfig()
    assert (config.n_init, config.max_k) == (15, 8)
    spark.sparkContext.setJobGroup("few-jobs", "")
    try:
        fitted = cluster.fit_clusters(shares(spark, ["a", "b", "c"]), config)
        assert fitted.groupBy("segment").count().filter("count = 120").count() == 3
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")) < 150
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("groups", [2, 4, 6])
def test_large_fit_is_as_good_as_the_small_one(spark, monkeypatch, groups):
    config = EngineConfig(n_init=8)
    basket = shares(spark, ["a", "b"], groups=groups).cache()
    monkeypatch.setattr(cluster, "LARGE_SEGMENT", 100)
    monkeypatch.setattr(large_cluster, "CHUNK", 50)
    fitted = cluster.fit_clusters(basket, config).collect()
    x = scaled(spark, basket, config)
    assert len(fitted) == len({r.customer_id for r in fitted}) == 240
    for name in ("a", "b"):
        rows = [r for r in fitted if r.segment == name]
        z, k = np.array([x[r.customer_id] for r in rows]), rows[0].k
        assert {r.k for r in rows} == {k} and {r.n_customers for r in rows} == {120}
        assert rows[0].inertia <= cluster.kmeans(z, k, 42, 8)[2] * 1.05
        label, c = np.array([r.label for r in rows]), {r.label: np.array(r.centroid) for r in rows}
        d = np.array([[((v - c[j]) ** 2).sum() for j in sorted(c)] for v in z])
        assert (d.argmin(1) == label).all() and rows[0].inertia == pytest.approx(d.min(1).sum())
        square = ((z[:, None] - z[None]) ** 2).sum(2)
        want = []
        for i, j in enumerate(label):
            own = (label == j).sum()
            a = square[i, label == j].sum() / max(own - 1, 1)
            b = min(square[i, label == o].mean() for o in set(label) - {j})
            want.append((b - a) / max(a, b) if own > 1 else 0.0)
        assert rows[0].silhouette == pytest.approx(np.mean(want), abs=6e-5)


def test_seeds_are_drawn_by_squared_distance():
    """Two places at distances 1 and 3 from the seed: one in ten draws is of the nearer."""
    h = np.arange(4000, dtype=np.uint64) * np.uint64(2654435761)
    z = np.array([[0.0], [1.0], [3.0]])
    hits = [large_cluster.drawn(z, h[3 * i : 3 * i + 3], np.zeros((1, 1, 1)), 42)[0, 1] for i in range(1300)]
    assert 0.0 not in hits and 0.07 < np.mean(np.array(hits) == 1.0) < 0.13


@pytest.mark.parametrize("groups", [("l2_qty", "brand", "functionality", "rfm"), ("functionality",), ("rfm", "brand")])
def test_rows_by_customer_are_those_of_the_matrix(spark, groups):
    """The form with one exchange gives what the matrix in long form gives, also for a customer without quantities."""
    basket = shares(spark, ["a"], n=9).withColumns({c: F.pmod(F.xxhash64("customer_id"), F.lit(7)) / 7 for c in features.RFM})
    basket = basket.withColumn("total_quantity", F.when(F.col("customer_id") == "a-3", 0.0).otherwise(F.col("total_quantity")))
    config = EngineConfig(feature_groups=groups)
    got = {r.customer_id: r.has for r in features.customer_features(basket, config).collect()}
    want = {r.customer_id: r.has for r in features.by_customer(features.feature_matrix(basket, config)).collect()}
    assert got == want and len(got) == 9
    with pytest.raises(ValueError):
        features.customer_features(basket, EngineConfig(feature_groups=("nothing",)))


def test_clustering_reads_what_the_basket_says(spark):
    """What is read for clustering has the features of the whole market basket."""
    tables = queries.Tables(spark, SMALL)
    rows = [{(r.segment, r.customer_id): r.has for r in features.customer_features(b, EngineConfig()).collect()} for b in (tables.basket, tables.fitting.basket)]
    assert rows[0].keys() == rows[1].keys() and len(rows[0]) > 100
    assert all(rows[0][k].keys() == rows[1][k].keys() and rows[0][k] == pytest.approx(rows[1][k], abs=1e-12) for k in rows[0])


def test_segments_without_differences_keep_their_customers(spark, monkeypatch):
    one = spark.createDataFrame([(f"c{i}", "s", "l", "b", "f", 1.0) for i in range(40)], "customer_id string, segment string, l2_category string, brand string, functionality string, total_quantity double")
    for limit in (100, 30):
        monkeypatch.setattr(cluster, "LARGE_SEGMENT", limit)
        fitted = cluster.fit_clusters(one, EngineConfig(n_init=2))
        assert fitted.count() == 40 and fitted.filter((F.col("label") != 0) | (F.col("k") != 1)).isEmpty()


def jobs_of(spark, monkeypatch, name):
    """A registered query's rows where segments of six customers and more are large, and the jobs that it took."""
    monkeypatch.setattr(cluster, "LARGE_SEGMENT", 5)
    spark.sparkContext.setJobGroup(name, "")
    try:
        tables = queries.Tables(spark, SMALL)
        rows = queries.finished(name, tables).collect()
        return rows, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)), tables
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_model_registry_of_large_segments(spark, monkeypatch):
    rows, jobs, tables = jobs_of(spark, monkeypatch, "model_registry")
    sizes = {r.segment: r.n for r in tables.slim.groupBy("segment").agg(F.count_distinct("customer_id").alias("n")).collect()}
    assert {r.segment: r.n_customers for r in rows} == sizes and sum(n > 5 for n in sizes.values()) > 3
    assert all(2 <= r.k <= 8 and r.inertia >= 0 for r in rows if r.n_customers > 5) and jobs < 300


def test_rules_in_the_clusters_of_large_segments(spark, monkeypatch):
    rows, jobs, _ = jobs_of(spark, monkeypatch, "fitted_rules")
    assert rows and len({r.cluster_id for r in rows}) > len({r.segment for r in rows}) and jobs < 300
    assert all(r.lift >= 1.2 and r.support <= r.confidence <= 1 for r in rows)


def test_registry_writes_no_lines_and_joins_recent_orders_only(spark, monkeypatch):
    """What is written before the fit is a row a customer, and orders are filtered by date before lines meet them."""
    written = []
    for module in (queries, features, cluster):
        monkeypatch.setattr(module, "stage", lambda df, name, write=module.stage: written.append((name, out := write(df, name))) or out)
    _, _, tables = jobs_of(spark, monkeypatch, "model_registry")
    assert "read_lines" not in dict(written)
    rows = max(df.count() for _, df in written)
    assert rows == tables.slim.select("segment", "customer_id").distinct().count()
    plan = tables.recent._jdf.queryExecution().optimizedPlan().toString()
    assert any("Filter" in x and "o_orderdate" in x and "scalar-subquery" in x for x in plan[plan.index("Join") :].split("\n"))


def test_last_date_is_that_of_the_invoices(spark, monkeypatch, tmp_path):
    want = basket.reference_date(star.load(spark, SMALL).invoices).first()
    assert star.last_date(spark, SMALL).first() == want
    day = lambda i: datetime.datetime(2020, 1, i)
    spark.createDataFrame([(1, day(1)), (2, day(3)), (3, day(4)), (4, day(5)), (5, None)], "o_orderkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 1), (2, 1), (3, 9), (5, 1)], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")  # part 9 isn't known, order 4 is empty
    spark.createDataFrame([(1,)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    for latest in (1, 2, 3, 1000):
        monkeypatch.setattr(star, "LATEST", latest)
        assert star.last_date(spark, str(tmp_path)).first().ref_date == day(3)


def test_features_of_lines_are_those_of_the_basket(spark):
    """Also for customers without a number, unknown ones, ones listed twice in one segment or two, and lines without quantities."""
    rng = np.random.default_rng(3)
    ids = [*(f"c{i}" for i in range(30)), None]
    day = lambda: datetime.datetime(2020, 1, int(rng.integers(1, 28)))
    invoices = spark.createDataFrame(
        [(ids[rng.integers(len(ids))], f"p{rng.integers(9)}", None if rng.integers(9) == 0 else float(rng.integers(3)), day(), float(rng.integers(1, 5))) for _ in range(400)] + [("empty", "p1", 0.0, day(), 1.0), ("none", "p1", None, day(), 1.0)],
        "customer_id string, product_id string, quantity double, invoice_date timestamp, unit_price double",
    )
    products = spark.createDataFrame([(f"p{i}", f"b{i % 3}", f"l{i % 4}", "x", f"f{i % 2}", True, 2.0) for i in range(8)], "product_id string, brand string, l2_category string, l3_category string, functionality string, in_stock boolean, product_price double")
    customers = spark.createDataFrame([*((f"c{i}", "r", f"e{i % 2}") for i in range(28)), ("c1", "r", "e1"), ("c2", "r", "other"), ("c3", None, "e"), (None, "r", "e"), ("empty", "r", "e"), ("none", "r", "e")], "customer_id string, region string, end_use string")
    for groups in (("l2_qty", "brand", "functionality", "rfm"), ("brand",), ("functionality", "rfm")):
        config = EngineConfig(feature_groups=groups)
        want = {(r.segment, r.customer_id): r.has for r in features.customer_features(basket.build_market_basket(invoices, products, customers, config), config).collect()}
        lines = basket.product_lines(basket.recency_scope(invoices, config, basket.reference_date(invoices)), products, config)
        rows = features.line_features(lines, customers, config).collect()
        got = {(r.segment, r.customer_id): r.has for r in rows}
        assert got.keys() == want.keys() and len(rows) == len(want) > 30
        assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_customers_go_on_over_batches(monkeypatch):
    """However rows are cut into batches, a customer is one row."""
    n = [1, 7, 2, 12, 3, 1]
    ids = [x for x, k in zip([None, "a", "b", "c", "d", "e"], n) for _ in range(k)]
    number = pa.array(range(len(ids)), pa.int64())
    table = pa.table({"customer_id": pa.array(ids, pa.string()), "day": pa.array([i % 3 for i in range(len(ids))], pa.int64()), "ref": number, "q": number.cast(pa.float64()), "s": number.cast(pa.float64()), "f0": pa.array([f"x{i % 2}" for i in range(len(ids))])})
    results = []
    for size, buffer in ((100, 100), (1, 1), (4, 5), (3, 2)):
        monkeypatch.setattr(features, "BUFFER", buffer)
        results.append([r | {"has": dict(r["has"])} for b in features._customers(1)(table.to_batches(max_chunksize=size)) for r in b.to_pylist()])
    assert all(r == results[0] for r in results) and [r["customer_id"] for r in results[0]] == [None, "a", "b", "c", "d", "e"]
    assert [r["rfm_frequency"] for r in results[0]] == [1, 3, 2, 3, 3, 1] and results[0][1]["spend"] == sum(range(1, 8))
    assert results[0][2]["has"] == {"x0": 8 / 17, "x1": 9 / 17}
