"""Small hand-made cases for boundaries."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.config import EngineConfig
from tallyloom.operators import basket, cluster, feedback, rank, rules, serve, sessions
from tallyloom.sources import canonical, files

CONFIG = EngineConfig()
DAY = dt.datetime(2024, 1, 1)


def invoices(spark, rows):
    """rows: customer, product, day number, quantity, price."""
    data = [(c, p, DAY + dt.timedelta(days=d), float(q), float(x)) for c, p, d, q, x in rows]
    return spark.createDataFrame(data, "customer_id string, product_id string, invoice_date timestamp_ntz, quantity double, unit_price double")


def test_gap_equal_to_window_stays(spark):
    rows = invoices(spark, [("c", "p", d, 1, 1) for d in (0, 7, 14, 22)])
    out = sessions.baskets(sessions.sessionise(rows, spark.createDataFrame([(7,)], "window_days long")))
    assert sorted(r.n_rows for r in out.collect()) == [1, 3]


def test_same_day_is_one_basket_and_two_directions(spark):
    rows = invoices(spark, [("c", "a", 0, 1, 1), ("c", "b", 0, 1, 1)])
    clusters = spark.createDataFrame([("c", "s_0", "s")], "customer_id string, cluster_id string, segment string")
    pairs = rules.pair_counts(rules.basket_products(rows, clusters, CONFIG)).collect()
    assert {(r.product_a, r.product_b, r.pair_freq) for r in pairs} == {("a", "b", 1), ("b", "a", 1)}


def test_window_without_gaps(spark):
    rows = invoices(spark, [("c", "p", 0, 1, 1), ("d", "p", 5, 1, 1)])
    assert sessions.basket_window(rows, CONFIG).first().window_days == 30


@pytest.mark.parametrize(("days", "want"), [((0, 3), 7), ((0, 8, 15), 8), ((0, 8, 17), 8), ((0, 200), 90)])
def test_window_is_clamped_and_half_even(spark, days, want):
    assert sessions.basket_window(invoices(spark, [("c", "p", d, 1, 1) for d in days]), CONFIG).first().window_days == want


def test_min_max_of_a_constant(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 3.0)], "customer_id string, x double")
    assert [r.y for r in basket.min_max(df, {"x": "y"}).collect()] == [0.5, 0.5]


@pytest.mark.parametrize(("prices", "want"), [([1, 2], ["Mid"] * 2), ([1, 1, 1, 1, 1, 2, 3], ["Mid"] * 7), (list(range(1, 10)), ["Low"] * 3 + ["Mid"] * 3 + ["High"] * 3)])
def test_price_bands(spark, prices, want):
    data = [(str(i), "p", "r", "e", float(p)) for i, p in enumerate(prices)]
    lines = spark.createDataFrame(data, "customer_id string, product_id string, region string, end_use string, price double")
    got = {r.customer_id: r.price_band for r in basket.price_bands(lines).collect()}
    assert [got[str(i)] for i in range(len(prices))] == want


@pytest.mark.parametrize("buckets", [4096, 3])
def test_thirds_are_exact(spark, monkeypatch, buckets):
    """Against sorting: ties, one value, negative ones, and groups of very uneven spread."""
    monkeypatch.setattr(basket, "BUCKETS", buckets)
    rng = np.random.default_rng(0)
    groups = {"ties": rng.integers(0, 5, 101), "one": [7.0], "same": [2.0] * 9, "wide": np.exp(rng.normal(0, 6, 400)), "below": -rng.random(50), "two": [1.0, 2.0]}
    rows = spark.createDataFrame([(g, float(x)) for g, xs in groups.items() for x in xs], "g string, x double")
    got = {r.g: r for r in basket.thirds(rows, ["g"], "x").collect()}
    for g, xs in groups.items():
        xs = np.array(xs, float)
        assert np.allclose([got[g].q1, got[g].q2], np.quantile(xs, [1 / 3, 2 / 3]), rtol=1e-12) and (got[g].lo, got[g].hi, got[g].n) == (xs.min(), xs.max(), len(set(xs)))


def test_cutoff_is_inclusive(spark):
    rows = invoices(spark, [("c", "p", 0, 1, 1), ("c", "p", -730, 1, 1), ("c", "p", -731, 1, 1)])
    assert basket.recency_scope(rows, CONFIG).count() == 2


def test_bad_rows(spark):
    raw = spark.createDataFrame([("1", "c", "p", "x", "2024-01-01", "2"), ("2", "c", "p", "3", "junk", "2"), ("3", "d", "?", None, "2024-01-02", None)], "invoice_id string, customer_id string, product_id string, quantity string, invoice_date string, list_price string")
    assert canonical.invalid_dates(raw).first().invalid == 1
    inv = canonical.invoices(raw)
    assert sorted(r.quantity for r in inv.collect()) == [0.0, 0.0]
    products = canonical.products(spark.createDataFrame([("p", None, "1")], "product_id string, brand string, in_stock string"))
    customers = canonical.customers(spark.createDataFrame([("c", "North", None)], "customer_id string, region string, end_use string"))
    scoped = basket.recency_scope(inv, CONFIG)
    audit = basket.unmatched(scoped, products, customers).first()
    assert (audit.no_product, audit.no_customer) == (1, 1)
    out = {r.customer_id: r for r in basket.build_market_basket(inv, products, customers, CONFIG).collect()}
    assert out["c"].segment == "North_Unknown" and out["c"].brand == "Unknown" and out["c"].in_stock
    assert out["d"].segment == "Unknown_Unknown" and out["d"].l2_category == "Unknown"


def test_lift_boundary(spark):
    items = spark.createDataFrame([("s", "c", str(b), p, 1.0) for b in range(12) for p in (["a", "b"] if b < 6 else ["a"] if b < 10 else [])] + [("s", "c", "10", "x", 1.0), ("s", "c", "11", "x", 1.0)], "segment string, cluster_id string, basket_id string, product_id string, weight double")
    got = {(r.product_a, r.product_b): r.lift for r in rules.association_rules(items, CONFIG).collect()}
    assert got == {("a", "b"): 1.2, ("b", "a"): 1.2}  # confidence 6/10 over 6/12: exactly the least lift
    assert rules.association_rules(items, EngineConfig(min_lift=1.2001)).isEmpty()


@pytest.mark.parametrize(("total", "want"), [(50, 2), (100, 3), (500, 15)])
def test_least_frequency(spark, total, want):
    items = spark.range(total).select(F.lit("s").alias("segment"), F.lit("c").alias("cluster_id"), F.col("id").cast("string").alias("basket_id"), F.lit("p").alias("product_id"), F.lit(1.0).alias("weight"))
    assert rules.cluster_totals(items, CONFIG).first().min_freq == want


@pytest.mark.parametrize(("quantity", "want"), [(0.2, 1), (2.5, 2), (3.5, 4)])
def test_usual_quantity(spark, quantity, want):
    df = spark.createDataFrame([("c", "p", quantity, 1)], "customer_id string, product_id string, total_quantity double, purchase_frequency long")
    assert rank.quantity_lookup(df).first().qty == want


def shop(spark):
    """Three customers of a segment with ten products; c1 bought p0 only."""
    rows = [("c1", "p0")] + [("c2", f"p{i}") for i in range(1, 7)] + [("c3", f"p{i}") for i in range(10)]
    data = [(c, "s", p, f"l{int(p[1]) % 2}", f"m{int(p[1]) % 3}", p != "p9", 1, 2.0, 5) for c, p in rows]
    b = spark.createDataFrame(data, "customer_id string, segment string, product_id string, l2_category string, l3_category string, in_stock boolean, purchase_frequency long, total_quantity double, recency_days long")
    clusters = b.select("customer_id", F.lit("s_0").alias("cluster_id"), "segment").distinct()
    return b, clusters


RULE = "segment string, cluster_id string, product_a string, product_b string, pair_freq long, product_freq long, confidence double, support double, weighted_support double, lift double"


def test_fallback_and_top_up(spark):
    b, clusters = shop(spark)
    mined = spark.createDataFrame([("s", "s_0", "p0", f"p{i}", 5, 9, 0.5, 0.2, 0.2, 2.0) for i in (1, 2, 3)], RULE)
    got = rank.rank_recommendations(b, clusters, mined, CONFIG).collect()
    by = {c: sorted((r.rank, r.trigger_product == "fallback") for r in got if r.customer_id == c) for c in ("c1", "c2", "c3")}
    assert [k for k, _ in by["c1"]] == [1, 2, 3, 4, 5] and sum(f for _, f in by["c1"]) == 2
    assert [k for k, _ in by["c2"]] == [1, 2, 3] and all(f for _, f in by["c2"])  # p0, p7, p8: the pool is exhausted
    assert by["c3"] == []
    assert not any(r.recommended_product == "p9" for r in got)
    none = rank.rank_recommendations(b, clusters, mined.limit(0), CONFIG).filter("customer_id = 'c1'").collect()
    assert len(none) == 5 and all(r.trigger_product == "fallback" and r.recommended_qty == 1 for r in none)


def test_score_of_a_known_rule(spark):
    row = spark.createDataFrame([(0.667, 0.077, 8.67, 0.0)], "confidence double, weighted_support double, lift double, recency_score double")
    assert row.select(rank.rule_score(CONFIG).alias("x")).first().x == pytest.approx(0.5156, abs=0.001)


@pytest.mark.parametrize(
    ("rating", "sentiment", "reason", "want"),
    [
        (" HIGH ", None, None, 1.3), ("low", "positive", "good_fit", 0.1), ("Medium", "Positive", "not_relevant", 1.0), ("medium", " negative", "good_fit", 0.4), ("medium", None, "price_too_high", 0.4),
        ("medium", "", " Good_Fit ", 1.0), ("medium", None, "whatever", 1.0), ("medium", None, None, 1.0), ("great", None, None, 1.0), (None, "negative", None, 1.0),
    ],
)
def test_feedback_weight(spark, rating, sentiment, reason, want):
    df = spark.createDataFrame([(rating, sentiment, reason)], "rating string, sentiment string, reason_code string")
    assert df.select(feedback.weight(CONFIG).alias("w")).first().w == want


def test_feedback_dates(spark):
    t = dt.datetime(2025, 1, 1)
    data = [("c", "p", "High", None, None, None, 1), ("c", "q", "High", None, None, t - dt.timedelta(days=365), 2), ("c", "r", "Low", None, None, t - dt.timedelta(days=366), 3), ("c", "s", "Low", None, None, t - dt.timedelta(days=9), 4), ("c", "s", "High", None, None, t, 5), ("c", "p", "Low", None, None, t, 6)]
    df = spark.createDataFrame(data, "customer_id string, product_id string, rating string, reason_code string, sentiment string, feedback_date timestamp_ntz, feedback_id long")
    last = feedback.latest(feedback.weighted(feedback.recent(df, CONFIG), CONFIG)).collect()
    assert {(r.product_id, r.weight) for r in last} == {("p", 0.1), ("q", 1.3), ("s", 1.3)}


def test_optional_feedback(spark):
    assert canonical.feedback(spark.createDataFrame([("c", "High")], "customer_id string, rating string")) is None
    assert canonical.feedback(spark.createDataFrame([("c", "p", "High")], "customer_id string, recommended_product string, rating string")) is not None
    assert files.read_optional(spark, "/nowhere/at/all.csv") is None
    recs = spark.range(1)
    assert feedback.calibrate(recs, None, CONFIG) is recs


@pytest.mark.parametrize(("inertias", "want"), [([100, 95], 3), ([100, 50, 48], 4), ([100, 50, 20, 5], 5), ([100, 0, 0], 4), ([7], 2)])
def test_elbow(inertias, want):
    assert cluster.pick_elbow(inertias, 10) == want


def test_kmeans_finds_clear_groups():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.1, (20, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    label, _, inertia = cluster.kmeans(x, 3, 42, 5)
    assert len({tuple(label[i : i + 20]) for i in (0, 20, 40)}) == 3 and inertia < 5
    assert cluster.silhouette(x, label) > 0.9


@pytest.mark.parametrize(("n", "want"), [(5, 1), (6, 2), (9, 3), (16, 4), (100, 4)])
def test_older_k(spark, n, want):
    assert spark.range(1).select(cluster.sqrt_k(F.lit(n)).alias("k")).first().k == want


def test_serving(spark):
    recs = spark.createDataFrame([("c1", "p1", "s_0", 0.5, 1, "why", 2)], "customer_id string, recommended_product string, cluster_id string, score double, rank int, reason string, recommended_qty int")
    model = spark.createDataFrame([("s", k, ["a", "b"], [0.0, 0.0], [1.0, 0.0], [float(k), 0.0]) for k in (0, 1)], "segment string, label int, features array<string>, mean array<double>, std array<double>, centroid array<double>")
    asked = [{"customer_id": ""}, {"customer_id": "c1"}, {"customer_id": "x"}, {"customer_id": "x", "segment": "s"}, {"customer_id": "x", "segment": "t", "purchase_vector": {"a": 1}}, {"customer_id": "x", "segment": "s", "purchase_vector": {"a": 0.9}}]
    body = spark.createDataFrame([(1, json.dumps({"instances": asked})), (2, json.dumps(asked[1])), (3, "{junk")], "request_no long, body string")
    out = {(r.request_no, r.item_no): r for r in serve.answer(serve.parse(body), recs, model).collect()}
    assert [out[1, i].source for i in range(6)] == [None, "precomputed", None, None, None, "realtime_assignment"]
    assert [bool(out[1, i].error) for i in range(6)] == [True, False, True, True, True, False]
    assert out[1, 5].cluster_id == "s_1" and out[1, 5].recommendations is None
    assert out[2, 0].recommendations[0].recommended_product == "p1" and out[3, 0].error
    assert json.loads(serve.render(serve.answer(serve.parse(body.filter("request_no = 2")), recs, model)).first().body)["cluster_id"] == "s_0"
    with pytest.raises(ValueError):
        serve.parse(body, content_type="text/csv")


def test_registry(spark):
    rows = [(1, "Approved", DAY), (2, "Approved", DAY + dt.timedelta(1)), (3, "Rejected", DAY + dt.timedelta(2))]
    assert cluster.latest_approved(spark.createDataFrame(rows, "version int, status string, created_at timestamp_ntz")).first().version == 2


def test_config():
    c = EngineConfig.parse({"TopK": "3", "MinLift": "1.5", "FeatureGroups": "brand,rfm", "WConf": "0.9"})
    assert (c.top_k, c.min_lift, c.feature_groups) == (3, 1.5, ("brand", "rfm")) and sum(c.weights) == pytest.approx(1)
    with pytest.raises(ValueError):
        EngineConfig(top_k=0)
    with pytest.raises(KeyError):
        EngineConfig.parse({"Nonsense": "1"})


def test_registered_clusterings_run_the_whole_job(monkeypatch):
    """The reference's defaults: MaxK 8 and NInit 15; the older clustering has 10 starts."""
    from types import SimpleNamespace

    from tallyloom.plans import queries

    asked = []
    monkeypatch.setattr(cluster, "fit_clusters", lambda basket, config, *rest: asked.append((config.n_init, config.max_k, rest)))
    monkeypatch.setattr(cluster, "customer_clusters", lambda fitted: fitted)
    queries.fitted(SimpleNamespace(basket=None))
    queries.BY_NAME["legacy_clusters"](SimpleNamespace(basket=None))
    assert asked == [(15, 8, ()), (10, 8, ("raw_l2", "sqrt"))]
