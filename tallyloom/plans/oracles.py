"""The registered queries in DuckDB's SQL, written independently of the operators, over the raw order tables."""

from __future__ import annotations

from ..operators.feedback import NEGATIVE
from ..operators.validate import EXPECTED
from ..sources.star import REASONS

_NEGATIVE = ", ".join(f"'{c}'" for c in NEGATIVE)
_REASONS = ", ".join(f"'{c}'" for c in REASONS)
_EXPECTED = " ".join(f"WHEN '{k}' THEN {v}" for k, v in EXPECTED.items())


def _text(x: str, places: int) -> str:
    """A number with so many decimals, rounded half up."""
    return f"round(({x})::DECIMAL(18, 9), {places})::DECIMAL(18, {places})::VARCHAR"


#: Common table expressions in order of dependence; those a query doesn't use cost nothing.
STEPS = {
    "customers": """SELECT c_custkey::VARCHAR AS customer_id, c_custkey, c_name AS customer_name, r_name AS region, c_mktsegment AS end_use,
        CASE WHEN c_acctbal < 0 THEN 'Small' WHEN c_acctbal < 5000 THEN 'Medium' ELSE 'Large' END AS customer_type
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "parts": """SELECT p_partkey, p_brand || '/' || p_type AS product_id, p_brand AS brand, p_type AS l2_category, split_part(p_brand, '#', 2)::INT AS bn, p_retailprice FROM part""",
    "products": """SELECT product_id, brand, l2_category, l2_category || '-' || (bn % 4) AS l3_category, 'F' || (bn % 5) AS functionality, bn <> 20 AS in_stock,
        round(avg(p_retailprice), 2) AS product_price FROM parts GROUP BY ALL""",
    "invoices": """SELECT o_custkey::VARCHAR AS customer_id, product_id, l_quantity::DOUBLE AS quantity, o_orderdate::DATE AS invoice_date, l_extendedprice / nullif(l_quantity, 0) AS unit_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN parts ON l_partkey = p_partkey""",
    "ref": "SELECT max(invoice_date) AS ref_date FROM invoices",
    "scoped": "SELECT * FROM invoices, ref WHERE invoice_date >= ref_date - 730",
    "lines": """SELECT s.customer_id, s.product_id, quantity, invoice_date, ref_date, coalesce(region, 'Unknown') AS region, coalesce(end_use, 'Unknown') AS end_use,
        coalesce(region, 'Unknown') || '_' || coalesce(end_use, 'Unknown') AS segment, coalesce(brand, 'Unknown') AS brand, coalesce(l2_category, 'Unknown') AS l2_category,
        coalesce(l3_category, 'Unknown') AS l3_category, coalesce(functionality, 'Unknown') AS functionality, coalesce(in_stock, false) AS in_stock,
        coalesce(unit_price, product_price, 0) AS price, quantity * coalesce(unit_price, product_price, 0) AS line_spend
        FROM scoped s LEFT JOIN products USING (product_id) LEFT JOIN customers c ON c.customer_id = s.customer_id""",
    "slim": """SELECT customer_id, segment, region, end_use, product_id, brand, l2_category, l3_category, functionality, in_stock, count(DISTINCT invoice_date) AS purchase_frequency,
        sum(quantity) AS total_quantity, sum(line_spend) AS total_spend, any_value(ref_date) - max(invoice_date) AS recency_days FROM lines GROUP BY ALL""",
    "rfm": """SELECT customer_id, any_value(ref_date) - max(invoice_date) AS rfm_recency, count(DISTINCT invoice_date) AS rfm_frequency, sum(line_spend) AS rfm_monetary FROM lines GROUP BY 1""",
    "bounds": "SELECT min(rfm_recency) AS r0, max(rfm_recency) AS r1, min(rfm_frequency) AS f0, max(rfm_frequency) AS f1, min(rfm_monetary) AS m0, max(rfm_monetary) AS m1 FROM rfm",
    "scores": """SELECT rfm.*, CASE WHEN r1 = r0 THEN 0.5 ELSE (r1 - rfm_recency)::DOUBLE / (r1 - r0) END AS rfm_recency_score,
        CASE WHEN f1 = f0 THEN 0.5 ELSE (rfm_frequency - f0)::DOUBLE / (f1 - f0) END AS rfm_frequency_score,
        CASE WHEN m1 = m0 THEN 0.5 ELSE (rfm_monetary - m0) / (m1 - m0) END AS rfm_monetary_score FROM rfm, bounds""",
    "prices": "SELECT customer_id, product_id, region, end_use, round(avg(price), 8) AS mean_price FROM lines GROUP BY ALL",
    "edges": """SELECT region, end_use, round(quantile_cont(mean_price, 1 / 3.0::DOUBLE), 8) AS q1, round(quantile_cont(mean_price, 2 / 3.0::DOUBLE), 8) AS q2,
        min(mean_price) AS lo, max(mean_price) AS hi, count(DISTINCT mean_price) AS n FROM prices GROUP BY ALL""",
    "bands": """SELECT customer_id, product_id, region, end_use, mean_price, CASE WHEN n < 3 OR lo = q1 OR q1 = q2 OR q2 = hi THEN 'Mid'
        WHEN mean_price <= q1 THEN 'Low' WHEN mean_price <= q2 THEN 'Mid' ELSE 'High' END AS price_band FROM prices JOIN edges USING (region, end_use)""",
    "basket": """SELECT slim.* EXCLUDE (region, end_use), rfm_recency, rfm_frequency, rfm_monetary, rfm_recency_score, rfm_frequency_score, rfm_monetary_score, price_band
        FROM slim LEFT JOIN scores USING (customer_id) LEFT JOIN bands USING (customer_id, product_id, region, end_use)""",
    "gaps": "SELECT customer_id, invoice_date, invoice_date - lag(invoice_date) OVER (PARTITION BY customer_id ORDER BY invoice_date) AS gap_days FROM invoices",
    "medians": "SELECT customer_id, median(gap_days) AS m FROM gaps WHERE gap_days IS NOT NULL GROUP BY 1",
    "win": "SELECT CASE WHEN median(m) IS NULL THEN 30 ELSE greatest(7, least(90, round_even(median(m), 0)::BIGINT)) END::BIGINT AS window_days FROM medians",
    "flags": """SELECT i.*, CASE WHEN coalesce(invoice_date - lag(invoice_date) OVER w > window_days, true) THEN 1 ELSE 0 END AS fresh
        FROM invoices i, win WINDOW w AS (PARTITION BY customer_id ORDER BY invoice_date)""",
    "numbered": "SELECT *, sum(fresh) OVER (PARTITION BY customer_id ORDER BY invoice_date) AS session_no FROM flags",
    "sessions": "SELECT *, customer_id || '_' || session_no::BIGINT AS basket_id, max(invoice_date) OVER (PARTITION BY customer_id, session_no) AS basket_date FROM numbered",
    "decayed": "SELECT DISTINCT customer_id, basket_id, basket_date, exp(-0.001::DOUBLE * greatest(ref_date - basket_date, 0)) AS weight FROM sessions, ref",
    "clusters": "SELECT DISTINCT customer_id, segment || '_' || (customer_id::BIGINT % 3) AS cluster_id, segment FROM slim",
    "items": """SELECT DISTINCT c.segment, c.cluster_id, s.basket_id, s.product_id, d.weight FROM sessions s JOIN clusters c USING (customer_id) JOIN decayed d USING (basket_id)""",
    "totals": """SELECT segment, cluster_id, count(DISTINCT basket_id) AS total_baskets, ceil(greatest(count(DISTINCT basket_id) * 0.03::DOUBLE, 2::DOUBLE))::BIGINT AS min_freq FROM items GROUP BY ALL""",
    "freq": "SELECT segment, cluster_id, product_id, count(*) AS product_freq FROM items GROUP BY ALL",
    "pairs": """SELECT a.segment, a.cluster_id, a.product_id AS product_a, b.product_id AS product_b, count(*) AS pair_freq, sum(a.weight) AS weighted_pair_freq
        FROM items a JOIN items b ON a.basket_id = b.basket_id AND a.product_id <> b.product_id GROUP BY ALL""",
    "metrics": """SELECT p.segment, p.cluster_id, product_a, product_b, pair_freq, fa.product_freq, pair_freq / fa.product_freq::DOUBLE AS confidence, pair_freq / total_baskets::DOUBLE AS support,
        weighted_pair_freq / total_baskets AS weighted_support, coalesce(round((pair_freq / fa.product_freq::DOUBLE) / nullif(fb.product_freq / total_baskets::DOUBLE, 0), 4), 0) AS lift, min_freq
        FROM pairs p JOIN freq fa ON fa.cluster_id = p.cluster_id AND fa.product_id = product_a JOIN freq fb ON fb.cluster_id = p.cluster_id AND fb.product_id = product_b JOIN totals t ON t.cluster_id = p.cluster_id""",
    "rules": "SELECT * EXCLUDE (min_freq) FROM metrics WHERE product_freq >= min_freq AND lift >= 1.2::DOUBLE",
    "stocked": "SELECT DISTINCT product_id FROM slim WHERE in_stock",
    "bought": "SELECT DISTINCT customer_id, product_id FROM slim",
    "cats": "SELECT product_id, min(l2_category) AS l2_category, min(l3_category) AS l3_category FROM slim GROUP BY 1",
    "l2": "SELECT customer_id, l2_category, coalesce(sum(total_quantity) / nullif(sum(sum(total_quantity)) OVER (PARTITION BY customer_id), 0), 0) AS l2_affinity FROM slim GROUP BY 1, 2",
    "l3": """SELECT customer_id, l3_category, coalesce(sum(purchase_frequency)::DOUBLE / nullif(sum(sum(purchase_frequency)) OVER (PARTITION BY customer_id), 0), 0)::DOUBLE AS l3_share FROM slim GROUP BY 1, 2""",
    "popular": "SELECT segment, product_id, sum(purchase_frequency)::BIGINT AS popularity FROM slim GROUP BY 1, 2",
    "qty": """SELECT customer_id, product_id, greatest(1, round_even(median(total_quantity / greatest(purchase_frequency, 1)), 0)::BIGINT) AS qty FROM slim GROUP BY 1, 2""",
    "rec": "SELECT customer_id, 1 / (1 + avg(recency_days)) AS recency_score FROM slim GROUP BY 1",
    "candidates": """SELECT b.customer_id, r.* FROM bought b JOIN clusters c USING (customer_id) JOIN rules r ON r.cluster_id = c.cluster_id AND r.product_a = b.product_id
        WHERE support >= 0.01::DOUBLE AND confidence >= 0.05::DOUBLE AND product_b IN (SELECT product_id FROM stocked)
        AND NOT EXISTS (SELECT 1 FROM bought x WHERE x.customer_id = b.customer_id AND x.product_id = product_b)""",
    "scored": """SELECT c.*, l2_category, l3_category, 0.45::DOUBLE * least(greatest(confidence, 0), 1) + 0.20::DOUBLE * least(greatest(weighted_support, 0), 1)
        + 0.20::DOUBLE * least(greatest((lift - 1) / 4, 0), 1) + 0.15::DOUBLE * least(greatest(recency_score, 0), 1) + coalesce(l3_share, 0) * 0.02::DOUBLE AS score
        FROM candidates c JOIN rec USING (customer_id) JOIN cats ON cats.product_id = product_b LEFT JOIN l3 USING (customer_id, l3_category)""",
    "best": "SELECT *, row_number() OVER (PARTITION BY customer_id, product_b ORDER BY round(score, 9) DESC, product_a) AS k FROM scored",
    "assoc": f"""SELECT b.customer_id, product_b AS recommended_product, cluster_id, segment, l2_category, l3_category, product_a AS trigger_product, support, confidence, lift, score,
        coalesce(qty, 1) AS recommended_qty, product_a || ' → ' || product_b || ' (support=' || {_text('support', 3)} || ', confidence=' || {_text('confidence', 3)} || ', lift=' || {_text('lift', 2)} || ')' AS reason FROM best b LEFT JOIN qty q ON q.customer_id = b.customer_id AND q.product_id = product_a WHERE k = 1""",
}


def _fallback(have: str) -> str:
    """Fallback rows for customers with fewer than five rows in `have`, in full: all products of the segment."""
    return f"""SELECT customer_id, product_id AS recommended_product, cluster_id, segment, l2_category, l3_category, 'fallback' AS trigger_product, 0::DOUBLE AS support, 0::DOUBLE AS confidence,
        0::DOUBLE AS lift, 0.1::DOUBLE + aff AS score, 1::BIGINT AS recommended_qty, 'Category-affinity fallback: ' || l2_category || ' affinity=' || {_text('aff', 2)} AS reason FROM (
          SELECT c.customer_id, p.product_id, c.cluster_id, c.segment, k.l2_category, k.l3_category, coalesce(l2_affinity, 0) AS aff, coalesce(h.n, 0) AS have,
                 row_number() OVER (PARTITION BY c.customer_id ORDER BY round(coalesce(l2_affinity, 0), 9) DESC, popularity DESC, p.product_id) AS place
          FROM clusters c JOIN popular p ON p.segment = c.segment JOIN cats k ON k.product_id = p.product_id LEFT JOIN l2 ON l2.customer_id = c.customer_id AND l2.l2_category = k.l2_category
          LEFT JOIN (SELECT customer_id, count(*) AS n FROM {have} GROUP BY 1) h ON h.customer_id = c.customer_id
          WHERE coalesce(h.n, 0) < 5 AND p.product_id IN (SELECT product_id FROM stocked)
            AND NOT EXISTS (SELECT 1 FROM bought b WHERE b.customer_id = c.customer_id AND b.product_id = p.product_id)
            AND NOT EXISTS (SELECT 1 FROM {have} a WHERE a.customer_id = c.customer_id AND a.recommended_product = p.product_id)
        ) WHERE place <= 5 - have"""


_ORDER = "PARTITION BY customer_id ORDER BY round(score, 9) DESC, (trigger_product = 'fallback')::INT, recommended_product"
STEPS |= {
    "nothing": "SELECT * FROM assoc LIMIT 0",
    "topup": _fallback("assoc"),
    "recs": f"SELECT * FROM (SELECT *, row_number() OVER ({_ORDER}) AS rank FROM (SELECT * FROM assoc UNION ALL SELECT * FROM topup)) WHERE rank <= 5",
    "catalogue": "SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS k, count(*) OVER () AS n FROM products",
    "feedback": f"""SELECT event_id AS feedback_id, user_id::VARCHAR AS customer_id, product_id,
        CASE event_type WHEN 'purchase' THEN 'High' WHEN 'click' THEN 'Medium' WHEN 'view' THEN 'Medium' WHEN 'error' THEN 'Low' ELSE 'unknown' END AS rating,
        CASE WHEN event_type = 'view' THEN list_extract([{_REASONS}], (event_id % {len(REASONS)})::INT + 1) END AS reason_code,
        CASE WHEN event_type = 'click' THEN 'positive' END AS sentiment, ts AS feedback_date FROM events JOIN catalogue ON k = event_id % n""",
    "weighted": f"""SELECT *, CASE lower(rating) WHEN 'high' THEN 1.3::DOUBLE WHEN 'low' THEN 0.1::DOUBLE WHEN 'medium' THEN
          CASE WHEN sentiment = 'positive' THEN 1.0::DOUBLE WHEN sentiment = 'negative' THEN 0.4::DOUBLE WHEN reason_code IN ({_NEGATIVE}) THEN 0.4::DOUBLE ELSE 1.0::DOUBLE END ELSE 1.0::DOUBLE END AS weight
        FROM feedback WHERE feedback_date IS NULL OR feedback_date >= (SELECT max(feedback_date) FROM feedback) - INTERVAL 365 DAY""",
    "latest": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, product_id ORDER BY feedback_date DESC NULLS LAST, feedback_id DESC) AS k FROM weighted) WHERE k = 1",
    "reweighted": """SELECT r.* EXCLUDE (rank, score), score * coalesce(weight, 1) AS score, coalesce(weight, 1) AS feedback_weight FROM recs r
        LEFT JOIN latest l ON l.customer_id = r.customer_id AND l.product_id = r.recommended_product WHERE score * coalesce(weight, 1) >= 0.08::DOUBLE""",
    "calibrated": f"SELECT * FROM (SELECT *, row_number() OVER ({_ORDER}) AS rank FROM reweighted) WHERE rank <= 5",
    "rates": """SELECT count(*) AS n, round(avg((weight >= 1)::INT), 4) AS acceptance_rate, round(avg((lower(rating) = 'high')::INT), 4) AS high_rate, round(avg((weight = 1)::INT), 4) AS medium_positive_rate,
        round(avg((weight = 0.4::DOUBLE)::INT), 4) AS medium_negative_rate, round(avg((lower(rating) = 'low')::INT), 4) AS low_rate FROM weighted""",
    "matrix": "SELECT segment, customer_id, feature, value FROM ("
    + " UNION ALL ".join(
        f"SELECT segment, customer_id, '{prefix}' || {column} AS feature, coalesce(sum(total_quantity) / nullif(sum(sum(total_quantity)) OVER (PARTITION BY customer_id), 0), 0) AS value FROM slim GROUP BY segment, customer_id, {column}"
        for column, prefix in (("l2_category", "l2_"), ("brand", "brand_"), ("functionality", "func_"))
    )
    + " UNION ALL SELECT segment, customer_id, unnest(['rfm_recency_score', 'rfm_frequency_score', 'rfm_monetary_score']), unnest([rfm_recency_score, rfm_frequency_score, rfm_monetary_score]) FROM (SELECT DISTINCT segment, customer_id FROM slim) JOIN scores USING (customer_id))",
    "people": "SELECT DISTINCT segment, customer_id FROM slim",
    "dense": "SELECT p.segment, p.customer_id, f.feature, coalesce(m.value, 0) AS value FROM people p JOIN (SELECT DISTINCT segment, feature FROM matrix) f ON f.segment = p.segment LEFT JOIN matrix m ON m.customer_id = p.customer_id AND m.feature = f.feature",
    "f0": "SELECT * FROM slim WHERE functionality = 'F0'",
    "shares": "SELECT segment, customer_id, 'func_' || functionality AS feature, sum(total_quantity) / sum(sum(total_quantity)) OVER (PARTITION BY customer_id) AS value FROM f0 GROUP BY segment, customer_id, functionality"
    " UNION ALL SELECT segment, customer_id, 'l2_' || l2_category, sum(total_quantity) / sum(sum(total_quantity)) OVER (PARTITION BY customer_id) FROM f0 GROUP BY segment, customer_id, l2_category",
    "unvaried": """SELECT p.segment, f.feature FROM (SELECT DISTINCT segment, customer_id FROM f0) p JOIN (SELECT DISTINCT segment, feature FROM shares) f ON f.segment = p.segment
        LEFT JOIN shares s ON s.customer_id = p.customer_id AND s.feature = f.feature GROUP BY ALL HAVING count(*) > 1 AND stddev_samp(coalesce(value, 0)) < 1e-12""",
    "stats": "SELECT segment, feature, avg(value) AS mean, stddev_pop(value) AS std, count(*) AS n FROM dense GROUP BY ALL",
    "zed": "SELECT d.segment, d.customer_id, d.feature, (value - mean) / CASE WHEN std = 0 THEN 1 ELSE std END AS z FROM dense d JOIN stats s ON s.segment = d.segment AND s.feature = d.feature WHERE n <= 1 OR std > 1e-12",
    "centre": "SELECT z.segment, customer_id::BIGINT % 3 AS label, feature, avg(z) AS c FROM zed z GROUP BY ALL",
    "distance": "SELECT z.segment, z.customer_id, label, round(sum((z - c) * (z - c)), 9) AS d FROM zed z JOIN centre c ON c.segment = z.segment AND c.feature = z.feature GROUP BY ALL",
    "enriched": """SELECT r.*, p.brand AS recommended_brand, p.l2_category AS recommended_category, p.product_price, t.brand AS trigger_brand, t.l2_category AS trigger_category, c.customer_name, c.region, c.end_use, c.customer_type,
        round_even(confidence * 100, 0)::INT || '%' AS confidence_text FROM recs r LEFT JOIN products p ON p.product_id = recommended_product LEFT JOIN products t ON t.product_id = trigger_product
        LEFT JOIN customers c ON c.customer_id = r.customer_id""",
    "assigned": "SELECT segment, customer_id, arg_min(label, (d, label)) AS label FROM distance GROUP BY ALL",
    "picked": "SELECT DISTINCT customer_id FROM recs ORDER BY md5('42:' || customer_id), customer_id LIMIT 10",
    "totals_l2": """SELECT * FROM (SELECT customer_id, l2_category, sum(total_quantity) AS total_quantity, sum(purchase_frequency)::BIGINT AS purchase_frequency,
        row_number() OVER (PARTITION BY customer_id ORDER BY sum(total_quantity) DESC, l2_category) AS place FROM slim GROUP BY 1, 2) WHERE place <= 5""",
    "best_bought": """SELECT * FROM (SELECT customer_id, product_id, l2_category, l3_category, total_quantity, row_number() OVER (PARTITION BY customer_id ORDER BY total_quantity DESC, product_id) AS place FROM slim) WHERE place <= 5""",
    "profiles": """SELECT customer_id, min(customer_name) AS customer_name, min(region) AS region, min(end_use) AS end_use, min(customer_type) AS customer_type, min(segment) AS segment, min(cluster_id) AS cluster_id,
        count(*) AS n_recommendations FROM enriched GROUP BY 1""",
    "matches": f"""SELECT customer_id, end_use, array_to_string(got, ',') AS recommended, array_to_string(list_filter(got, lambda x: list_contains(want, x)), ',') AS matched,
        len(list_filter(got, lambda x: list_contains(want, x))) > 0 AS categories_match FROM (
          SELECT customer_id, end_use, list_sort(list(DISTINCT recommended_category)) AS got, CASE end_use {_EXPECTED} ELSE [] END AS want FROM enriched GROUP BY 1, 2)""",
    "report": """SELECT customer_id, customer_name AS customer, region AS location, end_use AS business_type, rank, recommended_product, recommended_brand AS brand, recommended_category AS category,
        '$' || printf('%.2f', product_price) AS price, recommended_qty AS suggested_qty, confidence_text AS confidence, reason AS why FROM enriched""",
    "asked": """SELECT c.customer_id, c_custkey % 7 AS kind, 0 AS item_no, segment FROM customers c LEFT JOIN people p ON p.customer_id = c.customer_id
        UNION ALL SELECT customer_id, 99, 1, NULL FROM customers WHERE c_custkey % 7 IN (0, 1)""",
    "quality": """SELECT *, CASE WHEN avg_score >= 0.4::DOUBLE THEN 'High' WHEN avg_score >= 0.3::DOUBLE THEN 'Medium' ELSE 'Low' END AS quality,
        CASE WHEN avg_confidence >= 0.5::DOUBLE THEN 'High' WHEN avg_confidence >= 0.3::DOUBLE THEN 'Medium' ELSE 'Low' END AS confidence_tier
        FROM (SELECT customer_id, round(avg(score), 6) AS avg_score, round(max(score), 6) AS max_score, round(min(score), 6) AS min_score, round(avg(confidence), 6) AS avg_confidence FROM recs GROUP BY 1)""",
}
_HEAD = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in STEPS.items()) + "\n"
_RECS = "customer_id, recommended_product, cluster_id, segment, l2_category, l3_category, trigger_product, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(score, 6) AS score, recommended_qty, reason"
_SHARE = "SELECT segment, customer_id, '{prefix}' || {column} AS feature, round(coalesce(sum(total_quantity) / nullif(sum(sum(total_quantity)) OVER (PARTITION BY customer_id), 0), 0), 9) AS value FROM slim GROUP BY segment, customer_id, {column}"

FINAL = {
    "market_basket": """SELECT * REPLACE (round(total_quantity, 6) AS total_quantity, round(total_spend, 6) AS total_spend, round(rfm_monetary, 6) AS rfm_monetary, round(rfm_recency_score, 6) AS rfm_recency_score,
        round(rfm_frequency_score, 6) AS rfm_frequency_score, round(rfm_monetary_score, 6) AS rfm_monetary_score) FROM basket""",
    "basket_recency": "SELECT customer_id, product_id, purchase_frequency, recency_days FROM slim",
    "unmatched_audit": """SELECT count(*) AS n_rows, count(*) FILTER (p.product_id IS NULL) AS no_product, count(*) FILTER (c.customer_id IS NULL) AS no_customer
        FROM scoped s LEFT JOIN products p USING (product_id) LEFT JOIN customers c ON c.customer_id = s.customer_id""",
    "min_order_filter": "SELECT customer_id, count(*) AS n_rows, count(DISTINCT invoice_date) AS n_dates FROM lines GROUP BY 1 HAVING n_dates >= 4",
    "basket_summary": "SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers, count(DISTINCT product_id) AS n_products, count(DISTINCT segment) AS n_segments, min(recency_days) AS min_recency, max(recency_days) AS max_recency FROM slim",
    "rfm": "SELECT customer_id, rfm_recency, rfm_frequency, round(rfm_monetary, 6) AS rfm_monetary FROM rfm",
    "rfm_scores": "SELECT customer_id, rfm_recency, rfm_frequency, round(rfm_monetary, 6) AS rfm_monetary, round(rfm_recency_score, 6) AS rfm_recency_score, round(rfm_frequency_score, 6) AS rfm_frequency_score, round(rfm_monetary_score, 6) AS rfm_monetary_score FROM scores",
    "price_band": "SELECT * EXCLUDE (mean_price) FROM bands",
    "purchase_gaps": "SELECT customer_id, count(*) AS n_rows, sum(gap_days)::BIGINT AS sum_gap, max(gap_days) AS max_gap FROM gaps GROUP BY 1",
    "basket_window": "SELECT window_days FROM win",
    "sessions": "SELECT customer_id, basket_id, min(invoice_date) AS first_date, max(invoice_date) AS basket_date, count(*) AS n_rows, count(DISTINCT product_id) AS n_products FROM sessions GROUP BY 1, 2",
    "basket_dates": "SELECT DISTINCT customer_id, basket_id, basket_date FROM sessions",
    "session_decay": "SELECT customer_id, basket_id, basket_date, round(weight, 6) AS weight FROM decayed",
    "session_window_native": """SELECT customer_id, min(invoice_date) AS first_date, max(invoice_date) AS basket_date, count(*) AS n_rows FROM (
          SELECT *, sum(f) OVER (PARTITION BY customer_id ORDER BY invoice_date) AS s FROM (
            SELECT *, (coalesce(invoice_date - lag(invoice_date) OVER (PARTITION BY customer_id ORDER BY invoice_date) > window_days, true))::INT AS f FROM invoices, win)) GROUP BY customer_id, s""",
    "product_basket_freq": "SELECT * FROM freq",
    "cluster_totals": "SELECT segment, cluster_id, total_baskets FROM totals",
    "min_freq": "SELECT segment, cluster_id, min_freq FROM totals",
    "basket_pairs": "SELECT * REPLACE (round(weighted_pair_freq, 6) AS weighted_pair_freq) FROM pairs",
    "association_metrics": "SELECT * REPLACE (round(confidence, 6) AS confidence, round(support, 6) AS support, round(weighted_support, 6) AS weighted_support) FROM metrics",
    "association_rules": "SELECT * REPLACE (round(confidence, 6) AS confidence, round(support, 6) AS support, round(weighted_support, 6) AS weighted_support) FROM rules",
    "rule_invariants": "SELECT count(*) AS violations FROM rules WHERE confidence > 1 + 1e-9 OR support > 1 + 1e-9 OR weighted_support > support + 1e-9",
    "rule_summary": "SELECT count(*) AS n_rules, count(DISTINCT segment) AS n_segments, count(DISTINCT cluster_id) AS n_clusters, min(lift) AS min_lift, max(lift) AS max_lift, round(min(confidence), 6) AS min_confidence, round(max(confidence), 6) AS max_confidence FROM rules",
    "l2_affinity": "SELECT customer_id, l2_category, round(l2_affinity, 9) AS l2_affinity FROM l2",
    "l3_affinity": "SELECT customer_id, l3_category, round(l3_share, 9) AS l3_share FROM l3",
    "segment_popularity": "SELECT * FROM popular",
    "qty_lookup": "SELECT * FROM qty",
    "recency_score": "SELECT customer_id, round(recency_score, 6) AS recency_score FROM rec",
    "in_stock": "SELECT * FROM stocked",
    "rule_candidates": "SELECT customer_id, product_b, count(*) AS n_rules, max(lift) AS max_lift FROM candidates GROUP BY 1, 2",
    "scored_candidates": "SELECT customer_id, product_b, round(max(score), 6) AS max_score, round(min(score), 6) AS min_score FROM scored GROUP BY 1, 2",
    "assoc_recs": f"SELECT {_RECS} FROM assoc",
    "fallback_recs": f"SELECT {_RECS} FROM ({_fallback('nothing')})",
    "topup_recs": f"SELECT {_RECS} FROM topup",
    "recommendations": f"SELECT {_RECS}, rank FROM recs",
    "recommendation_summary": """SELECT count(*) AS n_recommendations, count(DISTINCT customer_id) AS n_customers, count(DISTINCT recommended_product) AS n_products,
        count(DISTINCT customer_id) FILTER (trigger_product <> 'fallback') AS via_rules, count(DISTINCT customer_id) FILTER (trigger_product = 'fallback') AS via_fallback, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score FROM recs""",
    "feedback_weights": "SELECT feedback_id, customer_id, product_id, rating, weight FROM weighted",
    "feedback_latest": "SELECT customer_id, product_id, feedback_id, weight FROM latest",
    "calibrated_recs": f"SELECT {_RECS}, rank, feedback_weight FROM calibrated",
    "feedback_overall": "SELECT * FROM rates",
    "feedback_by_segment": "SELECT segment, count(*) AS n, round(avg((weight >= 1)::INT), 4) AS acceptance_rate FROM weighted w JOIN recs r ON r.customer_id = w.customer_id AND r.recommended_product = w.product_id GROUP BY 1",
    "feedback_by_l2": "SELECT l2_category, count(*) AS n, round(avg((weight >= 1)::INT), 4) AS acceptance_rate FROM weighted w JOIN recs r ON r.customer_id = w.customer_id AND r.recommended_product = w.product_id GROUP BY 1",
    "reason_distribution": "SELECT coalesce(reason_code, 'not_provided') AS reason_code, count(*) AS n FROM weighted GROUP BY 1",
    "threshold_suggestions": """SELECT CASE WHEN a < 0.5 THEN round(least(0.2::DOUBLE, 0.05::DOUBLE + (0.5 - a) * 0.3::DOUBLE), 3) WHEN a > 0.8 THEN round(greatest(0.02::DOUBLE, 0.05::DOUBLE - (a - 0.8) * 0.1::DOUBLE), 3) ELSE 0.05::DOUBLE END AS min_confidence,
        CASE WHEN a < 0.5 THEN 0.1::DOUBLE WHEN a > 0.8 THEN 0.07::DOUBLE ELSE 0.08::DOUBLE END AS score_cutoff,
        CASE WHEN a < 0.5 THEN 'acceptance is low: stricter thresholds' WHEN a > 0.8 THEN 'acceptance is high: looser thresholds' ELSE 'acceptance is fair: no change' END AS rationale FROM (SELECT acceptance_rate AS a FROM rates)""",
    "proportions_l2": _SHARE.format(prefix="l2_", column="l2_category"),
    "proportions_brand": _SHARE.format(prefix="brand_", column="brand"),
    "proportions_func": _SHARE.format(prefix="func_", column="functionality"),
    "feature_matrix_long": "SELECT segment, customer_id, feature, round(value, 9) AS value FROM matrix",
    "zero_variance": "SELECT segment, feature FROM unvaried",
    "scaled_features": "SELECT z.segment, z.customer_id, z.feature, round(z, 9) AS value FROM zed z JOIN matrix m ON m.customer_id = z.customer_id AND m.feature = z.feature",
    "legacy_k": "SELECT segment, count(DISTINCT customer_id) AS n_customers, CASE WHEN count(DISTINCT customer_id) < 6 THEN 1 ELSE least(4, floor(sqrt(count(DISTINCT customer_id)))) END::BIGINT AS k FROM slim GROUP BY 1",
    "nearest_centroid": "SELECT * FROM assigned",
    "serve_lookup": """SELECT c.customer_id, CASE WHEN r.n > 0 THEN 'precomputed' END AS source, CASE WHEN r.n IS NULL THEN 'segment is required for a customer without recommendations' END AS error,
        r.cluster_id, coalesce(r.n, 0)::BIGINT AS n_recommendations FROM (SELECT customer_id FROM customers UNION ALL SELECT 'x' || customer_id FROM customers) c
        LEFT JOIN (SELECT customer_id, any_value(cluster_id) AS cluster_id, count(*) AS n FROM recs GROUP BY 1) r ON r.customer_id = c.customer_id""",
    "recommendation_checks": """SELECT unnest(['not_empty', 'rank_range', 'thresholds', 'at_most_top_k', 'rank_dense', 'duplicates', 'already_bought', 'segment_isolation']) AS "check", 0::BIGINT AS violations""",
    "enrich_recs": "SELECT customer_id, recommended_product, recommended_brand, recommended_category, trigger_brand, trigger_category, customer_name, region, end_use, confidence_text FROM enriched",
    "category_totals": "SELECT * FROM totals_l2",
    "category_match": "SELECT * FROM matches",
    "customer_profiles": "SELECT * FROM profiles",
    "top_products": "SELECT * FROM best_bought",
    "sample_analysis": """SELECT p.*, m.* EXCLUDE (customer_id, end_use), q.* EXCLUDE (customer_id),
        (SELECT string_agg(l2_category || ': ' || total_quantity::BIGINT || ' units (' || purchase_frequency || ' purchases)', '; ' ORDER BY place) FROM totals_l2 t WHERE t.customer_id = p.customer_id) AS bought_categories,
        (SELECT string_agg(product_id || ': ' || total_quantity::BIGINT || ' units', '; ' ORDER BY place) FROM best_bought t WHERE t.customer_id = p.customer_id) AS bought_products
        FROM profiles p JOIN picked USING (customer_id) JOIN matches m USING (customer_id) JOIN quality q USING (customer_id)""",
    "report_preview": "SELECT * EXCLUDE (customer_id) FROM report WHERE customer_id IN (SELECT customer_id FROM picked) ORDER BY customer, rank, recommended_product LIMIT 10",
    "registry_cycle": "SELECT segment, customer_id, arg_min((label + 1) % 3, (d, (label + 1) % 3)) AS label, 2::BIGINT AS version FROM distance GROUP BY ALL",
    "serve_requests": """SELECT q.customer_id AS request, item_no::BIGINT AS item_no,
        CASE WHEN kind = 0 AND r.n > 0 THEN 'precomputed' WHEN kind = 1 AND q.segment IS NOT NULL THEN 'realtime_assignment' END AS source,
        CASE WHEN kind IN (5, 6, 99) THEN 'customer_id is required' WHEN kind = 0 AND r.n > 0 OR kind = 1 AND q.segment IS NOT NULL THEN NULL
          WHEN kind IN (0, 1, 2) OR kind = 3 AND q.segment IS NULL THEN 'segment is required for a customer without recommendations'
          WHEN kind = 3 OR q.segment IS NULL THEN 'purchase_vector is required for a customer without recommendations' ELSE 'no model for segment nowhere' END AS error,
        CASE WHEN kind = 0 THEN r.cluster_id WHEN kind = 1 THEN q.segment || '_' || a.label END AS cluster_id, CASE WHEN kind = 0 THEN coalesce(r.n, 0) ELSE 0 END::BIGINT AS n_recommendations
        FROM asked q LEFT JOIN assigned a ON a.customer_id = q.customer_id
        LEFT JOIN (SELECT customer_id, any_value(cluster_id) AS cluster_id, count(*) AS n FROM recs GROUP BY 1) r ON r.customer_id = q.customer_id""",
    "customer_quality": "SELECT * FROM quality",
    "quality_distribution": "SELECT quality, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM quality), 2) AS percent FROM quality GROUP BY 1",
    "sales_report": "SELECT * EXCLUDE (customer_id) FROM report",
    "group_size_describe": """SELECT count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n) AS min, quantile_cont(n, 0.25) AS q25, quantile_cont(n, 0.5) AS q50, quantile_cont(n, 0.75) AS q75, max(n) AS max
        FROM (SELECT count(*)::DOUBLE AS n FROM slim GROUP BY customer_id)""",
    "coverage": """SELECT (SELECT count(DISTINCT customer_id) FROM slim) AS n_customers, count(DISTINCT customer_id) AS n_covered, round(avg(support) FILTER (trigger_product <> 'fallback'), 6) AS avg_support,
        round(avg(confidence) FILTER (trigger_product <> 'fallback'), 6) AS avg_confidence, round(count(DISTINCT customer_id)::DOUBLE / (SELECT count(DISTINCT customer_id) FROM slim), 6) AS coverage FROM recs""",
}

ORACLES: dict[str, str] = {name: _HEAD + sql for name, sql in FINAL.items()}
