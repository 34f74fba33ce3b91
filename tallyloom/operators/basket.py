"""Customer by product basket with recency, frequency, spend and price band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.scalars import category, days_between, segment
from ..sources.files import stage

ATTRIBUTES = ("brand", "l2_category", "l3_category", "functionality")


def reference_date(invoices: DataFrame) -> DataFrame:
    """One row: the last invoice date of all rows; never the wall clock."""
    return invoices.agg(F.max("invoice_date").alias("ref_date"))


def recency_scope(invoices: DataFrame, config: EngineConfig, ref: DataFrame | None = None) -> DataFrame:
    """Rows of the last recency_cutoff_days, with ref_date.

    ref is reference_date(invoices) where that is known already: then the rows are filtered before what joins them.
    """
    if ref is not None:
        recent = invoices.filter(F.col("invoice_date") >= ref.scalar() - F.make_dt_interval(F.lit(config.recency_cutoff_days)))
        return recent.withColumn("ref_date", ref.scalar())
    ref = reference_date(invoices)
    dated = invoices.crossJoin(F.broadcast(ref))  # one row
    return dated.filter(F.col("invoice_date") >= F.col("ref_date") - F.make_dt_interval(F.lit(config.recency_cutoff_days)))


def product_lines(scoped: DataFrame, products: DataFrame, config: EngineConfig) -> DataFrame:
    """Invoice rows with product attributes and spend; unmatched ones are Unknown."""
    price = F.coalesce("unit_price", "product_price") if "product_price" in products.columns else F.col("unit_price")
    rows = scoped.join(products.drop("product_name"), "product_id", "left").withColumns({c: category(c) for c in ATTRIBUTES})
    rows = rows.withColumn("price", F.coalesce(price, F.lit(0.0)) if config.has_price else F.lit(0.0))
    return rows.withColumn("line_spend", F.col("quantity") * F.col("price"))


def enriched_lines(scoped: DataFrame, products: DataFrame, customers: DataFrame, config: EngineConfig) -> DataFrame:
    """The same with customer attributes and segment."""
    rows = product_lines(scoped, products, config).join(customers.select("customer_id", "region", "end_use"), "customer_id", "left")
    return rows.withColumns({c: category(c) for c in ("region", "end_use")}).withColumn("segment", segment())


def unmatched(scoped: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """One row: rows, and those without a product or customer."""
    p = products.select("product_id", F.lit(1).alias("_p")).distinct()
    c = customers.select("customer_id", F.lit(1).alias("_c")).distinct()
    return scoped.join(p, "product_id", "left").join(c, "customer_id", "left").agg(F.count("*").alias("n_rows"), F.count_if(F.col("_p").isNull()).alias("no_product"), F.count_if(F.col("_c").isNull()).alias("no_customer"))


def with_min_orders(lines: DataFrame, config: EngineConfig) -> DataFrame:
    """Rows of customers with min_order_count distinct invoice dates or more."""
    if config.min_order_count <= 1:
        return lines
    enough = lines.groupBy("customer_id").agg(F.count_distinct("invoice_date").alias("n")).filter(F.col("n") >= config.min_order_count)
    return lines.join(enough.select("customer_id"), "customer_id", "left_semi")


def basket_core(lines: DataFrame) -> DataFrame:
    """Customer by product: purchase_frequency (distinct dates), total_quantity, total_spend, recency_days."""
    keys = ["customer_id", "segment", "region", "end_use", "product_id", *ATTRIBUTES, "in_stock"]
    lines = lines.withColumn("in_stock", F.coalesce("in_stock", F.lit(False)))
    # Dates are reduced to distinct ones first, so the second aggregation needs no shuffle of its own and stays partial.
    daily = lines.groupBy(*keys, "invoice_date").agg(F.sum("quantity").alias("q"), F.sum("line_spend").alias("s"), F.max("ref_date").alias("ref_date"))
    out = daily.groupBy(*keys).agg(F.count("*").alias("purchase_frequency"), F.sum("q").alias("total_quantity"), F.sum("s").alias("total_spend"), F.max("invoice_date").alias("last"), F.max("ref_date").alias("ref_date"))
    return out.withColumn("recency_days", days_between(F.col("ref_date"), F.col("last"))).drop("last", "ref_date")


def rfm(lines: DataFrame) -> DataFrame:
    """Per customer: days since the last date, distinct dates, spend."""
    daily = lines.groupBy("customer_id", "invoice_date").agg(F.sum("line_spend").alias("s"), F.max("ref_date").alias("ref_date"))
    out = daily.groupBy("customer_id").agg(F.max("invoice_date").alias("last"), F.max("ref_date").alias("ref"), F.count("*").alias("rfm_frequency"), F.sum("s").alias("rfm_monetary"))
    return out.select("customer_id", days_between(F.col("ref"), F.col("last")).alias("rfm_recency"), "rfm_frequency", "rfm_monetary")


def min_max(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Each column scaled to 0..1 over all rows under a new name, 0.5 where it is constant; a minus sign before a name turns it around.

    The bounds come from one row, not from a window over everything.
    """
    names = {c.lstrip("-") for c in columns}
    bounds = df.agg(*[f(c).alias(f"_{k}_{c}") for c in sorted(names) for k, f in (("lo", F.min), ("hi", F.max))])
    out = df.crossJoin(F.broadcast(bounds))
    for c, to in columns.items():
        name = c.lstrip("-")
        x, lo, hi = F.col(name).cast("double"), F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        part = (hi - x if c.startswith("-") else x - lo) / F.nullif(hi - lo, F.lit(0.0))
        out = out.withColumn(to, F.coalesce(part, F.lit(0.5)))
    return out.drop(*[f"_{k}_{c}" for c in names for k in ("lo", "hi")])


def rfm_scores(scores: DataFrame) -> DataFrame:
    return min_max(scores, {"-rfm_recency": "rfm_recency_score", "rfm_frequency": "rfm_frequency_score", "rfm_monetary": "rfm_monetary_score"})


BUCKETS = 4096  #: ranges of values that a group is cut into to find its thirds


def thirds(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A row a group: its thirds q1 and q2 over rows, linear between neighbours, lo, hi and the number n of distinct values.

    Exact, and no task holds a group: a histogram tells which of its ranges have the ranks wanted, and only the values of
    those are put in order.
    """
    values = rows.groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    groups = values.groupBy(*keys).agg(F.sum("c").alias("rows"), F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    placed = values.join(groups, keys).withColumn("bucket", F.coalesce(F.least(F.floor((F.col("v") - F.col("lo")) / width * BUCKETS), F.lit(BUCKETS - 1)), F.lit(0)).cast("int"))
    along = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # BUCKETS rows a group at most
    counts = placed.groupBy(*keys, "bucket", "rows").agg(F.sum("c").alias("c")).withColumn("before", F.coalesce(F.sum("c").over(along), F.lit(0)))
    place = lambda third: (F.col("rows") - 1) * third / F.lit(3)
    ranks = F.array(*[F.struct(F.lit(f"{side}{third}").alias("name"), f(place(third)).cast("long").alias("rank")) for third in (1, 2) for side, f in (("below", F.floor), ("above", F.ceil))])
    wanted = counts.select(*keys, "bucket", "before", "c", F.explode(ranks).alias("r")).filter((F.col("r.rank") >= F.col("before")) & (F.col("r.rank") < F.col("before") + F.col("c")))
    inside = Window.partitionBy(*keys, "bucket", "name").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    found = placed.select(*keys, "bucket", "v", F.col("c").alias("cv")).join(wanted.select(*keys, "bucket", "before", "r.name", "r.rank"), [*keys, "bucket"])
    found = found.withColumn("at", F.col("before") + F.coalesce(F.sum("cv").over(inside), F.lit(0))).filter((F.col("rank") >= F.col("at")) & (F.col("rank") < F.col("at") + F.col("cv")))
    pick = lambda name: F.max(F.when(F.col("name") == name, F.col("v"))).alias(name)
    known = groups.join(found.groupBy(*keys).agg(*[pick(f"{side}{third}") for third in (1, 2) for side in ("below", "above")]), keys)

    def quantile(third: int) -> Column:
        low, high = F.col(f"below{third}"), F.col(f"above{third}")
        return low + (high - low) * (place(third) - F.floor(place(third)))

    return known.select(*keys, quantile(1).alias("q1"), quantile(2).alias("q2"), "lo", "hi", "n")


def price_bands(lines: DataFrame) -> DataFrame:
    """Per customer, product, region and end use: mean price and its tertile band within region and end use.

    Edges are the linear thirds over the group's rows; bands are closed on the right; fewer than three distinct prices, or
    edges that coincide, make all of the group Mid.
    """
    prices = lines.groupBy("customer_id", "product_id", "region", "end_use").agg(F.round(F.avg("price"), 8).alias("mean_price"))
    edges = thirds(prices, ["region", "end_use"], "mean_price").withColumns({q: F.round(q, 8) for q in ("q1", "q2")})
    p = F.col("mean_price")
    flat = (F.col("n") < 3) | (F.col("lo") == F.col("q1")) | (F.col("q1") == F.col("q2")) | (F.col("q2") == F.col("hi"))
    band = F.when(flat, "Mid").when(p <= F.col("q1"), "Low").when(p <= F.col("q2"), "Mid").otherwise("High")
    return prices.join(edges, ["region", "end_use"]).select("customer_id", "product_id", "region", "end_use", "mean_price", band.alias("price_band"))


def basket_lines(invoices: DataFrame, products: DataFrame, customers: DataFrame, config: EngineConfig) -> DataFrame:
    """The invoice rows that a basket is made of, with the columns that it reads only."""
    lines = with_min_orders(enriched_lines(recency_scope(invoices, config), products, customers, config), config)
    return lines.select("customer_id", "segment", "region", "end_use", "product_id", *ATTRIBUTES, "in_stock", "invoice_date", "ref_date", "quantity", "price", "line_spend")


def build_market_basket(invoices: DataFrame, products: DataFrame, customers: DataFrame, config: EngineConfig) -> DataFrame:
    """The basket with RFM scores and price band, a row for each customer and product."""
    return market_basket(stage(basket_lines(invoices, products, customers, config), "lines"), config)


def market_basket(lines: DataFrame, config: EngineConfig) -> DataFrame:
    """The same from basket_lines, which are read several times: written, they are joined and filtered once."""
    core = basket_core(lines).join(rfm_scores(rfm(lines)), "customer_id", "left")
    if config.has_price:
        core = core.join(price_bands(lines).drop("mean_price"), ["customer_id", "product_id", "region", "end_use"], "left")
    else:
        core = core.withColumn("price_band", F.lit("Unknown"))
    return core.drop("region", "end_use")


def summary(basket: DataFrame) -> DataFrame:
    return basket.agg(F.count("*").alias("n_rows"), F.count_distinct("customer_id").alias("n_customers"), F.count_distinct("product_id").alias("n_products"), F.count_distinct("segment").alias("n_segments"), F.min("recency_days").alias("min_recency"), F.max("recency_days").alias("max_recency"))
