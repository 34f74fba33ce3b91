"""Synthetic customers, products, invoices and feedback of any size, the same for the same seed.

Every value is a hash of the row's number, the column and the seed, so rows are made where they are needed. Customers buy
what their end use prefers, larger ones more often; months follow the season.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.feedback import NEGATIVE, POSITIVE

# Domains of the columns.
REGIONS = ("North", "South", "East", "West", "Central", "Northeast", "Northwest", "Southeast")
END_USES = ("Hospital", "School", "Office", "Hotel", "Restaurant", "Factory", "Warehouse", "Retail", "Residential", "Government", "Laboratory")
CATEGORIES = tuple(f"Category {i:02d}" for i in range(1, 16))
FIRST_DAY, DAYS = "2023-01-01", 1096
#: Share of the year's orders by month.
SEASON = (0.07, 0.07, 0.09, 0.09, 0.10, 0.09, 0.08, 0.07, 0.09, 0.10, 0.08, 0.07)
#: By customer type: share of ten customers, least and most orders, least and most credit in thousands, words of a name.
TYPES = {"Small": (4, 5, 20, 1, 10, "Corner"), "Medium": (3, 10, 30, 10, 50, "City"), "Large": (2, 20, 50, 50, 200, "Regional"), "Enterprise": (1, 50, 100, 200, 500, "National")}
CUSTOMER_TYPES = tuple(TYPES)
#: An end use prefers the categories FAVOURITE_STEP apart from three times its own number on, in falling order of weight.
FAVOURITES, FAVOURITE_STEP = (0.35, 0.25, 0.15, 0.12, 0.08, 0.05), 2
#: Least and most units of an order line, by the category's number: bulk goods, small parts, machines, the rest.
UNITS = ((5, 50), (10, 100), (1, 5), (2, 25), (2, 25))


def unit(row: Column, column: str, seed: int) -> Column:
    """A number from 0 to 1 by hash."""
    return F.pmod(F.xxhash64(row, F.lit(column), F.lit(seed)), F.lit(1 << 32)) / float(1 << 32)


def pick(values: tuple, u: Column, weights: tuple[float, ...] | None = None) -> Column:
    """One of values by a number from 0 to 1, as often as its weight says."""
    weights = weights or (1.0,) * len(values)
    total, run = sum(weights), 0.0
    out = F.lit(values[-1])
    edges = []
    for w in weights:
        run += w / total
        edges.append(run)
    for value, edge in reversed(list(zip(values, edges, strict=True))[:-1]):
        out = F.when(u < edge, F.lit(value)).otherwise(out)
    return out


def between(low: int, high: int, u: Column) -> Column:
    """A whole number from low to high by a number from 0 to 1."""
    return (low + F.floor(u * (high - low + 1))).cast("int")


def _by_type(kind: Column, make) -> Column:
    out = F.lit(None)
    for name, values in TYPES.items():
        out = F.when(kind == name, make(*values)).otherwise(out)
    return out


def customer_type(number: Column) -> Column:
    """By the last digit, as often as TYPES says."""
    out, left, digit = F.lit(CUSTOMER_TYPES[-1]), 10, F.pmod(number, F.lit(10))
    for name in reversed(CUSTOMER_TYPES):
        left -= TYPES[name][0]
        out = F.when(digit >= left, out).otherwise(F.lit(CUSTOMER_TYPES[max(0, CUSTOMER_TYPES.index(name) - 1)]))
    return out


def end_use_number(customer: Column, seed: int) -> Column:
    return between(0, len(END_USES) - 1, unit(customer, "use", seed))


def category_number(product: Column) -> Column:
    return F.pmod(product - 1, F.lit(len(CATEGORIES))).cast("int")


def base_price(product: Column, seed: int) -> Column:
    return F.round(5 + F.pow(unit(product, "price", seed), 3) * 995, 2)


def customers(spark: SparkSession, n: int = 5000, seed: int = 42) -> DataFrame:
    i = F.col("id")
    u = lambda c: unit(i, c, seed)
    kind = customer_type(i)
    use = F.get(F.array(*[F.lit(x) for x in END_USES]), end_use_number(i, seed))
    return spark.range(1, n + 1).select(
        F.format_string("C%05d", i).alias("customer_id"), F.concat_ws(" ", _by_type(kind, lambda *v: F.lit(v[5])), use, i.cast("string")).alias("customer_name"), pick(REGIONS, u("region")).alias("region"), use.alias("end_use"),
        kind.alias("customer_type"), F.format_string("City %d", between(1, 100, u("city"))).alias("city"), F.format_string("S%02d", between(1, 50, u("state"))).alias("state"),
        between(1, 25, u("years")).alias("years_as_customer"), (_by_type(kind, lambda *v: between(v[3], v[4], u("credit"))) * 1000).cast("int").alias("credit_limit"),
    )


def products(spark: SparkSession, n: int = 5463, seed: int = 42) -> DataFrame:
    i = F.col("id")
    u = lambda c: unit(i, c, seed)
    l2 = F.get(F.array(*[F.lit(c) for c in CATEGORIES]), category_number(i))
    brand = F.format_string("Brand %d", between(1, 60, u("brand")))
    l3 = F.format_string("%s - %d", l2, between(1, 6, u("l3")))
    return spark.range(1, n + 1).select(
        F.format_string("P%05d", i).alias("product_id"), F.concat_ws(" ", brand, F.lit("Model"), between(100, 999, u("model")).cast("string"), l3).alias("product_name"), brand.alias("brand"), l2.alias("l2_category"),
        l3.alias("l3_category"), F.format_string("Function %d", between(1, 12, u("function"))).alias("functionality"),
        base_price(i, seed).alias("unit_price"), pick(("each", "box", "case"), u("unit")).alias("unit_of_measure"), F.when(u("stock") < 0.95, "TRUE").otherwise("FALSE").alias("in_stock"),
    )


def invoices(spark: SparkSession, n: int = 50_000, n_customers: int = 5000, n_products: int = 5463, seed: int = 42) -> DataFrame:
    """n order lines: the customer by its type's usual number of orders, the category by its end use, the product among that category's."""
    i = F.col("id")
    u = lambda c: unit(i, c, seed)
    kind = pick(CUSTOMER_TYPES, u("type"), tuple(share * (low + high) for share, low, high, *_ in TYPES.values()))
    digit = _by_type(kind, lambda share, *_: between(0, share - 1, u("digit")))
    firsts = {name: sum(TYPES[k][0] for k in CUSTOMER_TYPES[: CUSTOMER_TYPES.index(name)]) for name in CUSTOMER_TYPES}
    for name, first in firsts.items():
        digit = F.when(kind == name, digit + first).otherwise(digit)
    number = 10 * F.floor(u("customer") * -(-(n_customers + 1) // 10)) + digit
    # The digits of the last ten may go past the end, and customer 0 doesn't exist.
    customer = F.when((number < 1) | (number > n_customers), 1 + F.pmod(F.floor(u("again") * n_customers), F.lit(n_customers))).otherwise(number).cast("long")
    rows = spark.range(1, n + 1).select("id", customer.alias("customer"))
    place = pick(tuple(range(len(FAVOURITES))), u("category"), FAVOURITES)
    rows = rows.withColumn("category", F.pmod(3 * end_use_number(F.col("customer"), seed) + FAVOURITE_STEP * place, F.lit(len(CATEGORIES))).cast("int"))
    shelf = F.floor((n_products - 1 - F.col("category")) / len(CATEGORIES)) + 1  # products of the category
    product = F.when(shelf > 0, F.floor(u("product") * shelf) * len(CATEGORIES) + F.col("category") + 1).otherwise(1 + F.floor(u("product") * n_products))
    month = pick(tuple(range(12)), u("month"), SEASON)
    day = F.date_add(F.add_months(F.lit(FIRST_DAY).cast("date"), (F.floor(u("year") * 3) * 12 + month).cast("int")), F.floor(u("day") * 28).cast("int"))
    units = F.lit(None)
    for k, (low, high) in enumerate(UNITS):
        units = F.when(F.pmod("category", F.lit(len(UNITS))) == k, between(low, high, u("quantity"))).otherwise(units)
    rows = rows.withColumns({"product": product.cast("long"), "quantity": units.cast("int"), "day": day})
    price = F.round(base_price(F.col("product"), seed) * (0.90 + 0.15 * u("discount")), 2)
    return rows.select(
        F.format_string("INV%06d", i).alias("invoice_id"), F.format_string("C%05d", "customer").alias("customer_id"), F.format_string("P%05d", "product").alias("product_id"), "quantity",
        F.col("day").alias("invoice_date"), price.alias("unit_price"), F.round(price * F.col("quantity"), 2).alias("line_total"),
    )


def feedback(recs: DataFrame, share: float = 0.3, day: str = "2025-12-31", seed: int = 42) -> DataFrame:
    """What sales people might say about a share of the recommendations: rating, reason, sentiment, date; better ones for higher scores."""
    who = F.concat_ws(":", "customer_id", "recommended_product")
    u = lambda c: unit(who, c, seed)
    luck = u("rating") + F.col("score") / 2
    rating = F.when(luck > 0.85, "High").when(luck > 0.35, "Medium").otherwise("Low")
    reason = F.when(rating == "Low", pick(NEGATIVE, u("reason"))).when(rating == "High", pick(POSITIVE, u("reason"))).when(u("said") < 0.5, pick((*NEGATIVE, *POSITIVE), u("reason")))
    sentiment = F.when(rating == "Medium", pick(("positive", "negative", None), u("sentiment")))
    return recs.filter(u("asked") < share).select(
        "customer_id", F.col("recommended_product").alias("product_id"), rating.alias("rating"), reason.alias("reason_code"), sentiment.alias("sentiment"), F.date_sub(F.lit(day).cast("date"), between(0, 400, u("date"))).cast("timestamp_ntz").alias("feedback_date"),
    )
