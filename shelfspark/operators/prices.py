"""Price feed operators (W3, W4, F21, U1, U3, S4; B1, B2 bridges).

The shuffles here are the per-key windows of W4 and the B2 aggregation.
``with_previous_price`` windows per (store, product): callers aggregate to one
observation per key and time first (``daily_price``), which shrinks the data
before the exchange and makes the window order unique.
``with_previous_price_bucketed`` windows per (key, time bucket) for keys
that may hold a large share of all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import patterns as P


def price_change_pct(cur: Column, prev: Column) -> Column:
    """``round((cur - prev) / prev * 100, 2)`` when prev is not NULL and
    > 0, else NULL; one rounding, half away from zero."""
    return F.when(prev > 0, F.round((cur - prev) / prev * 100, 2))


def with_previous_price(prices: DataFrame, keys: list[str], order: str, price: str = "price") -> DataFrame:
    """Previous observation of the same product in the same store."""
    w = Window.partitionBy(*keys).orderBy(order)
    return prices.withColumn("prev_price", F.lag(price).over(w))


def daily_price(prices: DataFrame, keys: list[str], day: Column, at: str, price: str = "price",
                how: str = "last") -> DataFrame:
    """B2: one price per key and day.  ``last`` = the latest observation of
    the day (``max_by``), absorbing duplicate appends; ``min`` = lowest."""
    value = F.max_by(price, at) if how == "last" else F.min(price)
    return prices.groupBy(*keys, day.alias("day")).agg(value.alias(price))


_AMOUNT = r"\$\s*([0-9][0-9.]*(?:,[0-9]+)?)"


def parse_card(raw_text: Column) -> list[Column]:
    """B1 (ours): product name = first non-blank line; price = first ``$``
    amount in Argentine format (``.`` thousands, ``,`` decimals)."""
    amount = F.regexp_extract(raw_text, _AMOUNT, 1)
    number = F.regexp_replace(F.regexp_replace(amount, r"\.", ""), ",", ".")
    return [
        F.regexp_extract(raw_text, r"^\s*([^\n]*\S)", 1).alias("product_name"),
        number.try_cast("decimal(12,2)").alias("price"),
    ]


def sample_prices(spark: SparkSession, scraped_at: str | Column | None = None) -> DataFrame:
    """The reference's four literal sample rows (2 products x 2 stores);
    ``scraped_at`` (a job parameter: the run's time) adds the load time."""
    rows = spark.createDataFrame(
        P.SAMPLE_PRICES,
        "product_name string, price double, currency string, store_name string, category string, url string")
    if scraped_at is None:
        return rows
    return rows.withColumn("scraped_at", scraped_at if isinstance(scraped_at, Column) else F.lit(scraped_at).cast("timestamp"))


def union_price_feeds(feeds: list[DataFrame]) -> DataFrame:
    """One price feed from same-schema per-chain tables."""
    return reduce(lambda a, b: a.unionByName(b), feeds)


def with_previous_price_bucketed(prices: DataFrame, keys: list[str], order: str, bucket: Column,
                                 price: str = "price") -> DataFrame:
    """W4 for unaggregated prices of keys that may hold a large share of all rows.

    A plain ``lag`` window sends every row of a key to one task.  Here rows are
    windowed per ``(key, bucket)`` (``bucket``: e.g. the month of the
    observation time).  The same window pass gives each bucket's last price;
    the first row of a bucket takes the last price of the key's previous
    bucket from that one row per (key, bucket).  ``order`` must be unique
    within a key.  Same result as ``with_previous_price``.  Aggregate to one
    row per key and time first where that is wanted anyway; the plain form is
    then the cheaper one."""
    w = Window.partitionBy(*keys, "_bucket").orderBy(order)
    inner = (prices.withColumn("_bucket", bucket).withColumn("prev_price", F.lag(price).over(w))
             .withColumn("_first", F.row_number().over(w) == 1).withColumn("_final", F.lead(order).over(w).isNull()))
    last = inner.where("_final").select(*keys, "_bucket", F.col(price).alias("_last"))
    names = {k: f"_carry_{k}" for k in [*keys, "_bucket"]}  # NULL keys are keys too
    carry = last.select(*[F.col(k).alias(v) for k, v in names.items()], F.lag("_last").over(
        Window.partitionBy(*keys).orderBy("_bucket")).alias("_carry"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()])
    return (inner.join(carry, same, "left")
            .withColumn("prev_price", F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("prev_price")))
            .drop("_bucket", "_first", "_final", "_carry", *names.values()))
