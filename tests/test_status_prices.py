import datetime as dt

from pyspark.sql import functions as F

from shelfspark.operators import prices, status


def test_status_class(spark):
    df = spark.createDataFrame([(s,) for s in ["success", "failed", "up_for_retry", "running", "queued", None]],
                               "s string")
    got = [r.c for r in df.select(status.status_class(F.col("s")).alias("c")).collect()]
    assert got == ["COMPLETED", "FAILED", "RETRYING", "RUNNING", "UNKNOWN", "UNKNOWN"]


def test_failed_lookup_is_an_error_and_detail_by_flow(spark):
    d = dt.date(2025, 6, 17)
    exp = spark.createDataFrame([(d, "a", 1), (d, "a", 2), (d, "b", 3)], "ds date, flow string, k int")
    obs = spark.createDataFrame([(1, "success", False), (2, "success", True)], "k int, state string, broken boolean")
    rows = status.expected_vs_observed(exp, obs, ["k"], lookup_failed="broken")
    r = status.run_status_summary(rows, "ds").first()
    assert (r.total, r.completed, r.error, r.unknown) == (3, 1, 1, 1)
    got = {(x.flow, x.status): x.tasks for x in status.run_status_detail(rows, "ds", "flow").collect()}
    assert got == {("a", "COMPLETED"): 1, ("a", "ERROR"): 1, ("b", "UNKNOWN"): 1}


def test_run_status_summary_partial(spark):
    d = dt.date(2025, 6, 17)
    exp = spark.createDataFrame([(d, "vea"), (d, "jumbo"), (d, "carrefour")], "ds date, flow string")
    obs = spark.createDataFrame([("vea", "success"), ("jumbo", "success"), ("carrefour", "failed")],
                                "flow string, state string")
    r = status.run_status_summary(status.expected_vs_observed(exp, obs, ["flow"]), "ds").first()
    assert (r.total, r.completed, r.failed, r.other, r.verdict) == (3, 2, 1, 0, "PARTIAL")
    assert round(r.success_rate, 2) == 66.67


def test_missing_observation_is_unknown(spark):
    exp = spark.createDataFrame([("a",), ("b",)], "flow string")
    obs = spark.createDataFrame([("a", "success")], "flow string, state string")
    got = {r.flow: r.status for r in status.expected_vs_observed(exp, obs, ["flow"]).collect()}
    assert got == {"a": "COMPLETED", "b": "UNKNOWN"}


def test_display_name(spark):
    df = spark.createDataFrame([("vea_dulce_de_leche_prices",), ("other",)], "dag string")
    names = status.names_table(spark, {"vea_dulce_de_leche_prices": "VEA"}, "dag", "label")
    got = {r.dag: r.label for r in status.with_display_name(df, names, "dag", "label").collect()}
    assert got == {"vea_dulce_de_leche_prices": "VEA", "other": "other"}


def test_price_change_pct(spark):
    df = spark.createDataFrame([(16.2, 15.5), (1.0, 0.0), (1.0, None), (1.0, -2.0), (1.0000499999999, 1.0), (5.0, 1e-40)],
                               "c double, p double")
    got = [r.x for r in df.select(prices.price_change_pct(F.col("c"), F.col("p")).alias("x")).collect()]
    assert got[:5] == [4.52, None, None, None, 0.0] and got[5] > 1e40


def test_inputs_of_the_price_change_hold_no_ties(spark):
    """Engines may round a tie either way: the compared queries have none."""
    import __spark_entry__ as E
    from .conftest import SF
    for name in ("price_change_pct", "daily_last_value"):
        rows = E.queries()[name](spark, SF).where("prev_price > 0")
        cents = F.abs((F.col("price") - F.col("prev_price")) / F.col("prev_price") * 10000)
        assert rows.where(F.abs(cents - F.floor(cents) - 0.5) < 1e-9).count() == 0, name


def test_previous_price_and_daily(spark):
    t = lambda d, h: dt.datetime(2025, 6, d, h)
    df = spark.createDataFrame([("A", "x", t(16, 1), 10.0), ("A", "x", t(16, 5), 11.0),
                                ("A", "x", t(17, 9), 12.0)],
                               "store string, product string, at timestamp, price double")
    daily = prices.daily_price(df, ["store", "product"], F.to_date("at"), "at")
    got = [(r.price, r.prev_price) for r in
           prices.with_previous_price(daily, ["store", "product"], "day").orderBy("day").collect()]
    assert got == [(11.0, None), (12.0, 11.0)]


def test_parse_card(spark):
    df = spark.createDataFrame([("Dulce de Leche 400g\n$ 1.234,50\n2x1",), ("Sin precio",)], "t string")
    rows = df.select(*prices.parse_card(F.col("t"))).collect()
    assert rows[0].product_name == "Dulce de Leche 400g" and float(rows[0].price) == 1234.50
    assert rows[1].price is None
    df = spark.createDataFrame([("a\n$ 1234,50",), ("a\n$ 12345",), ("a\n$ 12.345",), ("a\n$5",)], "t string")
    assert [float(r.price) for r in df.select(*prices.parse_card(F.col("t"))).collect()] == [1234.5, 12345.0, 12345.0, 5.0]


def test_sample_prices(spark):
    assert prices.sample_prices(spark).count() == 4
    assert {r.scraped_at for r in prices.sample_prices(spark, "2025-06-16 06:00:00").collect()} == {dt.datetime(2025, 6, 16, 6)}


def test_bucketed_previous_price_equals_plain_lag(spark):
    import random
    rnd = random.Random(3)
    base = dt.datetime(2025, 1, 1)
    rows = [("hot", base + dt.timedelta(hours=7 * i), float(rnd.randint(1, 99))) for i in range(600)]
    rows += [("cold", base + dt.timedelta(days=40 * i), float(i + 1)) for i in range(5)]
    df = spark.createDataFrame(rows, "product string, at timestamp, price double")
    plain = {(r.product, r.at): r.prev_price
             for r in prices.with_previous_price(df, ["product"], "at").collect()}
    buck = {(r.product, r.at): r.prev_price for r in prices.with_previous_price_bucketed(
        df, ["product"], "at", F.date_trunc("week", F.col("at"))).collect()}
    assert plain == buck and len(buck) == 605


def test_bucketed_lag_spreads_a_hot_key_over_tasks(spark):
    base = dt.datetime(2025, 1, 1)
    rows = [("hot", base + dt.timedelta(hours=5 * i), float(i % 50 + 1)) for i in range(4000)]
    rows += [(f"p{j}", base + dt.timedelta(days=i), 1.0 + i) for j in range(30) for i in range(5)]
    df = spark.createDataFrame(rows, "product string, at timestamp, price double")

    def tasks_for_hot(out):
        ids = out.where("product = 'hot'").select(F.spark_partition_id().alias("p"), "prev_price")
        return len(ids.groupBy("p").agg(F.max("prev_price")).collect())
    plain = prices.with_previous_price(df, ["product"], "at")
    buck = prices.with_previous_price_bucketed(df, ["product"], "at", F.date_trunc("month", F.col("at")))
    # at test size AQE would merge the small post-shuffle partitions back into
    # one task; at scale they are large and are not merged
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        assert tasks_for_hot(plain) == 1
        assert tasks_for_hot(buck) > 2
    finally:
        spark.conf.set(key, old)
