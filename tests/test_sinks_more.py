import datetime as dt
import os

from pyspark.sql import functions as F

from shelfspark.sinks import writers


def test_daily_archive_same_day_overwrite(spark, tmp_dir):
    root = os.path.join(tmp_dir, "arch")
    ts = dt.datetime(2025, 6, 16, 6, 0, 0, 123456)
    df = spark.createDataFrame([("a", ts, "VEA", "dl", "2025-06-16"), ("b", ts, "JUMBO", "dl", "2025-06-16")],
                               "raw_data string, at timestamp, chain string, category string, dt string")
    writers.archive_json(df, root)
    writers.archive_json(df.where("chain = 'JUMBO'").withColumn("raw_data", F.lit("b2")), root)
    back = writers.read_archive(spark, root, "raw_data string, at timestamp, chain string, category string, "
                                             "dt string")
    assert sorted((r.chain, r.raw_data, r.at) for r in back.collect()) == [("JUMBO", "b2", ts), ("VEA", "a", ts)]


def test_create_or_replace_and_views(spark):
    name = "shelfspark_test_tbl"
    writers.create_or_replace(spark.range(3), name)
    writers.create_or_replace(spark.range(5), name)
    assert spark.table(name).count() == 5
    writers.publish_view(spark.range(2), "shelfspark_test_view")
    assert spark.table("shelfspark_test_view").count() == 2
    spark.sql(f"DROP TABLE IF EXISTS {name}")
