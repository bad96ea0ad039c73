from pyspark.sql import functions as F

from shelfspark.operators import crawl

from .conftest import SF


def run_cases(spark, seq, max_empty):
    rows = [("r", i + 1, c == "e", 0 if c == "e" else 1) for i, c in enumerate(seq.split())]
    log = spark.createDataFrame(rows, "run string, page int, empty boolean, cards int")
    ann = crawl.crawl_cutoff(log, "run", ["page"], "empty", max_empty)
    kept = [r.page for r in ann.where("kept").orderBy("page").collect()]
    summ = crawl.crawl_summary(ann, "run").first()
    return kept, summ.pages_processed


def test_cutoff_cases(spark):
    assert run_cases(spark, "n n e n e e n", 2) == ([1, 2, 4], 5)
    assert run_cases(spark, "n n e n", 1) == ([1, 2], 2)
    assert run_cases(spark, "n n e n", 0) == ([1, 2], 2)
    assert run_cases(spark, "e n", 0) == ([], 0)
    assert run_cases(spark, "n e", 2) == ([1], None)


def loop_reference(pages, max_empty):
    """Brute force: the collector's sequential walk."""
    kept, streak = [], 0
    for pid, empty in pages:
        if empty:
            streak += 1
            if streak >= max_empty:
                break
        else:
            streak = 0
            kept.append(pid)
    return kept


def test_cutoff_equals_sequential_walk_on_events(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts", "event_id", "event_type")
    log = ev.withColumn("empty", F.col("event_type") == "error")
    for m in (0, 1, 2, 3):
        ann = crawl.crawl_cutoff(log, "user_id", ["ts", "event_id"], "empty", m)
        got = {(r.user_id, r.event_id) for r in ann.where("kept").collect()}
        rows = sorted(ev.collect(), key=lambda r: (r.user_id, r.ts, r.event_id))
        want, by_user = set(), {}
        for r in rows:
            by_user.setdefault(r.user_id, []).append((r.event_id, r.event_type == "error"))
        for u, pages in by_user.items():
            want |= {(u, e) for e in loop_reference(pages, m)}
        assert got == want, m


def test_page_is_empty(spark):
    df = spark.createDataFrame([(200, False, True, 3), (None, False, True, 1), (404, False, True, 2),
                                (200, True, True, 2), (200, False, False, 2), (200, False, True, 0)],
                               "s int, le boolean, hp boolean, c int")
    out = [r.e for r in df.select(crawl.page_is_empty(F.col("s"), F.col("le"), F.col("hp"),
                                                      F.col("c")).alias("e")).collect()]
    assert out == [False, False, True, True, True, True]


def test_cutoff_with_column_limits_null_runs_and_big_keys(spark):
    big = 9007199254740993  # not a double
    rows = [(k, i, c == "e", m) for k, walk, m in [(None, "n e e n", 2), (big, "n e n n", 0), (7, "e n e e n", 2)]
            for i, c in enumerate(walk.split())]
    log = spark.createDataFrame(rows, "run bigint, page int, empty boolean, m int")
    ann = crawl.crawl_cutoff(log, "run", ["page"], "empty", F.col("m"), num_partitions=5)
    got = {(r.run, r.page): (r.page_num, r.streak, r.stop_page, r.kept) for r in ann.collect()}
    assert [got[None, i] for i in range(4)] == [(1, 0, 3, True), (2, 1, 3, False), (3, 2, 3, False), (4, 0, 3, False)]
    assert [got[big, i][2:] for i in range(4)] == [(2, True), (2, False), (2, False), (2, False)]
    assert [got[7, i][2:] for i in range(5)] == [(4, False), (4, True), (4, False), (4, False), (4, False)]


def test_a_hot_run_is_walked_in_ranges(spark):
    import random
    rnd = random.Random(5)
    rows = [("hot", i, rnd.random() < 0.2) for i in range(3000)] + [(f"r{j}", i, rnd.random() < 0.3) for j in range(40) for i in range(9)]
    log = spark.createDataFrame(rows, "run string, page int, empty boolean")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        for m in (1, 3, 6):
            ann = crawl.crawl_cutoff(log, "run", ["page"], "empty", m, num_partitions=8)
            got = {(r.run, r.page) for r in ann.where("kept").collect()}
            want = set()
            for run in {r[0] for r in rows}:
                want |= {(run, p) for p in loop_reference(sorted((p, e) for r, p, e in rows if r == run), m)}
            assert got == want, m
        tasks = ann.where("run = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 2 and max(t["count"] for t in tasks) < 2000
    finally:
        spark.conf.set(key, old)


def test_cutoff_has_no_python_node(spark):
    log = spark.createDataFrame([("a", 1, True)], "run string, page int, empty boolean")
    plan = crawl.crawl_cutoff(log, "run", ["page"], "empty", 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
