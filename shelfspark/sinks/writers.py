"""Sinks (K1-K8).

Paths are cluster storage (the shared folder from ``spark.checkpoint.dir`` or
a table location), never a machine-local temp folder.  Every write is a
Spark job; nothing is gathered on the driver.
"""

from __future__ import annotations

import json
import uuid
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import key_timestamp, last_path_segment
from ..operators.quality import RequiredColumnViolation, required_inline
from .ledger import Ledger


def clustered(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cluster rows by the output partition columns before a partitioned
    write (``REBALANCE`` hint): without it every task writes a file into
    every partition value it holds (tasks x values small files).  AQE splits
    a skewed value (one store-day with a third of the rows) over several
    tasks and coalesces small ones, so files stay near the advisory size."""
    return df.hint("rebalance", *cols)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its row count, taken while it is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def _seen(seen: Observation) -> dict:
    """The observed values, after the write.  An input that Catalyst proves empty is
    not run at all, and then the observation holds no row."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "toPyRow" not in str(error):
            raise
        return {"n": 0}


def append_prices(df: DataFrame, path: str, partition_cols: tuple[str, ...] = ("scraped_date", "store_name"),
                  run_id: str | None = None, required: list[str] | None = None) -> bool:
    """K1: append only, in one pass over the input; empty input appends no row
    and returns False.  A second run on one day doubles the rows, as in the
    reference; pass ``run_id`` to make a re-run of the same run replace its
    own partition instead.  ``required`` columns are checked while writing
    (K3): a NULL fails the job, and a failed append commits no file."""
    if required:
        df = required_inline(df, required)
    cols = list(partition_cols)
    if run_id is not None:
        df = df.withColumn("run_id", F.lit(run_id))
        cols = [*cols, "run_id"]
    rows, seen = _counted(df)
    writer = clustered(rows, cols).write.partitionBy(*cols)
    if run_id is not None:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)
    return _seen(seen)["n"] > 0


def replace_snapshot(df: DataFrame, path: str, required: list[str] | None = None, not_null: list[str] | None = None,
                     keep: int = 2) -> bool:
    """K2: full refresh guarded by *rows*, in one pass over the input.

    The rows go to a folder of their own, with ``required`` checked inline (K3) and
    NULLs of ``not_null`` columns counted (A9) in the same pass; only a complete,
    non-empty result without violations is recorded, under the next version number,
    which one writer gets.  So no rows, a violation, a lost job or another writer
    leave whole snapshots: the highest version is the current one.  The newest
    ``keep`` versions stay, so readers of the one before are not cut off."""
    ledger = Ledger(df.sparkSession, f"{path}/_versions")
    checked = not_null or []
    aggregates = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in checked]]
    seen = Observation()
    folder = f"data-{uuid.uuid4().hex}"
    try:
        (required_inline(df, required) if required else df).observe(seen, *aggregates).write.parquet(f"{path}/{folder}")
        counts = _seen(seen)
        nulls = {c: counts[f"null_{c}"] for c in checked if counts.get(f"null_{c}")}
        if nulls:
            raise RequiredColumnViolation("NULL in required columns: " + ", ".join(f"{c}={n}" for c, n in nulls.items()))
    except BaseException:
        ledger.delete(f"{path}/{folder}")
        raise
    if not counts["n"]:
        ledger.delete(f"{path}/{folder}")
        return False
    ledger.claim(lambda _: {"folder": folder, "schema": df.schema.json()})
    for number in ledger.numbers()[:-keep]:
        with suppress(Py4JJavaError):  # another writer may be clearing up too
            ledger.delete(f"{path}/{ledger.read(number)['folder']}")
            ledger.delete(ledger.name(number))
    return True


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that ``replace_snapshot`` writes."""
    now = Ledger(spark, f"{path}/_versions").last()
    if now is None:
        raise FileNotFoundError(f"no snapshot in {path}")
    return spark.read.schema(T.StructType.fromJson(json.loads(now["schema"]))).parquet(f"{path}/{now['folder']}")


JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"  # keep microseconds in JSON text


def archive_json(df: DataFrame, root: str, partition_cols: tuple[str, ...] = ("chain", "category", "dt")) -> None:
    """K4: daily JSON archive ``chain/category/dt``; a same-day run replaces
    that day's partition only (dynamic partition overwrite)."""
    (clustered(df, list(partition_cols)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("timestampFormat", JSON_TS_FORMAT).partitionBy(*partition_cols).json(root))


def read_archive(spark, root: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("timestampFormat", JSON_TS_FORMAT).json(root)


def archive_key(load_ts: Column, source_url: Column) -> Column:
    """K5/F22/F23 object key ``<yyyymmdd_hhmmss>_<last url segment>``."""
    return F.concat(key_timestamp(load_ts), F.lit("_"), last_path_segment(source_url))


def archive_timestamped(df: DataFrame, root: str, load_ts: Column, source_url: Column) -> None:
    """K5: JSON records under ``root/load_key=<yyyymmdd_hhmmss>/``, append
    only, never overwritten.  One directory per load run (not per object:
    a directory per record would put millions of tiny files on the store);
    each record keeps ``source_name`` (last URL segment), so the object key
    ``<load_key>_<source_name>`` is recovered on read (``archived_objects``)."""
    keyed = (df.withColumn("load_key", key_timestamp(load_ts))
             .withColumn("source_name", last_path_segment(source_url)))
    clustered(keyed, ["load_key"]).write.mode("append").partitionBy("load_key").json(root)


def archived_objects(spark, root: str, schema: str) -> DataFrame:
    """Read an archive back; ``object_key`` = ``<load_key>_<source_name>``."""
    back = spark.read.schema(f"{schema}, source_name string, load_key string").json(root)
    return back.withColumn("object_key", F.concat(F.col("load_key"), F.lit("_"), F.col("source_name")))


def partitioned_feed(spark: SparkSession, path: str, schema: str, chains: list[str], name: str,
                     by: str = "store_name") -> dict[str, DataFrame]:
    """One feed partitioned by chain, and a view of it for each chain
    (``<name>_<chain>``), which reads that chain's folders only."""
    feed = spark.read.schema(schema).parquet(path)
    return {chain: publish_view(feed.where(F.col(by) == chain), f"{name}_{chain.lower()}") for chain in chains}


def create_or_replace(df: DataFrame, table: str, path: str | None = None) -> None:
    """K6: CTAS replace of a catalog table (external at ``path`` when given,
    e.g. under the shared folder; else in the session's warehouse)."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """K8: the model layer's default materialisation is a view."""
    df.createOrReplaceTempView(name)
    return df


def publish_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """K8: marts are tables."""
    create_or_replace(df, name, path)


def dense_index(df: DataFrame, order_cols: list[str], start: int | Column = 1, id_col: str = "id") -> DataFrame:
    """Consecutive ids in ``order_cols`` order without a single-partition
    window: range-partition and sort, checkpoint once (fixes the partition
    contents so a retried task sees the same rows), take the in-partition
    position from ``monotonically_increasing_id`` and add per-partition
    offsets from a table with one row per partition.  ``order_cols`` must be unique."""
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    marked = ranged.withColumn("_mono", F.monotonically_increasing_id()).checkpoint(eager=True)
    pid = F.shiftright(F.col("_mono"), 33)
    marked = marked.withColumn("_pid", pid).withColumn("_local", F.col("_mono") - F.shiftleft(F.col("_pid"), 33))
    counts = marked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    first = start if isinstance(start, Column) else F.lit(start)
    # one row per partition; the planner broadcasts it by its size
    return (marked.join(offsets, "_pid")
            .withColumn(id_col, (first + F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_mono", "_pid", "_local", "_off"))


def highest_id(spark: SparkSession, path: str, id_col: str) -> int:
    """The largest id of a table, from the footers of its files (aggregate push-down)."""
    wanted = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        return spark.read.schema(f"`{id_col}` bigint").parquet(path).agg(F.max(id_col)).first()[0] or 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def append_with_surrogate_id(df: DataFrame, path: str, order_cols: list[str], id_col: str = "id",
                             load_ts: Column | None = None) -> bool:
    """K7: append rows with the next serial ids and a default load time.  Each run
    appends the batch again, as the reference's seed insert does.

    A run reserves its range of ids in a ledger beside the table before it writes, so
    two appenders never share an id; a run that fails then leaves a gap, as a
    sequence does.  Ids also stay above those of rows that came another way.  A run's
    files are written aside and then moved into the table, as two jobs that write into
    one folder at a time would clear each other's temporary files."""
    spark = df.sparkSession
    ledger = Ledger(spark, f"{path.rstrip('/')}_ids")
    held = highest_id(spark, path, id_col) if ledger.exists(path) else 0
    placed = dense_index(df, order_cols, start=0, id_col="_place")
    n = placed.count()
    if not n:
        return False
    _, reserved = ledger.claim(lambda last: {"first": max(held, last["last"] if last else 0) + 1,
                                             "last": max(held, last["last"] if last else 0) + n})
    rows = placed.withColumn(id_col, F.col("_place") + reserved["first"]).drop("_place")
    aside = f"{path.rstrip('/')}/_batch-{reserved['token']}"
    rows.withColumn("fecha_creacion", load_ts if load_ts is not None else F.current_timestamp()).write.parquet(aside)
    ledger.move_files(aside, path)
    return True
