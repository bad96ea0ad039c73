"""Session helpers.

The library never builds its own cluster configuration: on a cluster the
session comes from the launcher.  ``get_session`` is for tests, the bench and
local runs; ``shared_dir`` finds the cluster-shared folder (from
``spark.checkpoint.dir``) used for lineage cuts and scratch tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every entry point relies on: UTC so DATE()/TIME() of timestamps are
# stable, ANSI so strict offsets raise like the warehouse does, AQE so joins
# and shuffles are re-planned from runtime sizes (coalescing, skew splits,
# sort-merge -> broadcast when a side turns out small).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # batches that go to Python workers are held on both sides: long texts count by bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


def get_session(master: str | None = None, app: str = "shelfspark",
                shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SHELFSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the SQL settings above to an existing session (runtime confs)."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep theirs
            pass
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it this raises.  Only with a local master (tests, local
    runs) is one created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. a Connect session): conf only
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="shelfspark-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # noqa: BLE001 - core conf may be read-only at runtime
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder (never a machine-local tmp)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = "/".join([base, "shelfspark", *parts])
    if unique:
        path = f"{path}-{uuid.uuid4().hex[:12]}"
    return path
