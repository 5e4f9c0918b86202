"""Session construction and the shared scratch location.

Library code never builds its own session: every function takes the caller's
DataFrames.  ``get_session`` exists for tests, the bench and the command line.

``shared_dir`` returns the folder named by ``spark.checkpoint.dir``.  On a
cluster that folder must be shared storage (HDFS, object store); it is where
lineage is cut (``DataFrame.checkpoint``) and where the sink checks write
their tables.  A private temporary folder is only created when the setting is
absent *and* the master is local, as in tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tapflow", checkpoint_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a local session for tests, the bench and the CLI.

    On a cluster the session comes from ``spark-submit`` and its settings;
    library functions never depend on these values.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small local shuffles: keep every core busy instead of merging
        # partitions up to the 1 MB default minimum
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.parquet.writeLegacyFormat", "true")
    )
    if checkpoint_dir:
        builder = builder.config(_CHECKPOINT_KEY, checkpoint_dir)
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch folder, from ``spark.checkpoint.dir``.

    Falls back to a fresh private folder only for a local master; on a
    cluster a missing setting is an error, as a machine-local folder would
    not survive the loss of an executor.
    """
    root = spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        try:
            root = spark.conf.get(_CHECKPOINT_KEY)
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            root = None
    if not root:
        root = getattr(spark, "_tapflow_scratch", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                f"{_CHECKPOINT_KEY} is not set; point it at shared storage")
        root = tempfile.mkdtemp(prefix="tapflow-")
        spark._tapflow_scratch = root  # type: ignore[attr-defined]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
