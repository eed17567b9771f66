"""Spark session helpers.

The library never creates its own session inside an operator; callers pass one in.
``get_session`` is for scripts, tests and the bench: it sets the knobs the operators
are designed around (AQE, ANSI, Arrow) and leaves cluster-provided settings alone.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "kvadrat",
) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("KVADRAT_DRIVER_MEMORY", "16g"))
    )
    if (master or "local").startswith("local"):  # the test tables are one row group each
        builder = builder.config("spark.kvadrat.scanPartitions", cpus)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CHECKPOINT: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; without it
    a cluster session is refused, for executors would write to their own disks. A local session
    (tests) gets a fresh scratch folder when it is unset.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_CHECKPOINT:
        _LOCAL_CHECKPOINT[key] = tempfile.mkdtemp(prefix="kvadrat-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(_LOCAL_CHECKPOINT[key])
    return _LOCAL_CHECKPOINT[key]


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared scratch root for checkpoints and intermediate tables of this session."""
    return ensure_checkpoint_dir(spark)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the session's checkpoint folder (set up if needed):
    materializes ``df`` once in reliable storage and cuts its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``kvadrat`` importable in Python workers (needed by the Arrow steps).

    Local masters share the driver's file system: the package root is put on the workers'
    ``PYTHONPATH``. Other masters get the package as a zip through ``addPyFile`` (what
    ``spark-submit --py-files`` does)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.master.startswith("local"):
        current = sc.environment.get("PYTHONPATH", "")
        if root not in current.split(os.pathsep):
            sc.environment["PYTHONPATH"] = os.pathsep.join([p for p in [root, current] if p])
    else:
        import shutil

        staging = tempfile.mkdtemp(prefix="kvadrat-pkg-")
        archive = shutil.make_archive(os.path.join(staging, "kvadrat"), "zip", root, "kvadrat")
        sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
