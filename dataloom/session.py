"""Session construction and shared-storage helpers.

The library never writes to a machine-local folder on its own: scratch output
(written tables, streaming checkpoints, lineage cuts) goes below the folder the
cluster names in ``spark.checkpoint.dir``. Only when that is unset (local tests,
bench) do we pick a folder ourselves.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_spark(cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "dataloom") -> SparkSession:
    """Local session with the settings the library is tuned for.

    On a cluster the session comes from the launcher; the same keys belong in
    its config (AQE on, UTC, Arrow on). ``shuffle_partitions`` is a floor that
    AQE coalesces at run time; at 100 TB set it to roughly input_bytes / 128 MB.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DATALOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.bucketing.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.split("[")[0] == "local":
        # Unset: tests and local runs only; the folder goes when the process ends.
        own = tempfile.mkdtemp(prefix="dataloom-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
    else:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/dataloom-scratch/{name}-{uuid.uuid4().hex[:12]}"


def fixed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table in the shared scratch folder and read back: fixed rows, no lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the given test tables."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``dataloom`` importable in Python workers (pandas UDFs, applyInPandas).

    Equivalent to ``--py-files``: the package is zipped once per Spark context
    and added with ``addPyFile``; Spark distributes it to every executor.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="dataloom-pyfiles-"), "dataloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
