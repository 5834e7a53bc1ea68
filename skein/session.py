"""Session helpers.

Cluster jobs get their session from the cluster (``SparkSession.builder.getOrCreate``);
``local_session`` is for tests and the bench only. Lineage cuts go to the shared
folder named by ``spark.checkpoint.dir`` — read from the session, set here only when
it is unset (local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "skein",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.cleaner.periodicGC.interval", "1min")
        .config("spark.driver.memory", os.environ.get("SKEIN_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder (``spark.checkpoint.dir``, the shared folder
    the cluster names). Only a local-mode session without one gets a scratch folder; on a
    cluster a machine-local folder would be invisible to the executors, so it is an error."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for lineage cuts")
        current = tempfile.mkdtemp(prefix="skein-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss): one
    job computes the rows and writes them, later readers read the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder. Lineage ends there as with
    ``cut_lineage``, and later readers read only the columns they need. The folder's owner
    clears it; results that are still to be computed may read it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
