"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that every run wants. Sizes (shuffle partitions, memory, executors)
# belong to the deployment; AQE coalesces or splits whatever it is given.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording a Python call site for every column costs more than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "vaultspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` overrides (dots as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent, which is
    the single-JVM case (tests, notebooks).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="vaultspark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def keep(df: DataFrame) -> DataFrame:
    """Write a frame that is used several times to the shared folder, and read it back.

    Its lineage ends there, so a lost executor costs no recomputation, and Spark
    knows its true size: whether a join broadcasts it is left to
    ``spark.sql.autoBroadcastJoinThreshold`` and to AQE.
    """
    path = scratch_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/vaultspark/{label}-{uuid.uuid4().hex}"
