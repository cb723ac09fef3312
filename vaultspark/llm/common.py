"""What the operators share: registration, input columns, kept intermediate tables."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Rows in an Arrow batch of whole texts: batches stay small where texts are long.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, and workers that find this package where the driver found it.

    A cluster whose machines lack that folder ships the package with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def release_memory() -> None:
    """At the end of a task: give what Arrow and the allocator hold back to the system.

    A worker serves many tasks of different operators; what they leave must not add up.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its oracle."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read_columns(spark: SparkSession, sf_dir: str, table: str, **types: str) -> DataFrame:
    """The named columns of a table, cast to the given types; others are not read."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in types.items()))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_columns(spark, sf_dir, "documents", doc_id="long", text="string")


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without
    computing the frame again, and its size is known to the planner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
