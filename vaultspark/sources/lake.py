"""Lake tables kept as Parquet: discovery, schemas, scans.

A table is either one file ``<root>/<table>.parquet`` or a directory
``<root>/<table>/``. Names match case-insensitively.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

log = logging.getLogger(__name__)

CATALOG_SCHEMA = "table_name string, ordinal int, column_name string, data_type string"
OBSERVED_SCHEMA = CATALOG_SCHEMA + ", n_values bigint"


def _entries(spark: SparkSession, root: str) -> dict[str, str]:
    """Table name -> path for the entries right under ``root`` (one listing call)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    found: dict[str, str] = {}
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith((".", "_")):
            continue
        if status.isDirectory():
            # A directory of the same name as a file loses to the file.
            found.setdefault(name.removesuffix(".parquet").lower(), status.getPath().toString())
        elif name.endswith(".parquet"):
            found[name.removesuffix(".parquet").lower()] = status.getPath().toString()
    return found


def list_lake_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables under ``root``, lower-cased and sorted."""
    return sorted(_entries(spark, root))


def read_lake(
    spark: SparkSession,
    root: str,
    table: str,
    columns: list[str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Scan one table; a qualifier before the dot is ignored."""
    key = table.strip().split(".", 1)[-1].lower()
    entries = _entries(spark, root)
    if key not in entries:
        raise FileNotFoundError(f"table {table!r} not found in lake tables under {root}")
    frame = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(entries[key])
    return frame.select(*columns) if columns else frame


def read_lake_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every table under ``root``, lazily; schemas come from the file footers."""
    entries = sorted(_entries(spark, root).items())
    # Each footer is a small job of its own; several run side by side.
    with ThreadPoolExecutor(max_workers=8) as pool:
        frames = pool.map(lambda entry: spark.read.parquet(entry[1]), entries)
        return {table: frame for (table, _), frame in zip(entries, frames, strict=True)}


def catalog_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, ordinal, column_name, data_type)`` from schemas alone."""
    rows = [
        (table, i, f.name.lower(), f.dataType.simpleString())
        for table, frame in tables.items()
        for i, f in enumerate(frame.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def lake_catalog(spark: SparkSession, root: str) -> DataFrame:
    """The catalog of every table under ``root``."""
    return catalog_of(spark, read_lake_tables(spark, root))


def observed_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """The catalog with the number of values each column holds.

    A change payload leaves NULLs out, so a column without any value is not
    visible to a consumer of the change stream. One pass per table counts all
    its columns at once and shuffles one row per task.
    """

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def one(table: str, frame: DataFrame) -> DataFrame:
        fields = frame.schema.fields
        counts = frame.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
        rows = ", ".join(
            f"{quoted(table)}, {i + 1}, {quoted(f.name.lower())}, {quoted(f.dataType.simpleString())}, c{i}"
            for i, f in enumerate(fields)
        )
        return counts.selectExpr(
            f"stack({len(fields)}, {rows}) as (table_name, ordinal, column_name, data_type, n_values)"
        )

    return reduce(DataFrame.unionByName, [one(t, f) for t, f in tables.items()])


# Counts of values are in Parquet footers; Spark answers from there when the
# table comes through its newer file source.
_FOOTER_COUNTS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


# When a file lacks the statistics that would answer, Spark's error names this setting.
_NO_STATISTICS = "spark.sql.parquet.aggregatePushdown"


def observe_lake(spark: SparkSession, root: str) -> DataFrame:
    """``observed_catalog`` of a whole lake, computed once and kept.

    The counts come from the file footers, so no data page is read. Files written
    without statistics cannot answer; then the columns are scanned. The result
    is metadata, kept in the shared folder because callers use it repeatedly.
    """
    # A session of its own has the settings; other queries of this one do not see them.
    own = spark.newSession()
    for key, value in _FOOTER_COUNTS.items():
        own.conf.set(key, value)
    path = scratch_path(spark, "observed")
    try:
        observed_catalog(read_lake_tables(own, root)).write.parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        if _NO_STATISTICS not in str(error):
            raise
        log.warning("files of %s hold no counts, scanning instead", root)
        observed_catalog(read_lake_tables(spark, root)).write.mode("overwrite").parquet(path)
    # Footers of an empty table answer NULL.
    return spark.read.schema(OBSERVED_SCHEMA).parquet(path).na.fill(0, ["n_values"])


def bronze_schema(columns: list[str]) -> T.StructType:
    """All-STRING schema: what a bronze table starts with."""
    return T.StructType([T.StructField(c.lower(), T.StringType(), True) for c in columns])


def empty_bronze(spark: SparkSession, columns: list[str]) -> DataFrame:
    """An empty bronze frame for a lake table's columns."""
    return spark.createDataFrame([], bronze_schema(columns))


def empty_bronze_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """One empty bronze frame per lake table that has columns."""
    return {t: empty_bronze(spark, f.columns) for t, f in tables.items() if f.columns}
