"""The columns that each bronze table offers: a versioned log, and readers that go by it.

Landed rows carry their payload as a map, so a new column needs no rewrite: it is one more
row in the log. Creating, matching and adopting tables write the log, each time as a
whole small snapshot; readers take the newest complete one, so schemas never come from
file footers. Columns are never dropped, and their order never changes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.canonical import to_text_frame, utc_literal
from ..operators import bronze as B
from ..operators.envelope import widen
from ..session import keep
from .lake import empty_bronze
from .storage import bronze_batches, read_bronze, read_snapshot, snapshot_version, write_bronze, write_snapshot

_COLUMNS = "table_name string, ordinal int, column_name string"


def _log_path(root: str) -> str:
    return f"{root}/_schema"


def bronze_catalog(spark: SparkSession, root: str) -> DataFrame:
    """``(table_name, ordinal, column_name)`` of all bronze tables, empty ones too."""
    log = read_snapshot(spark, _log_path(root))
    return spark.createDataFrame([], _COLUMNS) if log is None else log


def match_lake(spark: SparkSession, root: str, lake: DataFrame) -> DataFrame:
    """Create the tables that bronze lacks and add the columns that its tables lack; returns what was done.

    Nothing is written if every column is there already.
    """
    have = bronze_catalog(spark, root)
    actions = keep(B.match_lake(lake, have))
    if actions.isEmpty():
        return actions
    both = have.withColumn("late", F.lit(0)).unionByName(
        actions.select("table_name", "ordinal", "column_name", F.lit(1).alias("late")))
    order = Window.partitionBy("table_name").orderBy("late", "ordinal", "column_name")
    log = both.select("table_name", F.row_number().over(order).alias("ordinal"), "column_name")
    write_snapshot(log.coalesce(1), _log_path(root), snapshot_version(spark, _log_path(root)) + 1)
    return actions


def adopt_table(rows: DataFrame, root: str, table: str, now: dt.datetime, source: str) -> None:
    """Land an existing table's rows in bronze, as text, and log its columns.

    It is one batch of a stream of its own, so adopting again replaces what was adopted.
    """
    spark, name = rows.sparkSession, table.strip().lower()
    columns = [(name, i, c.lower()) for i, c in enumerate(rows.columns, 1)]
    match_lake(spark, root, spark.createDataFrame(columns, _COLUMNS))
    text = to_text_frame(rows)
    entries = F.array(*[F.struct(F.lit(c.lower()).alias("key"), F.col(f"`{c}`").alias("value")) for c in text.columns])
    landed = text.select(
        F.lit(name).alias("table"),
        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("fields"),
        utc_literal(now).alias("__ingested_at"), F.lit(source).alias("__record_source"))
    write_bronze(landed, root, 0, f"adopted-{name}")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A bronze table with all logged columns as text, and its audit columns; empty if nothing has landed."""
    name = table.strip().lower()
    logged = bronze_catalog(spark, root).filter(F.col("table_name") == name).orderBy("ordinal")
    columns = [r["column_name"] for r in logged.collect()]
    if not columns:
        raise ValueError(f"bronze knows no column of {table!r}")
    if not bronze_batches(spark, root, name):
        audit = {"__ingested_at": F.lit(None).cast("timestamp"), "__record_source": F.lit(None).cast("string")}
        return empty_bronze(spark, columns).withColumns(audit)
    return widen(read_bronze(spark, root, name).select("fields", "__ingested_at", "__record_source"), columns)
