"""Bronze schemas against lake schemas, and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.canonical import utc_literal
from ..functions.names import BRONZE_AUDIT_COLUMNS, bronze_type


def _ordered_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """Columns of ``first`` in order, then those only in ``second``."""
    both = first.withColumn("side", F.lit(0)).unionByName(second.withColumn("side", F.lit(1)))
    named = both.select(
        "table_name", "side", "ordinal", F.lower(F.trim("column_name")).alias("column_name")
    ).filter((F.col("column_name") != "") & ~F.col("column_name").isin(BRONZE_AUDIT_COLUMNS))
    places = named.groupBy("table_name", "column_name").agg(
        F.min(F.struct("side", "ordinal")).alias("place")
    )
    order = Window.partitionBy("table_name").orderBy("place", "column_name")
    return places.select(
        "table_name", F.row_number().over(order).alias("ordinal"), "column_name"
    )


def bronze_columns(lake: DataFrame, bronze: DataFrame) -> DataFrame:
    """The columns a bronze table has to offer: the lake's, then its own extras."""
    cols = ["table_name", "ordinal", "column_name"]
    return _ordered_union(lake.select(cols), bronze.select(cols))


def payload_columns(bronze: DataFrame, keys: DataFrame) -> DataFrame:
    """Bronze columns followed by payload keys they lack."""
    cols = ["table_name", "ordinal", "column_name"]
    seen = keys.select(
        F.col("table").alias("table_name"), F.col("position").alias("ordinal"), "column_name"
    )
    return _ordered_union(bronze.select(cols), seen)


def missing_columns(want: DataFrame, have: DataFrame) -> DataFrame:
    """Rows of ``want`` whose column ``have`` lacks, compared without case."""
    low = have.select("table_name", F.lower("column_name").alias("low")).distinct()
    return (
        want.withColumn("low", F.lower("column_name"))
        .join(low, ["table_name", "low"], "left_anti")
        .select(*want.columns)
    )


def bronze_align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Order, cast and NULL-fill the frame to a target schema; extras are dropped."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (
                F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType)
                if f.name.lower() in have
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def bronze_types(catalog: DataFrame) -> DataFrame:
    """The catalog with each column's bronze type."""
    return catalog.withColumn("bronze_type", bronze_type(F.col("data_type")))


def match_lake(lake: DataFrame, bronze: DataFrame) -> DataFrame:
    """What to do so that bronze offers every lake column.

    ``create`` for columns of tables bronze does not have, ``add`` for new
    columns of those it has; columns already there give no row.
    """
    tables = bronze.select("table_name", F.lit(True).alias("known")).distinct()
    want = bronze_columns(lake, bronze)
    return (
        missing_columns(want, bronze)
        .join(tables, "table_name", "left")
        .select(
            "table_name",
            "ordinal",
            "column_name",
            F.when(F.col("known"), "add").otherwise("create").alias("action"),
        )
    )


def adopt_parquet(df: DataFrame, columns: list[str], now: dt.datetime, source: str) -> DataFrame:
    """An existing Parquet table as bronze: its rows, missing columns, audit."""
    have = {c.lower() for c in df.columns}
    extra = [c for c in columns if c.lower() not in have]
    return df.select(
        *[F.col(f"`{c}`").alias(c.lower()) for c in df.columns],
        *[F.lit(None).cast("string").alias(c.lower()) for c in extra],
        utc_literal(now).alias("__ingested_at"),
        F.lit(source).alias("__record_source"),
    )


def prune_bronze(df: DataFrame, cutoff: dt.datetime) -> DataFrame:
    """Rows not older than the cutoff; a frame without an ingest time keeps all."""
    if "__ingested_at" not in df.columns:
        return df
    mark = utc_literal(cutoff)
    return df.filter(F.col("__ingested_at").isNull() | (F.col("__ingested_at") >= mark))


def stable_counts(samples: DataFrame, checks: int = 2, min_rows: int = 1) -> DataFrame:
    """From polls ``(table, poll, rows)``: when each table's count settled.

    Polls below ``min_rows`` are passed over. A table is ready at the first poll
    that ends ``checks`` equal counts in a row; otherwise the last count seen is
    reported with ``ready`` false.
    """
    by_poll = Window.partitionBy("table").orderBy("poll")
    counted = samples.filter(F.col("rows") >= min_rows)
    runs = counted.withColumn(
        "new_run",
        F.when(F.lag("rows").over(by_poll) == F.col("rows"), 0).otherwise(1),
    ).withColumn("run", F.sum("new_run").over(by_poll))
    # A run is a stretch of equal counts; its length so far decides.
    within = Window.partitionBy("table", "run").orderBy("poll")
    lengths = runs.withColumn("length", F.row_number().over(within))
    settled = F.col("length") >= checks
    result = lengths.groupBy("table").agg(
        F.min(F.when(settled, F.struct("poll", "rows"))).alias("at"),
        F.max(F.struct("poll", "rows")).alias("last"),
    )
    tables = samples.select("table").distinct()
    return tables.join(result, "table", "left").select(
        "table",
        F.col("at").isNotNull().alias("ready"),
        F.col("at.poll").alias("ready_at"),
        F.coalesce("at.rows", "last.rows", F.lit(0)).alias("rows"),
    )


def tables_without_schema(want: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requested tables that the catalog knows no column of; loads refuse them."""
    names = want.select(F.lower(F.trim("table_name")).alias("table_name")).filter(
        F.col("table_name") != ""
    )
    return names.distinct().join(
        catalog.select(F.lower("table_name").alias("table_name")), "table_name", "left_anti"
    )
