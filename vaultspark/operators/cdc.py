"""Insert-only change capture by a per-table high-water mark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import canonical_text, iso_utc, utc_literal

INSERT = "insert"  # fixed value: the only change kind captured


def _mark_of(c: Column, data_type: T.DataType) -> Column:
    """The change column as a timestamp; text that is none gives NULL."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c
    return c.try_cast("timestamp")


def payload(df: DataFrame, ts_col: str) -> Column:
    """A row as a JSON object of canonical texts, without its NULL fields."""
    fields = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        text = iso_utc(c, f.dataType) if f.name == ts_col else canonical_text(c, f.dataType)
        fields.append(text.alias(f.name))
    return F.to_json(F.struct(*fields))


def to_envelopes(df: DataFrame, table: str, ts_col: str) -> DataFrame:
    """One insert envelope per row."""
    ts_type = df.schema[ts_col].dataType
    return df.select(
        F.lit(table).alias("table"),
        payload(df, ts_col).alias("payload"),
        F.lit(INSERT).alias("cdc_type"),
        iso_utc(F.col(f"`{ts_col}`"), ts_type).alias("cdc_ingestion_timestamp"),
    )


def cdc_full(df: DataFrame, table: str, ts_col: str) -> DataFrame:
    """Envelopes of every row whose change column is set, parseable or not."""
    return to_envelopes(df.filter(F.col(f"`{ts_col}`").isNotNull()), table, ts_col)


def watermark_of(watermarks: DataFrame, table: str) -> dt.datetime | None:
    """One table's mark, as a literal for scan pushdown (a single value)."""
    row = watermarks.filter(F.col("table_name") == table).agg(F.max("watermark").alias("w")).select(micros_of("w")).first()
    return from_micros(row[0])


def micros_of(column: str) -> Column:
    """A mark as a number, which does not change on its way to the driver."""
    return F.unix_micros(F.col(column).cast("timestamp")).alias(column)


def from_micros(value: int | None) -> dt.datetime | None:
    return None if value is None else dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=value)


def new_rows(df: DataFrame, ts_col: str, mark: dt.datetime | None) -> DataFrame:
    """Rows past the mark, strictly; all rows with a change time if there is no mark.

    The mark is a literal of the column's own type, so the comparison reaches
    the Parquet or JDBC scan. Unparseable change times never pass a mark.
    """
    if mark is None:
        return df.filter(F.col(f"`{ts_col}`").isNotNull())
    data_type = df.schema[ts_col].dataType
    past = utc_literal(mark)
    if isinstance(data_type, T.TimestampNTZType):
        wall = mark.astimezone(dt.timezone.utc) if mark.tzinfo else mark
        past = F.lit(wall.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return df.filter(_mark_of(F.col(f"`{ts_col}`"), data_type) > past)


def cdc_incremental(
    df: DataFrame, table: str, ts_col: str, mark: dt.datetime | None
) -> DataFrame:
    """Envelopes of the rows past the table's mark."""
    return to_envelopes(new_rows(df, ts_col, mark), table, ts_col)


def change_marks(df: DataFrame, table: str, ts_col: str) -> DataFrame:
    """``(table_name, watermark)`` of captured rows, reduced to one row."""
    data_type = df.schema[ts_col].dataType
    newest = df.agg(F.max(_mark_of(F.col(f"`{ts_col}`"), data_type)).alias("watermark"))
    mark = F.col("watermark")
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        # A time without zone is UTC.
        mark = F.concat(mark.cast("timestamp_ntz").cast("string"), F.lit("Z"))
    return newest.select(F.lit(table).alias("table_name"), mark.cast("timestamp").alias("watermark"))


def advance_watermarks(changes: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Each table's newest mark; tables without new rows keep theirs."""
    seen = changes.groupBy("table_name").agg(F.max("watermark").alias("seen"))
    return (
        watermarks.join(seen, "table_name", "full_outer")
        .select("table_name", F.greatest("seen", "watermark").alias("watermark"))
        .filter(F.col("watermark").isNotNull())
    )


def load_watermarks(raw: DataFrame) -> DataFrame:
    """Stored marks (text) as timestamps, invalid ones dropped."""
    return raw.select(
        "table_name", F.col("watermark").try_cast("timestamp").alias("watermark")
    ).filter(F.col("watermark").isNotNull())


def save_watermarks(watermarks: DataFrame) -> DataFrame:
    """Marks as UTC ISO-8601 text for storing, missing ones left out."""
    data_type = watermarks.schema["watermark"].dataType
    return watermarks.filter(F.col("watermark").isNotNull()).select(
        "table_name", iso_utc(F.col("watermark"), data_type).alias("watermark")
    )


def capture_modes(tables: DataFrame, watermarks: DataFrame, skip: DataFrame) -> DataFrame:
    """How the running capture treats each table.

    With a mark: ``incremental``. Without one: ``skip`` if an initial load has
    claimed the table, else ``full``.
    """
    marked = watermarks.filter(F.col("watermark").isNotNull()).select(
        "table_name", F.lit(True).alias("marked")
    )
    claimed = skip.select("table_name", F.lit(True).alias("claimed")).distinct()
    return (
        tables.select("table_name")
        .distinct()
        .join(marked, "table_name", "left")
        .join(claimed, "table_name", "left")
        .select(
            "table_name",
            F.when(F.col("marked"), "incremental")
            .when(F.col("claimed"), "skip")
            .otherwise("full")
            .alias("mode"),
        )
    )


def initial_load_tables(tables: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Tables the initial load still has to capture: those without a mark."""
    marked = watermarks.filter(F.col("watermark").isNotNull())
    return tables.select("table_name").distinct().join(marked, "table_name", "left_anti")


def tables_with_cdc_column(catalog: DataFrame, ts_columns: list[str]) -> DataFrame:
    """Tables that own one of the change columns, and so can be captured."""
    return (
        catalog.groupBy("table_name")
        .agg(F.bool_or(F.lower("column_name").isin([c.lower() for c in ts_columns])).alias("ok"))
        .filter("ok")
        .select("table_name")
    )


def cdc_counts(envelopes: DataFrame) -> DataFrame:
    """Captured rows per table."""
    return envelopes.groupBy("table").agg(F.count(F.lit(1)).alias("n_rows"))
