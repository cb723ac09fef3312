"""Lake tables kept in a relational database, read through Spark's JDBC source.

Spark splits the scan when a numeric, date or timestamp column with bounds is
given; without one a single task reads the table, so large tables need it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import RDBMS_NAME_LIMIT


def _quote_literal(text: str) -> str:
    return text.replace("'", "''")


def _quote_identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def tables_query(schema: str) -> str:
    """Base tables of a schema, as a JDBC source subquery."""
    return (
        "(SELECT table_name FROM information_schema.tables "
        f"WHERE table_schema = '{_quote_literal(schema)}' AND table_type = 'BASE TABLE') t"
    )


def columns_query(schema: str, table: str | None = None) -> str:
    """Columns of a schema (or one table, any case) as a JDBC source subquery."""
    where = f"table_schema = '{_quote_literal(schema)}'"
    if table is not None:
        where += f" AND lower(table_name) = lower('{_quote_literal(table[:RDBMS_NAME_LIMIT])}')"
    return (
        "(SELECT table_name, ordinal_position AS ordinal, lower(column_name) AS column_name, "
        f"data_type FROM information_schema.columns WHERE {where}) c"
    )


def table_source(schema: str, table: str, columns: list[str] | None = None) -> str:
    """A full or projected table as a JDBC source name or subquery."""
    name = f"{_quote_identifier(schema)}.{_quote_identifier(table[:RDBMS_NAME_LIMIT])}"
    if not columns:
        return name
    return f"(SELECT {', '.join(map(_quote_identifier, columns))} FROM {name}) t"


def read_lake_jdbc(
    spark: SparkSession,
    url: str,
    schema: str,
    table: str,
    columns: list[str] | None = None,
    partition_column: str | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a database table; with bounds the scan runs in ``partitions`` tasks."""
    reader = spark.read.format("jdbc").option("url", url)
    reader = reader.option("dbtable", table_source(schema, table, columns))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(partitions or 8))
        )
    return reader.load()


def jdbc_catalog(
    spark: SparkSession,
    url: str,
    schema: str,
    table: str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """The catalog of a database schema, ordered columns per table."""
    return spark.read.jdbc(url, columns_query(schema, table), properties=properties or {}).orderBy(
        "table_name", "ordinal"
    )
