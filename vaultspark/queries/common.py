"""Inputs shared by the queries, and the SQL pieces shared by the oracles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import KEY_TOKENS, TECHNICAL_COLUMNS
from ..operators import cdc
from ..operators.modelling import model_lake
from ..sources.lake import lake_catalog, observe_lake, read_lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)
T0_SQL = "'2024-01-01 00:00:00'"
T1_SQL = "'2024-02-01 00:00:00'"

# The driver's tables: their columns in order, with Spark's type names.
TABLES = {
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}
CHANGE_COLUMNS = {"events": "ts", "lineitem": "l_shipdate", "orders": "o_orderdate"}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and its oracle."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- Spark inputs ---------------------------------------------------------------


def lake(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return read_lake(spark, sf, table)


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of all tables, empty ones too."""
    return lake_catalog(spark, sf)


def with_counts(spark: SparkSession, sf: str, columns: DataFrame) -> DataFrame:
    """A catalog with ``n_values``, the number of values of each column."""
    counts = observe_lake(spark, sf).select("table_name", "column_name", F.col("n_values").alias("n"))
    return columns.join(counts, ["table_name", "column_name"], "left").select(
        *columns.columns, F.coalesce("n", F.lit(0)).alias("n_values")
    )


def registry(spark: SparkSession, sf: str) -> DataFrame:
    return model_lake(catalog(spark, sf))


def envelopes(spark: SparkSession, sf: str, tables: list[str] | None = None) -> DataFrame:
    """Insert envelopes of whole tables."""
    frames = [
        cdc.cdc_full(lake(spark, sf, t), t, CHANGE_COLUMNS[t]) for t in tables or CHANGE_COLUMNS
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def consumed(spark: SparkSession, sf: str, tables: list[str] | None = None) -> DataFrame:
    """The same envelopes with the consumer's column names."""
    return envelopes(spark, sf, tables).withColumnRenamed(
        "cdc_ingestion_timestamp", "cdc_modified_at"
    )


def joined(names: Column | str) -> Column:
    """A list as one text, which every engine prints alike."""
    return F.array_join(names, ",")


def show_models(models: DataFrame) -> DataFrame:
    return models.select(
        "model_name", "table_name", "model_type",
        joined("business_keys").alias("business_keys"), joined("attributes").alias("attributes"),
    )


# --- oracle pieces --------------------------------------------------------------


def columns_of(table: str) -> list[str]:
    return [c.split()[0] for c in TABLES[table].split(", ")]


def type_of(table: str, column: str) -> str:
    return dict(c.split() for c in TABLES[table].split(", "))[column]


def sql_text(table: str, column: str) -> str:
    """Canonical text of a column in DuckDB."""
    if type_of(table, column) == "timestamp_ntz":
        return sql_ts_text(column)
    return f"cast({column} as varchar)"


def sql_ts_text(column: str, separator: str = " ") -> str:
    return (
        f"(strftime({column}, '%Y-%m-%d{separator}%H:%M:%S') || case when microsecond({column}) % 1000000 = 0 "
        f"then '' else strftime({column}, '.%f') end)"
    )


def sql_iso(column: str) -> str:
    return f"({sql_ts_text(column, 'T')} || '+00:00')"


def sql_payload(table: str, ts_col: str) -> str:
    """The JSON payload of a row of a table without NULLs."""
    parts = ", ".join(
        f"{c} := {sql_iso(c) if c == ts_col else sql_text(table, c)}" for c in columns_of(table)
    )
    return f"cast(to_json(struct_pack({parts})) as varchar)"


def sql_hash(table: str, attributes: list[str]) -> str:
    if not attributes:
        return "sha256('')"
    inner = " || '||' || ".join(f"coalesce({sql_text(table, a)}, '')" for a in attributes)
    return f"sha256({inner})"


def sql_singular(c: str) -> str:
    return (
        f"(case when {c} like '%ies' then left({c}, length({c}) - 3) || 'y' "
        f"when {c} like '%s' and {c} not like '%ss' then left({c}, length({c}) - 1) else {c} end)"
    )


def sql_strip_suffix(c: str) -> str:
    cases = " ".join(
        f"when ends_with({c}, '_{t}') then left({c}, length({c}) - {len(t) + 1}) "
        f"when ends_with({c}, '{t}') then left({c}, length({c}) - {len(t)})"
        for t in KEY_TOKENS
    )
    return f"(case {cases} else {c} end)"


def sql_is_key(c: str) -> str:
    return "(" + " or ".join(f"contains(lower({c}), '{t}')" for t in KEY_TOKENS) + ")"


def _counts() -> str:
    parts = []
    for table, spec in TABLES.items():
        names = ", ".join(f"'{c}'" for c in columns_of(table))
        types = ", ".join(f"'{c.split()[1]}'" for c in spec.split(", "))
        counts = ", ".join(f"count({c})" for c in columns_of(table))
        ordinals = ", ".join(str(i) for i in range(1, len(columns_of(table)) + 1))
        parts.append(
            f"select '{table}' as table_name, unnest([{ordinals}]) as ordinal, unnest([{names}]) as column_name, "
            f"unnest([{types}]) as data_type, unnest([{counts}]) as n_values from {table}"
        )
    return " union all ".join(parts)


COUNTED = f"counted as ({_counts()})"
CATALOG = f"{COUNTED}, catalog as (select * from counted)"

_TECHNICAL = ", ".join(f"'{c}'" for c in TECHNICAL_COLUMNS)

# cands: key candidates; hubs: one key per table; fks; attrs; models: the registry.
MODELS = f"""{CATALOG},
cands as (select * from catalog where {sql_is_key('column_name')}),
ranked as (
  select *, starts_with(regexp_replace(column_name, '[^a-z0-9]', '', 'g'), {sql_singular('table_name')}) as named
  from cands),
hubs as (
  select table_name, column_name as hub_key, named from ranked
  qualify row_number() over (partition by table_name order by named desc, ordinal) = 1),
fks as (
  select c.table_name, c.ordinal, c.column_name, h.hub_key from cands c join hubs h using (table_name)
  where c.column_name <> h.hub_key),
attrs as (
  select table_name, ordinal, column_name from catalog
  where not {sql_is_key('column_name')} and column_name not in ({_TECHNICAL})),
attr_lists as (
  select table_name, string_agg(column_name, ',' order by ordinal) as attributes from attrs group by 1),
models as (
  select 'hub_' || {sql_singular('table_name')} as model_name, table_name, 'hub' as model_type,
         hub_key as business_keys, '' as attributes from hubs
  union all
  select 'sat_' || {sql_singular('table_name')}, table_name, 'sat', hub_key, attributes
  from hubs join attr_lists using (table_name)
  union all
  select 'link_' || {sql_singular('table_name')} || '_' || {sql_singular(sql_strip_suffix('column_name'))},
         table_name, 'link', hub_key || ',' || column_name, '' from fks)"""


def with_models(select: str) -> str:
    return f"with {MODELS} {select}"


def with_catalog(select: str) -> str:
    return f"with {CATALOG} {select}"
