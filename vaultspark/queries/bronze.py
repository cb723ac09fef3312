"""Bronze schemas and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import timestamps_as_text
from ..operators import bronze as B
from ..operators import envelope as EV
from ..sources import lake as L
from .common import CHANGE_COLUMNS, T1, catalog, columns_of, consumed, lake, query, sql_ts_text, with_catalog, with_counts

# A bronze layer that lags the lake: tables before 'l', without key columns
# named *key, with one column of its own per table.
_BRONZE_SQL = """bronze as (
  select table_name, ordinal, column_name from catalog where table_name < 'l' and column_name not like '%key'
  union all select distinct table_name, 99, 'legacy_flag' from catalog where table_name < 'l')"""


def _bronze(cat):
    mine = cat.filter("table_name < 'l' and column_name not like '%key'").select(
        "table_name", "ordinal", F.upper("column_name").alias("column_name")
    )
    extra = (
        cat.filter("table_name < 'l'")
        .select("table_name")
        .distinct()
        .select("table_name", F.lit(99).alias("ordinal"), F.lit("legacy_flag").alias("column_name"))
    )
    audit = extra.withColumn("column_name", F.lit("__ingested_at"))
    return mine.unionByName(extra).unionByName(audit)


_UNION_SQL = """places as (
  select table_name, column_name, min(side * 1000 + ordinal) as place from (
    select table_name, column_name, ordinal, 0 as side from catalog
    union all select table_name, column_name, ordinal, 1 from bronze) group by 1, 2),
wanted as (
  select table_name, row_number() over (partition by table_name order by place, column_name) as ordinal, column_name
  from places)"""


@query("bronze_columns", with_catalog(f", {_BRONZE_SQL}, {_UNION_SQL} select * from wanted"))
def bronze_columns(spark, sf):
    cat = catalog(spark, sf)
    return B.bronze_columns(cat, _bronze(cat))


_PAYLOAD_SQL = " union all ".join(
    f"select '{t}', {1000 + i}, '{c}' from {t} having count({c}) > 0"
    for t in CHANGE_COLUMNS
    for i, c in enumerate(columns_of(t))
)


@query(
    "bronze_payload_columns",
    with_catalog(
        f""", {_BRONZE_SQL},
merged as (select table_name, ordinal as place, column_name from bronze union all {_PAYLOAD_SQL}),
firsts as (select table_name, column_name, min(place) as place from merged group by 1, 2)
select table_name, row_number() over (partition by table_name order by place, column_name) as ordinal, column_name
from firsts"""
    ),
)
def bronze_payload_columns(spark, sf):
    return B.payload_columns(_bronze(catalog(spark, sf)), EV.payload_keys(consumed(spark, sf)))


@query(
    "missing_columns",
    with_catalog(
        f""", {_BRONZE_SQL} select table_name, ordinal, column_name from catalog c where not exists
(select 1 from bronze b where b.table_name = c.table_name and b.column_name = c.column_name)"""
    ),
)
def missing_columns(spark, sf):
    cat = catalog(spark, sf)
    return B.missing_columns(cat.select("table_name", "ordinal", "column_name"), _bronze(cat))


@query(
    "match_lake",
    with_catalog(
        f""", {_BRONZE_SQL}, {_UNION_SQL}
select w.*, case when w.table_name < 'l' then 'add' else 'create' end as action from wanted w where not exists
(select 1 from bronze b where b.table_name = w.table_name and b.column_name = w.column_name)"""
    ),
)
def match_lake(spark, sf):
    cat = catalog(spark, sf)
    return B.match_lake(cat, _bronze(cat))


@query(
    "bronze_align",
    """select user_id::varchar as user_id, event_id, cast(null as varchar) as extra, value::varchar as value,
try_cast(event_type as bigint) as event_type from events""",
)
def bronze_align(spark, sf):
    target = T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("event_id", T.LongType()),
            T.StructField("extra", T.StringType()),
            T.StructField("value", T.StringType()),
            T.StructField("event_type", T.LongType()),
        ]
    )
    events = lake(spark, sf, "events").withColumnRenamed("user_id", "USER_ID")
    return B.bronze_align(events, target)


@query(
    "bronze_type_map",
    with_catalog(
        """ select table_name, ordinal, column_name, data_type, n_values, case data_type
when 'string' then 'STRING' when 'int' then 'INT' when 'bigint' then 'BIGINT' when 'double' then 'DOUBLE'
else 'STRING' end as bronze_type from catalog"""
    ),
)
def bronze_type_map(spark, sf):
    return B.bronze_types(with_counts(spark, sf, catalog(spark, sf)))


@query("bronze_empty_schema", with_catalog(" select table_name, ordinal, column_name, 'string' as data_type from catalog"))
def bronze_empty_schema(spark, sf):
    """The catalog of the empty bronze frames of all tables, empty ones too."""
    return L.catalog_of(spark, L.empty_bronze_tables(spark, L.read_lake_tables(spark, sf)))


@query(
    "adopt_parquet",
    f"""select page_id, url, html, cast(null as varchar) as title, cast(null as varchar) as lang,
'2024-02-01 00:00:00' as __ingested_at, 'adopted' as __record_source from pages""",
)
def adopt_parquet(spark, sf):
    rows = B.adopt_parquet(lake(spark, sf, "pages"), ["url", "TITLE", "lang"], T1, "adopted")
    return timestamps_as_text(rows)


@query(
    "prune_bronze",
    f"select event_id, {sql_ts_text('ts')} as __ingested_at from events where ts >= timestamp '2024-01-15 12:00:00'",
)
def prune_bronze(spark, sf):
    rows = lake(spark, sf, "events").select("event_id", F.col("ts").alias("__ingested_at"))
    return timestamps_as_text(B.prune_bronze(rows, dt.datetime(2024, 1, 15, 12)))


@query(
    "stable_counts",
    """with samples as (select user_id, cast(ts as date) as poll, count(*) as n from events group by 1, 2),
ok as (select *, row_number() over (partition by user_id order by poll) as r from samples where n >= 2),
ready as (
  select a.user_id, min(c.poll) as poll from ok a
  join ok b on b.user_id = a.user_id and b.r = a.r + 1 and b.n = a.n
  join ok c on c.user_id = a.user_id and c.r = a.r + 2 and c.n = a.n group by 1),
latest as (select user_id, max_by(n, poll) as n from ok group by 1)
select cast(s.user_id as varchar) as "table", r.poll is not null as ready, cast(r.poll as varchar) as ready_at,
coalesce(o.n, l.n, 0) as rows
from (select distinct user_id from samples) s left join ready r using (user_id)
left join ok o on o.user_id = r.user_id and o.poll = r.poll left join latest l on l.user_id = s.user_id""",
)
def stable_counts(spark, sf):
    """Each user's events per day as the polled counts of one table."""
    samples = (
        lake(spark, sf, "events")
        .groupBy(F.col("user_id").cast("string").alias("table"), F.to_date("ts").alias("poll"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    out = B.stable_counts(samples, checks=3, min_rows=2)
    return out.withColumn("ready_at", F.col("ready_at").cast("string"))


@query(
    "tables_without_schema",
    """select distinct 'tbl_' || source as table_name from documents
union all select 'labels_' || quality from labels group by 1""",
)
def tables_without_schema(spark, sf):
    """Requests name real tables and tables made up from the data; the latter have no schema."""
    want = (
        lake(spark, sf, "documents").select(F.concat(F.lit("TBL_"), "source").alias("table_name"))
        .unionByName(lake(spark, sf, "labels").select(F.concat(F.lit("labels_"), "quality").alias("table_name")))
        .unionByName(catalog(spark, sf).select(F.upper("table_name").alias("table_name")))
    )
    return B.tables_without_schema(want, catalog(spark, sf))
