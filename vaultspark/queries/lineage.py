"""Lineage, impact, bursts, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.canonical import timestamps_as_text
from ..operators import cdc
from ..operators import envelope as EV
from ..operators import lineage as LN
from ..operators import modelling as MD
from .common import T0, T0_SQL, consumed, envelopes, joined, lake, query, registry, sql_ts_text, with_models


@query(
    "lineage",
    with_models(
        f"""select table_name as source_table, model_name as target_model, model_type, business_keys, attributes,
{T0_SQL} as logged_at from models"""
    ),
)
def lineage(spark, sf):
    rows = LN.lineage(registry(spark, sf), F.lit(T0).cast("timestamp"))
    shown = rows.select(
        "source_table", "target_model", "model_type", joined("business_keys").alias("business_keys"),
        joined("attributes").alias("attributes"), "logged_at",
    )
    return timestamps_as_text(shown)


@query(
    "impacted_models",
    with_models(
        """select model_name from models where table_name in ('lineitem', 'orders')
and (select count(*) from lineitem) > 0 and (select count(*) from orders) > 0"""
    ),
)
def impacted_models(spark, sf):
    """Models behind the tables that a batch of envelopes touched."""
    touched = EV.touched_tables(consumed(spark, sf, ["lineitem", "orders"]))
    return LN.impacted_models(touched, registry(spark, sf))


@query(
    "referenced_sources",
    with_models(
        """select distinct table_name from models
union select 'src_' || source from documents union select 'tbl_' || role from conversations"""
    ),
)
def referenced_sources(spark, sf):
    """Sources declared before, here named after the data, joined by those of the models."""
    reg = registry(spark, sf)
    known = (
        lake(spark, sf, "documents").select(F.concat(F.lit(" SRC_"), "source").alias("table_name"))
        .unionByName(lake(spark, sf, "conversations").select(F.concat(F.lit("tbl_"), "role").alias("table_name")))
    )
    return LN.referenced_sources(reg, known, MD.models_of_type(reg, "hub"))


_BURSTS_SQL = f"""with marked as (
  select *, case when lag(ts) over w is null or ts >= lag(ts) over w + interval {{quiet}} second then 1 else 0 end as opens
  from events window w as (partition by {{key}} order by ts)),
bursts as (
  select *, sum(opens) over (partition by {{key}} order by ts rows unbounded preceding) as burst from marked)
select {{show}}{sql_ts_text('min(ts)')} as burst_start, {sql_ts_text('max(ts) + interval {quiet} second')} as burst_end,
count(*) as n_requests, string_agg(distinct event_type, ',' order by event_type) as "values" from bursts group by {{key}}, burst"""


def _bursts_sql(key: str, show: str, quiet: int) -> str:
    return _BURSTS_SQL.replace("{key}", key).replace("{show}", show).replace("{quiet}", str(quiet))


@query("burst_sessions", _bursts_sql("user_id", "user_id, ", 3600 * 6))
def burst_sessions(spark, sf):
    """Each user's events, six quiet hours apart."""
    out = LN.coalesce_bursts(lake(spark, sf, "events"), "ts", "event_type", 3600 * 6, ["user_id"])
    return timestamps_as_text(out.withColumn("values", joined("values")))


@query("burst_requests", _bursts_sql("'all'", "", 240))
def burst_requests(spark, sf):
    """All events as one queue of requests, four quiet minutes apart."""
    out = LN.coalesce_bursts(lake(spark, sf, "events"), "ts", "event_type", 240, slice_seconds=21_600)
    return timestamps_as_text(out.withColumn("values", joined("values")))


_CHUNKS_SQL = f"""with b as ({_bursts_sql("'all'", "", 240)}),
split as (select *, string_split("values", ',') as v from b)
select burst_start, burst_end, n_requests, r as run, array_to_string(v[r * 2 + 1 : r * 2 + 2], ',') as "values"
from split, lateral (select unnest(generate_series(0, (len(v) - 1) // 2)) as r)"""


@query("burst_chunks", _CHUNKS_SQL)
def burst_chunks(spark, sf):
    """The same bursts in runs of at most two values."""
    out = LN.coalesce_bursts(lake(spark, sf, "events"), "ts", "event_type", 240, slice_seconds=21_600)
    chunks = LN.chunk_bursts(out, 2)
    return timestamps_as_text(chunks.withColumn("values", joined("values")))


@query(
    "reconcile_counts",
    """with counts as (
  select 'events' as t, count(*) as n, count(*) filter (ts < timestamp '2024-01-20') as landed from events
  union all select 'lineitem', count(*), count(*) from lineitem union all select 'orders', count(*), count(*) from orders)
select t as "table", n + 10 * (t = 'events')::int as target, landed, landed >= n + 10 * (t = 'events')::int as reached,
greatest(n + 10 * (t = 'events')::int - landed, 0) as short from counts""",
)
def reconcile_counts(spark, sf):
    """Events from 20 January on have not landed; ten were expected before."""
    expected = cdc.cdc_counts(envelopes(spark, sf))
    early = (F.col("table") != "events") | (F.col("cdc_modified_at") < "2024-01-20")
    landed = cdc.cdc_counts(consumed(spark, sf).filter(early))
    base = spark.createDataFrame([("events", 10)], "table string, n_rows bigint")
    return LN.reconcile(expected, landed, base)
