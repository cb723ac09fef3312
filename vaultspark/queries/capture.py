"""Lake discovery and change capture."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.canonical import timestamps_as_text
from ..operators import cdc
from ..operators import envelope as EV
from ..plans.capture import capture
from ..session import scratch_path
from ..sources import envelopes as ES
from ..sources import lake as L
from .common import (
    CHANGE_COLUMNS,
    COUNTED,
    TABLES,
    catalog,
    columns_of,
    consumed,
    envelopes,
    lake,
    query,
    sql_iso,
    sql_payload,
    sql_ts_text,
    with_catalog,
    with_counts,
)

MARK = dt.datetime(2024, 1, 15)


def _counts_sql(tables: dict) -> str:
    return " union all ".join(f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in tables)


@query("lake_tables", _counts_sql(TABLES))
def lake_tables(spark, sf):
    """Every table found under the root, read whole."""
    out = None
    for table in L.list_lake_tables(spark, sf):
        rows = lake(spark, sf, table).agg(F.count(F.lit(1)).alias("n_rows"))
        rows = rows.select(F.lit(table).alias("table_name"), "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("lake_catalog", f"with {COUNTED} select * from counted")
def lake_catalog(spark, sf):
    return with_counts(spark, sf, catalog(spark, sf))


@query(
    "read_lake_orders",
    f"select o_orderkey, o_custkey, o_totalprice, {sql_ts_text('o_orderdate')} as o_orderdate from orders",
)
def read_lake_orders(spark, sf):
    """A projected scan under another spelling of the name."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    return timestamps_as_text(L.read_lake(spark, sf, "public.Orders", columns))


def _envelope_sql(table: str, where: str = "") -> str:
    ts = CHANGE_COLUMNS[table]
    return (
        f'select \'{table}\' as "table", {sql_payload(table, ts)} as payload, \'insert\' as cdc_type, '
        f"{sql_iso(ts)} as cdc_ingestion_timestamp from {table} {where}"
    )


@query("cdc_full_load", _envelope_sql("orders"))
def cdc_full_load(spark, sf):
    return cdc.cdc_full(lake(spark, sf, "orders"), "orders", "o_orderdate")


@query("cdc_incremental", _envelope_sql("events", "where ts > timestamp '2024-01-15'"))
def cdc_incremental(spark, sf):
    return cdc.cdc_incremental(lake(spark, sf, "events"), "events", "ts", MARK)


@query("payload_encode", f"select l_orderkey, {sql_payload('lineitem', 'l_shipdate')} as payload from lineitem")
def payload_encode(spark, sf):
    rows = lake(spark, sf, "lineitem")
    return rows.select("l_orderkey", cdc.payload(rows, "l_shipdate").alias("payload"))


_OLD_MARKS = [("orders", dt.datetime(2030, 1, 1)), ("lineitem", dt.datetime(1990, 1, 1)), ("gone", dt.datetime(2000, 1, 1))]


@query(
    "cdc_watermarks",
    f"""with seen as (
  select 'events' as table_name, max(ts) as m from events
  union all select 'orders', max(o_orderdate) from orders
  union all select 'lineitem', max(l_shipdate) from lineitem),
old as (select * from (values ('orders', timestamp '2030-01-01'), ('lineitem', timestamp '1990-01-01'),
  ('gone', timestamp '2000-01-01')) v(table_name, w)),
new as (select table_name, case when m is null then w when w is null then m else greatest(m, w) end as watermark
  from seen full join old using (table_name))
select table_name, {sql_ts_text('watermark')} as watermark from new""",
)
def cdc_watermarks(spark, sf):
    changes = None
    for table, ts_col in CHANGE_COLUMNS.items():
        marks = cdc.change_marks(lake(spark, sf, table), table, ts_col)
        changes = marks if changes is None else changes.unionByName(marks)
    old = spark.createDataFrame(_OLD_MARKS, "table_name string, watermark timestamp")
    return timestamps_as_text(cdc.advance_watermarks(changes, old))


@query(
    "watermarks_valid",
    f"""select 'feed_' || event_id as table_name, {sql_ts_text('ts')} as watermark
from events where event_type not in ('error', 'view')""",
)
def watermarks_valid(spark, sf):
    """One stored mark per event; some event types store text that is no time."""
    e = lake(spark, sf, "events")
    raw = e.select(
        F.concat(F.lit("feed_"), "event_id").alias("table_name"),
        F.when(F.col("event_type") == "error", F.lit("not a time"))
        .when(F.col("event_type") == "view", F.lit(""))
        .otherwise(F.col("ts").cast("string"))
        .alias("watermark"),
    )
    return timestamps_as_text(cdc.load_watermarks(raw))


@query(
    "watermarks_saved",
    f"select event_type as table_name, {sql_iso('max(ts)')} as watermark from events group by 1",
)
def watermarks_saved(spark, sf):
    marks = lake(spark, sf, "events").groupBy(F.col("event_type").alias("table_name")).agg(
        F.max("ts").alias("watermark")
    )
    return cdc.save_watermarks(marks)


@query(
    "cdc_skip_full_load",
    """select 'events' as "table", count(*) as n_rows from events where ts > timestamp '2024-01-15'
union all select 'lineitem', count(*) from lineitem""",
)
def cdc_skip_full_load(spark, sf):
    """events has a mark; orders has none and is claimed; lineitem has none."""
    tables = {t: lake(spark, sf, t) for t in CHANGE_COLUMNS}
    marks = spark.createDataFrame([("events", MARK)], "table_name string, watermark timestamp")
    out, _ = capture(tables, CHANGE_COLUMNS, marks, {"orders"})
    return cdc.cdc_counts(out)


@query(
    "capture_modes",
    with_catalog(
        """select distinct table_name, case when table_name in ('events') then 'incremental'
when table_name in ('events', 'orders') then 'skip' else 'full' end as mode from catalog"""
    ),
)
def capture_modes(spark, sf):
    marks = spark.createDataFrame([("events", MARK)], "table_name string, watermark timestamp")
    claimed = spark.createDataFrame([("orders",), ("events",)], "table_name string")
    return cdc.capture_modes(catalog(spark, sf).select("table_name"), marks, claimed)


@query(
    "cdc_eligible_tables",
    with_catalog(
        "select distinct table_name from catalog where column_name in ('ts', 'l_shipdate', 'o_orderdate')"
    ),
)
def cdc_eligible_tables(spark, sf):
    return cdc.tables_with_cdc_column(catalog(spark, sf), list(CHANGE_COLUMNS.values()))


@query("cdc_counts", _counts_sql(CHANGE_COLUMNS).replace("table_name", '"table"'))
def cdc_counts(spark, sf):
    return cdc.cdc_counts(envelopes(spark, sf))


@query(
    "envelope_batch_counts",
    """select 'events' as "table", count(*) as n_rows, count(distinct event_id) as n_payloads from events
union all select 'orders', count(*), count(distinct o_orderkey) from orders""",
)
def envelope_batch_counts(spark, sf):
    """Publish envelopes to files, read them all back."""
    path = scratch_path(spark, "envelopes")
    ES.publish_envelopes(envelopes(spark, sf, ["events", "orders"]), "text", path)
    rows = EV.parse_envelopes(ES.envelope_batch(spark, "text", path))
    return rows.groupBy("table").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("payload").alias("n_payloads")
    )


def _messages(spark, sf):
    """Messages of the orders: sound ones and, by status, broken ones beside them."""
    rows = consumed(spark, sf, ["orders"])
    orders = lake(spark, sf, "orders")
    sound = ES.as_messages(rows.withColumn("table", F.lit("Orders")))
    cut = sound.select(F.expr("substring(value, 1, 20)").alias("value"))
    nameless = ES.as_messages(rows.drop("table"))
    other = orders.select(
        F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(F.lit("[1, 2]")).cast("string").alias("value")
    )
    return sound.unionByName(cut).unionByName(nameless).unionByName(other)


@query(
    "parse_envelopes",
    f"""select 'Orders' as "table", {sql_payload('orders', 'o_orderdate')} as payload, 'insert' as cdc_type,
{sql_iso('o_orderdate')} as cdc_modified_at from orders""",
)
def parse_envelopes(spark, sf):
    return EV.parse_envelopes(_messages(spark, sf))


@query("envelope_tables", """select 'orders' as "table", count(*) as n_rows from orders""")
def envelope_tables(spark, sf):
    rows = EV.normalize_table(EV.parse_envelopes(_messages(spark, sf)))
    return rows.groupBy("table").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "allow_tables",
    """select 'events' as "table", count(*) as n_rows from events
union all select 'lineitem', count(*) from lineitem""",
)
def allow_tables(spark, sf):
    rows = EV.allow_tables(consumed(spark, sf), ["EVENTS", " lineitem ", "absent"])
    return rows.groupBy("table").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "route_one_table",
    "select cast(o_orderkey as varchar) as o_orderkey, cast(o_totalprice as varchar) as o_totalprice, "
    "cast(null as varchar) as not_there from orders",
)
def route_one_table(spark, sf):
    schema = L.bronze_schema(["o_orderkey", "o_totalprice", "not_there"])
    return EV.route_one(consumed(spark, sf), "orders", schema)


def _keys_sql(tables) -> str:
    return " union all ".join(
        f"select '{t}' as \"table\", {i} as position, '{c}' as column_name from {t} having count({c}) > 0"
        for t in tables
        for i, c in enumerate(columns_of(t))
    )


@query("payload_keys", _keys_sql(CHANGE_COLUMNS))
def payload_keys(spark, sf):
    return EV.payload_keys(consumed(spark, sf))


@query("payload_keys_history", _keys_sql(["lineitem", "orders"]))
def payload_keys_history(spark, sf):
    """The history is the topic from its start; the events' columns are known already."""
    history = EV.parse_envelopes(ES.as_messages(consumed(spark, sf)))
    known = spark.createDataFrame([("events",)], "table string")
    return EV.payload_keys_from_history(history, known)


def _wide_sql(table: str, extra: str = "") -> str:
    ts = CHANGE_COLUMNS[table]
    texts = ", ".join(
        f"{sql_iso(c) if c == ts else f'cast({c} as varchar)'} as {c}" for c in columns_of(table)
    )
    return f"select {texts}, 'insert' as cdc_type, {sql_iso(ts)} as cdc_modified_at{extra} from {table}"


@query("bronze_wide_orders", _wide_sql("orders", ", cast(null as varchar) as o_later"))
def bronze_wide_orders(spark, sf):
    """Payloads widened to the table's columns and one that no payload has yet."""
    columns = [*columns_of("orders"), "o_later"]
    return EV.parse_payload(consumed(spark, sf, ["orders"]), columns)


@query(
    "bronze_audit",
    _wide_sql("events", ", '2024-02-01 00:00:00' as __ingested_at, 'kafka_cdc' as __record_source"),
)
def bronze_audit(spark, sf):
    rows = EV.parse_payload(consumed(spark, sf, ["events"]), columns_of("events"))
    return timestamps_as_text(EV.add_audit(rows, dt.datetime(2024, 2, 1)))


@query(
    "batch_touched",
    """select 'lineitem' as "table", count(*) as n_rows from lineitem
union all select 'orders', count(*) from orders""",
)
def batch_touched(spark, sf):
    """The events carry no payload here, so their table is not touched."""
    rows = consumed(spark, sf)
    emptied = F.when(F.col("table") != "events", F.col("payload"))
    return EV.touched_tables(rows.withColumn("payload", emptied))
