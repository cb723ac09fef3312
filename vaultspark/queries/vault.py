"""Vault loads and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.canonical import hashdiff, timestamps_as_text
from ..operators import vault as V
from ..plans.load import vault_row_counts as count_rows
from ..sources.lake import read_lake_tables
from .common import (
    T0,
    T0_SQL,
    T1,
    T1_SQL,
    columns_of,
    lake,
    query,
    registry,
    sql_hash,
    sql_ts_text,
    type_of,
    with_models,
)

CUSTOMER = ["c_name", "c_acctbal", "c_mktsegment"]
EVENT = ["ts", "event_type", "value", "props"]
LINEITEM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDER = ["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _shown(table: str, columns: list[str]) -> str:
    return ", ".join(
        f"{sql_ts_text(c)} as {c}" if type_of(table, c) == "timestamp_ntz" else c for c in columns
    )


def _audit(table: str, at: str = T0_SQL) -> str:
    return f"{at} as load_datetime, '{table}' as record_source"


def _keys_sql(table: str, keys: list[str]) -> str:
    return f"select distinct {', '.join(keys)}, {_audit(table)} from {table}"


def _sat_sql(table: str, keys: list[str], attrs: list[str]) -> str:
    cols = _shown(table, [*keys, *attrs])
    return f"select distinct {cols}, {sql_hash(table, attrs)} as hashdiff, {_audit(table)} from {table}"


def _hub(spark, sf, table, keys):
    return timestamps_as_text(V.load_hub(lake(spark, sf, table), keys, table, T0))


def _sat(spark, sf, table, keys, attrs):
    return timestamps_as_text(V.load_satellite(lake(spark, sf, table), keys, attrs, table, T0))


@query("hub_customer", _keys_sql("customer", ["c_custkey"]))
def hub_customer(spark, sf):
    return _hub(spark, sf, "customer", ["c_custkey"])


@query("hub_event", _keys_sql("events", ["event_id"]))
def hub_event(spark, sf):
    return _hub(spark, sf, "events", ["event_id"])


@query("hub_lineitem", _keys_sql("lineitem", ["l_orderkey"]))
def hub_lineitem(spark, sf):
    return _hub(spark, sf, "lineitem", ["l_orderkey"])


@query("link_order_cust", _keys_sql("orders", ["o_orderkey", "o_custkey"]))
def link_order_cust(spark, sf):
    return timestamps_as_text(V.load_link(lake(spark, sf, "orders"), ["o_orderkey", "o_custkey"], "orders", T0))


@query("link_lineitem_part", _keys_sql("lineitem", ["l_orderkey", "l_partkey"]))
def link_lineitem_part(spark, sf):
    return timestamps_as_text(V.load_link(lake(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"], "lineitem", T0))


@query("hashdiff_events", f"select event_id, {sql_hash('events', EVENT)} as hashdiff from events")
def hashdiff_events(spark, sf):
    rows = lake(spark, sf, "events")
    return rows.select("event_id", hashdiff(rows, EVENT).alias("hashdiff"))


@query("sat_no_attributes", _sat_sql("orders", ["o_custkey"], []))
def sat_no_attributes(spark, sf):
    return _sat(spark, sf, "orders", ["o_custkey"], [])


@query("sat_customer", _sat_sql("customer", ["c_custkey"], CUSTOMER))
def sat_customer(spark, sf):
    return _sat(spark, sf, "customer", ["c_custkey"], CUSTOMER)


@query("sat_event", _sat_sql("events", ["event_id"], EVENT))
def sat_event(spark, sf):
    return _sat(spark, sf, "events", ["event_id"], EVENT)


@query("sat_order", _sat_sql("orders", ["o_orderkey"], ORDER))
def sat_order(spark, sf):
    return _sat(spark, sf, "orders", ["o_orderkey"], ORDER)


@query("sat_document", _sat_sql("documents", ["doc_id"], ["text", "lang", "source", "n_chars"]))
def sat_document(spark, sf):
    return _sat(spark, sf, "documents", ["doc_id"], ["text", "lang", "source", "n_chars"])


@query("sat_lineitem", _sat_sql("lineitem", ["l_orderkey"], LINEITEM))
def sat_lineitem(spark, sf):
    return _sat(spark, sf, "lineitem", ["l_orderkey"], LINEITEM)


# Merges: the first load took the even keys at T0, the second takes all at T1.


def _merged_at(key: str) -> str:
    return f"case when {key} % 2 = 0 then {T0_SQL} else {T1_SQL} end as load_datetime"


@query("merge_hub", f"select distinct c_custkey, {_merged_at('c_custkey')}, 'customer' as record_source from customer")
def merge_hub(spark, sf):
    rows = lake(spark, sf, "customer")
    target = V.load_hub(rows.filter("c_custkey % 2 = 0"), ["c_custkey"], "customer", T0)
    new = V.load_hub(rows, ["c_custkey"], "customer", T1)
    return timestamps_as_text(V.merge_hub(target, new, ["c_custkey"]))


@query(
    "merge_link",
    f"""select distinct l_orderkey, l_suppkey, {_merged_at('l_orderkey')}, 'lineitem' as record_source from lineitem""",
)
def merge_link(spark, sf):
    keys = ["l_orderkey", "l_suppkey"]
    rows = lake(spark, sf, "lineitem")
    target = V.load_link(rows.filter("l_orderkey % 2 = 0"), keys, "lineitem", T0)
    return timestamps_as_text(V.merge_hub(target, V.load_link(rows, keys, "lineitem", T1), keys))


# In the second load every third order has moved on to another status.
_MOVED = "case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end"
_ORDER_SHOWN = f"o_totalprice, {sql_ts_text('o_orderdate')} as o_orderdate, o_orderpriority"
_ORDER_SAT = f"o_orderkey, o_orderstatus, {_ORDER_SHOWN}, {sql_hash('orders', ORDER)} as hashdiff"
_MERGE_SAT_SQL = f"""with first_load as (select distinct {_ORDER_SAT} from orders where o_orderkey % 2 = 0),
second_load as (select distinct {_ORDER_SAT} from (select * replace ({_MOVED} as o_orderstatus) from orders))"""


def _order_loads(spark, sf):
    rows = lake(spark, sf, "orders")
    moved = rows.withColumn("o_orderstatus", F.expr(_MOVED))
    first = V.load_satellite(rows.filter("o_orderkey % 2 = 0"), ["o_orderkey"], ORDER, "orders", T0)
    return first, V.load_satellite(moved, ["o_orderkey"], ORDER, "orders", T1)


@query(
    "merge_satellite",
    f"""{_MERGE_SAT_SQL}
select *, {_audit('orders')} from first_load union all
select *, {_audit('orders', T1_SQL)} from second_load s where not exists
(select 1 from first_load f where f.o_orderkey = s.o_orderkey and f.hashdiff = s.hashdiff)""",
)
def merge_satellite(spark, sf):
    target, new = _order_loads(spark, sf)
    return timestamps_as_text(V.merge_satellite(target, new, ["o_orderkey"]))


@query(
    "merge_refresh",
    f"""{_MERGE_SAT_SQL}
select *, {_audit('orders', T1_SQL)} from second_load union all
select *, {_audit('orders')} from first_load f where not exists
(select 1 from second_load s where f.o_orderkey = s.o_orderkey and f.hashdiff = s.hashdiff)""",
)
def merge_refresh(spark, sf):
    target, new = _order_loads(spark, sf)
    return timestamps_as_text(V.merge_refresh(target, new, V.merge_keys("sat", ["o_orderkey"])))


@query(
    "append_new_columns",
    """select event_id, ts, event_type, value, null as props from (
  select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, event_type, value from events where event_id % 2 = 0)
union all
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S'), event_type, value, props from events where event_id % 2 = 1""",
)
def append_new_columns(spark, sf):
    """Rows loaded before and after a column came up."""
    rows = lake(spark, sf, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    before = rows.filter("event_id % 2 = 0").select("event_id", "ts", "event_type", "value")
    after = rows.filter("event_id % 2 = 1").select("event_id", "ts", "event_type", "value", "props")
    return V.append_new_columns(before, after)


_ROW_COUNTS = [
    ("benchmark", "item_id", []), ("conversations", "conv_id", []), ("customer", "c_custkey", ["c_nationkey"]),
    ("documents", "doc_id", []), ("embeddings", "vec_id", []), ("events", "event_id", ["user_id"]),
    ("labels", "doc_id", []), ("lineitem", "l_orderkey", ["l_partkey", "l_suppkey", "l_linenumber"]),
    ("nation", "n_nationkey", ["n_regionkey"]), ("orders", "o_orderkey", ["o_custkey"]), ("pages", "page_id", []),
    ("part", "p_partkey", []), ("region", "r_regionkey", []), ("supplier", "s_suppkey", ["s_nationkey"]),
]


def _row_counts_sql() -> str:
    links = {"c_nationkey": "c_nation", "user_id": "user", "l_partkey": "l_part", "l_suppkey": "l_supp",
             "l_linenumber": "l_line", "n_regionkey": "n_region", "o_custkey": "o_cust", "s_nationkey": "s_nation"}
    parts = []
    for table, key, fks in _ROW_COUNTS:
        one = table[:-1] if table.endswith("s") else table
        attrs = [c for c in columns_of(table) if c != key and c not in fks]
        models = [(f"hub_{one}", "hub", [key])]
        models += [(f"sat_{one}", "sat", [key, *attrs])] if attrs else []
        models += [(f"link_{one}_{links[fk]}", "link", [key, fk]) for fk in fks]
        parts += [
            f"select '{name}' as model_name, '{kind}' as model_type, '{table}' as table_name, "
            f"(select count(*) from (select distinct {', '.join(cols)} from {table})) as n_rows"
            for name, kind, cols in models
        ]
    return " union all ".join(parts)


@query("vault_row_counts", _row_counts_sql())
def vault_row_counts(spark, sf):
    """Every model of every table: the size of the whole vault after a first load."""
    return count_rows(registry(spark, sf), read_lake_tables(spark, sf))


@query(
    "vault_gap",
    with_models(
        """, known as (select * from models where table_name < 'p')
select table_name, model_name, 'no_table' as gap from known where model_type <> 'hub'
union all
select distinct table_name, null, 'no_model' from catalog where table_name not in (select table_name from known)"""
    ),
)
def vault_gap(spark, sf):
    """Tables from 'p' on have no model; of the models only hubs are built."""
    reg = registry(spark, sf)
    known = reg.filter("table_name < 'p'")
    built = known.filter("model_type = 'hub'").select(F.col("model_name").alias("table_name"))
    return V.vault_gap(reg.select("table_name").distinct(), known, built)
