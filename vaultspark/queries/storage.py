"""Queries that write bronze and vault stores below the shared folder and read them back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import timestamps_as_text, utc_literal
from ..operators import cdc
from ..operators import envelope as EV
from ..operators import evolve as E
from ..operators import lineage as LN
from ..operators import vault as V
from ..plans.capture import OUTBOX, capture, capture_job, stored_marks, write_outbox
from ..plans.load import initial_load, load_outcomes, load_vault, start_up_gap
from ..session import keep, scratch_path
from ..sources import bronze_schema as BS
from ..sources import envelopes as ES
from ..sources import lake as L
from ..sources import storage as S
from ..streaming import start_bronze_stream, vault_refresher
from .common import (
    CHANGE_COLUMNS, T0, T0_SQL, T1, T1_SQL, catalog, columns_of, consumed, lake, query, registry, sql_hash, sql_iso, sql_text, with_models)

_ORDERS_TEXT = ", ".join(
    f"{sql_iso(c) if c == CHANGE_COLUMNS['orders'] else sql_text('orders', c)} as {c}" for c in columns_of("orders")
)


@query("bronze_landing", f"select {_ORDERS_TEXT} from orders")
def bronze_landing(spark, sf):
    """Two streams, whose batch numbers are the same, land in one root; one batch is replayed."""
    root = scratch_path(spark, "bronze")
    landed = EV.land_payload(EV.add_audit(consumed(spark, sf, ["orders"]), T0))
    half = F.crc32(F.to_json("fields")) % 2
    for part in (0, 1, 0):
        S.write_bronze(landed.filter(half == part), root, 0, f"stream{part}")
    return EV.widen(S.read_bronze(spark, root, "orders").select("fields"), columns_of("orders"))


@query("capture_job", f"select {_ORDERS_TEXT} from orders")
def capture_published(spark, sf):
    """Two runs, the second over more rows, then one without news; what was published, read back."""
    root = scratch_path(spark, "capture")
    orders = lake(spark, sf, "orders")
    marks, topic = f"{root}/marks", f"{root}/topic"
    for rows in (orders.filter("o_orderdate < timestamp_ntz'1998-01-01 00:00:00'"), orders, orders):
        capture_job(spark, {"orders": rows}, CHANGE_COLUMNS, marks, "text", topic)
    parsed = EV.parse_envelopes(ES.envelope_batch(spark, "text", topic))
    return EV.parse_payload(parsed, columns_of("orders")).drop("cdc_type", "cdc_modified_at")


@query("capture_replayed", f"select {_ORDERS_TEXT} from orders")
def capture_replayed(spark, sf):
    """A run stops between publishing and its marks; the next one sends the outbox again, the stream lands each row once."""
    root = scratch_path(spark, "capture")
    orders = lake(spark, sf, "orders")
    marks, topic, bronze = f"{root}/marks", f"{root}/topic", f"{root}/bronze"
    write_outbox(capture({"orders": orders}, CHANGE_COLUMNS, stored_marks(spark, marks))[0], f"{marks}/{OUTBOX}", 1)
    ES.publish_envelopes(S.read_snapshot(spark, f"{marks}/{OUTBOX}"), "text", topic)
    for _ in range(2):  # the repeat, and a run without news
        capture_job(spark, {"orders": orders}, CHANGE_COLUMNS, marks, "text", topic)
    stream = start_bronze_stream(
        ES.envelope_stream(spark, "text", topic), bronze, f"{root}/checkpoint", f"replayed-{uuid.uuid4().hex}", trigger=None,
        replay_window="1 hour")
    stream.awaitTermination()
    return EV.widen(S.read_bronze(spark, bronze, "orders").select("fields"), columns_of("orders"))


_SAT = [c for c in columns_of("orders") if not c.endswith("key")]


@query(
    "vault_reload",
    f"""select 'hub_order' as model_name, cast(o_orderkey as varchar) as key, null as hashdiff from (select distinct o_orderkey from orders)
    union all select 'link_order_o_cust', concat_ws('|', o_orderkey, o_custkey), null from (select distinct o_orderkey, o_custkey from orders)
    union all select 'sat_order', cast(o_orderkey as varchar), {sql_hash('orders', _SAT)}
    from (select distinct o_orderkey, {', '.join(_SAT)} from orders)""",
)
def vault_reload(spark, sf):
    """A part is loaded twice under one id, then everything under an id that sorts before it."""
    root = scratch_path(spark, "vault")
    orders = lake(spark, sf, "orders")
    models = registry(spark, sf).filter("table_name = 'orders'")
    part = {"orders": orders.filter(F.crc32(F.col("o_orderkey").cast("string")) % 3 == 0)}
    load_vault(models, part, root, "b")
    load_vault(models, part, root, "b")
    load_vault(models, {"orders": orders}, root, "a")

    def shown(name: str, keys: list[str]) -> DataFrame:
        rows = S.read_vault(spark, f"{root}/{name}")
        digest = F.col("hashdiff") if "hashdiff" in rows.columns else F.lit(None).cast("string")
        return rows.select(F.lit(name).alias("model_name"), F.concat_ws("|", *keys).alias("key"), digest.alias("hashdiff"))

    return reduce(DataFrame.unionByName, [
        shown("hub_order", ["o_orderkey"]), shown("link_order_o_cust", ["o_orderkey", "o_custkey"]), shown("sat_order", ["o_orderkey"])])


# In the second load every third order has moved on to another status.
_MOVED = "case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end"
_SAT_ROWS = f"select distinct cast(o_orderkey as varchar) as key, {sql_hash('orders', _SAT)} as hashdiff"
_LOADS_SQL = f"""with first_load as ({_SAT_ROWS} from orders where o_orderkey % 2 = 0),
second_load as ({_SAT_ROWS} from (select * replace ({_MOVED} as o_orderstatus) from orders where o_orderkey % 5 > 0))"""


def _two_loads(spark, sf, mode: str) -> DataFrame:
    """Rows of the orders' satellite after a load of the even orders and one of most orders, some moved on."""
    root = scratch_path(spark, "vault")
    orders = lake(spark, sf, "orders")
    models = registry(spark, sf).filter("model_name = 'sat_order'")
    load_vault(models, {"orders": orders.filter("o_orderkey % 2 = 0")}, root, "a", T0, buckets=16)
    moved = orders.withColumn("o_orderstatus", F.expr(_MOVED)).filter("o_orderkey % 5 > 0")
    load_vault(models, {"orders": moved}, root, "b", T1, mode=mode)
    rows = S.read_vault(spark, f"{root}/sat_order")
    return timestamps_as_text(rows.select(F.col("o_orderkey").alias("key"), "hashdiff", "load_datetime"))


@query(
    "vault_incremental",
    f"""{_LOADS_SQL}
select key, hashdiff, {T0_SQL} as load_datetime from first_load union all
select key, hashdiff, {T1_SQL} from second_load where (key, hashdiff) not in (select key, hashdiff from first_load)""",
)
def vault_incremental(spark, sf):
    """An incremental load into a bucketed table: known rows keep their time."""
    return _two_loads(spark, sf, "append")


@query(
    "vault_refresh",
    f"""{_LOADS_SQL}
select key, hashdiff, {T1_SQL} as load_datetime from second_load union all
select key, hashdiff, {T0_SQL} from first_load where (key, hashdiff) not in (select key, hashdiff from second_load)""",
)
def vault_refresh(spark, sf):
    """The same loads, the second as a refresh: loaded rows take the new time, others stay."""
    return _two_loads(spark, sf, "refresh")


@query(
    "vault_create_if_absent",
    f"select distinct cast(c_custkey as varchar) as c_custkey, {T0_SQL} as load_datetime from customer where c_custkey % 2 = 0",
)
def vault_create_if_absent(spark, sf):
    """A table is created once; what a second creation brings is ignored."""
    path = scratch_path(spark, "created")
    rows = lake(spark, sf, "customer").select(F.col("c_custkey").cast("string"))
    S.create_if_absent(V.load_hub(rows.filter("c_custkey % 2 = 0"), ["c_custkey"], "customer", T0), path, "1")
    S.create_if_absent(V.load_hub(rows, ["c_custkey"], "customer", T1), path, "2")
    return timestamps_as_text(S.read_vault(spark, path).select("c_custkey", "load_datetime"))


@query(
    "bronze_tables_landed",
    """select 'lineitem' as table_name, count(*) as n_rows, count(l_shipdate) as dated from lineitem union all
select 'orders', count(*), count(o_orderdate) from orders""",
)
def bronze_tables_landed(spark, sf):
    """Three tables land in one write, each in its own partition; one of them is truncated."""
    root = scratch_path(spark, "bronze")
    S.land_bronze(EV.add_audit(consumed(spark, sf), T0), root, 0, "s")
    S.truncate_bronze(spark, root, "EVENTS")
    wide = EV.widen(S.read_bronze(spark, root).select("table", "fields"), ["l_shipdate", "o_orderdate"])
    return wide.groupBy(F.col("table").alias("table_name")).agg(
        F.count("*").alias("n_rows"), F.count(F.coalesce("l_shipdate", "o_orderdate")).alias("dated"))


@query(
    "bronze_catch_up",
    """select 'hub_order' as model_name, cast(o_orderkey as varchar) as key from (select distinct o_orderkey from orders) union all
select 'link_order_o_cust', concat_ws('|', o_orderkey, o_custkey) from (select distinct o_orderkey, o_custkey from orders)""",
)
def bronze_catch_up(spark, sf):
    """Two streams land batches, the vault takes in one of them, misses the rest, and catches up; again finds nothing."""
    root, vault = scratch_path(spark, "bronze"), scratch_path(spark, "vault")
    landed = EV.land_payload(EV.add_audit(consumed(spark, sf, ["orders"]), T0))
    number = F.pmod(F.xxhash64(F.to_json("fields")), F.lit(6))
    models = registry(spark, sf).filter("table_name = 'orders' and model_type <> 'sat'")
    refresh = vault_refresher(spark, models, root, vault)
    for batch in range(3):
        for stream in (0, 1):
            S.write_bronze(landed.filter(number == 2 * batch + stream), root, batch, f"stream{stream}")
        if batch == 0:
            refresh({"orders": 1}, batch)
    for _ in range(2):  # a new refresher knows from the ledger what is loaded
        vault_refresher(spark, models, root, vault).flush()
    tables = {"hub_order": ["o_orderkey"], "link_order_o_cust": ["o_orderkey", "o_custkey"]}
    return reduce(DataFrame.unionByName, [
        S.read_vault(spark, f"{vault}/{name}").select(F.lit(name).alias("model_name"), F.concat_ws("|", *keys).alias("key"))
        for name, keys in tables.items()])


@query(
    "metadata_log",
    with_models("""select target_model, count(*) as entries, count(distinct lineage_id) as ids from (
  select model_name as target_model, model_name as lineage_id from models union all
  select model_name, model_name from models where table_name = 'orders') group by 1"""),
)
def metadata_log(spark, sf):
    """The lineage log after all models were logged, and those of one table once more; ids follow from the content."""
    path = scratch_path(spark, "log")
    models = registry(spark, sf)
    S.append_log(LN.lineage(models, utc_literal(T0)), path)
    S.append_log(LN.lineage(models.filter("table_name = 'orders'"), utc_literal(T1)), path)
    return spark.read.parquet(path).groupBy("target_model").agg(
        F.count("*").alias("entries"), F.countDistinct("lineage_id").alias("ids"))


_LATE = "case when o_orderkey % 2 = 1 then o_orderpriority end"
_ORDER_COLUMNS = [c for c in columns_of("orders") if c != "o_orderpriority"]


@query(
    "bronze_schema_log",
    "with o as (select * replace (" + _LATE + """ as o_orderpriority) from orders)
select 'orders' as table_name, column_name, ordinal, n_values from (values """
    + ", ".join(f"('{c}', {i})" for i, c in enumerate([*_ORDER_COLUMNS, "o_orderpriority"], 1))
    + ") t(column_name, ordinal) join (unpivot (select "
    + ", ".join(f"count({c}) as {c}" for c in columns_of("orders"))
    + """ from o) on columns(*) into name column_name value n_values) using (column_name)
union all select 'pages', column_name, ordinal, (select count(*) from pages) from (values ('page_id', 1), ('url', 2), ('html', 3)) t(column_name, ordinal)
union all select 'region', 'r_regionkey', 1, 0 union all select 'region', 'r_name', 2, 0""",
)
def bronze_schema_log(spark, sf):
    """Bronze is created without a column, rows land, the lake gains the column, more rows land; a table is adopted."""
    root = scratch_path(spark, "bronze")
    orders, everything = lake(spark, sf, "orders"), L.lake_catalog(spark, sf)
    early = everything.filter("table_name in ('orders', 'region') and column_name <> 'o_orderpriority'")
    BS.match_lake(spark, root, early)
    for batch, rows in enumerate((orders.filter("o_orderkey % 2 = 0").drop("o_orderpriority"), orders.filter("o_orderkey % 2 = 1"))):
        sent = cdc.cdc_full(rows, "orders", CHANGE_COLUMNS["orders"]).withColumnRenamed("cdc_ingestion_timestamp", "cdc_modified_at")
        S.land_bronze(EV.add_audit(sent, T0), root, batch, "s")
        BS.match_lake(spark, root, everything.filter("table_name = 'orders'"))
    for _ in range(2):
        BS.adopt_table(lake(spark, sf, "pages"), root, "pages", T1, "adopted")

    def shown(table: str) -> DataFrame:
        rows = BS.read_table(spark, root, table)
        columns = [c for c in rows.columns if not c.startswith("__")]
        counts = rows.agg(*[F.count(c).alias(c) for c in columns])
        listed = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("ordinal"), F.col(c).alias("n_values")) for i, c in enumerate(columns, 1)]))
        return counts.select(F.lit(table).alias("table_name"), listed.alias("c")).select("table_name", "c.*")

    return reduce(DataFrame.unionByName, [shown(t) for t in ("orders", "pages", "region")])


@query(
    "vault_start_up",
    with_models("""select 'before' as stage, table_name, model_name, 'no_table' as gap from models where table_name in ('customer', 'nation')
union all select stage, table_name, null, 'no_model' from (select distinct table_name from models) t, (values ('before'), ('after')) s(stage)
where table_name not in ('customer', 'nation', 'region')"""),
)
def vault_start_up(spark, sf):
    """What a start-up finds missing in a vault of one table, and what is left once it has loaded the rest."""
    root = scratch_path(spark, "vault")
    models = registry(spark, sf).filter("table_name in ('customer', 'nation', 'region')")
    load_vault(models, {"region": lake(spark, sf, "region")}, root, "0")
    found = []
    for stage in ("before", "after"):
        found.append(keep(start_up_gap(spark, sf, models, root).select(F.lit(stage).alias("stage"), "*")))
        initial_load(spark, sf, models, root, stage)
    return found[0].unionByName(found[1])


@query(
    "evolution_load_outcomes",
    """select * from (values
(1, 'OPERATION_STATUS_TRANSIENT_ERROR', 'VAULT_ADD_COLUMN_TRANSIENT'), (2, 'OPERATION_STATUS_PERMANENT_ERROR', 'VAULT_ADD_COLUMN_FAILED'),
(3, 'OPERATION_STATUS_TRANSIENT_ERROR', 'VAULT_NEW_HUB_TRANSIENT'), (4, 'OPERATION_STATUS_PERMANENT_ERROR', 'VAULT_NEW_LINK_FAILED_PERMANENT'),
(5, 'OPERATION_STATUS_OK', ''), (6, 'OPERATION_STATUS_OK', '')) t(seq, status, error_code)
where (select count(*) from orders) + (select count(*) from part) + (select count(*) from customer) + (select count(*) from supplier) > 0""",
)
def evolution_load_outcomes(spark, sf):
    """Operations whose models fail to load answer for it; others, on the same tables or not, do not."""
    everything = registry(spark, sf)
    columns = catalog(spark, sf)
    ops = spark.createDataFrame(
        [(k, f"c{k}", "", f"i{k}", "LAYER_VAULT", kind, table, {"column_name": column} if column else {}) for k, (kind, table, column) in enumerate([
            (E.ADD_COLUMN, "orders", "late"), (E.ADD_COLUMN, "part", "late"), (E.NEW_HUB, "customer", None),
            (E.NEW_LINK, "supplier", None), (E.ADD_COLUMN, "nation", "late"), (E.NEW_HUB, "orders", None)], 1)],
        "seq bigint, correlation_id string, plan_id string, idempotency_key string, layer string, kind string, target string, params map<string,string>")
    # The vault knows these tables' models but for the hubs of two and the links of one.
    known = everything.filter(
        "table_name in ('orders', 'part', 'nation', 'customer', 'supplier') and model_name not in ('hub_order', 'hub_customer') "
        "and not (table_name = 'supplier' and model_type = 'link')")
    done = E.apply_batch(ops, known, columns)

    def broken(table: str, column: str, message: str) -> DataFrame:
        return lake(spark, sf, table).withColumn(column, F.raise_error(F.lit(message)).cast("string"))

    sources = {
        "orders": broken("orders", "late", "java.net.ConnectException: Connection refused"), "part": broken("part", "late", "no such unit"),
        "customer": broken("customer", "c_custkey", "key out of range"), "supplier": broken("supplier", "s_nationkey", "key out of range"),
        "nation": lake(spark, sf, "nation").withColumn("late", F.lit("x"))}
    queued = done.registry.join(done.queued.select("model_name").distinct(), "model_name", "left_semi")
    outcomes = load_outcomes(queued, sources, scratch_path(spark, "vault"), "1", T0)
    return E.with_load_outcomes(done.results, done.registry, outcomes).select("seq", "status", "error_code")
