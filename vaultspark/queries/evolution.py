"""Schema evolution. Every event stands for one operation request.

The target follows the user, the kind the event type, and the ``k`` in the
event's properties decides the column, gaps and errors. The registry covers the
tables before 'l'; the others, and the made-up table ``ghosts``, have no models.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.canonical import timestamps_as_text
from ..operators import evolve as E
from ..operators import modelling as MD
from ..plans.load import model_rows
from .common import (
    T0,
    TABLES,
    catalog,
    joined,
    lake,
    query,
    sql_hash,
    sql_singular,
    with_models,
)
from .modelling import _INFER
from .vault import EVENT, _audit, _shown

TARGETS = [*TABLES, "ghosts"]

# One text for both engines: only functions that Spark and DuckDB share.
_K = "cast(substr(props, 7, length(props) - 7) as int)"  # from {"k": 42}
_OPS = f"""select event_id as seq, concat('c', event_id) as correlation_id,
  case when k < 10 then '' else concat('plan-', user_id) end as plan_id,
  case when k >= 98 then '' else concat('i', event_id) end as idempotency_key,
  case when k = 7 then 'LAYER_LAKE' else 'LAYER_VAULT' end as layer,
  case event_type when 'click' then 'OPERATION_ADD_COLUMN' when 'signup' then 'OPERATION_NEW_HUB'
    when 'purchase' then 'OPERATION_NEW_LINK' when 'error' then 'OPERATION_DROP_COLUMN'
    else case when k % 2 = 0 then 'OPERATION_CHANGE_TYPE' else 'OPERATION_RENAME_COLUMN' end end as kind,
  case when k = 13 then '' {" ".join(f"when user_id % {len(TARGETS)} = {i} then '{t.title()}'" for i, t in enumerate(TARGETS))} end as target,
  case when k = 17 then null when k < 5 then 'c_name' else concat('attr_', k) end as column_name,
  case when k % 11 = 0 then 'user_id' end as fk_column,
  case when k = 13 and user_id % 2 = 0 then 'orders' end as table_param
from (select *, {{k}} as k from events)"""
_OPS_SQL = _OPS.replace("{k}", _K)
_OPS_SPARK = _OPS_SQL.replace(" from events)", " from {events})")

# The first objection to an operation, and the table it means.
_OPS_CHECKED = f"""ops as ({_OPS_SQL}),
checked as (
  select *, lower(coalesce(nullif(target, ''), case when kind in ('OPERATION_NEW_HUB', 'OPERATION_NEW_LINK')
    then table_param end, '')) as table_name from ops),
judged as (
  select *, case when layer <> 'LAYER_VAULT' then 'WRONG_LAYER'
    when kind = 'OPERATION_RENAME_COLUMN' then 'UNSUPPORTED_OPERATION'
    when kind in ('OPERATION_ADD_COLUMN', 'OPERATION_CHANGE_TYPE', 'OPERATION_DROP_COLUMN') and column_name is null
      then 'MISSING_PARAM'
    when table_name = '' then 'MISSING_TARGET' end as objection from checked),
valid as (select * from judged where objection is null)"""

# Tables: registered ones with their models, the others with an inferred key.
_FACTS = f"""{_INFER},
facts as (
  select t.table_name, t.table_name < 'l' and t.table_name <> 'ghosts' as registered, t.table_name <> 'ghosts' as found,
    case when t.table_name = 'ghosts' then 'id' when t.table_name < 'l' then h.hub_key else i.business_keys end as k,
    coalesce(a.attributes, '') as attributes, h.hub_key
  from (select table_name from inferred union all select 'ghosts') t
  left join hubs h using (table_name) left join inferred i using (table_name)
  left join attr_lists a using (table_name))"""


def operations(spark, sf):
    rows = spark.sql(_OPS_SPARK, events=lake(spark, sf, "events"))
    params = F.create_map(
        F.lit("column_name"), "column_name", F.lit("fk_column"), "fk_column", F.lit("table_name"), "table_param"
    )
    ops = rows.withColumn("params", params).drop("column_name", "fk_column", "table_param")
    # A stored operations table would have plain columns. The generator gives the
    # derived one the same: later filters see columns, not the rules behind them.
    return ops.select(F.inline(F.array(F.struct("*"))))


def _half(spark, sf):
    cat = catalog(spark, sf)
    return cat, MD.model_lake(cat).filter("table_name < 'l'")


_EVIDENCE = (
    "concat('vault:', coalesce(nullif(target, ''), 'unknown'), ':', coalesce(nullif(plan_id, ''), 'no_plan'), ':', "
    "coalesce(nullif(idempotency_key, ''), 'no_idem'))"
)


@query("evidence_id", f"with {_OPS_CHECKED} select seq, {_EVIDENCE} as evidence_snapshot_id from ops")
def evidence_id(spark, sf):
    return E.with_evidence_id(operations(spark, sf)).select("seq", "evidence_snapshot_id")


_STATUS_OF_OBJECTION = """case when objection = 'WRONG_LAYER' then 'OPERATION_STATUS_ALREADY_APPLIED'
when objection is not null then 'OPERATION_STATUS_PERMANENT_ERROR' end"""


@query(
    "validate_ops",
    f"with {_OPS_CHECKED} select seq, table_name, objection as error_code, {_STATUS_OF_OBJECTION} as status from judged",
)
def validate_ops(spark, sf):
    return E.validate_ops(operations(spark, sf)).select("seq", "table_name", "error_code", "status")


_MESSAGES = """case event_type when 'error' then concat('[TABLE_OR_VIEW_NOT_FOUND] t', user_id)
when 'click' then concat('relation "t', user_id, '" does not exist')
when 'view' then concat('syntax error near ', event_id)
when 'purchase' then concat('Connection refused by host', user_id)
else concat('Table t', user_id, ' not found in lake tables') end"""


@query(
    "classify_error",
    """select event_id, case when event_type = 'view' then 'OPERATION_STATUS_PERMANENT_ERROR'
else 'OPERATION_STATUS_TRANSIENT_ERROR' end as load_status,
case when event_type in ('click', 'signup') then 'OPERATION_STATUS_TRANSIENT_ERROR'
else 'OPERATION_STATUS_PERMANENT_ERROR' end as discovery_status from events""",
)
def classify_error(spark, sf):
    log = lake(spark, sf, "events").select("event_id", F.expr(_MESSAGES).alias("message"))
    return E.classify_errors(log).drop("message")


_ADDS = f"""adds as (
  select *, case when trim(plan_id) = '' then concat('#', seq) else concat('plan:', plan_id) end as plan
  from valid where kind = 'OPERATION_ADD_COLUMN')"""


@query(
    "evolve_plan_columns",
    f"""with {_OPS_CHECKED}, {_ADDS},
firsts as (select table_name, plan, column_name, min(seq) as seq from adds group by 1, 2, 3)
select table_name, plan, string_agg(column_name, ',' order by seq) as columns from firsts group by 1, 2""",
)
def evolve_plan_columns(spark, sf):
    plans = E.coalesce_plan(operations(spark, sf))
    return plans.select("table_name", "plan", joined("columns").alias("columns"))


# One request after the other, per table: each step extends its plan's version
# or opens a new one on top of the newest.
_ADD_STEPS = f"""{_OPS_CHECKED}, {_ADDS}, {_FACTS},
fresh as (
  select a.table_name, a.column_name, min(a.seq) as seq, arg_min(a.plan, a.seq) as plan, arg_min(a.plan_id, a.seq) as plan_id
  from adds a join facts f using (table_name)
  where a.column_name <> f.k and not (f.registered and list_contains(string_split(f.attributes, ','), a.column_name))
  group by 1, 2),
steps as (select *, row_number() over (partition by table_name order by seq) as n from fresh),
walk as (
  select table_name, 0 as n, cast([] as struct(plan varchar, plan_id varchar, seq bigint, attrs varchar[])[]) as versions
  from (select distinct table_name from steps)
  union all
  select w.table_name, s.n,
    case when list_contains(list_transform(w.versions, lambda v: v.plan), s.plan)
      then list_transform(w.versions, lambda v: struct_pack(plan := v.plan, plan_id := v.plan_id, seq := v.seq,
        attrs := case when v.plan = s.plan then list_append(v.attrs, s.column_name) else v.attrs end))
      else list_append(w.versions, struct_pack(plan := s.plan, plan_id := s.plan_id, seq := s.seq,
        attrs := list_append(case when len(w.versions) > 0 then w.versions[-1].attrs
          when f.registered and f.attributes <> '' then string_split(f.attributes, ',') else cast([] as varchar[]) end,
          s.column_name))) end
  from walk w join steps s on s.table_name = w.table_name and s.n = w.n + 1 join facts f on f.table_name = w.table_name),
ends as (
  select table_name, versions from walk qualify row_number() over (partition by table_name order by n desc) = 1),
made as (
  select e.table_name, i, e.versions[i].plan_id as plan_id, e.versions[i].seq as created_seq, e.versions[i].attrs as attrs,
    f.k, f.registered
  from ends e cross join lateral (select unnest(generate_series(1, len(e.versions))) as i) join facts f using (table_name))"""


@query(
    "evolve_add_column",
    with_models(
        f""", {_ADD_STEPS}
select concat('sat_', {sql_singular('table_name')},
    case when registered then concat('_v', i + 1) when i > 1 then concat('_v', i) else '' end) as model_name,
  table_name, 'sat' as model_type, k as business_keys, array_to_string(attrs, ',') as attributes, plan_id, created_seq
from made"""
    ).replace("with ", "with recursive ", 1),
)
def evolve_add_column(spark, sf):
    cat, reg = _half(spark, sf)
    models = E.apply_add_column(operations(spark, sf), reg, cat).models
    return models.select(
        "model_name", "table_name", "model_type", joined("business_keys").alias("business_keys"),
        joined("attributes").alias("attributes"), "plan_id", "created_seq",
    )


@query(
    "evolve_new_hub",
    with_models(
        f""", {_OPS_CHECKED}, {_FACTS},
asked as (select table_name, min(seq) as created_seq from valid where kind = 'OPERATION_NEW_HUB' group by 1)
select p || {sql_singular('table_name')} as model_name, table_name, t as model_type, k as business_keys, '' as attributes,
  created_seq
from asked join facts using (table_name), (values ('hub_', 'hub'), ('sat_', 'sat')) v(p, t) where not registered"""
    ),
)
def evolve_new_hub(spark, sf):
    cat, reg = _half(spark, sf)
    models = E.apply_new_hub(operations(spark, sf), reg, cat).models
    return models.select(
        "model_name", "table_name", "model_type", joined("business_keys").alias("business_keys"),
        joined("attributes").alias("attributes"), "created_seq",
    )


@query(
    "evolve_new_link",
    with_models(
        f""", {_OPS_CHECKED},
asked as (
  select table_name, min(seq) as created_seq from valid where kind = 'OPERATION_NEW_LINK' and fk_column is null group by 1)
select model_name, table_name, business_keys, created_seq from models join asked using (table_name)
where model_type = 'link' and table_name >= 'l'"""
    ),
)
def evolve_new_link(spark, sf):
    cat, reg = _half(spark, sf)
    models = E.apply_new_link(operations(spark, sf), reg, cat).models
    return models.select("model_name", "table_name", joined("business_keys").alias("business_keys"), "created_seq")


@query(
    "evolve_change_type",
    with_models(
        f""", {_OPS_CHECKED}
select distinct table_name, model_name from models where table_name < 'l'
and table_name in (select table_name from valid where kind = 'OPERATION_CHANGE_TYPE')"""
    ),
)
def evolve_change_type(spark, sf):
    cat, reg = _half(spark, sf)
    return E.apply_change_type(operations(spark, sf), reg, cat).queued


@query(
    "evolve_drop_column",
    with_models(
        f""", {_OPS_CHECKED}, {_FACTS},
drops as (select * from valid where kind = 'OPERATION_DROP_COLUMN'),
any_drop as (select table_name, min(seq) as s from drops group by 1),
link_drop as (select table_name, min(seq) as s from drops where fk_column is null group by 1)
select model_name, table_name, model_type, business_keys, attributes, s as created_seq
from models join any_drop using (table_name) where table_name >= 'l' and model_type = 'sat'
union all
select model_name, table_name, model_type, f.k, attributes, s
from models join any_drop using (table_name) join facts f using (table_name) where table_name >= 'l' and model_type = 'hub'
union all
select model_name, table_name, model_type, business_keys, attributes, s
from models join link_drop using (table_name) where table_name >= 'l' and model_type = 'link'"""
    ).replace("attributes, s as", "models.attributes, s as").replace("attributes, s\n", "models.attributes, s\n"),
)
def evolve_drop_column(spark, sf):
    cat, reg = _half(spark, sf)
    models = E.apply_drop_column(operations(spark, sf), reg, cat).models
    return models.select(
        "model_name", "table_name", "model_type", joined("business_keys").alias("business_keys"),
        joined("attributes").alias("attributes"), "created_seq",
    )


@query(
    "apply_batch",
    with_models(
        f""", {_OPS_CHECKED}, {_ADDS}, {_FACTS},
firsts as (
  select f.table_name, min(v.seq) filter (v.kind = 'OPERATION_NEW_HUB') as new_hub,
    min(v.seq) filter (v.kind = 'OPERATION_DROP_COLUMN' and f.found) as dropped,
    min(v.seq) filter (v.kind in ('OPERATION_NEW_LINK', 'OPERATION_DROP_COLUMN') and v.fk_column is null) as linked
  from valid v join facts f using (table_name) group by 1),
fresh as (
  select a.table_name, min(a.seq) as seq from adds a join facts f using (table_name)
  where a.column_name <> f.k and not (f.registered and list_contains(string_split(f.attributes, ','), a.column_name))
  group by a.table_name, a.column_name),
fks_of as (select table_name, string_agg(column_name, ',') as fks from fks group by 1),
effects as (
  select seq from fresh
  union select least(new_hub, dropped) from firsts join facts using (table_name) where not registered
  union select dropped from firsts join facts using (table_name) where not registered
  union select linked from firsts join facts using (table_name) join fks_of using (table_name) where not registered
  union select new_hub from firsts join facts using (table_name)
    left join (select table_name, min(seq) as first_add from fresh group by 1) a using (table_name)
    where not registered and new_hub < coalesce(first_add, new_hub + 1) and new_hub < coalesce(dropped, new_hub + 1)),
results as (
  select j.*, f.found, case when objection is not null then objection
      when kind = 'OPERATION_NEW_LINK' and not f.found then 'DV_DISCOVERY_FAILED'
      when kind = 'OPERATION_DROP_COLUMN' and not f.found then 'DV_DROP_FAILED'
      when kind = 'OPERATION_NEW_LINK' and (x.fks is null or (j.fk_column is not null
        and not list_contains(string_split(x.fks, ','), j.fk_column))) then 'NO_LINK_CANDIDATE'
      else '' end as error_code
  from judged j left join facts f using (table_name) left join fks_of x using (table_name))
select seq, correlation_id, kind, table_name, error_code, case when objection is not null then {_STATUS_OF_OBJECTION}
    when error_code in ('DV_DISCOVERY_FAILED', 'DV_DROP_FAILED') then 'OPERATION_STATUS_TRANSIENT_ERROR'
    when kind = 'OPERATION_CHANGE_TYPE' or seq in (select seq from effects) then 'OPERATION_STATUS_OK'
    else 'OPERATION_STATUS_ALREADY_APPLIED' end as status,
  case when objection is null and error_code <> 'DV_DISCOVERY_FAILED' then {_EVIDENCE} else '' end as evidence_snapshot_id
from results"""
    ),
)
def apply_batch(spark, sf):
    cat, reg = _half(spark, sf)
    return E.apply_batch(operations(spark, sf), reg, cat).results.select(
        "seq", "correlation_id", "kind", "table_name", "error_code", "status", "evidence_snapshot_id"
    )


@query(
    "ensure_satellite",
    with_models(
        """select case when table_name < 'l' then model_name || '_v2' else model_name end as model_name, table_name,
business_keys, attributes from models where model_type = 'sat' and (table_name >= 'l' or contains(attributes, ','))"""
    ),
)
def ensure_satellite(spark, sf):
    """The registry before 'l' keeps only each satellite's first attribute."""
    cat, reg = _half(spark, sf)
    narrow = reg.withColumn("attributes", F.slice("attributes", 1, 1))
    templates = MD.split_vault(MD.table_metadata(cat)).filter("model_type = 'sat'").drop("place")
    out = E.ensure_satellite(templates, narrow)
    return out.select("model_name", "table_name", joined("business_keys").alias("business_keys"),
                      joined("attributes").alias("attributes"))


@query(
    "next_version",
    """select concat('sat_', event_type) as base, concat('sat_', event_type, '_v', max(cast(regexp_replace(props, '[^0-9]', '', 'g') as int)) + 1)
as next_name from events group by event_type union all
select distinct concat('sat_', role), concat('sat_', role) from conversations""",
)
def next_version(spark, sf):
    """Names in use come from the events; roles have no satellite yet."""
    events = lake(spark, sf, "events")
    k = F.regexp_replace("props", "[^0-9]", "")
    base = F.concat(F.lit("sat_"), "event_type")
    names = events.select(base.alias("model_name")).unionByName(
        events.select(F.concat(base, F.lit("_v"), k).alias("model_name"))
    )
    roles = lake(spark, sf, "conversations").select(F.concat(F.lit("sat_"), "role").alias("base"))
    return E.next_version(events.select(base.alias("base")).unionByName(roles), names)


@query(
    "latest_satellite",
    """with versions as (
  select concat('t_', event_type) as table_name, user_id as v,
    concat('sat_', event_type, '_v', user_id) as model_name, count(distinct props) as n from events group by 1, 2, 3)
select table_name, arg_max(model_name, v) as model_name, arg_max(n, v) as n_attributes from versions group by 1""",
)
def latest_satellite(spark, sf):
    """One satellite version per event type and user; its attributes are the
    property values seen, of which there are at most a hundred."""
    rows = (
        lake(spark, sf, "events")
        .groupBy("event_type", "user_id")
        .agg(F.collect_set("props").alias("attributes"))
        .select(
            F.concat(F.lit("sat_"), "event_type", F.lit("_v"), "user_id").alias("model_name"),
            F.concat(F.lit("t_"), "event_type").alias("table_name"),
            F.lit("sat").alias("model_type"),
            F.array(F.lit("id")).alias("business_keys"),
            "attributes",
        )
    )
    latest = E.latest_satellite(rows)
    return latest.select("table_name", "model_name", F.size("attributes").cast("bigint").alias("n_attributes"))


@query(
    "probe_links",
    with_models(
        """, asked as (
  select distinct lower(event_type) as t, case when event_id % 2 = 0 then 'l_partkey' end as fk_filter from events
  union select table_name, null from catalog union select 'lineitem', 'l_suppkey')
select m.table_name, a.fk_filter, m.model_name as name, m.business_keys as keys from models m join asked a on a.t = m.table_name
where m.model_type = 'link' and (a.fk_filter is null or ends_with(m.business_keys, ',' || a.fk_filter))"""
    ),
)
def probe_links(spark, sf):
    cat = catalog(spark, sf)
    asked = (
        lake(spark, sf, "events")
        .select(
            F.concat(F.lit("lake."), "event_type").alias("table_name"),
            F.when(F.col("event_id") % 2 == 0, "l_partkey").alias("fk_filter"),
        )
        .unionByName(cat.select("table_name", F.lit(None).cast("string").alias("fk_filter")))
        .unionByName(cat.filter("table_name = 'lineitem'").select(
            F.lit("public.LineItem").alias("table_name"), F.lit("l_suppkey").alias("fk_filter")))
    )
    out = E.probe_links(asked, cat)
    return out.withColumn("keys", joined("keys"))


@query(
    "introspect_vault",
    with_models(
        """select table_name, max(case when model_type = 'hub' then model_name end) as hub,
coalesce(string_agg(model_name, ',' order by model_name) filter (model_type = 'link'), '') as links,
coalesce(string_agg(model_name, ',' order by model_name) filter (model_type = 'sat'), '') as satellites,
string_agg(model_name || '(' || business_keys || case when attributes = '' then '' else ',' || attributes end || ')', ' '
  order by model_name) as tables
from models group by 1"""
    ),
)
def introspect_vault(spark, sf):
    out = E.introspect_vault(MD.model_lake(catalog(spark, sf)))
    vault = F.col("vaults")[0]
    described = F.transform(
        "tables", lambda t: F.concat(t["name"], F.lit("("), F.array_join(t["columns"], ","), F.lit(")"))
    )
    return out.select(
        "table_name",
        vault["hub"].alias("hub"),
        joined(vault["links"]).alias("links"),
        joined(vault["satellites"]).alias("satellites"),
        F.array_join(described, " ").alias("tables"),
    )


_V2 = [*EVENT, "user_id"]


@query(
    "evolve_backfill",
    f"select distinct {_shown('events', ['event_id', *_V2])}, {sql_hash('events', _V2)} as hashdiff, "
    f"{_audit('events')} from events",
)
def evolve_backfill(spark, sf):
    """The data behind a new satellite version: events with one more attribute."""
    cat = catalog(spark, sf)
    op = [(1, "c1", "plan-1", "i1", "LAYER_VAULT", E.ADD_COLUMN, "events", {"column_name": "user_id"})]
    ops = spark.createDataFrame(
        op,
        "seq bigint, correlation_id string, plan_id string, idempotency_key string, layer string, kind string, "
        "target string, params map<string,string>",
    )
    [model] = E.apply_add_column(ops, MD.model_lake(cat), cat).models.collect()
    return timestamps_as_text(model_rows(lake(spark, sf, "events"), model, T0))
