"""Names and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import modelling as MD
from .common import (
    catalog,
    joined,
    lake,
    query,
    registry,
    show_models,
    sql_singular,
    sql_strip_suffix,
    with_models,
)

# Names made from the parts, so that the rules see many and odd ones.
_RAW = "p_brand || '.' || p_type || '-' || p_name || ' ' || p_partkey"
_PLURAL = "lower(p_type) || p_partkey || (case p_size % 4 when 0 then 'ies' when 1 then 's' when 2 then 'ss' else 'x' end)"
_KEYED = (
    "replace(p_name, ' ', '_') || (case p_size % 8 when 0 then '_id' when 1 then 'id' when 2 then '_nr' "
    "when 3 then 'Key' when 4 then '_number' when 5 then '_code' when 6 then '' else '_ID' end)"
)


def _named(spark, sf, expr):
    return lake(spark, sf, "part").select("p_partkey", F.expr(expr).alias("name"))


@query("normalize_name", f"select p_partkey, regexp_replace(lower({_RAW}), '[^a-z0-9]', '', 'g') as name from part")
def normalize_name(spark, sf):
    return _named(spark, sf, _RAW).select("p_partkey", N.normalize_name(F.col("name")).alias("name"))


@query("singularize", f"select p_partkey, {sql_singular('n')} as name from (select p_partkey, {_PLURAL} as n from part)")
def singularize(spark, sf):
    return _named(spark, sf, _PLURAL).select("p_partkey", N.singularize(F.col("name")).alias("name"))


@query(
    "strip_key_suffix",
    f"select p_partkey, {sql_strip_suffix('n')} as name from (select p_partkey, lower({_KEYED}) as n from part)",
)
def strip_key_suffix(spark, sf):
    return _named(spark, sf, _KEYED).select("p_partkey", N.strip_key_suffix(F.col("name")).alias("name"))


_LONG = f"'\"' || {_RAW} || repeat('_x', p_size) || '\"'"
_CLEAN = "replace(replace(trim(substr(n, instr(n, '.') + 1), '\"'), '.', '_'), '-', '_')"


@query(
    "physical_name",
    f"select p_partkey, left({_CLEAN}, 63) as rdbms, lower({_CLEAN}) as parquet from (select p_partkey, {_LONG} as n from part)",
)
def physical_name(spark, sf):
    name = F.col("name")
    return _named(spark, sf, _LONG).select(
        "p_partkey",
        N.physical_name(name, "rdbms").alias("rdbms"),
        N.physical_name(name, "parquet").alias("parquet"),
    )


@query("key_candidates", with_models("select table_name, ordinal, column_name from cands"))
def key_candidates(spark, sf):
    return MD.key_candidates(catalog(spark, sf))


@query("hub_key", with_models("select table_name, hub_key, named as name_match from hubs"))
def hub_key(spark, sf):
    return MD.hub_key(catalog(spark, sf))


@query("foreign_keys", with_models("select * from fks"))
def foreign_keys(spark, sf):
    return MD.foreign_keys(catalog(spark, sf))


@query("attributes", with_models("select * from attrs"))
def attributes(spark, sf):
    return MD.attributes(catalog(spark, sf))


_META = """, lists as (
  select c.table_name, string_agg(c.column_name, ',' order by c.ordinal) as columns from catalog c group by 1),
fk_lists as (select table_name, string_agg(column_name, ',' order by ordinal) as foreign_keys from fks group by 1),
meta as (
  select l.table_name, l.columns,
    coalesce(h.hub_key || case when f.foreign_keys is null then '' else ',' || f.foreign_keys end, '') as business_keys,
    coalesce(a.attributes, '') as attributes, h.hub_key, coalesce(f.foreign_keys, '') as foreign_keys
  from lists l left join hubs h using (table_name) left join fk_lists f using (table_name)
  left join attr_lists a using (table_name))"""


@query("table_metadata", with_models(f"{_META} select * from meta"))
def table_metadata(spark, sf):
    return MD.table_metadata(catalog(spark, sf)).select(
        "table_name", joined("columns").alias("columns"), joined("business_keys").alias("business_keys"),
        joined("attributes").alias("attributes"), "hub_key", joined("foreign_keys").alias("foreign_keys"),
    )


@query("split_vault", with_models("select * from models"))
def split_vault(spark, sf):
    return show_models(MD.split_vault(MD.table_metadata(catalog(spark, sf))))


@query(
    "model_type",
    with_models(
        """select table_name, case when n_keys = 1 then 'hub' when n_keys > 1 and n_other = 0 then 'link' else 'sat' end
as model_type from (
  select c.table_name, count(k.column_name) as n_keys, count(*) - count(k.column_name) as n_other
  from catalog c left join cands k on k.table_name = c.table_name and k.column_name = c.column_name group by 1)"""
    ),
)
def model_type(spark, sf):
    return MD.model_type(MD.table_metadata(catalog(spark, sf))).select("table_name", "model_type")


_INFER = f"""tokens(position, name) as (values (3, 'id'), (4, 'customerid'), (5, 'customer_id'), (6, 'accountid'),
  (7, 'account_id'), (8, 'orderid'), (9, 'order_id')),
wishes as (
  select t.table_name, position, name from (select distinct table_name from catalog) t, tokens
  union all select distinct table_name, 1, regexp_replace(table_name, 's$', '') || 'id' from catalog
  union all select distinct table_name, 2, regexp_replace(table_name, 's$', '') || '_id' from catalog),
wished as (
  select c.table_name, arg_min(c.column_name, position) as k from catalog c join wishes w
  on w.table_name = c.table_name and w.name = c.column_name group by 1),
suffixed as (
  select table_name, arg_min(column_name, ordinal) as k from catalog where ends_with(column_name, 'id') group by 1),
foremost as (select table_name, arg_min(column_name, ordinal) as k from catalog group by 1),
inferred as (
  select l.table_name, coalesce(w.k, s.k, l.k) as business_keys
  from foremost l left join wished w using (table_name) left join suffixed s using (table_name))"""


@query(
    "infer_business_keys",
    with_models(
        f""", {_INFER}
select i.table_name, case when i.table_name < 'l' then h.hub_key else i.business_keys end as business_keys
from inferred i left join hubs h using (table_name)"""
    ),
)
def infer_business_keys(spark, sf):
    """Tables before 'l' are registered and keep their hub's key."""
    cat = catalog(spark, sf)
    known = MD.model_lake(cat).filter("table_name < 'l'")
    out = MD.infer_business_keys(cat.select("table_name"), cat, known)
    return out.select("table_name", joined("business_keys").alias("business_keys"))


@query(
    "registry_rows",
    with_models(
        """select model_name, table_name, model_type, business_keys, attributes,
business_keys || case when attributes = '' then '' else ',' || attributes end as columns from models"""
    ),
)
def registry_rows(spark, sf):
    """Specs with repeats and an alias come out in registry form."""
    specs = MD.split_vault(MD.table_metadata(catalog(spark, sf)))
    noisy = specs.select(
        "model_name",
        "table_name",
        F.when(F.col("model_type") == "sat", "Satellite").otherwise(F.upper("model_type")).alias("model_type"),
        "business_keys",
        F.concat("attributes", "business_keys", "attributes").alias("attributes"),
        F.concat("columns", "columns").alias("columns"),
    )
    return MD.registry_rows(noisy).select(
        "model_name", "table_name", "model_type", joined("business_keys").alias("business_keys"),
        joined("attributes").alias("attributes"), joined("columns").alias("columns"),
    )


@query("model_lake", with_models("select * from models"))
def model_lake(spark, sf):
    return show_models(registry(spark, sf))


@query(
    "models_by_table",
    with_models("select table_name, string_agg(model_name, ',' order by model_name) as models from models group by 1"),
)
def models_by_table(spark, sf):
    return MD.models_by_table(registry(spark, sf)).select("table_name", joined("models").alias("models"))


@query("models_of_type", with_models("select model_name, table_name from models where model_type = 'link'"))
def models_of_type(spark, sf):
    return MD.models_of_type(registry(spark, sf), "LINK").select("model_name", "table_name")


@query(
    "registry_changed",
    with_models("select model_name from models where model_type = 'sat' or table_name >= 'l'"),
)
def registry_changed(spark, sf):
    """The old registry ends before 'l' and knew the satellites under other attributes."""
    new = registry(spark, sf)
    old = new.filter("table_name < 'l'").withColumn(
        "attributes",
        F.when(F.col("model_type") == "sat", F.reverse(F.array_append("attributes", "was_here"))).otherwise(
            F.col("attributes")
        ),
    )
    return MD.registry_changed(new, old).select("model_name")
