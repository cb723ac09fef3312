"""Schema evolution: a table of operations in, results and new models out.

Operations take effect in ``seq`` order, each seeing what earlier ones did, but
nothing here loops over them. What an operation changes depends only on *first*
occurrences: the first request for a column, for a hub, for a link, the first
drop that finds no satellite of the current shape. So the operations, however
many and however unevenly spread over tables, are first aggregated to those (one
row per column, table or foreign key), and only that much smaller set, bounded
by the schema, goes through windows. The full operations meet it again in two
joins that give each its status.

Inputs
------
ops       seq, correlation_id, plan_id, idempotency_key, layer, kind, target,
          params map<string,string>
registry  see ``modelling.REGISTRY_COLUMNS``, optionally ``plan_id`` of the plan
          that created a satellite
catalog   the lake's columns
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import messages as M
from ..functions.names import model_version, physical_name, singularize, versioned
from ..session import keep
from .modelling import REGISTRY_COLUMNS, infer_business_keys, split_vault, table_metadata

ADD_COLUMN = "OPERATION_ADD_COLUMN"
NEW_HUB = "OPERATION_NEW_HUB"
NEW_LINK = "OPERATION_NEW_LINK"
CHANGE_TYPE = "OPERATION_CHANGE_TYPE"
DROP_COLUMN = "OPERATION_DROP_COLUMN"
HANDLED = [ADD_COLUMN, NEW_HUB, NEW_LINK, CHANGE_TYPE, DROP_COLUMN]
NEED_COLUMN = [ADD_COLUMN, CHANGE_TYPE, DROP_COLUMN]
TARGET_OR_PARAM = [NEW_HUB, NEW_LINK]

_END_OF_TIME = (1 << 63) - 1


@dataclass(frozen=True)
class Evolution:
    """What a batch of operations did."""

    results: DataFrame  # one row per operation
    models: DataFrame  # models created or extended, with created_seq and plan_id
    queued: DataFrame  # (table_name, model_name) to load from bronze
    registry: DataFrame  # the registry afterwards


# --- names and shapes -----------------------------------------------------------


def _no_names() -> Column:
    return F.array().cast("array<string>")


def _same_names(a: Column | str, b: Column | str) -> Column:
    return F.array_sort(a) == F.array_sort(b)


def _number_after(name: Column, base: Column) -> Column:
    """N if the name is exactly ``base_vN``."""
    digits = F.regexp_extract(name, r"_v(\d+)$", 1)
    return F.when(name == versioned(base, digits), digits.try_cast("int"))


def _nth_new_name(base: Column, base_taken: Column, highest: Column, nth: Column) -> Column:
    """Name of the ``nth`` new model: the base if free, then ever higher versions."""
    top = F.greatest(F.coalesce(highest, F.lit(1)), F.lit(1))
    taken = F.coalesce(base_taken, F.lit(False))
    number = top + nth - F.when(taken, 0).otherwise(1)
    return F.when(~taken & (nth == 1), base).otherwise(versioned(base, number.cast("int")))


def next_version(bases: DataFrame, names: DataFrame) -> DataFrame:
    """``(base, next_name)``: the base while free, else one above the highest version."""
    known = names.select("model_name", F.regexp_replace("model_name", r"_v\d+$", "").alias("stem"))
    # A name may itself be a base or a version of its stem; both count.
    stems = known.select(F.col("model_name").alias("base"), "model_name").unionByName(
        known.select(F.col("stem").alias("base"), "model_name")
    )
    used = stems.groupBy("base").agg(
        F.bool_or(F.col("model_name") == F.col("base")).alias("taken"),
        F.max(_number_after(F.col("model_name"), F.col("base"))).alias("highest"),
    )
    return (
        bases.select("base")
        .distinct()
        .join(used, "base", "left")
        .select(
            "base",
            _nth_new_name(F.col("base"), F.col("taken"), F.col("highest"), F.lit(1)).alias("next_name"),
        )
    )


def latest_satellite(registry: DataFrame) -> DataFrame:
    """Each table's newest satellite: highest version, then most attributes, then name."""
    rank = F.struct(
        model_version(F.col("model_name")).alias("version"),
        F.size("attributes").alias("n_attributes"),
        "model_name",
    )
    best = F.max_by(F.struct("model_name", "business_keys", "attributes"), rank)
    return (
        registry.filter(F.col("model_type") == "sat")
        .groupBy("table_name")
        .agg(best.alias("best"))
        .select("table_name", "best.*")
    )


def ensure_satellite(templates: DataFrame, registry: DataFrame) -> DataFrame:
    """Satellites to create so that each template's keys and attributes are covered.

    A satellite of the same shape, in any order, is enough; otherwise a new
    version stands beside the ones there are.
    """
    sats = registry.filter(F.col("model_type") == "sat")
    shape = [F.array_sort("business_keys").alias("k"), F.array_sort("attributes").alias("a")]
    have = sats.select("table_name", *shape).distinct()
    lacking = (
        templates.select("*", *shape).join(have, ["table_name", "k", "a"], "left_anti").drop("k", "a")
    )
    names = next_version(lacking.select(F.col("model_name").alias("base")), sats)
    return (
        lacking.withColumnRenamed("model_name", "base")
        .join(names, "base")
        .select(
            F.col("next_name").alias("model_name"),
            "table_name",
            "model_type",
            "business_keys",
            "attributes",
            "columns",
        )
    )


# --- single-row rules -----------------------------------------------------------


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def validate_ops(ops: DataFrame) -> DataFrame:
    """Operations with their table, parameters, and the first objection if any."""
    kind = F.col("kind")
    column = _filled(F.col("params")["column_name"])
    target = _filled(F.col("target"))
    asked = F.when(
        kind.isin(TARGET_OR_PARAM), F.coalesce(target, _filled(F.col("params")["table_name"]))
    ).otherwise(target)
    checked = ops.withColumns(
        {
            "column_name": column,
            "fk_column": _filled(F.col("params")["fk_column"]),
            "asked": asked,
        }
    )
    code = (
        F.when(~F.col("layer").eqNullSafe("LAYER_VAULT"), "WRONG_LAYER")
        .when(~F.coalesce(kind, F.lit("")).isin(HANDLED), "UNSUPPORTED_OPERATION")
        .when(kind.isin(NEED_COLUMN) & F.col("column_name").isNull(), "MISSING_PARAM")
        .when(F.col("asked").isNull(), "MISSING_TARGET")
    )
    message = (
        F.when(F.col("error_code") == "WRONG_LAYER", F.concat(F.lit("layer not handled: "), "layer"))
        .when(F.col("error_code") == "UNSUPPORTED_OPERATION", F.concat(F.lit("kind not supported: "), "kind"))
        .when(
            F.col("error_code") == "MISSING_PARAM",
            F.concat(F.lit("no column_name given for "), "kind"),
        )
        .when(
            F.col("error_code") == "MISSING_TARGET",
            F.concat(F.lit("no target table given for "), "kind"),
        )
    )
    return (
        checked.withColumn("table_name", physical_name(F.col("asked")))
        .withColumn("error_code", code)
        .withColumn("error_message", message)
        .withColumn(
            "status",
            F.when(F.col("error_code") == "WRONG_LAYER", M.ALREADY_APPLIED).when(
                F.col("error_code").isNotNull(), M.PERMANENT_ERROR
            ),
        )
        .drop("asked")
    )


def with_evidence_id(ops: DataFrame) -> DataFrame:
    """Operations with the id their evidence is kept under."""
    return ops.withColumn(
        "evidence_snapshot_id",
        M.evidence_id(F.col("target"), F.col("plan_id"), F.col("idempotency_key")),
    )


def classify_errors(log: DataFrame, message: str = "message") -> DataFrame:
    """An error log with each message's class, for loads and for discovery."""
    text = F.col(message)
    return log.withColumn(
        "load_status", F.when(M.is_transient(text), M.TRANSIENT_ERROR).otherwise(M.PERMANENT_ERROR)
    ).withColumn(
        "discovery_status",
        F.when(M.is_transient_discovery(text), M.TRANSIENT_ERROR).otherwise(M.PERMANENT_ERROR),
    )


def plan_key(plan_id: Column, seq: Column) -> Column:
    """What groups operations: the plan, or the operation itself without one."""
    trimmed = F.trim(F.coalesce(plan_id, F.lit("")))
    return F.when(trimmed == "", F.concat(F.lit("#"), seq.cast("string"))).otherwise(
        F.concat(F.lit("plan:"), trimmed)
    )


def coalesce_plan(ops: DataFrame) -> DataFrame:
    """Columns each plan adds to each table, in order of their first request.

    Repeated requests vanish in a partial aggregation before the shuffle.
    """
    adds = validate_ops(ops).filter(F.col("error_code").isNull() & (F.col("kind") == ADD_COLUMN))
    firsts = (
        adds.select("table_name", plan_key(F.col("plan_id"), F.col("seq")).alias("plan"), "column_name", "seq")
        .groupBy("table_name", "plan", "column_name")
        .agg(F.min("seq").alias("seq"))
    )
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("seq", "column_name"))), lambda r: r["column_name"]
    )
    return firsts.groupBy("table_name", "plan").agg(listed.alias("columns"))


# --- state per table --------------------------------------------------------------


def _templates(catalog: DataFrame) -> DataFrame:
    return split_vault(table_metadata(catalog))


def _satellite_state(registry: DataFrame) -> DataFrame:
    """What the registry says about each table's satellites."""
    base = F.concat(F.lit("sat_"), singularize(F.col("table_name")))
    sats = registry.filter(F.col("model_type") == "sat").withColumn("base", base)
    state = sats.groupBy("table_name").agg(
        F.bool_or(F.col("model_name") == F.col("base")).alias("base_taken"),
        F.max(_number_after(F.col("model_name"), F.col("base"))).alias("highest"),
        F.array_distinct(F.flatten(F.collect_list("attributes"))).alias("present"),
    )
    latest = latest_satellite(registry).select(
        "table_name",
        F.col("model_name").alias("latest_model"),
        F.col("attributes").alias("latest_attributes"),
    )
    return state.join(latest, "table_name")


def _table_facts(
    tables: DataFrame, registry: DataFrame, catalog: DataFrame, specs: DataFrame
) -> DataFrame:
    """One row per requested table: keys, satellite state, current templates."""
    sat = specs.filter(F.col("model_type") == "sat").select(
        "table_name",
        F.col("business_keys").alias("sat_keys"),
        F.col("attributes").alias("sat_attributes"),
    )
    hub = specs.filter(F.col("model_type") == "hub").select("table_name", F.lit(True).alias("has_hub"))
    links = (
        specs.filter(F.col("model_type") == "link")
        .groupBy("table_name")
        .agg(F.collect_set(F.col("business_keys")[1]).alias("link_fks"))
    )
    found = catalog.select("table_name", F.lit(True).alias("found")).distinct()
    facts = infer_business_keys(tables, catalog, registry)
    for part in (_satellite_state(registry), sat, hub, links, found):
        facts = facts.join(part, "table_name", "left")
    return facts.withColumns(
        {
            "present": F.coalesce("present", _no_names()),
            "base": F.concat(F.lit("sat_"), singularize(F.col("table_name"))),
            "link_fks": F.coalesce("link_fks", _no_names()),
            "found": F.coalesce("found", F.lit(False)),
            "has_hub": F.coalesce("has_hub", F.lit(False)),
        }
    )


def _with_plan_id(registry: DataFrame) -> DataFrame:
    if "plan_id" in registry.columns:
        return registry.select(*REGISTRY_COLUMNS, "plan_id")
    return registry.select(*REGISTRY_COLUMNS, F.lit(None).cast("string").alias("plan_id"))


# --- satellites over time -----------------------------------------------------------


def _first_adds(firsts: DataFrame, registry: DataFrame, facts: DataFrame) -> DataFrame:
    """The first request for each column no satellite has yet.

    ``own_model`` is the satellite the plan already created in an earlier batch.
    """
    added = (
        firsts.filter(F.col("kind") == ADD_COLUMN)
        .select("table_name", "column_name", "seq", "plan_id")
        .join(facts.select("table_name", "present", "business_keys"), "table_name")
        .filter(
            ~F.array_contains("present", F.col("column_name"))
            & ~F.array_contains("business_keys", F.col("column_name"))
        )
        .select("table_name", "column_name", "seq", "plan_id",
                plan_key(F.col("plan_id"), F.col("seq")).alias("plan"))
    )
    planned = (
        registry.filter((F.col("model_type") == "sat") & (F.trim("plan_id") != ""))
        .groupBy("table_name", F.concat(F.lit("plan:"), F.trim("plan_id")).alias("plan"))
        .agg(F.max(F.struct(model_version(F.col("model_name")).alias("v"), "model_name")).alias("m"))
        .select("table_name", "plan", F.col("m.model_name").alias("own_model"))
    )
    return added.join(planned, ["table_name", "plan"], "left")


def _timeline(adds: DataFrame, single: DataFrame, facts: DataFrame) -> DataFrame:
    """Creations (step 0) and column additions (step 1) of each table, in order.

    ``single`` holds creations that no plan owns: ``table_name, seq, plan`` with
    ``plan`` '#hub' or '#drop'. A version inherits what its predecessor had when
    it was created, so a column passes on only if its version was then still the
    newest. After a drop, inheritance starts anew from the current template.
    """
    created = (
        adds.filter(F.col("own_model").isNull())
        .groupBy("table_name", "plan")
        .agg(F.min(F.struct("seq", "plan_id")).alias("first"))
        .select("table_name", "plan", "first.seq", "first.plan_id")
        .unionByName(single.withColumn("plan_id", F.lit(None).cast("string")))
    )
    steps = created.select(
        "table_name", "seq", F.lit(0).alias("step"), "plan", "plan_id",
        F.lit(None).cast("string").alias("column_name"),
        F.lit(None).cast("string").alias("own_model"),
    ).unionByName(
        adds.select("table_name", "seq", F.lit(1).alias("step"), "plan", "plan_id", "column_name", "own_model")
    )
    order = Window.partitionBy("table_name").orderBy("seq", "step").rowsBetween(
        Window.unboundedPreceding, 0
    )
    numbered = steps.withColumns(
        {
            "newest": F.sum(F.when(F.col("step") == 0, 1).otherwise(0)).over(order),
            "epoch": F.max(F.when(F.col("plan") == "#drop", 1).otherwise(0)).over(order),
        }
    )
    of_plan = Window.partitionBy("table_name", "plan")
    owned = (
        numbered.withColumn(
            "version", F.coalesce(F.max(F.when(F.col("step") == 0, F.col("newest"))).over(of_plan), F.lit(0))
        )
        .join(facts.select("table_name", "latest_model", "latest_attributes", "sat_attributes",
                           "business_keys"), "table_name")
        .withColumn(
            "passes_on",
            (F.col("step") == 1)
            & (F.col("version") == F.col("newest"))
            & (F.col("own_model").isNull() | (F.col("own_model") == F.col("latest_model"))),
        )
    )
    in_epoch = Window.partitionBy("table_name", "epoch").orderBy("seq", "step").rowsBetween(
        Window.unboundedPreceding, 0
    )
    start = F.coalesce(
        F.when(F.col("epoch") == 1, F.col("sat_attributes")).otherwise(F.col("latest_attributes")),
        _no_names(),
    )
    return owned.withColumn(
        "inherited",
        F.array_except(
            F.array_distinct(
                F.concat(start, F.collect_list(F.when(F.col("passes_on"), F.col("column_name"))).over(in_epoch))
            ),
            F.when(F.col("plan") == "#drop", _no_names()).otherwise(F.col("business_keys")),
        ),
    )


def _new_satellites(timeline: DataFrame, facts: DataFrame) -> DataFrame:
    """The satellite versions a timeline creates, in their final state."""
    own = (
        timeline.filter((F.col("step") == 1) & F.col("own_model").isNull())
        .groupBy("table_name", "plan")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "column_name"))).alias("own"))
        .select("table_name", "plan", F.transform("own", lambda r: r["column_name"]).alias("own"))
    )
    named = facts.select("table_name", "base", "base_taken", "highest", "sat_keys")
    keys = F.when(F.col("plan") == "#drop", F.col("sat_keys")).otherwise(F.col("business_keys"))
    attrs = F.when(F.col("plan") == "#hub", _no_names()).otherwise(
        F.array_distinct(F.concat("inherited", F.coalesce("own", _no_names())))
    )
    return (
        timeline.filter(F.col("step") == 0)
        .join(own, ["table_name", "plan"], "left")
        .join(named, "table_name")
        .select(
            _nth_new_name(
                F.col("base"), F.col("base_taken"), F.col("highest"), F.col("newest")
            ).alias("model_name"),
            "table_name",
            F.lit("sat").alias("model_type"),
            keys.alias("business_keys"),
            attrs.alias("attributes"),
            F.concat(keys, attrs).alias("columns"),
            "plan_id",
            F.col("seq").alias("created_seq"),
        )
    )


def _extended_satellites(timeline: DataFrame, registry: DataFrame) -> DataFrame:
    """Registered satellites that their own plan goes on extending."""
    own = (
        timeline.filter((F.col("step") == 1) & F.col("own_model").isNotNull())
        .groupBy("table_name", F.col("own_model").alias("model_name"))
        .agg(
            F.array_sort(F.collect_list(F.struct("seq", "column_name"))).alias("own"),
            F.min("seq").alias("created_seq"),
        )
    )
    attrs = F.array_distinct(
        F.concat("attributes", F.transform("own", lambda r: r["column_name"]))
    )
    return registry.join(own, ["table_name", "model_name"]).select(
        "model_name",
        "table_name",
        "model_type",
        "business_keys",
        attrs.alias("attributes"),
        F.concat("business_keys", attrs).alias("columns"),
        "plan_id",
        "created_seq",
    )


def _first_unmatched_drop(
    valid: DataFrame, timeline: DataFrame, registry: DataFrame, facts: DataFrame
) -> DataFrame:
    """The first DROP_COLUMN per table that finds no satellite of the current shape.

    A satellite has a given shape during one stretch of operations at most, since
    it only ever grows. The drops outside all stretches are what remains of an
    anti-join against those few stretches.
    """
    templates = facts.filter(F.size("sat_attributes") > 0).select(
        "table_name", "sat_keys", "sat_attributes", F.col("business_keys").alias("table_keys")
    )
    grown = Window.partitionBy("table_name", "plan", "own_model").orderBy("seq")
    so_far = grown.rowsBetween(Window.unboundedPreceding, 0)
    registered = registry.filter(F.col("model_type") == "sat").select(
        "table_name", F.col("model_name").alias("own_model"),
        F.col("business_keys").alias("own_keys"), F.col("attributes").alias("own_attributes"),
    )
    states = (
        timeline.filter(F.col("step") == 1)
        .select("table_name", "plan", "own_model", "seq", "column_name", "version")
        .join(
            timeline.filter(F.col("step") == 0).select("table_name", "plan", "inherited"),
            ["table_name", "plan"], "left",
        )
        .join(registered, ["table_name", "own_model"], "left")
        .withColumn("added", F.collect_list("column_name").over(so_far))
        .withColumn("until", F.coalesce(F.lead("seq").over(grown), F.lit(_END_OF_TIME)))
        .join(templates, "table_name")
        .select(
            "table_name",
            F.col("seq").alias("since"),
            "until",
            F.coalesce("own_keys", "table_keys").alias("keys"),
            F.concat(F.coalesce("own_attributes", "inherited"), "added").alias("attrs"),
            "sat_keys",
            "sat_attributes",
        )
    )
    first_growth = (
        timeline.filter(F.col("own_model").isNotNull())
        .groupBy("table_name", "own_model")
        .agg(F.min("seq").alias("first_growth"))
    )
    untouched = (
        registered.join(first_growth, ["table_name", "own_model"], "left")
        .join(templates, "table_name")
        .select(
            "table_name",
            F.lit(-_END_OF_TIME).alias("since"),
            F.coalesce("first_growth", F.lit(_END_OF_TIME)).alias("until"),
            F.col("own_keys").alias("keys"),
            F.col("own_attributes").alias("attrs"),
            "sat_keys",
            "sat_attributes",
        )
    )
    covered = keep(
        states.unionByName(untouched)
        .filter(_same_names("keys", "sat_keys") & _same_names("attrs", "sat_attributes"))
        .select(F.col("table_name").alias("t"), "since", "until")
    )
    drops = valid.filter(F.col("kind") == DROP_COLUMN).select("table_name", "seq")
    return (
        drops.join(templates.select("table_name"), "table_name", "left_semi")
        .join(
            covered,
            (F.col("table_name") == F.col("t"))
            & (F.col("seq") >= F.col("since"))
            & (F.col("seq") < F.col("until")),
            "left_anti",
        )
        .groupBy("table_name")
        .agg(F.min("seq").alias("seq"))
    )


def _satellites(
    valid: DataFrame, firsts: DataFrame, registry: DataFrame, facts: DataFrame, kinds: set[str]
) -> tuple[DataFrame, DataFrame]:
    """New and extended satellites, and the timeline they follow from."""
    adds = _first_adds(firsts, registry, facts)
    first_add = adds.filter(F.col("own_model").isNull()).groupBy("table_name").agg(
        F.min("seq").alias("first_add")
    )
    bare = F.coalesce(F.size("sat_attributes"), F.lit(0)) < 1
    no_satellite = facts.filter(F.col("latest_model").isNull()).select(
        "table_name", (F.col("has_hub") & bare).alias("drop_makes_hub")
    )
    asks_hub = (F.col("kind") == NEW_HUB) | ((F.col("kind") == DROP_COLUMN) & F.col("drop_makes_hub"))
    # A hub brings an empty satellite only where none came before it.
    hub_sats = (
        firsts.join(no_satellite, "table_name")
        .filter(asks_hub)
        .groupBy("table_name")
        .agg(F.min("seq").alias("seq"))
        .join(first_add, "table_name", "left")
        .filter(F.col("first_add").isNull() | (F.col("seq") < F.col("first_add")))
        .select("table_name", "seq", F.lit("#hub").alias("plan"))
    )
    timeline = keep(_timeline(adds, hub_sats, facts))
    if DROP_COLUMN in kinds:
        dropped = keep(_first_unmatched_drop(valid, timeline, registry, facts))
        resets = dropped.join(facts.select("table_name", "sat_attributes"), "table_name").select(
            "table_name", F.col("seq").alias("reset_seq"), "sat_attributes"
        )
        # From the reset on, the template's columns are there already.
        adds = (
            adds.join(resets, "table_name", "left")
            .filter(
                F.col("reset_seq").isNull()
                | (F.col("seq") < F.col("reset_seq"))
                | ~F.array_contains("sat_attributes", F.col("column_name"))
            )
            .drop("reset_seq", "sat_attributes")
        )
        hub_sats = (
            hub_sats.join(resets.select("table_name", "reset_seq"), "table_name", "left")
            .filter(F.col("reset_seq").isNull() | (F.col("seq") < F.col("reset_seq")))
            .drop("reset_seq")
        )
        single = hub_sats.unionByName(dropped.select("table_name", "seq", F.lit("#drop").alias("plan")))
        timeline = keep(_timeline(adds, single, facts))
    models = _new_satellites(timeline, facts).unionByName(_extended_satellites(timeline, registry))
    return models, timeline


# --- hubs and links ------------------------------------------------------------------


def _hubs(firsts: DataFrame, registry: DataFrame, facts: DataFrame) -> DataFrame:
    """Hubs to create, by the first operation that asks for one."""
    name = F.concat(F.lit("hub_"), singularize(F.col("table_name")))
    wanted = facts.select("table_name", name.alias("model_name"), "business_keys", "has_hub")
    have = registry.filter(F.col("model_type") == "hub").select("table_name", "model_name").distinct()
    lacking = wanted.join(have, ["table_name", "model_name"], "left_anti")
    asks = (F.col("kind") == NEW_HUB) | ((F.col("kind") == DROP_COLUMN) & F.col("has_hub"))
    first = (
        firsts.select("table_name", "kind", "seq")
        .join(lacking.select("table_name", "has_hub"), "table_name")
        .filter(asks)
        .groupBy("table_name")
        .agg(F.min("seq").alias("created_seq"))
    )
    return lacking.join(first, "table_name").select(
        "model_name",
        "table_name",
        F.lit("hub").alias("model_type"),
        "business_keys",
        _no_names().alias("attributes"),
        F.col("business_keys").alias("columns"),
        F.lit(None).cast("string").alias("plan_id"),
        "created_seq",
    )


def _links(firsts: DataFrame, registry: DataFrame, specs: DataFrame) -> DataFrame:
    """Links to create: candidates whose key set no link has, once they are asked for."""
    have = registry.filter(F.col("model_type") == "link").withColumn("k", F.array_sort("business_keys"))
    lacking = (
        specs.filter(F.col("model_type") == "link")
        .withColumn("k", F.array_sort("business_keys"))
        .join(have.select("table_name", "k").distinct(), ["table_name", "k"], "left_anti")
        .withColumn("fk", F.col("business_keys")[1])
    )
    asks = (
        firsts.filter(F.col("kind").isin(NEW_LINK, DROP_COLUMN))
        .groupBy("table_name", "fk_column")
        .agg(F.min("seq").alias("seq"))
    )
    for_all = asks.filter(F.col("fk_column").isNull()).select("table_name", F.col("seq").alias("all_seq"))
    for_one = asks.filter(F.col("fk_column").isNotNull()).select(
        "table_name", F.col("fk_column").alias("fk"), F.col("seq").alias("one_seq")
    )
    asked = (
        lacking.join(for_all, "table_name", "left")
        .join(for_one, ["table_name", "fk"], "left")
        .withColumn("created_seq", F.least("all_seq", "one_seq"))
        .filter(F.col("created_seq").isNotNull())
    )
    stem = F.col("model_name")
    used = (
        have.select("table_name", F.col("model_name").alias("used"))
        .join(asked.select("table_name", F.col("model_name").alias("base")).distinct(), "table_name")
        .groupBy("table_name", "base")
        .agg(
            F.bool_or(F.col("used") == F.col("base")).alias("base_taken"),
            F.max(_number_after(F.col("used"), F.col("base"))).alias("highest"),
        )
    )
    nth = F.row_number().over(Window.partitionBy("table_name", "model_name").orderBy("created_seq", "place"))
    return (
        asked.withColumn("nth", nth)
        .withColumn("base", stem)
        .join(used, ["table_name", "base"], "left")
        .select(
            _nth_new_name(F.col("base"), F.col("base_taken"), F.col("highest"), F.col("nth")).alias("model_name"),
            "table_name",
            "model_type",
            "business_keys",
            "attributes",
            "columns",
            F.lit(None).cast("string").alias("plan_id"),
            "created_seq",
        )
    )


# --- the batch --------------------------------------------------------------------


def _first_requests(valid: DataFrame) -> DataFrame:
    """The operations that can matter: the first and last of each distinct request.

    This is the one aggregation over all operations. Map tasks reduce their share
    first, so a table with most of the operations costs no more than others.
    """
    kind = F.col("kind")
    return (
        valid.select(
            "table_name",
            "kind",
            F.when(kind == ADD_COLUMN, F.col("column_name")).alias("column_name"),
            F.when(kind.isin(NEW_LINK, DROP_COLUMN), F.col("fk_column")).alias("fk_column"),
            "seq",
            "plan_id",
        )
        .groupBy("table_name", "kind", "column_name", "fk_column")
        .agg(F.min(F.struct("seq", "plan_id")).alias("first"), F.max("seq").alias("last_seq"))
        .select("table_name", "kind", "column_name", "fk_column", "first.seq", "first.plan_id", "last_seq")
    )


def _change_type_queue(firsts: DataFrame, registry: DataFrame, models: DataFrame) -> DataFrame:
    """Models that type changes reload: all a table had when the last one came."""
    last = (
        firsts.filter(F.col("kind") == CHANGE_TYPE)
        .groupBy("table_name")
        .agg(F.max("last_seq").alias("last_seq"))
    )
    there = registry.select(
        "table_name", "model_name", F.lit(-_END_OF_TIME).alias("created_seq")
    ).unionByName(models.select("table_name", "model_name", "created_seq"))
    return (
        there.join(last, "table_name")
        .filter(F.col("created_seq") < F.col("last_seq"))
        .select("table_name", "model_name")
    )


def apply_batch(
    ops: DataFrame, registry: DataFrame, catalog: DataFrame, kinds: list[str] | None = None
) -> Evolution:
    """Apply operations in ``seq`` order; one result row each, none fails the others.

    ``kinds`` says which kinds occur, to leave out the steps that serve others.
    """
    present = set(kinds or HANDLED)
    # Everything below branches off a few small frames of metadata, and branches
    # again. Kept frames keep the plans short and the operations, the catalog and
    # the registry from being read once per branch.
    catalog = keep(catalog.select("table_name", "ordinal", "column_name", "data_type"))
    registry = keep(_with_plan_id(registry))
    specs = keep(_templates(catalog))

    checked = validate_ops(ops)
    valid = checked.filter(F.col("error_code").isNull()).select(
        "seq", "plan_id", "kind", "table_name", "column_name", "fk_column"
    )
    firsts = keep(_first_requests(valid))
    facts = keep(
        _table_facts(firsts.select("table_name").distinct(), registry, catalog, specs)
    )

    parts = []
    effects = []
    if present & {ADD_COLUMN, NEW_HUB, DROP_COLUMN}:
        sats, timeline = _satellites(valid, firsts, registry, facts, present)
        parts.append(sats)
        effects.append(timeline.select("seq"))
    if present & {NEW_HUB, DROP_COLUMN}:
        hubs = _hubs(firsts, registry, facts)
        parts.append(hubs)
    if present & {NEW_LINK, DROP_COLUMN}:
        links = _links(firsts, registry, specs)
        parts.append(links)

    none = registry.limit(0).withColumn("created_seq", F.lit(0).cast("bigint"))
    models = reduce(DataFrame.unionByName, parts, none)
    changed = reduce(DataFrame.unionByName, effects, none.select(F.col("created_seq").alias("seq")))
    models = keep(models.select(*REGISTRY_COLUMNS, "plan_id", "created_seq"))
    # An operation had an effect if it added a column or created a model.
    changed = changed.unionByName(models.select(F.col("created_seq").alias("seq")))

    queued = models.select("table_name", "model_name")
    if CHANGE_TYPE in present:
        queued = queued.unionByName(_change_type_queue(firsts, registry, models))

    renewed = registry.join(models.select("model_name").distinct(), "model_name", "left_anti")
    return Evolution(
        results=_results(checked, facts, keep(changed.distinct())),
        models=models,
        queued=queued.distinct(),
        registry=renewed.select(*REGISTRY_COLUMNS, "plan_id").unionByName(models.drop("created_seq")),
    )


def _results(checked: DataFrame, facts: DataFrame, changed: DataFrame) -> DataFrame:
    """A status for every operation.

    Both joins have a right side of schema size, kept as files of known size: below
    Spark's threshold it is broadcast, else AQE's skew handling splits a hot table.
    """
    known = facts.select("table_name", "business_keys", "present", "link_fks", "found")
    changed = changed.withColumn("changed", F.lit(True))
    kind = F.col("kind")
    is_valid = F.col("objection").isNull()
    names_key = (
        (kind == ADD_COLUMN)
        & F.array_contains("business_keys", F.col("column_name"))
        & ~F.array_contains("present", F.col("column_name"))
    )
    undiscovered = is_valid & kind.isin(NEW_LINK, DROP_COLUMN) & ~F.coalesce("found", F.lit(False))
    no_candidate = (
        is_valid
        & (kind == NEW_LINK)
        & (
            (F.size("link_fks") == 0)
            | (F.col("fk_column").isNotNull() & ~F.array_contains("link_fks", F.col("fk_column")))
        )
    )
    code = (
        F.when(~is_valid, F.col("objection"))
        .when(undiscovered & (kind == NEW_LINK), "DV_DISCOVERY_FAILED")
        .when(undiscovered, "DV_DROP_FAILED")
        .when(no_candidate, "NO_LINK_CANDIDATE")
        .otherwise("")
    )
    status = (
        F.when(~is_valid, F.col("status"))
        .when(undiscovered, M.TRANSIENT_ERROR)
        .when(F.col("changed") | (kind == CHANGE_TYPE) | names_key, M.OK)
        .otherwise(M.ALREADY_APPLIED)
    )
    message = F.when(
        undiscovered,
        F.concat(F.lit("table "), F.col("table_name"), F.lit(f" {M.DISCOVERY_MISSING_TABLE}")),
    ).otherwise(F.coalesce("error_message", F.lit("")))
    evidence = M.evidence_id(F.col("target"), F.col("plan_id"), F.col("idempotency_key"))
    has_evidence = is_valid & (F.col("code") != "DV_DISCOVERY_FAILED")
    return (
        checked.withColumnRenamed("error_code", "objection")
        .join(known, "table_name", "left")
        .join(changed, "seq", "left")
        .withColumn("changed", F.coalesce("changed", F.lit(False)))
        .withColumn("code", code)
        .select(
            "seq",
            "correlation_id",
            "plan_id",
            "idempotency_key",
            "kind",
            "table_name",
            status.alias("status"),
            F.col("code").alias("error_code"),
            message.alias("error_message"),
            F.when(has_evidence, evidence).otherwise("").alias("evidence_snapshot_id"),
        )
    )


def _of_kind(ops: DataFrame, registry: DataFrame, catalog: DataFrame, kind: str) -> Evolution:
    return apply_batch(ops.filter(F.col("kind") == kind), registry, catalog, [kind])


def apply_add_column(ops: DataFrame, registry: DataFrame, catalog: DataFrame) -> Evolution:
    """ADD_COLUMN: one new satellite version per plan and table with its columns."""
    return _of_kind(ops, registry, catalog, ADD_COLUMN)


def apply_new_hub(ops: DataFrame, registry: DataFrame, catalog: DataFrame) -> Evolution:
    """NEW_HUB: a hub, and an empty satellite if the table has none."""
    return _of_kind(ops, registry, catalog, NEW_HUB)


def apply_new_link(ops: DataFrame, registry: DataFrame, catalog: DataFrame) -> Evolution:
    """NEW_LINK: a link per foreign key (or the named one) that none covers."""
    return _of_kind(ops, registry, catalog, NEW_LINK)


def apply_change_type(ops: DataFrame, registry: DataFrame, catalog: DataFrame) -> Evolution:
    """CHANGE_TYPE: nothing is altered, the table's models are queued."""
    return _of_kind(ops, registry, catalog, CHANGE_TYPE)


def apply_drop_column(ops: DataFrame, registry: DataFrame, catalog: DataFrame) -> Evolution:
    """DROP_COLUMN: the current shape stands beside the old one, nothing is dropped."""
    return _of_kind(ops, registry, catalog, DROP_COLUMN)


# The models an operation answers for ("base" is a table's first satellite,
# "sat" a later version), and its codes where a load fails for good and where trying
# again may help.
_LOADS = {
    ADD_COLUMN: (["base", "sat"], "VAULT_ADD_COLUMN_FAILED", "VAULT_ADD_COLUMN_TRANSIENT"),
    NEW_HUB: (["hub", "base"], None, "VAULT_NEW_HUB_TRANSIENT"),
    NEW_LINK: (["link"], "VAULT_NEW_LINK_FAILED_PERMANENT", "VAULT_NEW_LINK_TRANSIENT"),
    CHANGE_TYPE: (["hub", "link", "base", "sat"], None, "DV_CHANGE_TYPE_FAILED"),
    DROP_COLUMN: (["hub", "link", "base", "sat"], None, "DV_DROP_FAILED"),
}


def with_load_outcomes(results: DataFrame, registry: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Results in which operations answer for the loads they queued.

    ``outcomes`` has ``model_name, table_name, ok, message`` (see ``load.load_outcomes``).
    An operation that was applied, and one of whose kind of models of its table failed to
    load, fails with the message of the first such model: for good, or so that trying again
    may help, as the message tells; new hubs, changed types and dropped columns can always
    be tried again. A failed ADD_COLUMN keeps no evidence. Other results stay as they are.
    """
    base = (F.col("model_type") == "sat") & (model_version(F.col("model_name")) <= 1)
    kinds = registry.select("model_name", F.when(base, "base").otherwise(F.col("model_type")).alias("model_type")).distinct()
    failed = outcomes.filter(~F.col("ok")).join(kinds, "model_name").groupBy("table_name", "model_type").agg(
        F.min(F.struct("model_name", "message")).alias("first"))
    pairs = [(kind, t) for kind, (types, _, _) in _LOADS.items() for t in types]
    answers = results.sparkSession.createDataFrame(pairs, "kind string, model_type string")
    blamed = failed.join(answers, "model_type").groupBy("table_name", "kind").agg(F.min("first").alias("first"))
    joined = results.join(blamed, ["table_name", "kind"], "left")
    fails = F.col("first").isNotNull() & (F.col("status") == M.OK)
    code, for_good = F.lit(None).cast("string"), F.lit(False)
    for kind, (_, permanent, transient) in _LOADS.items():
        lasting = F.lit(permanent is not None) & ~M.is_transient(F.col("first.message"))
        code = F.when(F.col("kind") == kind, F.when(lasting, F.lit(permanent)).otherwise(F.lit(transient))).otherwise(code)
        for_good = F.when(F.col("kind") == kind, lasting).otherwise(for_good)
    new = {
        "status": F.when(for_good, M.PERMANENT_ERROR).otherwise(M.TRANSIENT_ERROR),
        "error_code": code,
        "error_message": F.col("first.message"),
        "evidence_snapshot_id": F.when(F.col("kind") == ADD_COLUMN, "").otherwise(F.col("evidence_snapshot_id")),
    }
    return joined.select(*(
        F.when(fails, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in results.columns))


def evolution_log(results: DataFrame) -> DataFrame:
    """Results as rows of the metadata log."""
    return results.select(
        F.lit("vault").alias("layer"),
        F.col("table_name").alias("target"),
        "plan_id",
        "correlation_id",
        "idempotency_key",
        F.regexp_replace("kind", "^OPERATION_", "").alias("operation_kind"),
        F.col("evidence_snapshot_id").alias("evidence_id"),
        F.when(F.col("error_code") == "", F.col("status"))
        .otherwise(F.concat_ws(": ", "error_code", "error_message"))
        .alias("note"),
    )


# --- views of the model ---------------------------------------------------------------


def probe_links(tables: DataFrame, catalog: DataFrame) -> DataFrame:
    """Link candidates of requested tables ``(table_name, fk_filter)``, nothing created."""
    asked = tables.select(
        physical_name(F.col("table_name")).alias("table_name"),
        _filled(F.col("fk_filter")).alias("fk_filter"),
    ).distinct()
    return (
        _templates(catalog)
        .filter(F.col("model_type") == "link")
        .join(asked, "table_name")
        .filter(F.col("fk_filter").isNull() | (F.col("business_keys")[1] == F.col("fk_filter")))
        .select("table_name", "fk_filter", F.col("model_name").alias("name"), F.col("business_keys").alias("keys"))
    )


def introspect_vault(registry: DataFrame) -> DataFrame:
    """Each table's vault structures and model columns, nested and as JSON.

    ``vaults`` is empty for a table without a hub.
    """
    kind = F.col("model_type")

    def names(k: str) -> Column:
        return F.array_sort(F.collect_list(F.when(kind == k, F.col("model_name"))))

    described = F.array_sort(F.collect_list(F.struct(F.col("model_name").alias("name"), "columns")))
    grouped = registry.groupBy("table_name").agg(
        names("hub").alias("hubs"),
        names("link").alias("links"),
        names("sat").alias("satellites"),
        described.alias("tables"),
    )
    vault = F.struct(F.get("hubs", F.lit(0)).alias("hub"), "links", "satellites")
    vaults = F.when(F.size("hubs") > 0, F.array(vault)).otherwise(F.filter(F.array(vault), lambda v: F.lit(False)))
    evidence = grouped.select("table_name", vaults.alias("vaults"), "tables")
    return evidence.withColumn(
        "raw_evidence_json",
        F.to_json(F.struct(F.col("table_name").alias("dataset_id"), "vaults", "tables")),
    )
