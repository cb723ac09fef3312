"""From a column catalog to a registry of hubs, links and satellites.

All tables are modelled by one job over the catalog
``(table_name, ordinal, column_name, data_type)``. The catalog is metadata: its
size follows the number of columns, not of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.names import (
    COMMON_KEY_NAMES,
    MODEL_AUDIT_COLUMNS,
    NEUTRAL_TABLE_TOKENS,
    TECHNICAL_COLUMNS,
    is_key_candidate,
    normalize_name,
    singularize,
    strip_key_suffix,
)

REGISTRY_COLUMNS = [
    "model_name", "table_name", "model_type", "business_keys", "attributes", "columns",
]
# Model kinds and their alias.
MODEL_TYPES = {"hub": "hub", "link": "link", "sat": "sat", "satellite": "sat"}


def _no_names() -> Column:
    return F.array().cast("array<string>")


def _ordered(rows: Column) -> Column:
    """Column names of collected ``(ordinal, column_name)`` rows, in order."""
    return F.transform(F.array_sort(rows), lambda r: r["column_name"])


def key_candidates(catalog: DataFrame) -> DataFrame:
    """Columns whose name holds a key token."""
    return catalog.filter(is_key_candidate(F.col("column_name"))).select(
        "table_name", "ordinal", "column_name"
    )


def hub_key(catalog: DataFrame) -> DataFrame:
    """One key per table: the first candidate that starts with the singular table
    name, else the first candidate."""
    named = normalize_name(F.col("column_name")).startswith(singularize(F.col("table_name")))
    return (
        key_candidates(catalog)
        .groupBy("table_name")
        .agg(F.min(F.struct((~named).alias("other"), "ordinal", "column_name")).alias("best"))
        .select(
            "table_name",
            F.col("best.column_name").alias("hub_key"),
            (~F.col("best.other")).alias("name_match"),
        )
    )


def foreign_keys(catalog: DataFrame) -> DataFrame:
    """Key candidates other than the hub key."""
    return (
        key_candidates(catalog)
        .join(hub_key(catalog), "table_name")
        .filter(F.col("column_name") != F.col("hub_key"))
        .select("table_name", "ordinal", "column_name", "hub_key")
    )


def attributes(catalog: DataFrame) -> DataFrame:
    """Columns that are neither key candidates nor technical."""
    return catalog.filter(
        ~is_key_candidate(F.col("column_name")) & ~F.col("column_name").isin(TECHNICAL_COLUMNS)
    ).select("table_name", "ordinal", "column_name")


def table_metadata(catalog: DataFrame) -> DataFrame:
    """Per table: all columns, hub key, foreign keys, business keys, attributes."""
    name = F.col("column_name")
    row = F.struct("ordinal", "column_name")
    kind = (
        F.when(is_key_candidate(name), "key")
        .when(name.isin(TECHNICAL_COLUMNS), "technical")
        .otherwise("attribute")
    )
    grouped = (
        catalog.withColumn("kind", kind)
        .groupBy("table_name")
        .agg(
            _ordered(F.collect_list(row)).alias("columns"),
            _ordered(F.collect_list(F.when(F.col("kind") == "key", row))).alias("keys"),
            _ordered(F.collect_list(F.when(F.col("kind") == "attribute", row))).alias("attributes"),
        )
    )
    base = singularize(F.col("table_name"))
    named = F.filter("keys", lambda k: normalize_name(k).startswith(base))
    best = F.coalesce(F.try_element_at(named, F.lit(1)), F.try_element_at("keys", F.lit(1)))
    return (
        grouped.withColumn("hub_key", best)
        .withColumn("foreign_keys", F.filter("keys", lambda k: k != F.col("hub_key")))
        .select(
            "table_name",
            "columns",
            F.when(
                F.col("hub_key").isNotNull(), F.concat(F.array("hub_key"), F.col("foreign_keys"))
            )
            .otherwise(_no_names())
            .alias("business_keys"),
            "attributes",
            "hub_key",
            F.coalesce("foreign_keys", _no_names()).alias("foreign_keys"),
        )
    )


def split_vault(meta: DataFrame) -> DataFrame:
    """Model specs of each table: a hub, a satellite if there are attributes, and
    one link per foreign key. ``place`` keeps the order of the links."""
    base = singularize(F.col("table_name"))
    keyed = meta.filter(F.col("hub_key").isNotNull())
    key = F.array("hub_key")

    def spec(rows: DataFrame, name: Column, kind: str, keys: Column, attrs: Column, place: Column):
        return rows.select(
            name.alias("model_name"),
            "table_name",
            F.lit(kind).alias("model_type"),
            keys.alias("business_keys"),
            attrs.alias("attributes"),
            F.concat(keys, attrs).alias("columns"),
            place.cast("int").alias("place"),
        )

    hubs = spec(keyed, F.concat(F.lit("hub_"), base), "hub", key, _no_names(), F.lit(0))
    sats = spec(
        keyed.filter(F.size("attributes") > 0),
        F.concat(F.lit("sat_"), base), "sat", key, F.col("attributes"), F.lit(0),
    )
    per_fk = keyed.select("table_name", "hub_key", F.posexplode("foreign_keys").alias("fk_at", "fk"))
    link_name = F.concat_ws("_", F.lit("link"), base, singularize(strip_key_suffix(F.col("fk"))))
    links = spec(per_fk, link_name, "link", F.array("hub_key", "fk"), _no_names(), F.col("fk_at"))
    return hubs.unionByName(links).unionByName(sats)


def model_type(meta: DataFrame) -> DataFrame:
    """Kind of table by shape: one key is a hub, several keys and nothing besides
    audit columns a link, anything else a satellite."""
    audit = F.array(*[F.lit(c) for c in MODEL_AUDIT_COLUMNS])
    other = F.filter(
        F.array_except("columns", "business_keys"), lambda c: ~F.array_contains(audit, F.lower(c))
    )
    keys = F.size("business_keys")
    return meta.withColumn(
        "model_type",
        F.when(keys == 1, "hub").when((keys > 1) & (F.size(other) == 0), "link").otherwise("sat"),
    )


def _first_registered_keys(registry: DataFrame) -> DataFrame:
    """Keys a table already has: from its hub, else satellite, else link, by name."""
    rank = F.when(F.col("model_type") == "hub", 0).when(F.col("model_type") == "sat", 1).otherwise(2)
    keys = F.filter("business_keys", lambda k: k.isNotNull() & (k != ""))
    return (
        registry.withColumn("keys", keys)
        .filter(F.size("keys") > 0)
        .groupBy("table_name")
        .agg(F.min(F.struct(rank.alias("rank"), "model_name", "keys")).alias("best"))
        .select("table_name", F.col("best.keys").alias("registered_keys"))
    )


def infer_business_keys(tables: DataFrame, catalog: DataFrame, registry: DataFrame) -> DataFrame:
    """Business keys per table: registered ones, else by name, else by position.

    By name: ``<token>id`` or ``<token>_id`` for the table name's tokens, then the
    common key names; failing that the first column ending in ``id``; failing
    that the first column; ``id`` for a table without columns.
    """
    named = (
        catalog.select(
            "table_name", "ordinal", F.lower(F.trim("column_name")).alias("column_name")
        )
        .filter(F.col("column_name") != "")
    )
    tokens = F.filter(
        F.split(F.translate("table_name", "-", "_"), "_"),
        lambda t: (t != "") & ~t.isin(NEUTRAL_TABLE_TOKENS),
    )
    stems = F.transform(tokens, lambda t: F.regexp_replace(t, "s$", ""))
    from_tokens = F.flatten(
        F.transform(stems, lambda t: F.array(F.concat(t, F.lit("id")), F.concat(t, F.lit("_id"))))
    )
    preferred = F.concat(from_tokens, F.array(*[F.lit(n) for n in COMMON_KEY_NAMES]))
    rank = F.array_position(preferred, F.col("column_name")).cast("int")
    inferred = named.groupBy("table_name").agg(
        F.min(F.when(rank > 0, F.struct(rank.alias("rank"), "column_name"))).alias("preferred"),
        F.min(
            F.when(F.col("column_name").endswith("id"), F.struct("ordinal", "column_name"))
        ).alias("suffixed"),
        F.min(F.struct("ordinal", "column_name")).alias("first"),
    )
    return (
        tables.select("table_name")
        .distinct()
        .join(_first_registered_keys(registry), "table_name", "left")
        .join(inferred, "table_name", "left")
        .select(
            "table_name",
            F.coalesce(
                "registered_keys",
                F.array(
                    F.coalesce(
                        "preferred.column_name", "suffixed.column_name", "first.column_name",
                        F.lit("id"),
                    )
                ),
            ).alias("business_keys"),
        )
    )


def registry_rows(specs: DataFrame) -> DataFrame:
    """Specs in registry form: known kinds, no repeated names, attributes without keys.

    A hub or link without a key, or an unknown kind, fails the job.
    """
    given = F.lower(F.coalesce("model_type", F.lit("")))
    kinds = F.create_map(*[F.lit(x) for pair in MODEL_TYPES.items() for x in pair])
    kind = F.try_element_at(kinds, given)
    checked = (
        F.when(kind.isNull(), F.raise_error(F.concat(F.lit("unsupported model type: "), given)))
        .when(
            kind.isin("hub", "link") & (F.size("business_keys") == 0),
            F.raise_error(F.concat(F.col("model_name"), F.lit(" needs business keys"))),
        )
        .otherwise(kind)
    )
    return specs.select(
        "model_name",
        "table_name",
        checked.alias("model_type"),
        "business_keys",
        F.array_except(F.array_distinct("attributes"), "business_keys").alias("attributes"),
        F.array_distinct("columns").alias("columns"),
    )


def model_lake(catalog: DataFrame) -> DataFrame:
    """The registry of every table. A model name stands once: the last spec wins."""
    specs = split_vault(table_metadata(catalog))
    last = Window.partitionBy("model_name").orderBy(F.desc("table_name"), F.desc("place"))
    single = specs.withColumn("rank", F.row_number().over(last)).filter("rank = 1")
    return registry_rows(single)


def models_by_table(registry: DataFrame) -> DataFrame:
    """Model names per table, sorted."""
    return registry.groupBy("table_name").agg(
        F.array_sort(F.collect_list("model_name")).alias("models")
    )


def models_of_type(registry: DataFrame, kind: str) -> DataFrame:
    """Registry rows of one kind, any case."""
    return registry.filter(F.lower("model_type") == kind.lower())


def content_hash() -> Column:
    """Hash of a registry row's content."""
    return F.sha2(F.to_json(F.struct(*REGISTRY_COLUMNS)), 256)


def registry_changed(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks or holds with other content."""
    known = old.select("model_name", content_hash().alias("content")).distinct()
    return (
        new.withColumn("content", content_hash())
        .join(known, ["model_name", "content"], "left_anti")
        .drop("content")
    )
