"""From JSON messages to bronze rows. The same code serves batch and stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import utc_literal

# --- Fixed values: field names of a change message. ---------------------------
CHANGE_TIME_FIELDS = ["cdc_modified_at", "cdc_ingestion_timestamp", "modified_at"]
ENVELOPE_COLUMNS = ["table", "payload", "cdc_type", "cdc_modified_at"]
STREAM_SOURCE = "kafka_cdc"
# ------------------------------------------------------------------------------

# The id that a capture gives a message, in the message and in bronze.
MESSAGE_ID = "message_id"

_MESSAGE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ["table", "payload", "cdc_type", *CHANGE_TIME_FIELDS]]
)
_TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def parse_envelopes(messages: DataFrame, with_id: bool = False) -> DataFrame:
    """Messages to envelope columns, and the message id if asked for; those that name no table are dropped.

    A malformed message parses to NULL fields and so goes the same way. The
    change time is read under any of its three spellings. Other columns of the
    message, such as its source position, stay.
    """
    rest = [c for c in messages.columns if c != "value"]
    schema, ids = (T.StructType([*_MESSAGE, T.StructField(MESSAGE_ID, T.StringType())]), [MESSAGE_ID]) if with_id else (_MESSAGE, [])
    # Unpacking through a generator keeps the filter above the parse; pushed into
    # the projection, it would parse every message a second time.
    return (
        messages.select(*rest, F.inline(F.array(F.from_json("value", schema))))
        .filter(F.col("table").isNotNull())
        .select(
            "table",
            "payload",
            "cdc_type",
            F.coalesce(*CHANGE_TIME_FIELDS).alias("cdc_modified_at"),
            *ids,
            *rest,
        )
    )


def normalize_table(envelopes: DataFrame) -> DataFrame:
    """Lower-cased table names; rows without one are dropped."""
    return envelopes.withColumn("table", F.lower("table")).filter(F.col("table").isNotNull())


def allow_tables(envelopes: DataFrame, names: list[str]) -> DataFrame:
    """Keep the named tables, any case."""
    return envelopes.filter(F.lower("table").isin([n.strip().lower() for n in names]))


def route_one(envelopes: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """One table's rows parsed with a schema known beforehand (exact name)."""
    return (
        envelopes.filter(F.col("table") == table)
        .select(F.from_json("payload", schema).alias("r"))
        .select("r.*")
    )


def payload_keys(envelopes: DataFrame) -> DataFrame:
    """``(table, position, column_name)`` of all payloads, lower-cased.

    Rows are first reduced to their distinct key lists, of which there are few,
    so the shuffle does not grow with the rows. A key's position is the farthest
    one it has anywhere, which is its place in the fullest payload.
    """
    shapes = (
        envelopes.select(
            F.lower("table").alias("table"), F.json_object_keys("payload").alias("keys")
        )
        .groupBy("table", "keys")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    # Tied to the count, the generator's null check stays above the aggregation
    # instead of listing every payload's keys twice.
    keys = F.when(F.col("n_rows") > 0, F.col("keys"))
    return (
        shapes.select("table", F.posexplode(keys).alias("position", "column_name"))
        .groupBy("table", F.lower("column_name").alias("column_name"))
        .agg(F.max("position").alias("position"))
        .select("table", "position", "column_name")
    )


def payload_keys_from_history(history: DataFrame, known: DataFrame) -> DataFrame:
    """Payload keys of the tables that ``known`` (column ``table``) does not cover.

    The names, one per table of the lake, are sent to the history. Shuffled by
    name, all messages of a table would meet in one task.
    """
    fresh = history.withColumn("table", F.lower("table"))
    names = F.broadcast(known.select("table").distinct())
    return payload_keys(fresh.join(names, "table", "left_anti"))


def payload_map(payload: Column) -> Column:
    """A payload as text map; nested values stay JSON text."""
    return F.from_json(payload, _TEXT_MAP)


def map_value(fields: Column, name: Column) -> Column:
    """A field by its lower-case name, under whatever spelling the payload used."""
    other = F.filter(F.map_entries(fields), lambda e: F.lower(e["key"]) == name)
    return F.coalesce(F.try_element_at(fields, name), F.try_element_at(other, F.lit(-1))["value"])


def lower_keys(fields: Column) -> Column:
    """A payload map with lower-case keys, so that a column is one look-up.

    Of spellings that differ in case only, the lower-case one counts if it has a
    value, else the last. Maps that are lower-case already, the common case, stay as
    they are; only those with such spellings are put together key by key.
    """
    keys = F.map_keys(fields)
    # One text of all keys: a call per key costs much more on every row.
    spelled = F.array_join(keys, "")
    low = F.transform(keys, lambda k: F.lower(k))
    merged = F.map_from_entries(
        F.transform(F.array_distinct(low), lambda k: F.struct(k.alias("key"), map_value(fields, k).alias("value"))))
    return (
        F.when(fields.isNull() | (spelled == F.lower(spelled)), fields)
        .when(F.size(F.array_distinct(low)) == F.size(low), F.transform_keys(fields, lambda k, _: F.lower(k)))
        .otherwise(merged)
    )


def widen(landed: DataFrame, columns: list[str], fields: str = "fields") -> DataFrame:
    """Text columns out of the ``fields`` map with its lower-case keys, followed by the other columns."""
    rest = [c for c in landed.columns if c != fields]
    return landed.select(
        *[F.try_element_at(F.col(fields), F.lit(c.lower())).alias(c.lower()) for c in columns],
        *[F.col(f"`{c}`") for c in rest if c not in {x.lower() for x in columns}],
    )


def parse_payload(envelopes: DataFrame, columns: list[str]) -> DataFrame:
    """Payloads to one STRING column per name, plus the change columns."""
    spelled = envelopes.select(payload_map(F.col("payload")).alias("spelled"), "cdc_type", "cdc_modified_at")
    with_map = spelled.select(lower_keys(F.col("spelled")).alias("fields"), "cdc_type", "cdc_modified_at")
    return widen(with_map, columns)


def add_audit(
    df: DataFrame, now: dt.datetime | Column | None = None, source: str = STREAM_SOURCE
) -> DataFrame:
    """Add ``__ingested_at`` (given, or the query's clock) and ``__record_source``."""
    if now is None:
        now = F.current_timestamp()
    elif not isinstance(now, Column):
        now = utc_literal(now)
    return df.withColumn("__ingested_at", now).withColumn("__record_source", F.lit(source))


def drop_replays(stamped: DataFrame, window: str) -> DataFrame:
    """Messages of a stream whose id came before, within a time, are left out; messages without an id stay.

    The state holds the ids of the last ``window`` by ingest time, spread by id.
    """
    one = F.coalesce(MESSAGE_ID, F.uuid())
    return (
        stamped.withColumn("__once", one)
        .withWatermark("__ingested_at", window)
        .dropDuplicatesWithinWatermark(["__once"])
        .drop("__once")
    )


def landing_rows(envelopes: DataFrame) -> DataFrame:
    """Envelopes that land: those with a table and a payload, which is text still."""
    rest = [c for c in envelopes.columns if c not in ("table", "payload")]
    # Unpacking through a generator keeps the filter above the payload; pushed below
    # the projection that makes it, it would make every payload a second time.
    return (
        normalize_table(envelopes)
        .select("table", F.explode(F.array("payload")).alias("payload"), *rest)
        .filter(F.col("payload").isNotNull() & (F.col("table") != ""))
    )


def landed_fields(rows: DataFrame) -> DataFrame:
    """``landing_rows`` with their payload as a map, ``fields``, whose keys are lower-case."""
    rest = [c for c in rows.columns if c not in ("table", "payload")]
    return rows.select("table", payload_map(F.col("payload")).alias("spelled"), *rest).select(
        "table", lower_keys(F.col("spelled")).alias("fields"), *rest)


def land_payload(envelopes: DataFrame) -> DataFrame:
    """Bronze rows of any mix of tables: the payload as a map, in one frame.

    One frame for all tables means one write per batch however many tables it
    holds; columns are taken out of the map when a table is read. Keys land in
    lower case, once, so that readers need not look through a map for spellings.
    """
    return landed_fields(landing_rows(envelopes))


def missing_required(df: DataFrame, required: list[str] | None = None) -> list[str]:
    """Required columns the frame lacks; a batch with any is skipped."""
    return sorted(set(required or ENVELOPE_COLUMNS) - set(df.columns))


def touched_tables(envelopes: DataFrame) -> DataFrame:
    """Tables that a batch writes to, with their rows.

    A table none of whose rows carries a payload gives no columns and no rows.
    """
    return (
        normalize_table(envelopes)
        .groupBy("table")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count("payload").alias("with_payload"))
        .filter(F.col("with_payload") > 0)
        .select("table", "n_rows")
    )
