"""Capture changed lake rows as envelopes, table by table, in one frame."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc
from ..operators.envelope import MESSAGE_ID
from ..sources.envelopes import publish_envelopes
from ..sources.folders import delete
from ..sources.storage import complete_version, read_snapshot, write_snapshot

OUTBOX = "_outbox"


def _marks(watermarks: DataFrame) -> dict[str, dt.datetime]:
    """Marks by table: one value per table, needed as scan literals."""
    rows = watermarks.select("table_name", cdc.micros_of("watermark")).collect()
    return {r["table_name"]: cdc.from_micros(r["watermark"]) for r in rows if r["watermark"] is not None}


def capture(
    tables: dict[str, DataFrame],
    ts_columns: dict[str, str],
    watermarks: DataFrame,
    skip_full_load: set[str] = frozenset(),
) -> tuple[DataFrame | None, DataFrame]:
    """Envelopes of all rows past their table's mark, and the marks afterwards.

    Tables without a change column are left out. A table without a mark is
    captured whole, unless an initial load has claimed it. Each table's mark is a
    literal in its own scan, so old row groups are skipped.
    """
    marks = _marks(watermarks)
    envelopes, changes = [], []
    for table, frame in tables.items():
        ts_col = ts_columns.get(table)
        if ts_col is None or ts_col not in frame.columns:
            continue
        if table not in marks and table in skip_full_load:
            continue
        rows = cdc.new_rows(frame, ts_col, marks.get(table))
        envelopes.append(cdc.to_envelopes(rows, table, ts_col))
        changes.append(cdc.change_marks(rows, table, ts_col))
    if not envelopes:
        return None, watermarks
    return (
        reduce(DataFrame.unionByName, envelopes),
        cdc.advance_watermarks(reduce(DataFrame.unionByName, changes), watermarks),
    )


def initial_load(
    tables: dict[str, DataFrame], ts_columns: dict[str, str], watermarks: DataFrame
) -> tuple[DataFrame | None, DataFrame]:
    """Envelopes of whole tables that have no mark yet, and the marks afterwards."""
    marks = _marks(watermarks)
    fresh = {t: f for t, f in tables.items() if t not in marks}
    return capture(fresh, ts_columns, watermarks)


def stored_marks(spark: SparkSession, path: str) -> DataFrame:
    """The marks that the last finished capture stored; none at first."""
    stored = read_snapshot(spark, path)
    if stored is None:
        return spark.createDataFrame([], "table_name string, watermark timestamp")
    return cdc.load_watermarks(stored)


def write_outbox(envelopes: DataFrame, outbox: str, version: int) -> None:
    """Fix what a run publishes, with ids that no other run or job gives.

    Ids are a run's own prefix and a number that tells its rows apart; reading them
    from the written outbox, and not making them again, keeps them the same in a repeat.
    """
    number = F.monotonically_increasing_id().cast("string")
    write_snapshot(envelopes.withColumn(MESSAGE_ID, F.concat(F.lit(f"{uuid.uuid4().hex}-"), number)), outbox, version)


def capture_job(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    ts_columns: dict[str, str],
    marks_path: str,
    fmt: str,
    path: str | None = None,
    skip_full_load: set[str] = frozenset(),
    **options: str,
) -> int:
    """Publish all rows past the stored marks, then store the marks; returns the rows published.

    The envelopes are fixed in an outbox below the marks before they are published, each
    with a message id, and the marks are those of the very rows published: what arrives
    meanwhile waits for the next run. A run that stops before its marks are stored is
    repeated from its outbox, so messages are delivered at least once, and a repeated
    message has the id it had before: a stream with a ``replay_window`` lands it once.
    """
    version = complete_version(spark, marks_path) + 1
    outbox = f"{marks_path}/{OUTBOX}"
    if complete_version(spark, outbox) < version:
        envelopes, _ = capture(tables, ts_columns, stored_marks(spark, marks_path), skip_full_load)
        if envelopes is None:
            return 0
        write_outbox(envelopes, outbox, version)
    fixed = read_snapshot(spark, outbox)
    publish_envelopes(fixed, fmt, path, **options)
    seen = fixed.groupBy(F.col("table").alias("table_name")).agg(
        F.max(F.unix_micros(F.col("cdc_ingestion_timestamp").try_cast("timestamp"))).alias("micros"), F.count(F.lit(1)).alias("n"))
    changes = seen.collect()  # one row per table
    moved = spark.createDataFrame(
        [(r["table_name"], r["micros"]) for r in changes], "table_name string, micros bigint"
    ).select("table_name", F.timestamp_micros("micros").alias("watermark"))
    marks = stored_marks(spark, marks_path)
    write_snapshot(cdc.save_watermarks(cdc.advance_watermarks(moved, marks)).coalesce(1), marks_path, version)
    delete(spark, outbox)
    return sum(r["n"] for r in changes)
