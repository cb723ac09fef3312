"""Metadata, lineage, impact, bursts and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .modelling import REGISTRY_COLUMNS


def lineage(registry: DataFrame, logged_at: Column | None = None) -> DataFrame:
    """Source table to model, with an id that follows from the content."""
    return registry.select(
        F.col("table_name").alias("source_table"),
        F.col("model_name").alias("target_model"),
        "model_type",
        "business_keys",
        "attributes",
        "columns",
        F.sha2(F.to_json(F.struct(*REGISTRY_COLUMNS)), 256).alias("lineage_id"),
        (F.current_timestamp() if logged_at is None else logged_at).alias("logged_at"),
    )


def impacted_models(touched: DataFrame, registry: DataFrame) -> DataFrame:
    """Models to reload after a batch that touched some tables."""
    tables = touched.select(F.lower("table").alias("table_name")).distinct()
    models = registry.select(F.lower("table_name").alias("table_name"), "model_name")
    return models.join(tables, "table_name", "left_semi").select("model_name").distinct()


def referenced_sources(registry: DataFrame, known: DataFrame, requested: DataFrame) -> DataFrame:
    """Source tables to declare: those known before, those of the requested models
    and those of all registered models, lower-cased and without repeats."""
    low = F.lower(F.trim("table_name")).alias("table_name")
    of_request = registry.join(requested.select("model_name").distinct(), "model_name", "left_semi")
    return (
        known.select(low)
        .unionByName(of_request.select(low))
        .unionByName(registry.select(low))
        .filter(F.col("table_name") != "")
        .distinct()
    )


def reconcile(expected: DataFrame, landed: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Per table: rows that should have arrived, rows that did, and whether that suffices.

    ``base`` holds the rows present before anything was produced.
    """
    counts = expected.select("table", F.col("n_rows").alias("produced"))
    if base is None:
        counts = counts.withColumn("base", F.lit(0).cast("bigint"))
    else:
        before = base.select("table", F.col("n_rows").alias("base"))
        counts = counts.join(before, "table", "full_outer")
    arrived = landed.select("table", F.col("n_rows").alias("landed"))
    zero = F.lit(0).cast("bigint")
    joined = counts.join(arrived, "table", "full_outer").select(
        "table",
        (F.coalesce("base", zero) + F.coalesce("produced", zero)).alias("target"),
        F.coalesce("landed", zero).alias("landed"),
    )
    return joined.withColumn("reached", F.col("landed") >= F.col("target")).withColumn(
        "short", F.greatest(F.col("target") - F.col("landed"), zero)
    )


def _stream_bursts(df: DataFrame, ts: str, value: str, quiet_seconds: int, keys: list[str]) -> DataFrame:
    """Bursts of a stream by two chained aggregations: bins of the quiet time, then sessions of bins.

    The first step's state is spread over keys and bins and reduced by map tasks, so a
    dominant key, or a queue without keys, brings one row per bin to its session. A bin
    reaches the second step when the watermark has passed its end, up to a quiet time
    after a session that it continues would have ended; sessions are therefore kept with
    both ends moved on by a quiet time, which is taken off again at the end. So a burst
    comes out one quiet time after the watermark has passed its end. Spark joins sessions
    that only touch, so each is a microsecond short meanwhile.
    """
    quiet = F.expr(f"INTERVAL {quiet_seconds} SECONDS")
    bins = df.groupBy(*keys, F.window(ts, f"{quiet_seconds} seconds").alias("bin")).agg(
        F.min(ts).alias("first_at"),
        F.max(ts).alias("last_at"),
        F.count(F.lit(1)).alias("n_requests"),
        F.collect_set(value).alias("values"),
    )

    def micros(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    seconds = ((micros("last_at") - micros("first_at") + quiet_seconds * 1_000_000 - 1) / F.lit(1_000_000)).cast("decimal(18,6)")
    placed = bins.select(
        *keys,
        # An aggregate of the event time is event time too: marked as such, as the window's own end is.
        (F.col("first_at") + quiet).alias("moved", metadata={"spark.watermarkDelayMs": 0}),
        F.make_interval(secs=seconds).alias("gap"),
        "n_requests",
        "values",
    )
    # Spark's streaming sessions need a key; a single queue gets one that is
    # the same for all requests.
    by = keys or [F.isnotnull("moved").alias("all")]
    return (
        placed.groupBy(*by, F.session_window("moved", F.col("gap")).alias("s"))
        .agg(F.sum("n_requests").alias("n_requests"), F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"))
        .select(
            *keys,
            (F.col("s.start") - quiet).alias("burst_start"),
            (F.col("s.end") - quiet + F.expr("INTERVAL 1 MICROSECOND")).alias("burst_end"),
            "n_requests",
            F.array_sort("values").alias("values"),
        )
    )


def coalesce_bursts(
    df: DataFrame,
    ts: str,
    value: str,
    quiet_seconds: int,
    keys: list[str] | None = None,
    slice_seconds: int = 86_400,
) -> DataFrame:
    """Requests closer together than ``quiet_seconds`` as one burst.

    Gives ``keys, burst_start, burst_end, n_requests, values``; ``burst_end`` is
    the last request plus the quiet time, when the burst may run. Requests without
    a time count nowhere. A stream needs a watermark on ``ts``, set first, and gives
    the same bursts in append mode.

    A batch works in three steps, so that a key with a large share of the rows is
    never one task. Requests within one bin of the quiet time's length always
    belong together, so map tasks first reduce the rows to one per key and bin.
    Bins are then chained to sessions within fixed time slices, and last the
    sessions that touch a slice's edge are merged: only a slice's first and last
    session can continue in a neighbour, all others pass the last step by.
    """
    keys = list(keys or [])
    if df.isStreaming:
        return _stream_bursts(df, ts, value, quiet_seconds, keys)

    def islands(rows: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
        """Number the chains of intervals whose gaps are under the quiet time."""
        order = Window.partitionBy(*by).orderBy(start, end)
        gap_ok = F.col(start) < F.lag(end).over(order) + F.expr(f"INTERVAL {quiet_seconds} SECONDS")
        return rows.withColumn("opens", F.when(gap_ok, 0).otherwise(1)).withColumn(
            "island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
        )

    at = F.col(ts)
    def gather(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.groupBy(*by).agg(
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
            F.sum("n_requests").alias("n_requests"),
            F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"),
        )

    in_slice = [*keys, "slice"]
    bin_micros = quiet_seconds * 1_000_000
    slice_micros = bin_micros * max(slice_seconds // quiet_seconds, 1)

    def down_to(micros: Column, size: int) -> Column:
        return micros - F.pmod(micros, F.lit(size))

    bins = (
        df.filter(at.isNotNull())
        .select(
            *keys,
            at.alias("at"),
            down_to(F.unix_micros(at.cast("timestamp")), bin_micros).alias("bin"),
            F.col(value).alias("value"),
        )
        .groupBy(*keys, "bin")
        .agg(
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
            F.count(F.lit(1)).alias("n_requests"),
            F.collect_set("value").alias("values"),
        )
        .withColumn("slice", down_to(F.col("bin"), slice_micros))
        .drop("bin")
    )
    sessions = gather(islands(bins, in_slice, "first_at", "last_at"), [*in_slice, "island"])
    islands_of_slice = Window.partitionBy(*in_slice)
    placed = sessions.withColumn("islands", F.max("island").over(islands_of_slice))
    at_edge = (F.col("island") == 1) | (F.col("island") == F.col("islands"))
    inner = placed.filter(~at_edge).select(*keys, "first_at", "last_at", "n_requests", "values")
    edges = islands(placed.filter(at_edge).drop("island"), keys, "first_at", "last_at")
    merged = gather(edges, [*keys, "island"]).drop("island")
    return inner.unionByName(merged).select(
        *keys,
        F.col("first_at").alias("burst_start"),
        (F.col("last_at") + F.expr(f"INTERVAL {quiet_seconds} SECONDS")).alias("burst_end"),
        "n_requests",
        F.array_sort("values").alias("values"),
    )


def chunk_bursts(bursts: DataFrame, max_values: int) -> DataFrame:
    """Bursts cut into runs of at most ``max_values`` values, in sorted order."""
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("values") - 1, F.lit(0)), F.lit(max_values)),
        lambda i: F.slice("values", i + 1, max_values),
    )
    rest = [c for c in bursts.columns if c != "values"]
    return bursts.select(*rest, F.posexplode(runs).alias("run", "values"))
