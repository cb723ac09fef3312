"""Load vault tables from bronze or lake tables, driven by the registry.

The registry decides which jobs run, so it is read on the driver: one row per
model. Rows themselves never pass through the driver.
"""

from __future__ import annotations

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import to_text_frame
from ..operators import vault
from ..sources.lake import list_lake_tables, read_lake
from ..sources.storage import append_log, list_vault_tables
from ..sources.vault_tables import BUCKETS, merge_into

LOAD_THREADS = 4  # fixed value: models loaded side by side


def model_rows(source: DataFrame, model: Row, now: dt.datetime | None = None) -> DataFrame:
    """What a registry row loads from its source table."""
    return vault.load_model(
        source, model["model_type"], list(model["business_keys"]), list(model["attributes"]),
        model["table_name"], now,
    )


def load_one(
    source: DataFrame, model: Row, root: str, load_id: str, now: dt.datetime | None = None,
    mode: str = "append", buckets: int = BUCKETS,
) -> None:
    """Create or extend one vault table; repeating a load changes nothing.

    Keys and attributes are stored as canonical text, the one type that lake
    columns and payload fields share, so loads of either kind fit together. With
    ``mode="refresh"`` rows that are there already take the new load time.
    """
    columns = list(dict.fromkeys([*model["business_keys"], *model["attributes"]]))
    rows = model_rows(to_text_frame(source.select(*columns)), model, now)
    keys = vault.merge_keys(model["model_type"], list(model["business_keys"]))
    merge_into(rows, f"{root}/{model['model_name']}", keys, load_id, mode, buckets)


OUTCOMES = "model_name string, table_name string, ok boolean, seconds double, message string"
OUTCOME_LOG = "_outcomes"


def _outcomes(
    registry: DataFrame, sources: dict[str, DataFrame], root: str, load_id: str, now: dt.datetime | None,
    threads: int, mode: str, buckets: int,
) -> list[tuple[Row, float, Exception | None]]:
    """Each model's load with its time and its error; a few run at a time, since small ones do not fill a cluster."""
    models = [m for m in registry.orderBy("model_name").collect() if m["table_name"] in sources]

    def run(model: Row) -> tuple[Row, float, Exception | None]:
        start = time.monotonic()
        try:
            load_one(sources[model["table_name"]], model, root, load_id, now, mode, buckets)
        except Exception as error:  # a model's failure is its own
            return model, time.monotonic() - start, error
        return model, time.monotonic() - start, None

    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(run, models))


def load_vault(
    registry: DataFrame,
    sources: dict[str, DataFrame],
    root: str,
    load_id: str,
    now: dt.datetime | None = None,
    threads: int = LOAD_THREADS,
    mode: str = "append",
    buckets: int = BUCKETS,
) -> list[str]:
    """Load every registered model whose source is given; returns their names.

    ``mode`` is ``append`` (what is known stays as it is) or ``refresh`` (known rows
    take the new load time); ``buckets`` counts for tables that this load creates. A
    failing model fails the load once the others have ended; running it again is safe.
    """
    done = _outcomes(registry, sources, root, load_id, now, threads, mode, buckets)
    for _, _, error in done:
        if error is not None:
            raise error
    return [model["model_name"] for model, _, _ in done]


def load_outcomes(
    registry: DataFrame,
    sources: dict[str, DataFrame],
    root: str,
    load_id: str,
    now: dt.datetime | None = None,
    threads: int = LOAD_THREADS,
    mode: str = "append",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Load like ``load_vault``, but answer with one row per model instead of raising.

    The rows are also appended to a log below the vault. ``evolve.with_load_outcomes``
    turns them into the results of the operations that queued the models.
    """
    done = _outcomes(registry, sources, root, load_id, now, threads, mode, buckets)
    rows = [(m["model_name"], m["table_name"], e is None, round(s, 3), "" if e is None else str(e)) for m, s, e in done]
    frame = registry.sparkSession.createDataFrame(rows, OUTCOMES)
    append_log(frame.withColumn("load_id", F.lit(load_id)).coalesce(1), f"{root}/{OUTCOME_LOG}")
    return frame


def start_up_gap(spark: SparkSession, lake_root: str, registry: DataFrame, vault_root: str) -> DataFrame:
    """``(table_name, model_name, gap)`` of what the lake has and the vault lacks (see ``vault.vault_gap``)."""
    tables = spark.createDataFrame([(t,) for t in list_lake_tables(spark, lake_root)], "table_name string")
    return vault.vault_gap(tables, registry, list_vault_tables(spark, vault_root))


def initial_load(
    spark: SparkSession, lake_root: str, registry: DataFrame, vault_root: str, load_id: str, now: dt.datetime | None = None,
) -> list[str]:
    """Load the models without a table, of all lake tables; returns their names. A second call loads none."""
    unbuilt = start_up_gap(spark, lake_root, registry, vault_root).filter("gap = 'no_table'")
    models = registry.join(unbuilt.select("model_name"), "model_name", "left_semi")
    known = set(list_lake_tables(spark, lake_root))
    wanted = {r["table_name"] for r in models.select("table_name").distinct().collect()} & known
    return load_vault(models, {t: read_lake(spark, lake_root, t) for t in wanted}, vault_root, load_id, now)


def reload_models(
    queued: DataFrame,
    registry: DataFrame,
    sources: dict[str, DataFrame],
    root: str,
    load_id: str,
    now: dt.datetime | None = None,
) -> list[str]:
    """Load only the queued models: new versions fill up, others stay untouched."""
    wanted = registry.join(queued.select("model_name").distinct(), "model_name", "left_semi")
    return load_vault(wanted, sources, root, load_id, now)


def _digest(columns: list[str]) -> list[Column]:
    """128 bits that stand for a row's values; NULLs are marked, since hashes skip them."""
    marked = [c for n in columns for c in (F.col(n), F.col(n).isNull())]
    return [F.xxhash64(F.lit(seed), *marked).alias(f"d{seed}") for seed in (1, 2)]


def vault_row_counts(registry: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Rows each model's first load gives, all models in one job.

    The hub and the links of a table share one pass over its key columns, whose
    distinct combinations they count. Satellites compare digests, so that no text
    or array is shuffled; their hash follows from the other columns.
    """
    models = [m for m in registry.collect() if m["table_name"] in sources]
    key_columns: dict[str, dict[str, None]] = {}
    for m in models:
        if m["model_type"] != "sat":
            key_columns.setdefault(m["table_name"], {}).update(dict.fromkeys(m["business_keys"]))
    reduced = {t: sources[t].select(*columns).distinct() for t, columns in key_columns.items()}

    def one(model: Row) -> DataFrame:
        table = model["table_name"]
        if model["model_type"] == "sat":
            source = sources[table]
            columns = list(dict.fromkeys([*model["business_keys"], *model["attributes"]]))
            rows = source.select(*_digest(columns)).distinct()
        else:
            rows = reduced[table].select(*model["business_keys"]).distinct()
        return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(model["model_name"]).alias("model_name"),
            F.lit(model["model_type"]).alias("model_type"),
            F.lit(table).alias("table_name"),
            "n_rows",
        )

    return reduce(DataFrame.unionByName, [one(m) for m in models])
