"""Vault tables: rows in buckets by key hash, and a manifest that names the folders that count.

A table's rows lie in ``data/<load>/__bucket=<k>``. The manifest, a small Parquet file
written anew by each load, lists the folders that make up the table, with the range of
the first key, the rows and the schema; the newest complete manifest is the table. So

* a load shows up at once or not at all, and a load that failed halfway leaves
  folders that nobody reads (``vacuum`` removes them);
* an incremental load opens only folders of the buckets and key ranges that its own
  keys fall into, by name: no listing of the table, no footers, no merged schemas;
* a refresh rewrites the buckets it touches and no others;
* a bucket whose folders have become many is rewritten into one by the next load that
  touches it, so neither the manifest nor planning grows with the number of loads.

Buckets go by the hash of all merge keys (for satellites the hash of the attributes
too), so one key with very many versions spreads over all of them; a large bucket is
cut into several files by the rebalance hint. The driver sees one row per bucket and
folder, at most ``buckets * COMPACT_AT``. A table has one writer at a time; a second
one that meets the same manifest number fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import keep
from .folders import children, delete, path_exists

BUCKETS = 64
COMPACT_AT = 8
KEPT_MANIFESTS = 3
BUCKET = "__bucket"
MODES = ("append", "refresh")

_MANIFEST = "bucket int, folder string, n_rows long, low string, high string, buckets int, columns string"


@dataclass(frozen=True)
class Part:
    """One folder of a bucket, with the range of its rows' first key."""

    bucket: int
    folder: str
    n_rows: int
    low: str
    high: str


@dataclass(frozen=True)
class State:
    """What a manifest says."""

    version: int
    buckets: int
    schema: T.StructType
    parts: tuple[Part, ...]


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = children(spark, f"{path}/_manifest")
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def _manifest_path(path: str, version: int) -> str:
    return f"{path}/_manifest/version={version:012d}"


def state_of(spark: SparkSession, path: str) -> State | None:
    """The newest complete manifest; None if the table was never written."""
    for version in reversed(_versions(spark, path)):
        place = _manifest_path(path, version)
        if path_exists(spark, f"{place}/_SUCCESS"):
            rows = spark.read.schema(_MANIFEST).parquet(place).collect()
            head = rows[0]  # a manifest always has a row; that of an empty table has no bucket
            parts = tuple(Part(r["bucket"], r["folder"], r["n_rows"], r["low"], r["high"]) for r in rows if r["bucket"] is not None)
            return State(version, head["buckets"], T.StructType.fromJson(json.loads(head["columns"])), parts)
    return None


def _commit(spark: SparkSession, path: str, state: State) -> None:
    columns = state.schema.json()
    rows = [(p.bucket, p.folder, p.n_rows, p.low, p.high, state.buckets, columns) for p in state.parts]
    rows = rows or [(None, None, None, None, None, state.buckets, columns)]
    # An existing version of that number belongs to another writer: the write fails then.
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("error").parquet(_manifest_path(path, state.version))
    for old in _versions(spark, path)[:-KEPT_MANIFESTS]:
        delete(spark, _manifest_path(path, old))


def _folders(spark: SparkSession, path: str, schema: T.StructType, parts: list[Part]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{p.folder}" for p in parts])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of a table; columns that came later are NULL in older rows. None if there is no table."""
    state = state_of(spark, path)
    return None if state is None else _folders(spark, path, state.schema, list(state.parts))


def _with_bucket(rows: DataFrame, on: list[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*on), F.lit(buckets)).cast("int"))


def _ranges(rows: DataFrame, key: str) -> dict[int, tuple[int, str, str]]:
    """Rows and range of the first key (as text, NULL as the empty text) per bucket: one row each."""
    first = F.coalesce(F.col(key).cast("string"), F.lit(""))
    found = rows.groupBy(BUCKET).agg(F.count("*").alias("n"), F.min(first).alias("low"), F.max(first).alias("high"))
    return {r[BUCKET]: (r["n"], r["low"], r["high"]) for r in found.collect()}


def _merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns, then new ones; none is ever dropped."""
    known = {f.name.lower() for f in old}
    return T.StructType([*old, *(T.StructField(f.name, f.dataType) for f in new if f.name.lower() not in known)])


def reach(state: State, wanted: dict[int, tuple[int, str, str]]) -> list[Part]:
    """The folders that can hold a key of a batch with these buckets and key ranges."""
    return [p for p in state.parts if p.bucket in wanted and p.low <= wanted[p.bucket][2] and p.high >= wanted[p.bucket][1]]


def _unmatched(rows: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    right = other.select(*[F.col(k).alias(f"__{k}") for k in on])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in on])
    return rows.join(right, same, "left_anti")


def merge_into(
    rows: DataFrame, path: str, on: list[str], load_id: str, mode: str = "append", buckets: int = BUCKETS,
) -> State:
    """Merge rows, distinct in ``on``, into a table; creates it if need be.

    ``append`` adds the rows whose keys the table lacks. ``refresh`` also puts the
    loaded rows in place of those with the same keys, so that they take the new load
    time. Running the same load again changes nothing (``refresh``: nothing but times).
    """
    if mode not in MODES:
        raise ValueError(f"unknown load mode {mode}")
    spark = rows.sparkSession
    rows = rows.withColumn("load_id", F.lit(load_id))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    before = state_of(spark, path)
    state = before or State(0, buckets, schema, ())
    if not state.parts:
        out, replaced = _with_bucket(rows, on, state.buckets), set()
    else:
        batch = keep(_with_bucket(rows, on, state.buckets))
        wanted = _ranges(batch, on[0])
        near = reach(state, wanted)
        if mode == "append":
            fresh = _unmatched(batch, _folders(spark, path, state.schema, near), on)
            held = {b: sum(p.bucket == b for p in state.parts) for b in wanted}
            crowded = [p for p in state.parts if held.get(p.bucket, 0) >= COMPACT_AT]
            replaced = set(crowded)
            old = crowded
        else:
            # Only the folders that can hold a loaded key are rewritten.
            fresh, replaced, old = batch, set(near), near
        out = fresh
        if old:
            stays = _with_bucket(_folders(spark, path, state.schema, old), on, state.buckets)
            stays = _unmatched(stays, batch, on) if mode == "refresh" else stays
            out = stays.unionByName(fresh, allowMissingColumns=True)
    place = f"data/{load_id}-{uuid.uuid4().hex}"
    out.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{place}")
    written = children(spark, f"{path}/{place}")
    added: list[Part] = []
    if written:
        ranges = _ranges(spark.read.parquet(f"{path}/{place}").select(BUCKET, on[0]), on[0])
        added = [Part(b, f"{place}/{BUCKET}={b}", *ranges[b]) for b in sorted(ranges)]
    after = State(
        state.version + 1, state.buckets, _merged_schema(state.schema, schema),
        (*(p for p in state.parts if p not in replaced), *added))
    if before is None or added or replaced or after.schema != before.schema:
        _commit(spark, path, after)
        return after
    return before


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove data folders that no kept manifest names; returns how many. Not while a load runs."""
    used = set()
    for version in _versions(spark, path):
        place = _manifest_path(path, version)
        if path_exists(spark, f"{place}/_SUCCESS"):
            used |= {r["folder"] for r in spark.read.schema(_MANIFEST).parquet(place).select("folder").collect()}
    gone = 0
    for load in children(spark, f"{path}/data"):
        for bucket in children(spark, f"{path}/data/{load}"):
            folder = f"data/{load}/{bucket}"
            if folder not in used:
                delete(spark, f"{path}/{folder}")
                gone += 1
        if not children(spark, f"{path}/data/{load}"):
            delete(spark, f"{path}/data/{load}")
    return gone
