"""Bronze and vault storage on plain Parquet, safe to retry.

Bronze is one dataset partitioned by ``table, ingest_date, stream, batch``. The
stream is an id that lives with a checkpoint, so a batch replaces exactly its own
partitions: a replayed batch does not duplicate, and streams into one root never
touch each other's rows. A message that a second stream (after a lost checkpoint,
say) landed again is known by its source position; readers take its first landing.
Vault tables are bucketed and read through a manifest (``vault_tables``); the
append-only layout partitioned by ``load_id`` is kept for tables without merge keys: a
load that is run again replaces what its first, possibly unfinished, try left behind.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import utc_literal, utc_wall_time
from ..operators.envelope import landed_fields, landing_rows
from .envelopes import POSITION
from .folders import children as _children, delete as _delete, fs_of as _fs, path_exists
from .vault_tables import read_table

BRONZE_PARTITIONS = ["table", "ingest_date", "stream", "batch"]
NO_STREAM = "direct"
TABLE_PARTS = 8  # in how many parts a table of a large batch is dealt out; AQE joins small ones


# --- bronze -------------------------------------------------------------------


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream with this checkpoint: made once, kept beside its offsets."""
    folder = f"{checkpoint}/vaultspark_stream"
    found = _children(spark, folder)
    if found:
        return found[0]
    name = uuid.uuid4().hex
    fs, path = _fs(spark, f"{folder}/{name}")
    fs.mkdirs(path)
    return name


def write_bronze(landed: DataFrame, root: str, batch: int, stream: str = NO_STREAM) -> None:
    """Land one batch (see ``operators.envelope.land_payload``), replacing a replay.

    The rebalance hint lets AQE merge small tables into few files and cut a
    table that dominates the batch into several tasks.
    """
    _write_batch(landed.hint("rebalance", "table"), root, batch, stream)


def land_bronze(
    envelopes: DataFrame, root: str, batch: int, stream: str = NO_STREAM, parts: int = TABLE_PARTS
) -> None:
    """Land one batch of envelopes, as ``write_bronze`` lands their ``land_payload``.

    Rows are dealt out before payloads become maps, and a table in parts: AQE cuts a
    table between the tasks it comes from, not within one, so that a large input
    split would again be one large task. Fewer parts give fewer files; small batches
    need but one.
    """
    part = F.pmod(F.xxhash64("payload"), F.lit(parts))
    rows = landing_rows(envelopes).withColumn("__part", part).hint("rebalance", "table", "__part")
    _write_batch(landed_fields(rows.drop("__part")), root, batch, stream)


def _write_batch(landed: DataFrame, root: str, batch: int, stream: str) -> None:
    day = F.to_date(utc_wall_time(F.col("__ingested_at"), landed.schema["__ingested_at"].dataType))
    spark = landed.sparkSession
    fs, mark = _fs(spark, f"{root}/_streams/{stream}")
    fs.mkdirs(mark)
    (
        landed.withColumn("ingest_date", day)
        .withColumn("stream", F.lit(f"s-{stream}"))
        .withColumn("batch", F.lit(int(batch)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*BRONZE_PARTITIONS)
        .parquet(root)
    )


def read_bronze(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """Landed rows, of one table if named (partition-pruned), each message once.

    Only where several streams landed here can a source position repeat; it then
    belongs to the batch that landed it first.
    """
    staged = _switching(spark, root)
    try:
        frame = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(root)
    except AnalysisException as error:
        if not staged or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        frame = None  # all that landed here is being switched
    for place, folder in staged.items():
        rest = spark.read.option("basePath", folder).parquet(folder)
        for part, kind in zip(place.split("/"), ("string", "date", "string", "int")):
            name, _, value = part.partition("=")
            rest = rest.withColumn(name, F.lit(unquote(value)).cast(kind))
        frame = rest if frame is None else frame.unionByName(rest, allowMissingColumns=True)
    if table is not None:
        frame = frame.filter(F.col("table") == table.lower())
    if POSITION not in frame.columns or len(_children(spark, f"{root}/_streams")) < 2:
        return frame
    landing = F.struct("__ingested_at", "stream", "batch")
    first = frame.filter(F.col(POSITION).isNotNull()).groupBy(POSITION).agg(F.min(landing).alias("__first"))
    return (
        frame.join(first, POSITION, "left")
        .filter(F.col("__first").isNull() | (F.col("__first") == landing))
        .select(*frame.columns)
    )


Batch = tuple[str, str, str]


def bronze_batches(spark: SparkSession, root: str, table: str) -> set[Batch]:
    """``(ingest_date, stream, batch)`` folders of a table: names, not data."""
    top = f"{root}/table={table.strip().lower()}"
    live = {
        (day.partition("=")[2], stream.partition("=")[2], batch.partition("=")[2])
        for day in _children(spark, top)
        for stream in _children(spark, f"{top}/{day}")
        for batch in _children(spark, f"{top}/{day}/{stream}")
    }
    return live | set(_switching_batches(spark, root, table))


def batch_folders(wanted: set[Batch], landed: set[Batch]) -> list[str]:
    """The folders of wanted batches below a table's, as few as possible.

    A stream's whole day, or a whole day, is one folder where all that landed in it is wanted.
    """
    def grouped(batches: set[Batch], by: int) -> dict[tuple, set[Batch]]:
        out: dict[tuple, set[Batch]] = {}
        for b in batches:
            out.setdefault(b[:by], set()).add(b)
        return out

    names, folders, left = ("ingest_date", "stream", "batch"), [], set(wanted)
    for by in (1, 2):
        there = grouped(landed, by)
        for prefix, some in grouped(left, by).items():
            if some == there.get(prefix):
                folders.append("/".join(f"{n}={v}" for n, v in zip(names, prefix)))
                left -= some
    folders += ["/".join(f"{n}={v}" for n, v in zip(names, b)) for b in left]
    return sorted(folders)


def read_batches(spark: SparkSession, root: str, table: str, wanted: set[Batch], landed: set[Batch]) -> DataFrame:
    """The payload maps of some batches of a table, and nothing else: no other folder is listed, no footer read.

    A message that two streams landed is there twice; merges, which compare keys, take it once.
    """
    top = f"{root}/table={table.strip().lower()}"
    staged = _switching_batches(spark, root, table)
    live = [f"{top}/{f}" for f in batch_folders(wanted - staged.keys(), landed - staged.keys())]
    # Folders of a switch that stopped lie elsewhere; a prune switches one at a time.
    parts = [[staged[b]] for b in sorted(wanted & staged.keys())] + ([live] if live else [])
    frames = [spark.read.schema("fields map<string,string>").parquet(*paths).select("fields") for paths in parts]
    return reduce(DataFrame.union, frames)


def truncate_bronze(spark: SparkSession, root: str, table: str) -> bool:
    """Remove all rows of a table; False if it holds none."""
    path = f"{root}/table={table.strip().lower()}"
    if not path_exists(spark, path):
        return False
    _delete(spark, path)
    return True


def _switching(spark: SparkSession, root: str) -> dict[str, str]:
    """Rewritten batches whose live folder is deleted and not yet replaced: live place to complete staged folder.

    Readers take these from where they are staged, so a prune that stops between
    the two steps hides no row.
    """
    found = {}
    for name in _children(spark, f"{root}/_staged"):
        place, staged = name.replace("!", "/"), f"{root}/_staged/{name}"
        if not path_exists(spark, f"{root}/{place}") and path_exists(spark, f"{staged}/_SUCCESS"):
            found[place] = staged
    return found


def _switching_batches(spark: SparkSession, root: str, table: str) -> dict[Batch, str]:
    """``_switching`` of one table, by batch."""
    found = {}
    for place, staged in _switching(spark, root).items():
        name, day, stream, batch = (part.partition("=")[2] for part in place.split("/"))
        if name == table.strip().lower():
            found[(day, stream, batch)] = staged
    return found


def _recover(spark: SparkSession, root: str) -> None:
    """Finish switches that an interrupted prune left: a staged folder that is complete takes its place."""
    for name in _children(spark, f"{root}/_staged"):
        staged = f"{root}/_staged/{name}"
        if path_exists(spark, f"{staged}/_SUCCESS"):
            _switch(spark, staged, f"{root}/{name.replace('!', '/')}")
        else:
            _delete(spark, staged)


def _switch(spark: SparkSession, staged: str, live: str) -> None:
    """Replace a folder by a complete one; repeating an interrupted switch ends it."""
    fs, source = _fs(spark, staged)
    _, target = _fs(spark, live)
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot move {staged} to {live}")


def prune_bronze_store(spark: SparkSession, root: str, cutoff: dt.datetime) -> int:
    """Delete landed rows older than ``cutoff``; returns the partitions dropped or rewritten.

    Whole days before the cutoff go by deleting their folders. Only batches of
    the cutoff's own day are looked at, and only those that straddle the cutoff
    are rewritten: what stays is staged complete, then switched in by a rename. A
    prune that stopped in between is finished by the next one; until then readers
    see the staged rows.
    """
    _recover(spark, root)
    touched = 0
    wall = cutoff.astimezone(dt.timezone.utc) if cutoff.tzinfo else cutoff
    day = wall.date().isoformat()
    boundary = []
    for table in _children(spark, root):
        if not table.startswith("table="):
            continue
        for part in _children(spark, f"{root}/{table}"):
            value = part.removeprefix("ingest_date=")
            if value < day:
                _delete(spark, f"{root}/{table}/{part}")
                touched += 1
            elif value == day:
                boundary.append((table.removeprefix("table="), part))
    if not boundary:
        return touched

    mark = utc_literal(cutoff)
    frame = spark.read.option("basePath", root).parquet(root)
    day_rows = frame.filter(F.col("ingest_date") == F.lit(day).cast("date"))
    stale = (
        day_rows.groupBy("table", "stream", "batch")
        .agg(F.min("__ingested_at").alias("oldest"), F.max("__ingested_at").alias("newest"))
        .filter(F.col("oldest") < mark)
    )
    # One row per batch of a single day: folder names, not data.
    for row in stale.select("table", "stream", "batch", (F.col("newest") < mark).alias("whole")).collect():
        place = f"table={row['table']}/ingest_date={day}/stream={row['stream']}/batch={row['batch']}"
        if row["whole"]:
            _delete(spark, f"{root}/{place}")
        else:
            left = spark.read.parquet(f"{root}/{place}").filter(F.col("__ingested_at") >= mark)
            staged = f"{root}/_staged/{place.replace('/', '!')}"
            left.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staged)
            _switch(spark, staged, f"{root}/{place}")
        touched += 1
    return touched


# --- vault --------------------------------------------------------------------


def _load_value(load_id: str) -> str:
    # The prefix keeps partition discovery from reading digits as a number.
    return f"load-{load_id}"


def read_vault(spark: SparkSession, path: str, without: str | None = None) -> DataFrame | None:
    """A vault table, or None if nothing was loaded; ``without`` hides one load's rows.

    A load that runs again leaves out its own rows, which it replaces, and sees
    those of all others, whatever their ids and their order.
    """
    names = _children(spark, path)
    if "_manifest" in names:
        table = read_table(spark, path)
        return table if table is None or without is None else table.filter(F.col("load_id") != without)
    if not any(name.startswith("load_id=") for name in names):
        return None
    frame = spark.read.option("mergeSchema", "true").parquet(path)
    if without is not None:
        frame = frame.filter(F.col("load_id") != _load_value(without))
    return frame


def list_vault_tables(spark: SparkSession, root: str) -> DataFrame:
    """``(table_name)`` of the vault tables that have been created under ``root``."""
    names = [(name,) for name in _children(spark, root) if not name.startswith(("_", "."))]
    return spark.createDataFrame(names, "table_name string")


def append_vault(rows: DataFrame, path: str, load_id: str) -> None:
    """Add one load's rows; running the same load again replaces its rows.

    Loads end in an aggregation or join whose partitions AQE has already sized,
    so the rows are written as they lie.
    """
    (
        rows.withColumn("load_id", F.lit(_load_value(load_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_id")
        .parquet(path)
    )


def create_if_absent(df: DataFrame, path: str, load_id: str) -> bool:
    """First load creates the table; a later one leaves it as it is."""
    if read_vault(df.sparkSession, path) is not None:
        return False
    append_vault(df, path, load_id)
    return True


def write_snapshot(df: DataFrame, path: str, version: int) -> None:
    """A full new state under its own folder; readers switch once it is complete."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{path}/version={version:012d}"
    )


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete snapshot (the one whose write committed)."""
    for name in sorted(_children(spark, path), reverse=True):
        if name.startswith("version=") and path_exists(spark, f"{path}/{name}/_SUCCESS"):
            return spark.read.parquet(f"{path}/{name}")
    return None


def snapshot_version(spark: SparkSession, path: str) -> int:
    """The highest version written, complete or not; 0 if there is none."""
    names = [n for n in _children(spark, path) if n.startswith("version=")]
    return max((int(n.removeprefix("version=")) for n in names), default=0)


def complete_version(spark: SparkSession, path: str) -> int:
    """The version that ``read_snapshot`` reads; 0 if there is none."""
    names = [n for n in _children(spark, path) if n.startswith("version=") and path_exists(spark, f"{path}/{n}/_SUCCESS")]
    return max((int(n.removeprefix("version=")) for n in names), default=0)


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to the metadata or lineage log."""
    df.write.mode("append").parquet(path)
