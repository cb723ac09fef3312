"""Messages to bronze, micro-batch by micro-batch, and on to the vault."""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import envelope, lineage
from ..plans.load import LOAD_THREADS, load_one
from ..sources.storage import Batch, bronze_batches, land_bronze, read_batches, stream_id
from .ledger import BatchLedger

log = logging.getLogger(__name__)

TRIGGER = "2 seconds"  # fixed value: default time between micro-batches
AfterWrite = Callable[[dict[str, int], int], None]


def start_bronze_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    name: str = "bronze_multi",
    trigger: str | None = TRIGGER,
    on_after_write: AfterWrite | None = None,
    allowed_tables: list[str] | None = None,
    source: str = envelope.STREAM_SOURCE,
    replay_window: str | None = None,
) -> StreamingQuery:
    """Start landing a message stream; ``trigger=None`` takes what is there and stops.

    All tables of a micro-batch land in one write. The ingest time is set in the
    streaming plan, where it is the batch's recorded time, so a replayed batch
    gets the same one and replaces its own partitions, which carry an id kept with
    the checkpoint, so that no other stream can replace them. A failing write fails the
    batch; a failing callback is logged.

    With a ``replay_window`` ("2 hours", say) a message that a repeated capture sent
    again within that time lands once; it costs a shuffle of each batch by message id
    and the ids of that time as state. What comes later still lands twice, and merges,
    which compare keys, take it once.
    """
    parsed = envelope.normalize_table(envelope.parse_envelopes(messages, with_id=replay_window is not None))
    if allowed_tables:
        parsed = envelope.allow_tables(parsed, allowed_tables)
    stamped = envelope.add_audit(parsed, source=source)
    if replay_window is not None:
        stamped = envelope.drop_replays(stamped, replay_window)
    stream = stream_id(messages.sparkSession, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        missing = envelope.missing_required(batch)
        if missing:
            log.warning("batch %s lacks columns %s; skipped", batch_id, missing)
            return
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            land_bronze(rows, root, batch_id, stream, parts=1)
            if on_after_write is None:
                return
            touched = {r["table"]: r["n_rows"] for r in envelope.touched_tables(rows).collect()}
        finally:
            rows.unpersist()
        try:
            on_after_write(touched, batch_id)
        except Exception:
            log.exception("after-write callback failed for batch %s", batch_id)

    writer = (
        stamped.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(land)
    )
    if trigger is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


class VaultRefresher:
    """An after-write callback that loads the touched tables' models.

    A ledger below the vault says which bronze batches a model has taken in. A refresh
    loads every landed batch the ledger lacks, in one load that reads just the folders
    of these batches, however many there are: what a failed or left-out refresh missed,
    or what landed during an outage, comes with the next one. ``flush`` catches up on
    all models. A refresh that stops between its rows and its ledger entry is repeated,
    and merges keep what is known.

    With ``quiet_seconds`` a refresh waits until no batch has arrived for that long, and
    then runs by itself, also when the stream has fallen silent; ``longest_wait`` bounds
    the wait while batches keep coming. A refresh that fails is tried again after the
    next quiet time, and one takes ``max_models`` models at most, the others follow.
    ``close`` loads what is waiting and ends the waiting thread.
    """

    LEDGER = "_ledger"

    def __init__(
        self, spark: SparkSession, registry: DataFrame, bronze_root: str, vault_root: str, quiet_seconds: float = 0,
        longest_wait: float | None = None, max_models: int | None = None, mode: str = "append",
    ):
        self.spark, self.registry = spark, registry
        self.bronze_root, self.vault_root, self.mode = bronze_root, vault_root, mode
        self.quiet_seconds, self.longest_wait, self.max_models = quiet_seconds, longest_wait, max_models
        self.ledger = BatchLedger(spark, f"{vault_root}/{self.LEDGER}")
        self.waiting: set[str] = set()
        self._arrived = self._since = 0.0
        self._timer: threading.Timer | None = None
        self._state, self._work = threading.Lock(), threading.Lock()

    def __call__(self, touched: dict[str, int], batch_id: int) -> None:
        now = time.monotonic()
        with self._state:
            if not self.waiting:
                self._since = now
            self.waiting.update(t.lower() for t in touched)
            self._arrived = now
            if not self.waiting:
                return
        if self.quiet_seconds > 0:
            self._arm()
        else:
            self._drain()

    def flush(self) -> None:
        """Load whatever is landed and not yet loaded, of all models."""
        with self._state:
            self.waiting.update(r["table_name"].lower() for r in self.registry.select("table_name").distinct().collect())
        self._drain()

    def close(self) -> None:
        """Load what is waiting, and wait for nothing any more."""
        with self._state:
            if self._timer is not None:
                self._timer.cancel()
                self._timer = None
        if self.waiting:
            self._drain()

    def _due(self) -> float:
        """Seconds until the stream has been quiet, or waited for, long enough."""
        due = self._arrived + self.quiet_seconds
        if self.longest_wait is not None:
            due = min(due, self._since + self.longest_wait)
        return due - time.monotonic()

    def _arm(self) -> None:
        with self._state:
            if self._timer is None:
                self._timer = threading.Timer(max(0.0, self._due()), self._fire)
                self._timer.daemon = True
                self._timer.start()

    def _fire(self) -> None:
        with self._state:
            self._timer = None
            early = self._due() > 0
        if early:  # a batch came in while the timer ran
            self._arm()
            return
        try:
            self._drain()
        except Exception:
            log.exception("refresh failed; it is tried again")
            with self._state:
                self._arrived = self._since = time.monotonic()
            self._arm()

    def _drain(self) -> None:
        """Load the waiting tables' models; tables of which one fails wait on."""
        with self._work:
            with self._state:
                tables, self.waiting = self.waiting, set()
            left = set(tables)
            try:
                left -= self._refresh(tables)
            finally:
                with self._state:
                    self.waiting |= left

    def _refresh(self, tables: set[str]) -> set[str]:
        """Load all models of some tables; returns the tables if that went well, and raises if one failed."""
        touched = self.spark.createDataFrame([(t,) for t in sorted(tables)], "table string")
        names = lineage.impacted_models(touched, self.registry)
        models = self.registry.join(names, "model_name", "left_semi").orderBy("model_name").collect()
        landed = {t: bronze_batches(self.spark, self.bronze_root, t) for t in {m["table_name"].lower() for m in models}}
        step, failed = self.max_models or max(1, len(models)), []
        for at in range(0, len(models), step):
            todo = [(m, self.ledger.pending(m["model_name"], landed[m["table_name"].lower()])) for m in models[at:at + step]]
            with ThreadPoolExecutor(max_workers=LOAD_THREADS) as pool:
                jobs = [(m, pending, pool.submit(self._load, m, pending, landed[m["table_name"].lower()])) for m, pending in todo if pending]
            for model, pending, job in jobs:
                if job.exception() is None:
                    self.ledger.add(model["model_name"], pending, landed[model["table_name"].lower()])
                else:
                    failed.append(job.exception())
        if failed:
            raise failed[0]
        return tables

    def _load(self, model: Row, pending: set[Batch], landed: set[Batch]) -> None:
        rows = read_batches(self.spark, self.bronze_root, model["table_name"], pending, landed)
        columns = list(dict.fromkeys([*model["business_keys"], *model["attributes"]]))
        load_one(envelope.widen(rows, columns), model, self.vault_root, f"stream-{uuid.uuid4().hex}", mode=self.mode)


def vault_refresher(
    spark: SparkSession, registry: DataFrame, bronze_root: str, vault_root: str, quiet_seconds: float = 0, **options,
) -> VaultRefresher:
    """The refresher of a vault; see ``VaultRefresher`` for the options."""
    return VaultRefresher(spark, registry, bronze_root, vault_root, quiet_seconds, **options)
