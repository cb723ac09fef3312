"""Which bronze batches a model has taken in: intervals per stream, in one small file.

Batches of a stream are numbered in the order they land, so what a model has loaded is
nearly always one interval per stream, however many batches that are. A gap in the
numbers is closed where nothing landed in it. Batches written without a stream may come
in any order, so their gaps stay open.

The ledger is a snapshot written anew by each load; older ones are removed. Its size is
models x streams (and a few more rows where loads failed), never batches.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import SparkSession

from ..sources.folders import children, delete
from ..sources.storage import NO_STREAM, Batch, read_snapshot, snapshot_version, write_snapshot

Intervals = list[tuple[int, int]]

_SCHEMA = "model string, stream string, first long, last long"
_KEPT = 3


def merge_intervals(known: Intervals, loaded: list[int], open_batches: list[int], close_gaps: bool) -> Intervals:
    """``known`` and ``loaded`` as few intervals; two join unless a batch in ``open_batches`` lies between.

    Without ``close_gaps`` only neighbouring numbers join.
    """
    rest = sorted(open_batches)
    out: Intervals = []
    for first, last in sorted([*known, *((n, n) for n in loaded)]):
        if out and (first <= out[-1][1] + 1 or close_gaps and bisect_right(rest, out[-1][1]) == bisect_left(rest, first)):
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def covers(intervals: Intervals, number: int) -> bool:
    at = bisect_right(intervals, (number, float("inf"))) - 1
    return at >= 0 and intervals[at][1] >= number


class BatchLedger:
    """The intervals of all models of a vault; one refresher at a time writes them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._known: dict[str, dict[str, Intervals]] | None = None

    def known(self) -> dict[str, dict[str, Intervals]]:
        """Intervals by model and stream, read once: this ledger has one writer."""
        if self._known is None:
            self._known = {}
            stored = read_snapshot(self.spark, self.path)
            for r in stored.collect() if stored is not None else ():
                self._known.setdefault(r["model"], {}).setdefault(r["stream"], []).append((r["first"], r["last"]))
            for streams in self._known.values():
                for intervals in streams.values():
                    intervals.sort()
        return self._known

    def pending(self, model: str, landed: set[Batch]) -> set[Batch]:
        """Landed batches that the model has not taken in."""
        streams = self.known().get(model, {})
        return {b for b in landed if not covers(streams.get(b[1], []), int(b[2]))}

    def add(self, model: str, loaded: set[Batch], landed: set[Batch]) -> None:
        """Note that a model has taken in some batches, of those that had landed."""
        known = self.known()
        mine = {s: list(v) for s, v in known.get(model, {}).items()}
        for stream in {b[1] for b in loaded}:
            numbers = [int(b[2]) for b in loaded if b[1] == stream]
            rest = [int(b[2]) for b in landed - loaded if b[1] == stream and not covers(mine.get(stream, []), int(b[2]))]
            mine[stream] = merge_intervals(mine.get(stream, []), numbers, rest, stream != f"s-{NO_STREAM}")
        self._write({**known, model: mine})

    def _write(self, known: dict[str, dict[str, Intervals]]) -> None:
        rows = [(m, s, a, b) for m, streams in known.items() for s, intervals in streams.items() for a, b in intervals]
        version = snapshot_version(self.spark, self.path) + 1
        write_snapshot(self.spark.createDataFrame(rows, _SCHEMA).coalesce(1), self.path, version)
        self._known = known
        for name in sorted(n for n in children(self.spark, self.path) if n.startswith("version="))[:-_KEPT]:
            delete(self.spark, f"{self.path}/{name}")
