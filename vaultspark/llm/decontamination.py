"""Operator 6, benchmark decontamination: q-gram lemma filtering.

Benchmark items are cut into overlapping passages of ``PASSAGE`` characters
(shorter items are one passage). A passage of length m occurs in a text within k
edits only if at least ``m - q + 1 - q k`` of its q-grams do, on diagonals (place
in the text minus place in the passage) that differ by at most k. Per document
the shared q-grams are counted in overlapping diagonal bands of width 2 (k + 1),
one starting every k + 1 diagonals, so that some band holds all of them. Bands
that reach the count are verified by banded alignment, which gives the smallest
number of edits and the place where the passage ends.

The table of benchmark q-grams goes to the documents in slices of at most
``SLICE_CHARS`` characters, so what is broadcast is bounded and a larger
benchmark takes more passes. Texts are handled in pieces that overlap by more
than a passage and its edits, so memory is bounded for texts of any length. A
q-gram that many passages share (a line of dashes) meets a text in blocks of at most
``EXPANSION`` pairs of places, and a run of it only at every step-th place, which
meets the same bands. Nothing is left out.

Characters are compared in lower case, white space of any kind as a space.
Passages too short for a positive count allow as many edits as the lemma still
can filter, those shorter than q must occur as they are.

Defined cases: null or empty texts and items match nothing; rows of equal id and
text are one document, items of equal id one item, so each pair of a document and an
item gives one row however the benchmark was sliced; different texts under one id give
a row each; ties between ends take the first; a null id is reported as such. Ids may
be of any type that Arrow knows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import documents, query, read_columns, release_memory

Q = 8
ERRORS = 0.1
PASSAGE = 100
SLICE_CHARS = 2_000_000
PIECE = 1 << 18
EXPANSION = 1 << 21
_TABLE_BITS = 22
_SIGNS = 64
_MANY = 1000
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def plain(text: str) -> np.ndarray:
    """Code points in lower case with all white space as spaces; one per character of the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    codes[_IS_SPACE[np.minimum(codes, 0x3001)]] = 32
    return codes


_IS_SPACE = np.zeros(0x3002, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True
# Stands between the texts of a group: no q-gram of an item has it.
_WALL = "\U0010FFFF" * Q


def grams(codes: np.ndarray) -> np.ndarray:
    """Hashes of the q-grams, by doubling: pairs, fours, eights."""
    if len(codes) < Q:
        return np.empty(0, _U)
    h, width, base = codes.astype(_U) + _U(1), 1, _BASE
    while width < Q:
        h = h[: len(h) - width] * base + h[width:]
        width *= 2
        base = base * base
    return h * _U(0xD6E8FEB86659FD93)


def passages(items: list[tuple[object, str]]) -> list[tuple[object, int, np.ndarray]]:
    """``(item, place, code points)`` of the overlapping passages of items."""
    out = []
    for item, text in items:
        codes = plain(text)
        if len(codes) <= PASSAGE:
            out.append((item, 0, codes))
            continue
        places = list(range(0, len(codes) - PASSAGE, PASSAGE // 2)) + [len(codes) - PASSAGE]
        out += [(item, at, codes[at: at + PASSAGE]) for at in places]
    return [p for p in out if len(p[2])]


class Index:
    """The q-grams of passages: a bit table for the quick look, sorted hashes with their places."""

    def __init__(self, found: list[tuple[object, int, np.ndarray]]):
        self.passages = found
        size = np.array([len(p[2]) for p in found], np.int64)
        with np.errstate(over="ignore"):
            per = [grams(p[2]) for p in found]
            self.edits = np.minimum((ERRORS * size).astype(np.int64), np.maximum((size - Q) // Q, 0))
            self.least = size - Q + 1 - Q * self.edits
        h = np.concatenate([*per, np.empty(0, _U)])
        owner = np.repeat(np.arange(len(found)), [len(x) for x in per])
        place = np.concatenate([*(np.arange(len(x)) for x in per), np.empty(0, np.int64)]).astype(np.int64)
        by = np.argsort(h, kind="stable")
        self.h, self.owner, self.place = h[by], owner[by], place[by]
        self.distinct, self.first = np.unique(self.h, return_index=True)
        self.last = np.r_[self.first[1:], len(self.h)].astype(np.int64)
        self.bits = np.zeros(1 << _TABLE_BITS, bool)
        self.bits[(self.distinct >> _U(64 - _TABLE_BITS)).astype(np.int64)] = True
        self.longest = int(size.max()) if len(size) else 0
        # Per q-gram the narrowest half band of its passages.
        self.stride = np.minimum.reduceat(self.edits[self.owner] + 1, self.first) if len(self.h) else np.empty(0, np.int64)
        self.signs = np.zeros((len(found), _SIGNS), np.int16)
        for k, p in enumerate(found):
            self.signs[k] = np.bincount(p[2] % _SIGNS, minlength=_SIGNS)
        self.short = [k for k, p in enumerate(found) if len(p[2]) < Q]

    def _bands(self, codes: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """The bands that reach the count among some hits and their entries."""
        n = last - first
        if not n.sum():
            return
        entry = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        where = np.repeat(at, n)
        owner, place = self.owner[entry], self.place[entry]
        diagonal = where - place + (1 << 20)
        step = self.edits[owner] + 1
        band = diagonal // step
        # Band b covers diagonals of steps b and b + 1: each q-gram counts in two bands.
        key = np.concatenate([owner * (1 << 40) + band, owner * (1 << 40) + band - 1])
        gram, where = np.concatenate([place, place]), np.concatenate([where, where])
        by = np.lexsort((gram, key))
        key, gram, where = key[by], gram[by], where[by]
        new = np.r_[True, (key[1:] != key[:-1]) | (gram[1:] != gram[:-1])]  # a q-gram of the passage counts once
        keys, some, count = np.unique(key[new], return_index=True, return_counts=True)
        owners = keys >> 40
        good = count >= self.least[owners]
        owners, band, at, of = owners[good], (keys & ((1 << 40) - 1))[good], where[new][some][good], gram[new][some][good]
        if len(owners) > _MANY:
            lo = band * (self.edits[owners] + 1) - (1 << 20)
            good = self._signs_suffice(codes, owners, lo, lo + 2 * self.edits[owners] + 1)
            owners, band, at, of = owners[good], band[good], at[good], of[good]
        for o, b, x, g in zip(owners, band, at, of):
            width = int(self.edits[o]) + 1
            yield int(o), int(b) * width - (1 << 20), (int(b) + 2) * width - 1 - (1 << 20), int(x), int(x - g)

    def _signs_suffice(self, codes: np.ndarray, owners: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether a text has, where a band reaches, all signs of its passage but those it may lose; for many bands at once."""
        lacking, edits = np.zeros(len(owners), np.int64), self.edits[owners]
        begin = np.clip(lo - edits, 0, len(codes))
        end = np.clip(hi + edits + np.array([len(p[2]) for p in self.passages])[owners], 0, len(codes))
        kinds = codes % _SIGNS
        for kind in range(_SIGNS):
            before = np.r_[0, np.cumsum(kinds == kind, dtype=np.int32)]
            lacking += np.maximum(self.signs[owners, kind] - (before[end] - before[begin]), 0)
        return lacking <= edits

    def _blocks(self, at: np.ndarray, k: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Hits with the entries of their q-grams, ``(at, from, to)``, in blocks of bounded size that miss no band.

        A text is halved with an overlap that holds all hits of a band; a stretch too
        short for that goes by ranges of passages.
        """
        first, last = self.first[k], self.last[k]
        if (last - first).sum() <= EXPANSION:
            yield at, first, last
            return
        lap = self.longest + 2 * int(self.edits.max() + 1)
        if at[-1] - at[0] > 4 * lap:
            middle = (at[0] + at[-1]) // 2
            for part in (at < middle + lap, at >= middle):
                yield from self._blocks(at[part], k[part])
            return
        grams_here, which, often = np.unique(k, return_inverse=True, return_counts=True)
        n = self.last[grams_here] - self.first[grams_here]
        starts = np.r_[0, np.cumsum(n)]
        entry = np.repeat(self.first[grams_here] - starts[:-1], n) + np.arange(starts[-1])
        owner, many = self.owner[entry], len(self.passages)
        weight = np.cumsum(np.bincount(owner, np.repeat(often, n), many))
        cuts = np.r_[0, np.flatnonzero(np.diff(weight // EXPANSION)) + 1, many]
        key = np.repeat(np.arange(len(grams_here)), n) * many + owner  # ascending: so are the owners of a q-gram
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            span = [np.searchsorted(key, np.arange(len(grams_here)) * many + x) - starts[:-1] + self.first[grams_here] for x in (lo, hi)]
            yield at, span[0][which], span[1][which]

    def regions(self, codes: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """``(passage, first diagonal, last diagonal, place and diagonal of a q-gram)`` of the bands that reach the count.

        A band may come more than once.
        """
        h = grams(codes)
        at = np.flatnonzero(self.bits[(h >> _U(64 - _TABLE_BITS)).astype(np.int64)]) if len(self.distinct) else np.empty(0, np.int64)
        if len(at):
            k = np.minimum(np.searchsorted(self.distinct, h[at]), len(self.distinct) - 1)
            ok = self.distinct[k] == h[at]
            at, k = at[ok], k[ok]
        if len(at):
            # Of a run of one q-gram (a line of dashes) every step-th place and the last still meet all of its bands.
            same = (k[1:] == k[:-1]) & (at[1:] == at[:-1] + 1)
            begins = np.maximum.accumulate(np.where(np.r_[True, ~same], np.arange(len(at)), 0))
            ok = ((np.arange(len(at)) - begins) % self.stride[k] == 0) | np.r_[~same, True]
            for some, first, last in self._blocks(at[ok], k[ok]):
                yield from self._bands(codes, some, first, last)
        for o in self.short:
            p = self.passages[o][2]
            for x in np.flatnonzero(codes[: len(codes) - len(p) + 1] == p[0]) if len(codes) >= len(p) else ():
                if (codes[x: x + len(p)] == p).all():
                    yield o, int(x), int(x), int(x), int(x)


def align(passage: np.ndarray, codes: np.ndarray, lo: int, hi: int, edits: int) -> tuple[int, int, int] | None:
    """Banded alignment of a whole passage to a text: ``(edits, start, end)``, or None beyond the budget.

    Only diagonals ``lo - edits .. hi + edits`` are computed; the passage may start anywhere in the band.
    """
    lo, hi = lo - edits, hi + edits
    width = hi - lo + 1
    diagonals = np.arange(lo, hi + 1)
    steps = np.arange(width)
    far = 1 << 20
    cost = np.where((diagonals >= 0) & (diagonals <= len(codes)), 0, far)
    start = diagonals.copy()
    skipped, origins = np.full(width, far), np.zeros(width, np.int64)
    for i, sign in enumerate(passage):
        j = diagonals + i  # the text sign that column consumes
        inside = (j >= 0) & (j < len(codes))
        same = np.zeros(width, bool)
        same[inside] = codes[j[inside]] == sign
        step = np.where(inside, cost + ~same, far)
        skipped[:-1] = cost[1:] + 1  # a passage sign without a text sign: from the next diagonal
        origins[:-1] = start[1:]
        take = skipped < step
        best, origin = np.where(take, skipped, step), np.where(take, origins, start)
        # Text signs without a passage sign: along the row, from the left.
        low = np.minimum.accumulate(best - steps)
        left = np.maximum.accumulate(np.where(best - steps == low, steps, 0))
        cost, start = np.minimum(low + steps, far), origin[left]
        if cost.min() > edits:
            return None
    ends = diagonals + len(passage)
    cost = np.where((ends >= 0) & (ends <= len(codes)), cost, far)
    k = int(cost.argmin())
    return (int(cost[k]), int(start[k]), int(ends[k])) if cost[k] <= edits else None


def matches(index: Index, texts: list[str]) -> Iterator[tuple[int, object, int, int, int, int]]:
    """``(text's number, item, start, end, edits, passages)`` of each item found in whole texts.

    Short texts are handled in groups, long ones in overlapping pieces.
    """
    lap = 2 * index.longest + 2 * Q
    found: dict[tuple, list] = {}
    seen: dict[tuple, list] = {}

    def search(pieces: list[tuple[int, int, str]]) -> None:
        codes = plain(_WALL.join(p for _, _, p in pieces))
        ends = np.cumsum([len(p) + Q for _, _, p in pieces])
        for o, lo, hi, at, diagonal in index.regions(codes):
            k = int(np.searchsorted(ends, at, "right"))
            number, base, piece = pieces[k]
            first = int(ends[k]) - Q - len(piece)
            item, _, passage = index.passages[o]
            places = seen.setdefault((number, o), [])
            near = bisect_left(places, lo - first + base)
            if near < len(places) and places[near] <= hi - first + base:
                continue  # the neighbouring band has shown this place
            own, d = codes[first: first + len(piece)], diagonal - first
            if d >= 0 and np.array_equal(own[d: d + len(passage)], passage):
                hit = 0, d, d + len(passage)
            else:
                edits = int(index.edits[o])
                window = own[max(0, lo - first - edits): max(0, hi - first + edits + len(passage))]
                lacking = index.signs[o] - np.bincount(window % _SIGNS, minlength=_SIGNS)
                if lacking[lacking > 0].sum() > edits:
                    continue  # more signs of the passage are missing than it may lose
                hit = align(passage, own, lo - first, hi - first, edits)
            if hit is None:
                continue
            insort(places, base + hit[1])
            one = found.setdefault((number, item), [base + hit[1], base + hit[2], hit[0], set()])
            one[0], one[1], one[2] = min(one[0], base + hit[1]), max(one[1], base + hit[2]), min(one[2], hit[0])
            one[3].add(o)

    with np.errstate(over="ignore"):
        group, size = [], 0
        for number, text in enumerate(texts):
            for base in range(0, len(text), PIECE):
                group.append((number, base, text[base: base + PIECE + lap]))
                size += len(group[-1][2])
                if size >= PIECE:
                    search(group)
                    group, size = [], 0
        if group:
            search(group)
    for (number, item), (start, end, edits, parts) in found.items():
        yield number, item, start, end, edits, len(parts)


def _slices(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """Items in slices of bounded size; a longer item is a slice of its own parts."""
    now, size = [], 0
    for row in items.toLocalIterator():
        text = row["text"] or ""
        for at in range(0, max(1, len(text)), SLICE_CHARS):
            part = text[at: at + SLICE_CHARS + PASSAGE]
            if now and size + len(part) > SLICE_CHARS:
                yield now
                now, size = [], 0
            now.append((row["item"], part))
            size += len(part)
    if now:
        yield now


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``id_col, item_col, start, end, edits, passages``: one row per document and item found in it.

    ``start`` and ``end`` enclose all of the item's passages; ``edits`` is the smallest of theirs.
    ``id_col`` and ``item_col`` need different names.
    """
    if id_col == item_col:
        raise ValueError(f"documents and items both name their id {id_col}")
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_col].dataType
    names = ["id", "digest", "item", "slice", "start", "end", "edits", "passages"]
    schema = (f"id {id_type.simpleString()}, digest binary, item {item_type.simpleString()}, slice int, "
              "start long, end long, edits int, passages int")
    types = [to_arrow_type(id_type), pa.binary(), to_arrow_type(item_type), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for no, part in enumerate(_slices(items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")))):
        shipped = docs.sparkSession.sparkContext.broadcast(Index(passages(part)))

        def searched(batches: Iterator[pa.RecordBatch], shipped=shipped, no=no) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, bodies = batch.column(0), [t.as_py() or "" for t in batch.column(1)]
                rows = [(ids[k].as_py(), hashlib.sha256(bodies[k].encode("utf-8", "surrogatepass")).digest(), m[0], no, *m[1:])
                        for k, *m in matches(shipped.value, bodies)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        out = out.union(texts.mapInArrow(searched, schema))
    # Repeated documents have the same hits in each slice; an item's parts add up over the slices.
    return out.distinct().groupBy("id", "digest", "item").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("edits").alias("edits"),
        F.sum("passages").cast("int").alias("passages"),
    ).select(F.col("id").alias(id_col), F.col("item").alias(item_col), "start", "end", "edits", "passages")


def drop_contaminated(df: DataFrame, items: DataFrame, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``df`` in whose text no item is found; columns as they are, nothing is shuffled."""
    at = df.columns.index(text_col)
    for part in _slices(items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))):
        shipped = df.sparkSession.sparkContext.broadcast(Index(passages(part)))

        def clean(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for number, *_ in matches(shipped.value, [t.as_py() or "" for t in batch.column(at)]):
                    keep[number] = False
                yield batch.filter(pa.array(keep))
            release_memory()

        df = df.mapInArrow(clean, df.schema)
    return df


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_columns(spark, sf_dir, "benchmark", item_id="long", text="string")
    return find_contamination(documents(spark, sf_dir), items)
