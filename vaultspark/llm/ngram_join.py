"""Operator 4, n-gram Jaccard join: a prefix tree over globally ordered sets.

A document's set holds its distinct five-word shingles (64-bit hashes; A-Z lower
case, words cut at ASCII white space; fewer words make one shingle, none an empty
set). Two sets link when their Jaccard similarity is at least 0.75. Documents with
equal sets are one *class*, known by a 64-bit signature of set and size, and only
classes are compared.

All sets follow one global order: shingles that many documents share come last
(found by counting in tasks, over all documents), the others by hash. Any order
gives the same links; this one keeps common passages out of the tree's upper part.
Linked sets meet in the first ``n - ceil(0.75 n) + 1`` places of either, so only
these are stored.

1. *Nodes.* Tasks emit the upper paths of their sets, packed by node range; a node
   (shingle) lists its classes with size and depth. Nodes of one class end here.
2. *Short nodes* (up to ``SHORT`` classes) count the overlap of every pair below
   them. A pair whose size, depth and remaining length cannot reach the overlap it
   needs is pruned; so is one whose counted overlap is too small for what is left.
3. Every class is first offered one partner of short nodes, the one with the largest
   counted overlap, and one of *long nodes*, the one that shares most with others.
   Once these pairs are verified and components known, short nodes give the pairs
   between different components, and a long node whose classes all are in one
   component is pruned whole. The others give the pairs between different
   components, unless the number of nodes that a class shares with any other is
   already too small, or their outlines (numbers of shingles in 1024 parts of the
   hash range) cannot have the overlap in common. Pairs inside a component need no
   look, so a large group of near copies costs no square of its size, and no link
   between components is lost.
4. *Verification.* Candidate sets meet in blocks. The sets to compare with one set
   form a trie: in sorted order each shares a path with the one before, whose
   partial overlap is kept, and a subtree is left when the remaining length cannot
   reach the bound any more.

Defined cases: a null text counts as empty; documents without words link with
nothing, their component is their own id; repeated rows and copies share a class;
a null id takes part but is never the smallest; an empty table gives none.
Different sets of one size share a signature with probability 2^-64 a pair.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, kept, query, release_memory
from .graphs import connected_components

WORDS = 5
SHORT = 24
HEAVY = 48
MAX_HEAVY = 1 << 18
NODE_ROWS = 400_000
PAIRS_HELD = 300_000
BLOCK_ROWS = 400
FILTER_BITS = 24
OUTLINE_BITS = 10
PIECE_BYTES = 1 << 20

_U = np.uint64
_K = _U(0x9E3779B97F4A7C15)
_ANY_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    if not _POWERS:
        base = 0x5851F42D4C957F2D
        for x in (base, pow(base, -1, 1 << 64)):
            row = np.full(PIECE_BYTES + 1, x, _U)
            row[0] = 1
            _POWERS.append(np.multiply.accumulate(row))
    return _POWERS


def _words(data: bytes, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the words of at most ``PIECE_BYTES``; no word crosses a border.

    A word's hash is a difference of running sums of its bytes times powers of a base, shifted to the front.
    """
    # bytes.lower knows ASCII letters only, as asked.
    raw = np.frombuffer(data.lower(), np.uint8)
    inside = ~_SPACE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[borders] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers()
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * power[: len(raw)], out=total[1:])
    return _mix((total[end] - total[start]) * inverse[start] + (end - start).astype(_U) * _K), start


def _long_words(data: bytes) -> np.ndarray:
    """Hashes of the words of a text of any length, piece by piece, cut at white space."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE_BYTES)
        if end < len(data):
            blank = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, end - at, at)])
            if len(blank) == 0:  # one word longer than a piece
                more = _ANY_SPACE.search(data, end)
                end = more.start() if more else len(data)
                h = np.array([len(data[at:end])], _U)
                for k in range(at, end, PIECE_BYTES):
                    part, _ = _words(data[k: min(end, k + PIECE_BYTES)], np.array([0]))
                    h = _mix(h * _K + part)
                out.append(h)
                at = end
                continue
            end = at + int(blank[-1]) + 1
        out.append(_words(data[at:end], np.array([0]))[0])
        at = end
    return np.concatenate(out) if out else np.empty(0, _U)


def _shingled(words: np.ndarray) -> np.ndarray:
    out = words[: len(words) - WORDS + 1].copy()
    for k in range(1, WORDS):
        out = out * _K + words[k: len(words) - WORDS + 1 + k]
    return _mix(out)


def _set_of(words: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The sorted distinct shingles of one document, given its words and all shingles that start in it."""
    n = len(words)
    if n == 0:
        return np.empty(0, _U)
    if n < WORDS:
        out = np.array([n], _U)
        for k in range(n):
            out = _mix(out * _K + words[k: k + 1])
        return out
    s = np.sort(shingles)
    new = np.empty(len(s), bool)
    new[0] = True
    np.not_equal(s[1:], s[:-1], out=new[1:])
    return s[new]


def sets_of(data: bytes, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of texts in UTF-8 that lie one after the other."""
    n, k = len(offsets) - 1, 0
    while k < n:
        upto = max(k + 1, int(np.searchsorted(offsets, offsets[k] + PIECE_BYTES, "right")) - 1)
        part = data[offsets[k]: offsets[upto]]
        if len(part) > PIECE_BYTES:
            words = _long_words(part)
            yield _set_of(words, _shingled(words) if len(words) >= WORDS else words)
        else:
            borders = offsets[k: upto + 1] - offsets[k]
            words, places = _words(part, borders)
            at = np.searchsorted(places, borders)
            shingles = _shingled(words) if len(words) >= WORDS else words
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                yield _set_of(words[lo:hi], shingles[lo: max(lo, hi - WORDS + 1)])
        k = upto


def shingle_set(text: bytes | None) -> np.ndarray:
    """The set of one text."""
    text = text or b""
    return next(sets_of(text, np.array([0, len(text)])))


def signature(s: np.ndarray) -> int:
    """The class of a set, as a signed 64-bit number."""
    value = _mix(np.array([len(s)], _U) * _K + (s * s).sum(dtype=_U) if len(s) else np.zeros(1, _U))
    return int(value.view(np.int64)[0])


def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The overlap from which sizes n and m link: 100 i >= 75 (n + m - i)."""
    return -(-3 * (n + m) // 7)


def upper(n):
    """Places of a set in which it must meet what it links with."""
    return n - -(-3 * n // 4) + 1


def _ordered(s: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """A sorted set in the global order: heavy shingles last."""
    if len(heavy) == 0 or len(s) == 0:
        return s
    at = np.searchsorted(heavy, s)
    is_heavy = heavy[np.minimum(at, len(heavy) - 1)] == s
    return np.concatenate([s[~is_heavy], s[is_heavy]]) if is_heavy.any() else s


def _sets(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    texts = batch.column(column).cast(pa.binary())
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    yield from sets_of(memoryview(data)[places[0]: places[-1]].tobytes() if data else b"", places - places[0])


def _profile(df: DataFrame, id_type: str) -> DataFrame:
    """Per document ``id, cls, n``; and rows with ``times``: how often a task met a shingle."""

    def profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "cls", "n", "times"]
        shingles, times = np.empty(0, _U), np.empty(0, np.int64)
        for batch in batches:
            cls, n, fresh = [], [], {}
            for s in _sets(batch, 1):
                c = signature(s)
                cls.append(c)
                n.append(len(s))
                fresh[c] = s
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cls, pa.int64()), pa.array(n, pa.int32()), pa.nulls(len(cls), pa.int32())], names=names)
            if fresh:
                found, count = np.unique(np.concatenate(list(fresh.values())), return_counts=True)
                found, count = found[count > 1], count[count > 1]
                shingles, inverse = np.unique(np.concatenate([shingles, found]), return_inverse=True)
                times = np.bincount(inverse, np.concatenate([times, count]), len(shingles)).astype(np.int64)
        often = times >= 4
        k = int(often.sum())
        if k:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, id_arrow), pa.array(shingles[often].view(np.int64)), pa.nulls(k, pa.int32()),
                 pa.array(times[often].astype(np.int32))], names=names)
        _POWERS.clear()
        release_memory()

    id_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    return df.mapInArrow(profiled, f"id {id_type}, cls long, n int, times int")


def _nodes(texts: DataFrame, heavy: np.ndarray, ranges: int) -> DataFrame:
    """The upper paths of all sets, packed: ``range, entries`` with (shingle, class, size, depth) arrays."""
    shipped = texts.sparkSession.sparkContext.broadcast(heavy)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shipped.value
        for batch in batches:
            paths = {}
            for s in _sets(batch, 0):
                if len(s):
                    paths.setdefault(signature(s), s)
            if not paths:
                continue
            parts = [_ordered(s, order)[: upper(len(s))] for s in paths.values()]
            sizes = [len(p) for p in parts]
            shingle = np.concatenate(parts)
            cls = np.repeat(np.fromiter(paths, np.int64, len(paths)), sizes)
            n = np.repeat(np.array([len(s) for s in paths.values()], np.int32), sizes)
            depth = np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
            # The low bits choose the range; the high ones lead the global order.
            part = (shingle & _U(0xFFFFFFFF)) % _U(ranges)
            by = np.argsort(part, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(part[by]) != 0])
            blobs, keys = [], []
            for lo, hi in zip(starts, [*starts[1:], len(by)]):
                at = by[lo:hi]
                keys.append(int(part[at[0]]))
                blobs.append(shingle[at].tobytes() + cls[at].tobytes() + n[at].tobytes() + depth[at].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], names=["range", "entries"])
        _POWERS.clear()
        release_memory()

    return texts.mapInArrow(packed, "range long, entries binary")


_FOUND = "kind int, a long, b long, na int, nb int, c int"
_FOUND_ARROW = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("na", pa.int32()), ("nb", pa.int32()), ("c", pa.int32())])


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    parts = ([], [], [], [])
    for blob in blobs:
        k = len(blob) // 24
        parts[0].append(np.frombuffer(blob, _U, k))
        parts[1].append(np.frombuffer(blob, np.int64, k, 8 * k))
        parts[2].append(np.frombuffer(blob, np.int32, k, 16 * k))
        parts[3].append(np.frombuffer(blob, np.int32, k, 20 * k))
    return tuple(np.concatenate(p) for p in parts)


def _counted(a, b, na, nb) -> tuple[np.ndarray, ...]:
    """Equal pairs (classes ascending) put together, with their number."""
    swap = a > b
    a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
    by = np.lexsort((b, a))
    a, b, na, nb = a[by], b[by], na[by], nb[by]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.empty(0, int)
    return a[first], b[first], na[first], nb[first], np.diff(np.r_[first, len(a)]).astype(np.int32)


def _possible(n, m, i, j):
    """Can sets of sizes n and m that meet at depths i and j reach the overlap they need?"""
    return np.minimum(i, j) + 1 + np.minimum(n - i - 1, m - j - 1) >= needed(n, m)


def _found_batch(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(columns[0]), kind, np.int32)), *(pa.array(x) for x in columns)], schema=_FOUND_ARROW)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one range: counted pairs of short ones (kind 0), entries of long ones (kind 1).

    Kind 2 counts the nodes that a class shares with any other: no overlap counted in nodes can exceed it.
    Pairs leave whenever ``PAIRS_HELD`` have come together; their counts are added up later.
    """
    shingle, cls, n, depth = _unpack([blob for batch in batches for blob in batch.column("entries").to_pylist()])
    by = np.lexsort((cls, shingle))
    shingle, cls, n, depth = shingle[by], cls[by], n[by], depth[by]
    if len(shingle) > 1:  # a class that several tasks met
        new = np.r_[True, (shingle[1:] != shingle[:-1]) | (cls[1:] != cls[:-1])]
        shingle, cls, n, depth = shingle[new], cls[new], n[new], depth[new]
    first = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
    length = np.diff(np.r_[first, len(shingle)])
    many = np.repeat(length, length)
    long = many > SHORT
    if long.any():
        yield _found_batch(1, shingle[long].view(np.int64), cls[long], n[long], depth[long], many[long].astype(np.int32))
    if (many > 1).any():
        some, of, times = np.unique(cls[many > 1], return_index=True, return_counts=True)
        zero = np.zeros(len(some), np.int32)
        yield _found_batch(2, some, np.zeros(len(some), np.int64), n[many > 1][of], zero, times.astype(np.int32))
    shared = (many > 1) & (many <= SHORT)
    s, c, m, d = shingle[shared], cls[shared], n[shared], depth[shared]
    del shingle, cls, n, depth, many, by
    pairs, held = [], 0
    for step in range(1, SHORT):
        if len(s) <= step:
            break
        at = np.flatnonzero(s[step:] == s[:-step])
        if len(at) == 0:
            break
        to = at + step
        ok = _possible(m[at], m[to], d[at], d[to])
        at, to = at[ok], to[ok]
        pairs.append((c[at], c[to], m[at], m[to]))
        held += len(at)
        if held > PAIRS_HELD:
            yield _found_batch(0, *_counted(*(np.concatenate(x) for x in zip(*pairs))))
            pairs, held = [], 0
    if pairs:
        yield _found_batch(0, *_counted(*(np.concatenate(x) for x in zip(*pairs))))
    del s, c, m, d, pairs
    release_memory()


def _outline(s: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall to each of 1024 parts of the hash range; 255 stands for any number."""
    return np.minimum(np.bincount((s >> _U(64 - OUTLINE_BITS)).astype(np.int64), minlength=1 << OUTLINE_BITS), 255).astype(np.uint8)


def _fits(x: np.ndarray, y: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Can pairs of outlines (rows) reach the overlap they need? No part can share more than the smaller count."""
    least = np.minimum(x, y)
    return (least.sum(1, dtype=np.int64) >= need) | (least == 255).any(1)


def _across(table: pa.Table, outlines: pa.Table) -> pa.Table:
    """Pairs between different components that meet in long nodes and whose outlines leave enough overlap."""
    if table.num_rows == 0:
        return _FOUND_ARROW.empty_table()
    s, c, n, d, comp, most = (table.column(x).to_numpy() for x in ("shingle", "cls", "n", "depth", "component", "shared"))
    known, at = np.unique(outlines.column("name").to_numpy(), return_index=True)
    shape = np.stack([np.frombuffer(x, np.uint8) for x in outlines.column("outline").take(at).to_pylist()])
    by = np.lexsort((comp, s))
    s, c, n, d, comp, most = s[by], c[by], n[by], d[by], comp[by], most[by]
    row = np.searchsorted(known, c)
    below = -(-3 * n // 4) - 1  # places under the upper part
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.empty(0, int)
    pairs, pending, done = [], 0, []

    def gather():
        if pairs:
            done.append(_counted(*(np.concatenate(x) for x in zip(*pairs))))
            pairs.clear()

    for lo, hi in zip(first, [*first[1:], len(s)]):
        # A stripe of rows against the rest of the node: about a million pairs at a time.
        stripe = max(1, (1 << 20) // max(int(hi - lo), 1))
        for at in range(lo, hi, stripe):
            i = np.arange(at, min(at + stripe, hi))[:, None]
            j = np.arange(at + 1, hi)[None, :]
            ok = (comp[i] != comp[j]) & (j > i)
            ok &= np.minimum(most[i], most[j]) + np.maximum(below[i], below[j]) >= needed(n[i], n[j])
            x, y = np.nonzero(ok)
            x, y = x + at, y + at + 1
            ok = _possible(n[x], n[y], d[x], d[y])
            x, y = x[ok], y[ok]
            for part in range(0, len(x), 4096):  # outlines of a few thousand pairs at a time
                u, v = x[part: part + 4096], y[part: part + 4096]
                ok = _fits(shape[row[u]], shape[row[v]], needed(n[u], n[v]))
                u, v = u[ok], v[ok]
                pairs.append((c[u], c[v], n[u], n[v]))
                pending += len(u)
            if pending > 500_000:
                gather()
                pending = 0
    gather()
    if not done:
        return _FOUND_ARROW.empty_table()
    return pa.concat_tables([
        pa.Table.from_arrays([pa.array(np.zeros(len(cols[0]), np.int32)), *(pa.array(x) for x in cols)], schema=_FOUND_ARROW)
        for cols in done])


def trie_links(pivot: np.ndarray, sets: list[np.ndarray]) -> list[bool]:
    """Which sets link with the pivot; all are sorted.

    In lexicographic order every set shares a path with the one before it: the
    overlap counted along that path is kept, and only the rest is walked.
    """
    order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u8").tobytes())
    out = [False] * len(sets)
    before, overlap = np.empty(0, _U), np.zeros(1, np.int64)  # overlap[k]: within the first k
    size = len(pivot)
    for k in order:
        x = sets[k]
        shared = min(len(before), len(x), len(overlap) - 1)
        differ = np.flatnonzero(before[:shared] != x[:shared])
        at = int(differ[0]) if len(differ) else shared
        need = int(needed(np.int64(len(x)), np.int64(size)))
        path = [overlap[: at + 1]]
        found = int(overlap[at])
        while at < len(x):
            seen = int(np.searchsorted(pivot, x[at]))
            if found + min(len(x) - at, size - seen) < need:
                break  # what is left below here cannot be enough
            step = x[at: at + 256]
            place = np.minimum(np.searchsorted(pivot, step), size - 1)
            path.append(found + np.cumsum(pivot[place] == step))
            at += len(step)
            found = int(path[-1][-1])
        before, overlap = x, np.concatenate(path)
        out[k] = found >= need
    return out


def _verify_block(table: pa.Table) -> pa.Table:
    pivots, groups = {}, {}
    for y, cls, is_pivot, data in zip(*(table.column(x).to_pylist() for x in ("y", "cls", "pivot", "shingles"))):
        s = np.frombuffer(data, _U)
        if is_pivot:
            pivots[y] = s
        else:
            groups.setdefault(y, {})[cls] = s
    a, b = [], []
    for y, members in groups.items():
        names = list(members)
        linked = [x for x, ok in zip(names, trie_links(pivots[y], [members[x] for x in names])) if ok]
        a += linked
        b += [y] * len(linked)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _filter_of(classes: DataFrame) -> np.ndarray:
    """A bit for each class, by its low bits: a superset of fixed size, whatever the number of classes."""
    bits = classes.select(F.col("cls").bitwiseAND((1 << FILTER_BITS) - 1).alias("bit"))
    words = bits.groupBy((F.floor(F.col("bit") / 64)).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    got = words.toPandas()
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def _chosen(texts: DataFrame, classes: DataFrame, made: Callable[[np.ndarray], bytes], name: str) -> DataFrame:
    """``cls`` and what ``made`` gives for its set, for classes of a table and perhaps some more, once each."""
    bits = texts.sparkSession.sparkContext.broadcast(_filter_of(classes))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            out = {}
            for s in _sets(batch, 0):
                c = signature(s)
                bit = c & ((1 << FILTER_BITS) - 1)
                if table[bit >> 3] >> (bit & 7) & 1 and c not in out:
                    out[c] = made(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.binary())], names=["cls", name])
        _POWERS.clear()
        release_memory()

    return texts.mapInArrow(chosen, f"cls long, `{name}` binary").dropDuplicates(["cls"])


def _verify(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links among candidate pairs ``a, b``."""
    pairs = kept(pairs.select("a", "b"), "ngram-pairs")
    n_pairs = pairs.count()
    # A set that many are compared with is sent to several blocks.
    per = pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("copies"))
    spread = lambda *c: F.pmod(F.xxhash64(*c), F.lit(max(1, n_pairs // BLOCK_ROWS)))
    members = (
        pairs.join(per, "b").select(F.col("b").alias("y"), F.col("a").alias("cls"), F.lit(False).alias("pivot"),
                                    F.pmod(F.xxhash64("a"), F.col("copies")).cast("int").alias("copy"))
        .union(per.select("b", "b", F.lit(True), F.explode(F.sequence(F.lit(0), F.col("copies") - 1))))
        .withColumn("block", spread("y", "copy"))
    )
    members = kept(members, "ngram-members")
    sets = _chosen(texts, members, lambda s: s.tobytes(), "shingles")
    return sets.join(members, "cls").groupBy("block").applyInArrow(_verify_block, "a long, b long")


def _plausible(pairs: DataFrame) -> DataFrame:
    """Pairs whose counted overlap leaves enough: what lies below the upper part is at most as long as that."""
    return pairs.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("c").alias("c")).where(
        "c + greatest(ceil(3 * na / 4D), ceil(3 * nb / 4D)) - 1 >= ceil(3 * (na + nb) / 7D)")


def classes_and_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents as ``id, cls, n``, and links between classes as ``a, b``.

    The links connect what is connected; links inside a component may be missing.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    profile = kept(_profile(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), id_type), "ngram-profile")
    docs = profile.where("times is null").select("id", "cls", "n")
    texts = df.select(F.col(text_col).alias("text"))
    often = profile.where("times is not null").groupBy("cls").agg(F.sum("times").alias("times")).where(F.col("times") >= HEAVY)
    heavy = np.array([r["cls"] for r in often.orderBy(F.desc("times"), "cls").limit(MAX_HEAVY).collect()], np.int64).view(_U)
    entries = docs.agg(F.sum(F.floor(F.col("n") / 4) + 1)).first()[0] or 0
    ranges = max(1, -(-entries // NODE_ROWS))

    found = kept(_nodes(texts, np.sort(heavy), ranges).groupBy("range").applyInArrow(_walk, _FOUND), "ngram-nodes")
    short = found.where("kind = 0").select("a", "b", "na", "nb", "c")
    long = found.where("kind = 1").select(
        F.col("a").alias("shingle"), F.col("b").alias("cls"), F.col("na").alias("n"), F.col("nb").alias("depth"), F.col("c").alias("length"))

    # Every class is first offered one partner: of those it meets in short nodes the one with the
    # largest counted overlap, in long nodes the one that most others share with.
    plausible = kept(_plausible(short), "ngram-plausible")
    meets = plausible.select(F.col("a").alias("cls"), F.col("b").alias("partner"), "c").union(plausible.select("b", "a", "c"))
    fame = long.groupBy("cls").agg(F.sum("length").alias("fame"))
    partner = long.join(fame, "cls").groupBy("shingle").agg(F.max(F.struct("fame", "cls", "n")).alias("p"))
    famous = (
        long.join(partner, "shingle").where("cls <> p.cls and 4 * least(n, p.n) >= 3 * greatest(n, p.n)")
        .groupBy("cls", F.col("p.cls").alias("partner")).agg(F.count("*").alias("c"))
    )
    offers = [
        x.groupBy("cls").agg(F.max(F.struct("c", "partner")).alias("best"))
        .select(F.least("cls", "best.partner").alias("a"), F.greatest("cls", "best.partner").alias("b"))
        for x in (meets, famous)
    ]
    first = kept(offers[0].union(offers[1]).distinct(), "ngram-first")
    links = kept(_verify(texts, first), "ngram-links")

    # What is left are pairs between different components.
    components = kept(connected_components(links), "ngram-components")
    ends = [components.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in ("a", "b")]
    second = plausible.join(ends[0], "a", "left").join(ends[1], "b", "left").where(
        "coalesce(ca, a) <> coalesce(cb, b)").select("a", "b")
    across = _long_pairs(texts, found, long, components)
    if across is not None:
        second = second.union(across)
    second = kept(second.distinct().join(first, ["a", "b"], "left_anti"), "ngram-second")
    if second.isEmpty():
        return docs, links
    return docs, links.union(kept(_verify(texts, second), "ngram-links"))


def _long_pairs(texts: DataFrame, found: DataFrame, long: DataFrame, components: DataFrame) -> DataFrame | None:
    """Pairs between different components that meet in long nodes; None if no long node has several."""
    placed = long.join(components.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    mixed = placed.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    shared = found.where("kind = 2").groupBy(F.col("a").alias("cls")).agg(F.sum("c").cast("int").alias("shared"))
    rest = kept(placed.join(mixed.select("shingle"), "shingle").join(shared, "cls"), "ngram-rest")
    n_rest = rest.count()
    if n_rest == 0:
        return None
    ranged = rest.withColumn("range", F.pmod(F.xxhash64("shingle"), F.lit(max(1, n_rest // 20_000))))
    outlines = kept(_chosen(texts, rest.select("cls").distinct(), lambda s: _outline(s).tobytes(), "outline"), "ngram-outlines")
    shapes = ranged.select("range", "cls").distinct().join(outlines, "cls").select(
        F.col("range").alias("part"), F.col("cls").alias("name"), "outline")
    across = ranged.groupBy("range").cogroup(shapes.groupBy("part")).applyInArrow(_across, _FOUND)
    return kept(across, "ngram-across").select("a", "b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row."""
    docs, links = classes_and_links(df, id_col, text_col)
    components = connected_components(links).withColumnRenamed("node", "cls")
    placed = docs.join(components, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = placed.where("n > 0").groupBy("component").agg(F.min("id").alias("least"))
    return placed.join(least, "component", "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


OP4_SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda x: x <> '') as words from documents),
g as (
  select doc_id, list_distinct(case
    when len(words) = 0 then []
    when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) end) as s from w),
sets as (select min(doc_id) as id, list(doc_id) as members, list_sort(s) as s from g where len(s) > 0 group by list_sort(s)),
e as (select id, len(s) as n, unnest(s) as t from sets),
p as (
  select a.id as a, b.id as b, count(*) as i, any_value(a.n) as na, any_value(b.n) as nb
  from e a join e b on a.t = b.t and a.id <> b.id and 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n) group by 1, 2),
l as (select a, b from p where 100 * i >= 75 * (na + nb - i)),
reach(a, b) as (select id, id from sets union select r.a, l.b from reach r join l on r.b = l.a),
c as (select a, min(b) as component from reach group by a),
o as (select unnest(members) as doc_id, id from sets)
select g.doc_id, len(g.s) as n_shingles, coalesce(c.component, g.doc_id) as component_id
from g left join o on g.doc_id = o.doc_id left join c on o.id = c.a
"""


@query("op4_ngram_join", OP4_SQL)
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
