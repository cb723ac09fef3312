"""Operator 13, phrase collocation mining: double-array tries over all text positions.

Candidates are found level by level, Apriori-safe: a phrase of k words is proposed only
where its first and its last k - 1 words were proposed before. Tasks count proposals as
pairs of numbers (hash of the first k - 1 words, hash of the last word), Spark adds the
counts up, and pairs of ``LEAST`` or more become phrases by joins with the shorter
phrases and the words. What the next level may propose is broadcast as a table of bits
of fixed size. A collision, of hashes or of bits, can only propose too much. The
proposed phrases are dealt over shards of at most about ``SHARD_PHRASES`` phrases by
hash (so no common first word fills one), and each shard's phrases become a
double-array trie, built in a task and broadcast, whose size the shard bounds. For each
shard numpy moves the states of all text positions at once, word after word, counts the
accepting states with bincount, and Spark sums the tasks' counts. These counts are
exact; scores, containment and ranks are plain joins and windows on them.

The text is read five times where one shard holds all proposed phrases, and once more
for every further one. Words are cut out of whole batches at byte level by numpy; a text
of any length is worked through in chunks of ``CHUNK`` bytes that carry over the last
three words. Partial counts leave a task whenever they pass ``FLUSH`` entries.

Defined cases: a null text is empty; a null language counts as ``und``, together with
rows of that language; repeated rows count each time; ties are in the order of the
phrase (UTF-8 bytes), so ranks are fixed; empty tables and texts without words give no
rows. Extra columns are not read. Only A to Z are lower-cased; a byte that is not valid
UTF-8 cannot occur in a text column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, query, read_columns, release_memory

LONGEST = 4
LEAST = 30
CONTAINED = 80
TOP = 2000
BITS = 26
SHARD_PHRASES = 1 << 20
CHUNK = 1 << 21
FLUSH = 1 << 20
SLICE = 1 << 14
FAN_IN = 256
WHITE, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"

_KIND = np.zeros(256, np.uint8)
_KIND[list(WHITE)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_MIX, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Chunk:
    """Words of a stretch of texts: codes into ``words``, piece and language of each; the first ``fresh`` were seen before."""

    codes: np.ndarray
    words: pa.Array
    piece: np.ndarray
    lang: np.ndarray
    fresh: int


def chunks(batch: pa.RecordBatch, size: int = CHUNK) -> Iterator[Chunk]:
    """The words of all texts of a batch with columns ``lang`` (codes) and ``text``, both without nulls."""
    texts = batch["text"].cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    if offsets[0] == offsets[-1]:
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    langs = batch["lang"].to_numpy(zero_copy_only=False)
    low, tail = int(offsets[0]), []
    while low < offsets[-1]:
        high = _cut(data, offsets, low + size)
        raw = _LOWER[data[low:high]]
        kind = _KIND[raw]
        begins = np.zeros(high - low + 1, bool)
        begins[offsets[np.searchsorted(offsets, low):np.searchsorted(offsets, high, "right")] - low] = True
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1] | begins[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | begins[1:-1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        pieces = np.cumsum((kind == 2) | begins[:-1])
        lengths = np.concatenate([[len(w) for w in tail], ends - starts]).astype(np.int64)
        piece = np.concatenate([np.zeros(len(tail), np.int64), pieces[starts]])
        if len(lengths):
            # Chunks end where words end, so 32-bit offsets hold unless one word is longer than 2 GB.
            ranges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            letters = np.concatenate([np.frombuffer(b"".join(tail), np.uint8), raw[inside]])
            encoded = pa.Array.from_buffers(
                pa.binary(), len(lengths), [None, pa.py_buffer(ranges), pa.py_buffer(letters)]).dictionary_encode()
            codes = encoded.indices.to_numpy()
            here = np.arange(np.searchsorted(offsets, low, "right") - 1, np.searchsorted(offsets, high))
            held = np.diff(np.searchsorted(starts, np.append(offsets[here], high) - low))
            held[0] += len(tail)
            yield Chunk(codes, encoded.dictionary, piece, np.repeat(langs[here], held), len(tail))
            open_words = codes[piece == pieces[-1]][-(LONGEST - 1):]
            tail = encoded.dictionary.take(pa.array(open_words)).to_pylist()
        low = high


def _cut(data: np.ndarray, offsets: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where no word goes on: a text ends, or a byte is not of a word."""
    end = int(offsets[-1])
    if at >= end:
        return end
    text_end = int(offsets[np.searchsorted(offsets, at)])
    step = 1 << 12
    while at < text_end:
        found = np.flatnonzero(_KIND[data[at:min(at + step, text_end)]])
        if len(found):
            return at + int(found[0])
        at, step = at + step, step * 2
    return text_end


def _mixed(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its words but the last (or of its language) and that of the last."""
    h = (before ^ word) * _STEP
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def phrase_hashes(chunk: Chunk, lang_hashes: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hash of each word, and for k from 0 to ``longest`` those of the k words from each position on."""
    word = _word_hashes(chunk.words)[chunk.codes]
    out = [lang_hashes[chunk.lang]]
    for k in range(1, min(longest, len(word)) + 1):
        out.append(_mixed(out[-1][:len(word) - k + 1], word[k - 1:]))
    return word, out


def _in(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h >> np.uint64(64 - BITS)
    return (table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _windows(chunk: Chunk, k: int) -> np.ndarray:
    """Whether ``k`` words from a position on lie in one piece and were not seen before."""
    n = len(chunk.codes) - k + 1
    ok = chunk.piece[:max(n, 0)] == chunk.piece[k - 1:]
    ok[:max(chunk.fresh - k + 1, 0)] = False
    return ok


def _coded(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, list[str], np.ndarray]:
    """A batch with its languages as codes, the languages, and their hashes."""
    encoded = batch["lang"].dictionary_encode()
    names = encoded.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(x.encode(), seed=1) for x in names], np.uint64)
    return pa.RecordBatch.from_arrays([encoded.indices, batch["text"]], names=["lang", "text"]), names, hashes


def _summed(h: np.ndarray, c: np.ndarray | None, *columns: np.ndarray) -> list[np.ndarray]:
    """Rows of equal ``h`` as one, with the sum of ``c`` (or their number) and one of the others."""
    order = np.argsort(h)
    ordered = h[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(h) else order
    if c is None:
        sums = np.diff(np.append(starts, len(h)))
    else:
        sums = np.add.reduceat(c[order], starts) if len(h) else c
    return [ordered[starts], sums, *(x[order[starts]] for x in columns)]


def _words(texts: DataFrame) -> DataFrame:
    """``lang, phrase, h, w, c``: partial counts of single words, with the hashes of phrase and word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded, names, lang_hashes = _coded(batch)
            for chunk in chunks(coded):
                both = chunk.lang[chunk.fresh:].astype(np.int64) * len(chunk.words) + chunk.codes[chunk.fresh:]
                found, c = np.unique(both, return_counts=True)
                lang, code = np.divmod(found, len(chunk.words))
                w = _word_hashes(chunk.words)[code]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array(names, pa.string()).take(pa.array(lang)),
                    "phrase": chunk.words.take(pa.array(code)).cast(pa.string()),
                    "h": _mixed(lang_hashes[lang], w).view(np.int64), "w": w.view(np.int64), "c": c})
        release_memory()

    return texts.mapInArrow(count, "lang string, phrase string, h long, w long, c long")


def _longer(texts: DataFrame, k: int, before: np.ndarray) -> DataFrame:
    """``h, w, c``: partial counts of proposed phrases of ``k`` words by the hashes of their first words and their last."""
    shared = texts.sparkSession.sparkContext.broadcast(before)

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            coded, _, lang_hashes = _coded(batch)
            for chunk in chunks(coded):
                if len(chunk.codes) < k:
                    continue
                word, hashes = phrase_hashes(chunk, lang_hashes, k)
                shorter = _in(shared.value, hashes[k - 1])
                at = np.flatnonzero(_windows(chunk, k) & shorter[:-1] & shorter[1:])
                held.append(_summed(hashes[k][at], None, hashes[k - 1][at], word[at + k - 1]))
                if sum(len(x[0]) for x in held) > FLUSH:
                    held = [_summed(*map(np.concatenate, zip(*held)))]
                    if len(held[0][0]) > FLUSH // 2:
                        yield _proposed(held.pop())
        if held:
            yield _proposed(_summed(*map(np.concatenate, zip(*held))))
        release_memory()

    def _proposed(rows: list[np.ndarray]) -> pa.RecordBatch:
        _, c, h, w = rows
        return pa.RecordBatch.from_pydict({"h": h.view(np.int64), "w": w.view(np.int64), "c": c})

    return texts.mapInArrow(propose, "h long, w long, c long")


def _spelled(pairs: DataFrame, shorter: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, h`` of frequent pairs ``h, w``, from the phrases and words behind both hashes."""
    def rehash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, w = (batch[c].to_numpy().view(np.uint64) for c in ("h", "w"))
            yield pa.RecordBatch.from_arrays(
                [batch["lang"], batch["phrase"], pa.array(_mixed(h, w).view(np.int64))], names=["lang", "phrase", "h"])

    return pairs.join(shorter, "h").join(words, "w").select(
        "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "h", "w").mapInArrow(rehash, "lang string, phrase string, h long")


def _bit_table(hashes: DataFrame) -> np.ndarray:
    """One bit for each hash ``h``; the size is fixed by ``BITS``."""
    bit = F.shiftrightunsigned("h", 64 - BITS)
    words = hashes.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))).alias("bits")).toArrow()
    table = np.zeros(1 << (BITS - 6), np.uint64)
    table[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return table


class Trie:
    """A double-array trie of phrases over word codes, with one root per language.

    The child of state ``s`` by word ``w`` is slot ``base[s] + w`` if ``check`` there is
    ``s``. ``accept`` is the number of the phrase that ends in a state, or -1.
    """

    def __init__(self, row: dict):
        self.base, self.check, self.accept = (np.frombuffer(row[x], np.int32) for x in ("base", "check", "accept"))
        # Breaks between lines never occur in words.
        self.code = {w: i for i, w in enumerate(row["words"].split(b"\n"), 1)}
        self.root = {x: i for i, x in enumerate(row["langs"])}
        self.phrases = int(self.accept.max()) + 1

    @staticmethod
    def build(langs: pa.Array, phrases: pa.Array, numbers: np.ndarray) -> dict:
        """Arrays of the trie, for ``Trie``; the time is spent on states with several children only."""
        split = pc.split_pattern(phrases, " ")
        coded = split.flatten().dictionary_encode()
        names = langs.dictionary_encode()
        n_words, roots = len(coded.dictionary), len(names.dictionary)
        starts = np.asarray(split.offsets)
        length = np.diff(starts)
        code = coded.indices.to_numpy().astype(np.int64) + 1
        node = names.indices.to_numpy().astype(np.int64)
        parents, symbols, accepts = [], [], [np.full(roots, -1, np.int64)]
        total = roots
        for k in range(int(length.max())):
            rows = np.flatnonzero(length > k)
            edges, inverse = np.unique(node[rows] * (n_words + 1) + code[starts[rows] + k], return_inverse=True)
            parents.append(edges // (n_words + 1))
            symbols.append(edges % (n_words + 1))
            node[rows] = total + inverse
            accept = np.full(len(edges), -1, np.int64)
            ends = rows[length[rows] == k + 1]
            accept[node[ends] - total] = numbers[ends]
            accepts.append(accept)
            total += len(edges)
        made = Trie._laid_out(roots, n_words, *map(np.concatenate, (parents, symbols, accepts)))
        words = b"\n".join(coded.dictionary.cast(pa.binary()).to_pylist())
        return made | {"words": words, "langs": names.dictionary.to_pylist()}

    @staticmethod
    def _laid_out(roots: int, n_words: int, parent: np.ndarray, symbol: np.ndarray, accept: np.ndarray) -> dict:
        """Slots for all nodes: large families by trial, lone children wherever room is left."""
        draw = np.random.default_rng(0)
        order = np.argsort(parent, kind="stable")
        owner, first, size = np.unique(parent[order], return_index=True, return_counts=True)
        room = 2 * (len(accept) + n_words) + 64
        taken = np.zeros(room, bool)
        taken[:roots] = True
        slot = np.zeros(len(accept), np.int64)
        slot[:roots] = np.arange(roots)
        shift = np.zeros(len(accept), np.int64)
        for i in np.argsort(-size, kind="stable"):
            if size[i] == 1:
                break
            edges = order[first[i]:first[i] + size[i]]
            s = symbol[edges]
            low, high = -int(s.min()), len(taken) - 1 - int(s.max())
            tries = 0
            while True:
                at = int(draw.integers(low, high + 1))
                if not taken[at + s].any():
                    break
                tries += 1
                if tries == 64:
                    taken = np.concatenate([taken, np.zeros(len(taken) // 2 + n_words, bool)])
                    high, tries = len(taken) - 1 - int(s.max()), 0
            taken[at + s] = True
            slot[edges + roots] = at + s
            shift[owner[i]] = at
        lone = np.flatnonzero(size == 1)
        edges = order[first[lone]]
        free = np.flatnonzero(~taken)
        if len(free) < len(lone):
            free = np.concatenate([free, np.arange(len(taken), len(taken) + len(lone))])
        free = free[:len(lone)]
        slot[edges + roots] = free
        shift[owner[lone]] = free - symbol[edges]
        extent = int(slot.max()) + 1
        base, check, ends = np.zeros(extent, np.int32), np.full(extent, -1, np.int32), np.full(extent, -1, np.int32)
        base[slot] = shift
        check[slot[roots:]] = slot[parent]
        ends[slot] = accept
        return {"base": base.tobytes(), "check": check.tobytes(), "accept": ends.tobytes()}

    def count(self, chunk: Chunk, langs: list[str], totals: np.ndarray) -> None:
        """Add the occurrences of all phrases in a chunk to ``totals``."""
        codes = np.fromiter((self.code.get(w, 0) for w in chunk.words.to_pylist()), np.int64, len(chunk.words))
        word = codes[chunk.codes]
        state = np.array([self.root.get(x, -1) for x in langs], np.int64)[chunk.lang]
        at = np.flatnonzero((state >= 0) & (word > 0))
        state = state[at]
        for k in range(LONGEST):
            if k:
                on = at + k < len(word)
                at, state = at[on], state[on]
                on = (chunk.piece[at + k] == chunk.piece[at]) & (word[at + k] > 0)
                at, state = at[on], state[on]
            slot = self.base[state] + word[at + k]
            on = (slot >= 0) & (slot < len(self.check))
            on[on] = self.check[slot[on]] == state[on]
            at, state = at[on], slot[on]
            ends = self.accept[state[at + k >= chunk.fresh]]
            totals += np.bincount(ends[ends >= 0], minlength=len(totals))


def _tries(listed: DataFrame) -> DataFrame:
    """One row per shard of ``shard, number, lang, phrase``: the arrays of its trie."""
    def build(table: pa.Table) -> pa.Table:
        one = table.combine_chunks()
        lang, phrase = (one[c].chunk(0) for c in ("lang", "phrase"))
        made = Trie.build(lang, phrase, one["number"].to_numpy())
        release_memory()
        return pa.table({"shard": table["shard"][:1], **{k: [v] for k, v in made.items()}})

    return listed.groupBy("shard").applyInArrow(
        build, "shard long, base binary, check binary, accept binary, words binary, langs array<string>")


def _counted(texts: DataFrame, shard: int, trie: Trie) -> DataFrame:
    """``shard, number, c``: occurrences of the phrases of one shard.

    A task's counts are one vector, sent in slices; tasks are added up ``FAN_IN`` at a
    time, so no group holds more than ``FAN_IN`` slices, however many tasks there are.
    """
    shared = texts.sparkSession.sparkContext.broadcast(trie)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        totals = np.zeros(trie.phrases, np.int64)
        for batch in batches:
            coded, names, _ = _coded(batch)
            for chunk in chunks(coded):
                trie.count(chunk, names, totals)
        slices = [totals[i:i + SLICE] for i in range(0, len(totals), SLICE)]
        used = [i for i, x in enumerate(slices) if x.any()]
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array(used, pa.int64()), "part": pa.array([TaskContext.get().partitionId()] * len(used), pa.int64()),
            "counts": pa.array([slices[i].tobytes() for i in used], pa.binary())})
        release_memory()

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_buffer(), np.int64) for x in table["counts"]], axis=0)
        return pa.table({"slice": table["slice"][:1], "part": table["part"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, counts in zip(batch["slice"].to_pylist(), batch["counts"]):
                c = np.frombuffer(counts.as_buffer(), np.int64)
                found = np.flatnonzero(c)
                yield pa.RecordBatch.from_pydict({"number": found + at * SLICE, "c": c[found]})

    schema = "slice long, part long, counts binary"
    vectors, parts = texts.mapInArrow(count, schema), texts.rdd.getNumPartitions()
    while parts > 1:
        vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("slice", "part").applyInArrow(add, schema)
        parts = -(-parts // FAN_IN)
    return vectors.mapInArrow(unpack, "number long, c long").select(F.lit(shard).cast("long").alias("shard"), "number", "c")


def phrase_counts(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Phrases of ``lang, text`` (no nulls) with ``LEAST`` or more occurrences, as ``lang, phrase, k, f``; and words per language ``lang, n``."""
    singles = kept(_words(texts).groupBy("lang", "phrase", "h", "w").agg(F.sum("c").alias("c")), "words")
    totals = singles.groupBy("lang").agg(F.sum("c").alias("n"))
    frequent = singles.where(F.col("c") >= LEAST)
    words = kept(frequent.select("w", F.col("phrase").alias("word")).distinct(), "frequent-words")
    levels = [frequent.select("lang", "phrase", "h")]
    for k in range(2, LONGEST + 1):
        pairs = _longer(texts, k, _bit_table(levels[-1])).groupBy("h", "w").agg(F.sum("c").alias("c")).where(F.col("c") >= LEAST)
        levels.append(kept(_spelled(pairs.select("h", "w"), levels[-1], words), f"phrases-{k}"))
    spelled = levels[0]
    for more in levels[1:]:
        spelled = spelled.union(more)
    spelled = spelled.select("lang", "phrase")
    shards = max(1, -(-spelled.count() // SHARD_PHRASES))
    inside = Window.partitionBy("shard").orderBy("lang", "phrase")
    listed = kept(
        spelled.withColumn("shard", F.pmod(F.xxhash64("lang", "phrase"), F.lit(shards))).withColumn("number", F.row_number().over(inside).cast("long") - 1), "listed")
    tries = kept(_tries(listed), "tries")
    counted = None
    for shard in range(shards):
        made = tries.where(F.col("shard") == shard).toArrow().to_pylist()
        if made:
            found = kept(_counted(texts, shard, Trie(made[0])), "phrase-counts")
            counted = found if counted is None else counted.union(found)
    if counted is None:
        return texts.sparkSession.createDataFrame([], "lang string, phrase string, k int, f long"), totals
    k = F.length("phrase") - F.length(F.replace(F.col("phrase"), F.lit(" "), F.lit(""))) + 1
    frequent = listed.join(counted, ["shard", "number"]).where(F.col("c") >= LEAST)
    return kept(frequent.select("lang", "phrase", k.alias("k"), F.col("c").alias("f")), "phrases"), totals


def _wide(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` from the documents' ``lang`` and ``text``."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).where("text <> ''")
    phrases, totals = phrase_counts(texts)
    found = phrases.where("k > 1").withColumnRenamed("f", "a")
    cuts = found.select("lang", "phrase", "a", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "*", F.call_function("substring_index", "phrase", F.lit(" "), F.col("cut")).alias("head"),
        F.call_function("substring_index", "phrase", F.lit(" "), F.col("cut") - F.col("k")).alias("rest"))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.call_function("div", _wide(F.lit(2_000_000)) * F.col("a").cast("decimal(20,0)"), _wide(F.col("l")) + F.col("r").cast("decimal(20,0)"))
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))
    words = F.split("phrase", " ")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    inside = found.where("k > 2").select(F.col("lang").alias("g"), F.explode(spans).alias("part"), "a").groupBy("g", "part").agg(F.max("a").alias("most"))
    stays = scored.join(inside, (F.col("lang") == F.col("g")) & (F.col("phrase") == F.col("part")), "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * CONTAINED))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = stays.select("lang", "phrase", "a", "low.l", "low.r", "low.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = rf"""
with p as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
n as (select lang, sum(len(ws))::bigint as n from w group by lang),
g as (
  select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase
  from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w, (values (1), (2), (3), (4)) t(k) where len(ws) >= k) x),
f as (select lang, k, phrase, count(*) as f from g group by all having count(*) >= {LEAST}),
c as (select lang, k, phrase, string_split(phrase, ' ') as ws, f as a from f where k > 1),
cut as (select *, unnest(range(1, k)) as j from c),
s as (
  select cut.lang, cut.phrase, a, j, h.f as l, t.f as r, ((2000000::hugeint * a) // (h.f::hugeint + t.f))::bigint as score
  from cut
  join f h on h.lang = cut.lang and h.k = j and h.phrase = array_to_string(ws[1:j], ' ')
  join f t on t.lang = cut.lang and t.k = cut.k - j and t.phrase = array_to_string(ws[j + 1:], ' ')),
low as (select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1),
sub as (
  select lang, array_to_string(ws[i:i + m - 1], ' ') as phrase, max(a) as most
  from (select lang, ws, a, m, unnest(range(1, k - m + 2)) as i from c, (values (2), (3)) t(m) where m < k) x group by all),
o as (
  select low.*, row_number() over (partition by low.lang order by score desc, a desc, low.phrase) as rank
  from low left join sub on sub.lang = low.lang and sub.phrase = low.phrase
  where most is null or 100 * most < {CONTAINED} * a)
select lang, rank, phrase, a, l, r, n, score from o join n using (lang) where rank <= {TOP}
"""


@query("op13_collocations", OP13_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_columns(spark, sf_dir, "documents", lang="string", text="string"))
