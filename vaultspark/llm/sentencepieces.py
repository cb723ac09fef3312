"""Operator 5, SentencePiece encoding and decoding: a weighted finite-state transducer.

``Transducer`` compiles three machines from a model file: the normaliser (a space
becomes the mark U+2581, one is put before the text), the pieces (one arc per
piece, spelling it and writing its id) and byte fallback (a character without a
piece writes its UTF-8 bytes). Encoding composes them with an input and takes the
shortest path in the tropical semiring: states are places in the input together
with the piece that ends there, weights add along a path, the least total wins.

* Unigram models: an arc weighs minus its piece's score.
* BPE models: an arc weighs nothing where its piece is *stable* after the piece
  before it, else infinity; stable means that merging the two spellings from
  single characters ends in just these two pieces. Exactly one path of any input
  is finite, and it is what merging the whole input gives, so a single state is
  live at each place.

A text is cut before every mark that follows another sign, where no piece reaches
across (checked at compilation, else texts stay whole); paths of segments met
before are remembered, within a bound that changes nothing but the speed.

Decoding is the inverse: pieces spell themselves, runs of byte pieces are read as
UTF-8, the first mark goes, marks become spaces.

Defined cases: a null text counts as empty and has no tokens; rows are handled
one by one; a literal U+2581 cannot be told from a space, as in the model itself.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, query, release_memory

MARK = "▁"
SEGMENTS_KEPT = 250_000
PARTS_KEPT = 100_000
PAIRS_KEPT = 300_000
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            value: object = varint()
        elif key & 7 == 1:
            value, at = data[at: at + 8], at + 8
        elif key & 7 == 2:
            size = varint()
            value, at = data[at: at + size], at + size
        else:
            value, at = data[at: at + 4], at + 4
        yield key >> 3, value


class Transducer:
    """The compiled model."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = list(_fields(file.read()))
        self.names, self.kinds, self.scores = [], [], []
        for piece in (dict(_fields(v)) for k, v in model if k == 1):
            self.names.append(piece[1].decode("utf-8"))
            self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            self.kinds.append(piece.get(3, NORMAL))
        trainer = dict(_fields(next(v for k, v in model if k == 2)))
        rules = dict(_fields(next(v for k, v in model if k == 3)))
        self.bpe = trainer.get(3, UNIGRAM) == BPE
        if rules.get(2):
            raise NotImplementedError("only the identity normaliser is compiled")
        self.prefix = bool(rules.get(3, 1))
        self.squeeze = bool(rules.get(4, 1))
        if self.squeeze or not (self.bpe or trainer.get(3, UNIGRAM) == UNIGRAM):
            raise NotImplementedError("a normaliser or model type that is not compiled")
        spelled = [(n, i) for i, (n, k) in enumerate(zip(self.names, self.kinds)) if k in (NORMAL, USER)]
        self.ids = dict(spelled)
        self.longest = max(len(n) for n, _ in spelled)
        self.bytes = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(self.names, self.kinds)) if k == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        # Beginnings of pieces (True: a whole piece): where a spelling leaves this table, no arc goes on.
        self.begins = {n[:k]: False for n, _ in spelled for k in range(1, len(n))}
        self.begins.update((n, True) for n, _ in spelled)
        # Neighbours inside pieces: between other signs nothing is ever merged.
        self.inner = {n[k: k + 2] for n, _ in spelled for k in range(len(n) - 1)}
        self.cut = all(MARK not in n.lstrip(MARK) for n, _ in spelled)
        # Paths met before, in two generations: what is asked for again moves to the younger one.
        self.segments: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        own = {i: bytes([b]) for b, i in self.bytes.items()}
        self.spelling = [b"" if k == CONTROL else own.get(i, n.encode("utf-8")) for i, (n, k) in enumerate(zip(self.names, self.kinds))]

    # --- the normaliser

    def normal(self, text: str) -> str:
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    # --- weights

    def merged(self, signs: str) -> list[str]:
        """Merge neighbours, best score first and leftmost among equals, until no piece is left to make."""
        parts = list(signs)
        while len(parts) > 1:
            best, at = -math.inf, -1
            for k in range(len(parts) - 1):
                piece = self.ids.get(parts[k] + parts[k + 1])
                if piece is not None and self.scores[piece] > best:
                    best, at = self.scores[piece], k
            if at < 0:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def alone(self, piece: str) -> bool:
        """Does merging its spelling end in the piece itself?"""
        return self.merged(piece) == [piece]

    def stable(self, left: str, right: str) -> bool:
        """May ``right`` follow ``left``? With no left piece: does it come about at all?"""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            if not left:
                known = self.alone(right)
            elif left[-1] + right[0] not in self.inner:
                known = self.stable("", right)
            else:
                known = self.apart(left, right)
            self.pairs[left, right] = known
        return known

    def apart(self, left: str, right: str) -> bool:
        """Merging both spellings together, does no merge cross the border and each piece come about?"""
        ids, scores = self.ids, self.scores
        parts, border = list(left + right), len(left)
        weights = [scores[ids[p]] if (p := a + b) in ids else -math.inf for a, b in zip(parts, parts[1:])]
        while weights:
            best = max(weights)
            if best == -math.inf:
                break
            at = weights.index(best)
            if at == border - 1:
                return False
            border -= at < border
            one = parts[at] + parts[at + 1]
            parts[at: at + 2] = [one]
            del weights[at]
            if at:
                weights[at - 1] = scores[ids[p]] if (p := parts[at - 1] + one) in ids else -math.inf
            if at < len(weights):
                weights[at] = scores[ids[p]] if (p := one + parts[at + 1]) in ids else -math.inf
        return parts == [left, right]

    # --- composition with an input, and its shortest path

    def _finite_path(self, signs: str) -> list[str]:
        """The one path of finite weight of a BPE model: depth first, longest arcs first.

        A place from which no arc goes on is dead: only one piece can end there on a finite path.
        """
        n, known, begins = len(signs), self.pairs, self.begins
        out: list[str] = []
        left: list[list[str]] = []  # arcs not yet tried, by step
        dead = set()
        at, before, arcs = 0, "", None
        while at < n:
            if arcs is None:
                arcs = []
                for end in range(at + 1, n + 1):
                    spelled = signs[at:end]
                    whole = begins.get(spelled)
                    if whole or end == at + 1:
                        arcs.append(spelled)  # a single sign may have no piece: byte fallback
                    if whole is None:
                        break
            while arcs:
                piece = arcs.pop()
                if at + len(piece) in dead:
                    continue
                ok = known.get((before, piece))
                if ok if ok is not None else self.stable(before, piece):
                    out.append(piece)
                    left.append(arcs)
                    at, before, arcs = at + len(piece), piece, None
                    break
            else:
                dead.add(at)
                at -= len(out.pop())
                before, arcs = out[-1] if out else "", left.pop()
        return out

    def path(self, signs: str) -> list[str]:
        """The pieces along the shortest path; a character without a piece stands for itself."""
        if self.bpe:
            return self._finite_path(signs)
        n, ids, longest = len(signs), self.ids, self.longest
        cost, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        worst = min(self.scores) - 10.0
        for end in range(1, n + 1):
            for start in range(max(0, end - longest), end):
                piece = ids.get(signs[start:end])
                if piece is None and end - start > 1:
                    continue
                total = cost[start] - (worst if piece is None else self.scores[piece])
                if total < cost[end]:
                    cost[end], back[end] = total, start
        out, at = [], n
        while at:
            out.append(signs[back[at]:at])
            at = back[at]
        return out[::-1]

    def written(self, pieces: list[str]) -> bytes:
        """Ids of the pieces as 32-bit numbers; byte fallback for what has none."""
        out = []
        for piece in pieces:
            if piece in self.ids:
                out.append(self.ids[piece])
            elif self.bytes:
                out += [self.bytes[b] for b in piece.encode("utf-8")]
            else:
                out.append(self.unknown)
        return struct.pack(f"<{len(out)}i", *out)

    def encode_packed(self, text: str) -> bytes:
        signs = self.normal(text)
        parts = _SEGMENTS.findall(signs) if self.cut else [signs] if signs else []
        try:
            return b"".join(map(self.segments.__getitem__, parts))
        except KeyError:
            pass
        fresh = set(parts)
        if len(self.segments) + len(fresh) > SEGMENTS_KEPT:
            self.segments, self.older = {}, self.segments
        known, older = self.segments, self.older
        for part in fresh.difference(known):
            ids = older.get(part)
            known[part] = self.segment(part) if ids is None else ids
        return b"".join(map(known.__getitem__, parts))

    def segment(self, signs: str) -> bytes:
        """Ids of a segment. Between signs that no piece has side by side, it falls into parts of their own."""
        inner = self.inner
        cuts = [k for k in range(1, len(signs)) if signs[k - 1: k + 1] not in inner] if self.cut else []
        if not cuts:
            return self.written(self.path(signs))
        return b"".join([self.part(signs[lo:hi]) for lo, hi in zip([0, *cuts], [*cuts, len(signs)])])

    def part(self, signs: str) -> bytes:
        ids = self.parts.get(signs)
        if ids is None:
            ids = self.older_parts.get(signs)
            if ids is None:
                ids = self.written(self.path(signs))
            if len(self.parts) >= PARTS_KEPT:
                self.parts, self.older_parts = {}, self.parts
            self.parts[signs] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<i4").tolist()

    # --- the inverse

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.spelling.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


_SEGMENTS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_LOADED: dict[str, Transducer] = {}


def load(path: str) -> Transducer:
    """The compiled model at a path, once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Transducer(path)
    return _LOADED[path]


def encode_texts(
    df: DataFrame, path: str, text_col: str = "text", ids_col: str | None = "ids", keep_warm: bool = False,
) -> DataFrame:
    """All columns of ``df`` with ``n_tokens, n_byte_tokens, ids_sha256, round_trip``, and the ids if asked for.

    ``round_trip`` tells that decoding the ids gives the text back; ``ids_sha256`` hashes them as 32-bit numbers.
    With ``keep_warm`` a worker's next task finds the segments that this one met (bounded by the
    ``_KEPT`` numbers); without, a worker that goes on to other operators holds nothing.
    """
    added = [("n_tokens", T.LongType()), ("n_byte_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("round_trip", T.BooleanType())]
    if ids_col:
        added.append((ids_col, T.ArrayType(T.IntegerType())))
    clash = {name for name, _ in added} & set(df.columns)
    base = df.drop(*clash)
    at = base.columns.index(text_col)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = load(path)
        is_byte = np.array(machine.kinds) == BYTE
        for batch in batches:
            n, n_bytes, digest, trip, all_ids = [], [], [], [], []
            for value in batch.column(at):
                text = value.as_py() or ""
                packed = machine.encode_packed(text)
                ids = np.frombuffer(packed, "<i4")
                n.append(len(ids))
                n_bytes.append(int(is_byte[ids].sum()))
                digest.append(hashlib.sha256(packed).hexdigest())
                trip.append(machine.decode(ids.tolist()) == text.replace(MARK, " "))
                if ids_col:
                    all_ids.append(ids)
            columns = [pa.array(n, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(digest), pa.array(trip, pa.bool_())]
            if ids_col:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *(x for x, _ in added)])
        if not keep_warm:
            _LOADED.clear()
        del machine
        release_memory()

    return base.mapInArrow(encoded, T.StructType([*base.schema, *(T.StructField(x, t) for x, t in added)]))


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of ``df`` with the text that the ids stand for; null ids give a null text."""
    at = df.columns.index(ids_col)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = load(path)
        for batch in batches:
            texts = [None if x.as_py() is None else machine.decode(x.as_py()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    return df.mapInArrow(decoded, T.StructType([*df.schema, T.StructField(text_col, T.StringType())]))


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return encode_texts(docs, model_path(), ids_col=None, keep_warm=True).drop("text")
