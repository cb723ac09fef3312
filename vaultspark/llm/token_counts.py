"""Operator 3, token counts: overlap resynchronisation.

Texts of any length are counted without handing a whole huge text to the
tokenizer. A huge text is encoded in overlapping chunks, with offsets. Two
neighbouring chunks are spliced at a *stable common boundary*: a place in their
overlap where both encodings start a token and the character before it is white
space. No pre-token of the supported vocabularies crosses white space, and their
normalisers change nothing across it, so the tokens left of such a place do not
depend on what follows and those right of it not on what precedes. Where the
overlap has no such place, it is widened (and with it the chunk), in the limit
to the whole text.

A vocabulary says at loading whether this holds: where its pre-tokeniser is none of the
known ones, huge texts are encoded whole.

Vocabularies whose pre-tokeniser is ``WORD_PATTERN``, which drops white space, have a
short way for texts of ordinary length: their count is the sum over their words, and
counts of words met before are remembered, within a bound on the remembered words
that changes nothing but the speed. All others encode these texts whole.

Defined cases: a null text counts as empty; the empty text has no tokens; rows
are counted one by one, so repeated rows repeat; an empty table gives none.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, query

CHUNK_CHARS = 65_536
OVERLAP_CHARS = 2_048
OVER_LIMIT = 2_048
WORDS_KEPT = 400_000
# Sentence marks that end a pre-token wherever they follow a letter or digit.
TAIL = ".,;:!?%&$#*)]"

# Fixed value: the pre-tokens of word vocabularies; what lies between is dropped.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

Encoder = Callable[[str], tuple[list[int], list[int]]]


def _steps(part: object | None, inner: str) -> list[dict]:
    """The settings of a normaliser or pre-tokeniser, step by step."""
    if part is None:
        return []
    settings = json.loads(part.__getstate__())
    return settings[inner] if settings["type"] == "Sequence" else [settings]


class _Json:
    """A ``tokenizers`` vocabulary: ids with the start of each token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.counts: dict[str, int] = {}
        self.cores: dict[str, int] = {}
        steps, changes = _steps(self.library.pre_tokenizer, "pretokenizers"), _steps(self.library.normalizer, "normalizers")
        first = steps[0] if steps else {}
        drops_space = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
        known = all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} for x in changes)
        # Words may be counted one by one, and cut from their end marks.
        self.by_words = drops_space and known and first["pattern"] == {"Regex": WORD_PATTERN}
        # No pre-token goes on from white space to what follows it.
        self.stable = self.by_words or not changes and first.get("type") == "ByteLevel" and first.get("use_regex") is True

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        found = self.library.encode(text, add_special_tokens=False)
        return found.ids, [start for start, _ in found.offsets]

    def many(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class _Model:
    """A ``sentencepiece`` model; pieces never cross from a letter to a space."""

    by_words, stable = False, True

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        found = self.library.encode(text, return_type="proto").pieces
        sizes = [len(p.surface) for p in found]
        return [p.id for p in found], [0, *accumulate(sizes)][:-1] if sizes else []


_LOADED: dict[str, object] = {}


def load(path: str):
    """The vocabulary at a path, once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = _Json(path) if path.endswith(".json") else _Model(path)
    return _LOADED[path]


def spliced(text: str, encode: Encoder, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    """Token ids of a text from overlapping chunks; equal to ``encode(text)``.

    ``encode`` returns ids and the start of each token in its argument.
    """
    ids: list[int] = []
    start = 0
    end = min(len(text), chunk)
    own, places = encode(text[start:end])
    places = [start + p for p in places]
    while end < len(text):
        reach, ahead = overlap, chunk
        while True:
            nxt = max(start, end - reach)
            nxt_end = min(len(text), nxt + max(ahead, 2 * reach))
            new, new_places = encode(text[nxt:nxt_end])
            new_places = [nxt + p for p in new_places]
            left = {p: k for k, p in reversed(list(enumerate(places))) if nxt < p < end and text[p - 1].isspace()}
            # Tokens that share a start (bytes of one character) count from the first.
            right = {p: k for k, p in reversed(list(enumerate(new_places))) if p in left and not text[p].isspace()}
            if right:
                # The middle one keeps most context on either side.
                at = sorted(right)[len(right) // 2]
                ids += own[: left[at]]
                own, places = new[right[at]:], new_places[right[at]:]
                start, end = at, nxt_end
                break
            if nxt == start:
                # No boundary in the whole chunk: it must be encoded in one piece with the next.
                own, places, end = new, new_places, nxt_end
                break
            reach *= 2
    return ids + own


def _core(word: str) -> tuple[str, str]:
    """A word without its end marks, and the marks, if a pre-token surely ends between."""
    core = word.rstrip(TAIL)
    # Some letters end in a mark once in lower case, and a mark would join what follows.
    if core == word or not core or not core[-1].lower()[-1].isalnum():
        core = word
    tail = word[len(core):]
    return (core.lower() if core.isascii() and core.isalnum() else core), tail


def _add_words(vocabulary: _Json, missing: list[str]) -> None:
    """Remember the counts of words."""
    parts = [_core(w) for w in missing]
    unknown = list({p for pair in parts for p in pair if p}.difference(vocabulary.cores))
    if len(vocabulary.cores) > WORDS_KEPT:
        vocabulary.cores.clear()
        unknown = list({p for pair in parts for p in pair if p})
    vocabulary.cores.update(zip(unknown, vocabulary.many(unknown)))
    vocabulary.cores[""] = 0
    if len(vocabulary.counts) > WORDS_KEPT:
        vocabulary.counts.clear()
    cores = vocabulary.cores
    vocabulary.counts.update((w, cores[a] + cores[b]) for w, (a, b) in zip(missing, parts))


def count_text(vocabulary, text: str | None) -> int:
    """Tokens of one text."""
    if not text:
        return 0
    if len(text) > CHUNK_CHARS and vocabulary.stable:
        return len(spliced(text, vocabulary.encode))
    if len(text) > CHUNK_CHARS or not vocabulary.by_words:
        return len(vocabulary.encode(text)[0])
    words = text.replace("\n", " ").split(" ")
    known = vocabulary.counts
    try:
        return sum(map(known.__getitem__, words))
    except KeyError:
        distinct = set(words)
        if len(known) + len(distinct) > WORDS_KEPT:
            known.clear()
        _add_words(vocabulary, list(distinct.difference(known)))
        return sum(map(known.__getitem__, words))


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = OVER_LIMIT) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of each row; ``path`` names the vocabulary file."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path)
        for batch in batches:
            texts = batch.column(1)
            counts = [count_text(vocabulary, t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = df.select(F.col(id_col), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    kind = df.schema[id_col].dataType.simpleString()
    return slim.mapInArrow(counted, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))
