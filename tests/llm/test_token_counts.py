import random

import pytest
import sentencepiece
from tokenizers import Tokenizer

from vaultspark.llm import token_counts as tc
from vaultspark.llm.registry import QUERIES

PATH = tc.vocabulary_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_whole_table(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op3_token_counts"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        n = count(library, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def test_odd_words(library):
    rng = random.Random(5)
    parts = ["a", "The", "é", "é", " ", "\n", " ", "\x1c", "'s", "'", ".", "%%%", "12", "İ", "ß", "<|endoftext|>", "<|ENDOFTEXT|>", "你好", "😀", "..", "x.y", "̈"]
    vocabulary = tc.load(PATH)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert tc.count_text(vocabulary, text) == count(library, text), repr(text)


@pytest.mark.parametrize("chunk, overlap", [(40, 8), (64, 3), (200, 50), (30, 40)])
def test_splicing_equals_one_piece(library, chunk, overlap):
    rng = random.Random(chunk)
    encode = tc.load(PATH).encode
    for _ in range(60):
        words = ["".join(rng.choice("abcé😀.'") for _ in range(rng.choice([1, 3, 8, 90]))) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", "\n", "  "]) for w in words)
        assert tc.spliced(text, encode, chunk, overlap) == library.encode(text, add_special_tokens=False).ids


def test_splicing_without_any_boundary(library):
    text = "ab" * 500
    assert tc.spliced(text, tc.load(PATH).encode, 50, 10) == library.encode(text, add_special_tokens=False).ids


def test_splicing_a_sentencepiece_model():
    path = tc.vocabulary_path("piece_bpe_32k.model")
    text = "the thing, 你好 😀 and so on\n" * 40
    want = sentencepiece.SentencePieceProcessor(model_file=path).encode(text)
    assert len(tc.spliced(text, tc.load(path).encode, 100, 30)) == len(want)


def test_nulls_long_texts_and_clashes(spark, make_tables, library):
    long = "word, " * 60_000 + "x" * 5_000
    folder = make_tables(extra="n_tokens string", documents=[(1, None), (2, ""), (3, long), (None, "a b"), (4, "a b"), (4, "a b")])
    got = QUERIES["op3_token_counts"](spark, folder).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 2), (1, 0), (2, 0), (3, count(library, long)), (4, 2), (4, 2)]
    assert QUERIES["op3_token_counts"](spark, make_tables()).collect() == []


def test_other_vocabularies_are_counted_as_the_library_does(spark, sf_dir, monkeypatch):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = tc.vocabulary_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    texts += ["hello  world\n\n  it's\ta b ", " " * 50, "x" * 500]
    vocabulary = tc.load(path)
    assert vocabulary.stable and not vocabulary.by_words
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [tc.count_text(vocabulary, t) for t in texts] == want
    monkeypatch.setattr(tc, "CHUNK_CHARS", 300)
    assert [tc.count_text(vocabulary, t) for t in texts] == want
    assert [len(tc.spliced(t, vocabulary.encode, 300, 64)) for t in texts] == want
    assert tc.load(tc.vocabulary_path("word_bpe_49k.json")).by_words

    # A pre-tokeniser that is not known: no splicing, no words.
    made = tc._Json.__new__(tc._Json)
    other = Tokenizer(models.BPE())
    other.pre_tokenizer = pre_tokenizers.Metaspace()
    monkeypatch.setattr(Tokenizer, "from_file", staticmethod(lambda _: other))
    made.__init__("any")
    assert not made.stable and not made.by_words
