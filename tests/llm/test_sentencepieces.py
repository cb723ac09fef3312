import random
import struct

import pytest
import sentencepiece

from vaultspark.llm import sentencepieces as sps
from vaultspark.llm.registry import QUERIES

PATH = sps.model_path()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_random_signs(library):
    machine = sps.Transducer(PATH)
    rng = random.Random(3)
    signs = ["a", "b", "th", "e", " ", "  ", "\n", "\t", "é", "ß", "你", "好", "😀", "▁", "'s", ".", "0", "12", "the", "aaa", "   ", "́", "İ", "<s>", "<0x41>", "x" * 20]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(14)))
        assert machine.encode(text) == library.encode(text), repr(text)
        assert machine.decode(machine.encode(text)) == text.replace("▁", " ")


def test_whole_table_and_round_trip(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = sps.decode_ids(sps.encode_texts(docs, PATH), PATH).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.ids == library.encode(r.text)
        assert r.n_tokens == len(r.ids) and r.round_trip and r.decoded == r.text
    short = {r.doc_id: r for r in QUERIES["op5_sentencepiece"](spark, sf_dir).collect()}
    assert {k: r.ids_sha256 for k, r in short.items()} == {r.doc_id: r.ids_sha256 for r in got}


def test_nulls_and_clashing_columns(spark, make_tables):
    folder = make_tables(extra="ids string, n_tokens string", documents=[(1, None), (2, ""), (3, " "), (3, " "), (None, "x" * 30_000)])
    got = sorted((r.doc_id or 0, r.n_tokens, r.round_trip) for r in QUERIES["op5_sentencepiece"](spark, folder).collect())
    assert [g[:2] for g in got[1:]] == [(1, 0), (2, 0), (3, 1), (3, 1)] and all(g[2] for g in got)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert sps.encode_texts(docs, PATH).columns[-1] == "ids"
    assert QUERIES["op5_sentencepiece"](spark, make_tables()).collect() == []


def _message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += bytes([number << 3, value])
        elif isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        else:
            out += bytes([number << 3 | 2, len(value)]) + value
    return out


def test_unigram_model_takes_the_lightest_path(tmp_path):
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.0, 1), ("ab", -3.5, 1), ("▁ab", -7.0, 1), ("ba", -1.0, 1)]
    model = _message(*((1, _message((1, n.encode()), (2, s), (3, k))) for n, s, k in pieces),
                     (2, _message((3, 1))), (3, _message((3, 1), (4, 0))))
    (tmp_path / "u.model").write_bytes(model)
    machine = sps.Transducer(str(tmp_path / "u.model"))
    spell = lambda text: [machine.names[i] for i in machine.encode(text)]
    assert spell("ab") == ["▁", "ab"]  # 6.5 against 7 and 7
    assert spell("aba") == ["▁", "a", "ba"]
    assert spell("az") == ["▁", "a", "<unk>"]
