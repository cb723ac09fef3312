import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import rows

from vaultspark.llm import collocations
from vaultspark.llm.registry import ORACLES, QUERIES

QUERY = "op13_collocations"
ALPHABET = ["A", "b", "é", "漢", " ", "\t", " ", ".", "\n", ",", "\x0b", " ", "-", "b"]


def pieces_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute_force(docs, least=30, top=2000):
    f, n = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            longer = [b for q, b in found.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, _, left, right = min((2_000_000 * a // (counts[p[:j]] + counts[p[j:]]), j, counts[p[:j]], counts[p[j:]]) for j in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((-a, left, lang, n[lang], p.decode(), right, rank, -s))
    return sorted(out, key=repr)


def prose(seed, n, vocabulary=25):
    draw = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"É{i}B" for i in range(vocabulary)]
    return [" ".join(draw.choice(words[:5] if draw.random() < 0.6 else words) + draw.choice(["", "", "", ".", ",\t", "\n"])
                     for _ in range(draw.randint(0, 80))) for _ in range(n)]


CASES = {
    "several languages": [(t, ["en", "de", None, "und"][i % 4]) for i, t in enumerate(prose(1, 160))],
    "nulls, empty and repeated rows, ties": [(None, "en"), ("", "en"), (" \t.", None)] + [("a b a b a b c d. c d", "en")] * 30 + [("x y", "fr")] * 29,
    "one very long text": [(" ".join(prose(2, 120)), "en"), ("z " * 3_000, "en"), ("q" * 100_000, "de")],
}


@pytest.mark.parametrize("case", CASES)
def test_equals_brute_force_and_oracle(spark, make_tables, oracle, case):
    docs = CASES[case]
    folder = make_tables(documents=[(i, t, g) for i, (t, g) in enumerate(docs)], extra="phrase string, a long, k long, n string")
    names, got = rows(QUERIES[QUERY](spark, folder))
    assert names == ["a", "l", "lang", "n", "phrase", "r", "rank", "score"]
    assert got and got == brute_force(docs)
    assert (names, got) == oracle(ORACLES[QUERY], folder)


def test_whole_table_equals_oracle(spark, sf_dir, oracle):
    assert rows(QUERIES[QUERY](spark, sf_dir)) == oracle(ORACLES[QUERY], sf_dir)


def test_empty_table(spark, make_tables):
    assert QUERIES[QUERY](spark, make_tables()).collect() == []


def test_many_shards_give_the_same(spark, make_tables, monkeypatch):
    docs = CASES["several languages"]
    monkeypatch.setattr(collocations, "SHARD_PHRASES", 100)
    folder = make_tables(documents=[(i, t, g) for i, (t, g) in enumerate(docs)])
    assert rows(QUERIES[QUERY](spark, folder))[1] == brute_force(docs)


def test_counts_beyond_64_bits_in_products(spark, monkeypatch):
    big = 1 << 61
    frame = spark.createDataFrame([("en", "a", 1, big + 5), ("en", "b", 1, big + 2), ("en", "a b", 2, big + 1)], "lang string, phrase string, k int, f long")
    totals = spark.createDataFrame([("en", 3 * big)], "lang string, n long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda texts: (frame, totals))
    got = collocations.collocations(spark.createDataFrame([("en", "t")], "lang string, text string")).first()
    assert got.score == 2_000_000 * (big + 1) // (2 * big + 7) and got.n == 3 * big


@pytest.mark.parametrize("size", [1, 3, 16, 1 << 20])
def test_chunks_see_every_window_once(size):
    draw = random.Random(size)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 60))) for _ in range(80)] + ["", "b" * 50, ""]
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(np.arange(len(texts), dtype=np.int32)), "text": pa.array(texts)})
    got, want = Counter(), Counter()
    for chunk in collocations.chunks(batch.slice(3), size):
        words = chunk.words.to_pylist()
        for k in range(1, 5):
            for p in np.flatnonzero(collocations._windows(chunk, k)):
                got[chunk.lang[p], b" ".join(words[c] for c in chunk.codes[p:p + k]).decode()] += 1
    for i, text in enumerate(texts[3:], 3):
        for words in pieces_of(text):
            for k in range(1, 5):
                for p in range(len(words) - k + 1):
                    want[i, " ".join(words[p:p + k])] += 1
    assert got == want


def test_trie_holds_its_phrases_and_nothing_else():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    phrases = sorted({(draw.choice(["en", "de", "fr"]), " ".join(draw.choice(words[:40] if draw.random() < 0.7 else words) for _ in range(draw.randint(1, 4)))) for _ in range(4000)})
    trie = collocations.Trie(collocations.Trie.build(
        pa.array([g for g, _ in phrases]), pa.array([p for _, p in phrases]), np.arange(len(phrases))))
    found = {}

    def walk(state, lang, so_far):
        for word, code in trie.code.items():
            slot = trie.base[state] + code
            if 0 <= slot < len(trie.check) and trie.check[slot] == state:
                if trie.accept[slot] >= 0:
                    found[int(trie.accept[slot])] = (lang, " ".join([*so_far, word.decode()]))
                walk(slot, lang, [*so_far, word.decode()])

    for lang, root in trie.root.items():
        walk(root, lang, [])
    assert [found[i] for i in range(len(phrases))] == phrases
