import random

import numpy as np
import pytest

from llm_rows import rows
from vaultspark.llm import ngram_join as nj
from vaultspark.llm.graphs import connected_components
from vaultspark.llm.registry import ORACLES, QUERIES


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def components(texts):
    """Brute force: all pairs."""
    sets = {k: shingles(t) for k, t in texts.items()}
    label = {k: k for k in texts}
    keys = sorted(texts)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label, {k: len(s) for k, s in sets.items()}


def check(spark, make_tables, texts):
    folder = make_tables(documents=list(texts.items()), extra="cls int, n string, component string")
    label, size = components(texts)
    got = {r.doc_id: r for r in QUERIES["op4_ngram_join"](spark, folder).collect()}
    assert {k: r.component_id for k, r in got.items()} == label
    assert {k: r.n_shingles for k, r in got.items()} == size


def test_equals_oracle(spark, sf_dir, oracle):
    assert rows(QUERIES["op4_ngram_join"](spark, sf_dir)) == oracle(ORACLES["op4_ngram_join"], sf_dir)


def test_large_groups_of_near_copies_and_a_common_passage(spark, make_tables, monkeypatch):
    """Groups beyond short nodes, whose copies link with the original, with each other or with nothing."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(30)]
    texts = {}
    for g in range(3):
        base = [word() for _ in range(60 + 30 * g)]
        for k in range(70):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            texts[1000 * g + k] = " ".join(copy)
    for k in range(60):
        texts[5000 + k] = " ".join([word() for _ in range(rng.randrange(5, 50))] + passage)
    for k in range(40):
        texts[6000 + k] = " ".join(passage[: rng.randrange(1, 12)]) + " " + word()
    check(spark, make_tables, texts)


def test_nulls_short_texts_case_and_space(spark, make_tables):
    texts = {1: None, 2: "", 3: " \n\t", 4: "One two", 5: "one  TWO\n", 6: "one two three", 7: "É a", 8: "é a", 9: "a b c d e", 10: "A B C D E",
             11: "a b c d e f", 12: "x" * 200_000, 13: "a b c d e a b c d e a b c d e"}
    check(spark, make_tables, texts)


def test_repeated_rows_null_ids_and_empty_table(spark, make_tables):
    folder = make_tables(documents=[(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (7, "q"), (None, "")])
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in QUERIES["op4_ngram_join"](spark, folder).collect()), key=repr)
    assert got == [(0, 0, None), (0, 1, 5), (5, 1, 5), (5, 1, 5), (7, 1, 7)]
    assert QUERIES["op4_ngram_join"](spark, make_tables()).collect() == []


def test_sets_of_many_texts_at_once(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "b", "Th", "é", " ", "\n", "  ", "x y", "\x1c"]) for _ in range(rng.randrange(80))).encode() for _ in range(400)]
    monkeypatch.setattr(nj, "PIECE_BYTES", 50)
    monkeypatch.setattr(nj, "_POWERS", [])
    small = list(nj.sets_of(b"".join(texts), np.r_[0, np.cumsum([len(t) for t in texts])]))
    monkeypatch.setattr(nj, "PIECE_BYTES", 1 << 20)
    monkeypatch.setattr(nj, "_POWERS", [])
    for t, s in zip(texts, small):
        assert len(s) == len(shingles(t.decode()))
        if max(map(len, t.split()), default=0) <= 50:
            assert (nj.shingle_set(t) == s).all()


@pytest.mark.parametrize("seed", range(5))
def test_trie_counts_every_overlap(seed):
    rng = np.random.default_rng(seed)
    pivot = np.unique(rng.integers(0, 400, 200, dtype=np.uint64))
    sets = [np.unique(rng.choice(pivot, 150)) if k % 2 else np.unique(rng.integers(0, 400, 180, dtype=np.uint64)) for k in range(40)]
    sets += [pivot, pivot[:160], pivot[5:], sets[1]]
    want = [100 * len(i := np.intersect1d(pivot, s)) >= 75 * (len(pivot) + len(s) - len(i)) for s in sets]
    assert nj.trie_links(pivot, sets) == want and any(want) and not all(want)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(300)]
    star = [(1000, 1000 + k) for k in range(1, 50)]
    got = dict(connected_components(spark.createDataFrame(path + star + [(7, 7)], "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(301)}, **{1000 + k: 1000 for k in range(50)}}
