import math
import random
import zlib

import numpy as np

from vaultspark.llm import toxicity as tx
from vaultspark.llm.registry import QUERIES


def sets(texts):
    return [np.array(sorted({t for w in set(x.split()) for t in tx.terms_of(w)}), np.int32) for x in texts]


def test_pairs_are_learned():
    """An insult is toxic only next to a group's name: no additive weights can tell."""
    rng = random.Random(1)
    filler = [f"w{k}" for k in "abcdefghijklmnop"]
    texts, labels = [], []
    for _ in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        parts = rng.sample(filler, 6) + ["nitwit"] * insult + ["martians"] * group + ["teacup"] * (not insult) + ["meadow"] * (not group)
        rng.shuffle(parts)
        texts.append(" ".join(parts))
        labels.append(int(insult and group))
    model = tx.train(sets(texts[:1000]), np.array(labels[:1000]))
    got = [model.score(t) >= 0.5 for t in texts[1000:]]
    assert sum(a == bool(b) for a, b in zip(got, labels[1000:])) > 490


def test_pairs_without_any_single_signal_are_learned():
    """Toxic where exactly one of insult and group occurs: each word alone says nothing."""
    rng = random.Random(5)
    filler = [f"w{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    texts, labels = [], []
    for _ in range(3000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        parts = rng.sample(filler, 8) + ["nitwit"] * insult + ["martians"] * group
        rng.shuffle(parts)
        texts.append(" ".join(parts))
        labels.append(int(insult != group))
    model = tx.train(sets(texts[:2000]), np.array(labels[:2000]))
    got = [model.score(t) >= 0.5 for t in texts[2000:]]
    assert sum(a == bool(b) for a, b in zip(got, labels[2000:])) > 950


def test_score_is_the_written_out_sum_over_pairs():
    rng = np.random.default_rng(2)
    words = [f"word{a}" for a in "abcdefgh"]
    place = np.full(tx.BUCKETS, -1, np.int32)
    known = sorted({t for w in words[:6] for t in tx.terms_of(w)})
    place[known] = np.arange(len(known))
    model = tx.Model(place, -0.3, rng.normal(size=len(known)).astype(np.float32), rng.normal(size=(len(known), tx.FACTORS)).astype(np.float32))
    for k in range(9):
        text = " ".join(words[:k] + words[:2])
        rows = sorted({int(place[t]) for w in text.split() for t in tx.terms_of(w)} - {-1})
        z = model.bias + sum(float(model.weight[i]) for i in rows)
        z += sum(float(model.factor[i].astype(float) @ model.factor[j].astype(float)) for i in rows for j in rows if i < j)
        assert abs(model.score(text) - 1 / (1 + math.exp(-z))) < 1e-4


def test_held_out_rows(spark):
    rows = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in rows)
    scored = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in scored if y == 0], [s for s, y in scored if y == 1]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(good) * len(bad))
    assert auc > 0.95 and sum(s >= 0.7 for s in good) < 0.01 * len(good) and sum(s >= 0.7 for s in bad) > 0.7 * len(bad)


def test_held_out_labels_are_never_read(spark, make_tables):
    docs = [(k, ("you nitwit " if k % 2 else "hello there ") + f"number {k}") for k in range(200)]
    held = [zlib.crc32(str(k).encode()) % 3 == 1 for k in range(200)]
    plain = make_tables(documents=docs, labels=[(k, 1, k % 2) for k in range(200) if not held[k]])
    a = {r.doc_id: r.score for r in QUERIES["op10_toxicity"](spark, plain).collect()}
    upset = make_tables(documents=docs, labels=[(k, 1, 1 - k % 2 if held[k] else k % 2) for k in range(200)])
    assert a == {r.doc_id: r.score for r in QUERIES["op10_toxicity"](spark, upset).collect()}
    assert a[1] > 0.7 > 0.3 > a[2]


def test_nulls_repeats_clashes_and_one_label(spark, make_tables):
    folder = make_tables(
        extra="score string, y int, spread int, terms string", documents=[(1, None), (2, ""), (3, "a"), (3, "a"), (None, "x" * 50_000)],
        labels=[(1, 0, None), (None, 0, 1), (3, 0, 1), (3, 0, 0), (99, 0, 1)])
    got = QUERIES["op10_toxicity"](spark, folder).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    none = QUERIES["op10_toxicity"](spark, make_tables(documents=[(1, "a")])).collect()
    assert none[0].predicted == 0
    assert QUERIES["op10_toxicity"](spark, make_tables()).collect() == []


def test_the_cap_of_the_sample_does_not_move_scores(spark, make_tables):
    """Labels one to nine and noisy words: scores of a cut sample (one to one) keep the rate of the table."""
    rng = random.Random(3)
    docs, labels = [], []
    for k in range(4000):
        bad = int(rng.random() < 0.1)
        parts = rng.sample("abcdefgh", 4) + ["nitwit"] * (rng.random() < (0.6, 0.1)[1 - bad]) + ["meadow"] * (rng.random() < (0.2, 0.6)[1 - bad])
        docs.append((k, " ".join(parts)))
        labels.append((k, 1, bad))
    folder = make_tables(documents=docs, labels=labels)
    tables = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rate = sum(r[2] for r in labels) / len(labels)
    whole, cut = (tx.learn(*tables, max_rows=n) for n in (4000, 200))
    for model in (whole, cut):
        assert abs(sum(model.score(t) for _, t in docs) / len(docs) - rate) < 0.05
    for text in ("a b nitwit", "c d meadow", "nitwit meadow", "e f"):
        a, b = (math.log(s / (1 - s)) for s in (whole.score(text), cut.score(text)))
        assert abs(a - b) < 1
