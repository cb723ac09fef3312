import random

import numpy as np
import pytest

from vaultspark.llm import decontamination as dc
from vaultspark.llm.registry import QUERIES


def distance(passage, text):
    """Fewest edits of a whole passage to any part of a text."""
    row = [0] * (len(text) + 1)
    for a in range(1, len(passage) + 1):
        nxt = [a]
        for b in range(1, len(text) + 1):
            nxt.append(min(row[b - 1] + (passage[a - 1] != text[b - 1]), row[b] + 1, nxt[-1] + 1))
        row = nxt
    return min(row)


@pytest.mark.parametrize("seed", range(4))
def test_banded_alignment(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        p, t = rng.integers(0, 3, rng.integers(1, 12)).astype(np.uint32), rng.integers(0, 3, rng.integers(0, 20)).astype(np.uint32)
        assert dc.align(p, t, -len(p), len(t), len(p))[0] == distance(p, t)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def edited(rng, text, share):
    signs = list(text)
    for _ in range(int(share * len(text))):
        k = rng.randrange(len(signs))
        kind = rng.randrange(3)
        signs[k: k + 1] = [["z"], [], [signs[k], "q"]][kind]
    return "".join(signs)


def test_every_passage_within_the_budget_is_found_and_no_other(monkeypatch):
    rng = random.Random(6)
    items = [(k, words(rng, 40)) for k in range(20)]
    index = dc.Index(dc.passages(items))
    monkeypatch.setattr(dc, "PIECE", 700)  # texts go over several pieces
    texts, want = [], set()
    for k in range(120):
        text = words(rng, rng.randrange(0, 300))
        if k % 2:
            item, body = rng.choice(items)
            at = rng.randrange(len(text) + 1)
            text = text[:at] + " " + edited(rng, body, rng.choice([0, 0.03, 0.06])).upper().replace(" ", "\n") + " " + text[at:]
            want.add((k, item))
        texts.append(text)
    found = list(dc.matches(index, texts))
    assert {(k, item) for k, item, *_ in found} == want
    for k, item, start, end, edits, _ in found:
        part = dc.plain(texts[k][start:end])
        assert min(distance(p[2], part) for p in index.passages if p[0] == item) <= edits


def test_half_an_item_is_found():
    rng = random.Random(8)
    item = words(rng, 60)
    index = dc.Index(dc.passages([(1, item)]))
    assert [m[1] for m in dc.matches(index, [words(rng, 30) + item[: len(item) // 2] + words(rng, 30)])] == [1]
    assert list(dc.matches(index, [words(rng, 200)])) == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op6_decontamination"](spark, sf_dir).collect() if r.edits == 0} == exact and exact


def test_slices_nulls_short_items_and_repeats(spark, make_tables, monkeypatch):
    rng = random.Random(9)
    long = words(rng, 50)
    folder = make_tables(
        extra="edits string, start string",
        documents=[(1, None), (2, ""), (3, "say " + long + " so"), (3, "say " + long + " so"), (None, long), (5, "a 'tiny' one"), (6, "İ" + long)],
        benchmark=[(1, long), (2, None), (3, ""), (4, "'TINY'"), (5, "not here at all")])
    monkeypatch.setattr(dc, "SLICE_CHARS", 150)  # several passes
    got = sorted(((r.doc_id, r.item_id, r.edits) for r in QUERIES["op6_decontamination"](spark, folder).collect()), key=repr)
    assert got == sorted([(3, 1, 0), (None, 1, 0), (5, 4, 0), (6, 1, 0)], key=repr)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = dc.drop_contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert sorted(r.doc_id for r in left.collect()) == [1, 2] and left.columns == docs.columns
    assert QUERIES["op6_decontamination"](spark, make_tables()).collect() == []


@pytest.mark.parametrize("slice_chars", [150, 400, 2_000_000])
def test_one_row_per_document_and_item_however_sliced(spark, monkeypatch, slice_chars):
    rng = random.Random(12)
    long, other = words(rng, 120), words(rng, 40)  # the long item is longer than the small slices
    docs = spark.createDataFrame(
        [("a", "so " + long + " it goes"), ("a", "so " + long + " it goes"), ("a", other), ("b", other + " and " + long[: len(long) // 2])],
        "name string, body string")
    items = spark.createDataFrame([(1.5, long), (2.5, other), (1.5, long)], "key double, text string")
    monkeypatch.setattr(dc, "SLICE_CHARS", slice_chars)
    found = dc.find_contamination(docs, items, "name", "body", "key").collect()
    assert sorted((r.name, r.key, r.edits) for r in found) == [("a", 1.5, 0), ("a", 2.5, 0), ("b", 1.5, 0), ("b", 2.5, 0)]
    whole = next(r for r in found if (r.name, r.key) == ("a", 1.5))
    assert (whole.start, whole.end) == (3, 3 + len(long))


def test_edited_passages_of_the_whole_table(spark, sf_dir):
    """Benchmark items with edits, put into every fiftieth text of the table, against a full alignment."""
    rng = random.Random(13)
    items = [(i.item_id, i.text) for i in spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").collect()]
    docs = [(d.doc_id, d.text or "") for d in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    planted = {}
    for k in range(0, len(docs), 50):
        item, body = rng.choice(items)
        part = edited(rng, body, 0.04)
        docs[k] = (docs[k][0], docs[k][1] + " " + part)
        index = dc.Index(dc.passages([(item, body)]))
        if any(distance(p[2], dc.plain(part)) <= e for p, e in zip(index.passages, index.edits)):
            planted[docs[k][0]] = item
    found = dc.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                  spark.createDataFrame(items, "item_id long, text string")).collect()
    assert planted and set(planted.items()) <= {(r.doc_id, r.item_id) for r in found}


@pytest.mark.parametrize("expansion", [1, 300, 1 << 21])
def test_lines_of_one_sign_go_in_bounded_blocks(monkeypatch, expansion):
    rng = random.Random(14)
    items = [(k, words(rng, 6) + "\n" + "-" * 80 + "\n" + words(rng, 6)) for k in range(12)]
    index = dc.Index(dc.passages(items))
    texts = ["-" * 700, words(rng, 20) + "-" * 300 + " " + words(rng, 20)]
    texts += ["-" * rng.randrange(400) + edited(rng, items[k][1], 0.03) + "-" * rng.randrange(400) for k in range(6)]
    texts += [words(rng, 5) + "-" * 20 + edited(rng, items[k][1], 0.05) + "=" * 200 + items[k + 1][1].replace("-", "- ") for k in range(4)]
    monkeypatch.setattr(dc, "EXPANSION", expansion)
    monkeypatch.setattr(dc, "_MANY", 10)
    blocks = []
    bands = dc.Index._bands

    def watched(self, codes, at, first, last):
        blocks.append((last - first).sum())
        return bands(self, codes, at, first, last)

    monkeypatch.setattr(dc.Index, "_bands", watched)
    found = {(k, item) for k, item, *_ in dc.matches(index, texts)}
    want = set()
    for k, text in enumerate(texts):
        codes = dc.plain(text)
        want |= {(k, p[0]) for p, e in zip(index.passages, index.edits) if distance_at_most(p[2], codes, e)}
    assert found == want and len(want) >= 10
    # A block holds no more than asked for, but for what one passage shares with a short stretch.
    stretch = 4 * (index.longest + 2 * int(index.edits.max() + 1))
    assert all(n <= expansion + stretch * dc.PASSAGE for n in blocks)


def distance_at_most(passage, codes, edits):
    """``distance(passage, codes) <= edits``, a row at a time."""
    row = np.zeros(len(codes) + 1, np.int64)
    steps = np.arange(len(codes) + 1)
    for a, sign in enumerate(passage, 1):
        nxt = np.r_[a, np.minimum(row[:-1] + (codes != sign), row[1:] + 1)]
        row = np.minimum.accumulate(nxt - steps) + steps
    return row.min() <= edits
