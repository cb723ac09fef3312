import math
import random

import pytest
from llm_rows import rows
from pyspark.sql import functions as F

from vaultspark.llm import exact_search
from vaultspark.llm.registry import ORACLES, QUERIES

QUERY = "op12_exact_search"


def floored(x):
    return min(max(math.floor(x * 256), -(1 << 63)), (1 << 63) - 1)


def brute_force(table, k=5):
    kept = [(i, [floored(x) for x in v]) for i, v, *_ in table
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(kept):
        if i is None or i % 50:
            continue
        scored = [(-min(max(sum(a * b for a, b in zip(v, w)), -(1 << 63)), (1 << 63) - 1), j is None, j or 0, j)
                  for m, (j, w) in enumerate(kept) if m != n and len(w) == len(v)]
        out += [(i, rank, -s, j) for rank, (s, _, _, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def clustered(n, dim, seed, shift=0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    return [(k + shift, [c + draw.gauss(0, 0.05) for c in centres[k % 12]]) for k in range(n)]


CASES = {
    "clusters of unequal norms": clustered(900, 8, 1) + [(k, [9.0 * x for x in v]) for k, v in clustered(100, 8, 2, 2000)],
    "one vector a third of all rows": clustered(300, 4, 3) + [(k, [0.5, 0.5, 0.5, 0.5]) for k in range(1000, 1160)],
    "nulls, lengths, ties, repeated ids and rows": [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (50, [1.0, 0.0]), (50, None), (1, [float("nan"), 0.0]),
        (2, [float("inf"), 0.0]), (3, [None, 0.0]), (100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]),
        (None, [1.0, 0.0]), (4, [-1.0, -0.0]), (150, []), (5, []), (6, [-0.001, 0.001]), (200, [7.0] * 5), (-50, [0.0, 0.0])],
    "beyond doubles and longs": [
        (0, [3e7, -2e7, 1.0]), (1, [3e7, 2e7, 1.004]), (2, [3e7, 2e7, 1.0]), (50, [1e30, 1.0, 0.0]), (3, [4e15, 4e15, 1.0]), (100, [4e15, -4e15, 1.0])],
}


@pytest.mark.parametrize("case", CASES)
def test_equals_brute_force(spark, make_tables, monkeypatch, case):
    monkeypatch.setattr(exact_search, "PART_ROWS", 40)
    monkeypatch.setattr(exact_search, "QUERY_ROWS", 7)
    folder = make_tables(embeddings=CASES[case], extra="score long, part int, v string, key string")
    names, got = rows(QUERIES[QUERY](spark, folder))
    assert names == ["query_id", "rank", "score", "vec_id"]
    assert got == brute_force(CASES[case])


@pytest.mark.parametrize("case", ["clusters of unequal norms", "nulls, lengths, ties, repeated ids and rows"])
def test_equals_oracle(spark, make_tables, oracle, case):
    folder = make_tables(embeddings=CASES[case])
    assert rows(QUERIES[QUERY](spark, folder)) == oracle(ORACLES[QUERY], folder)


def test_whole_table_equals_oracle(spark, sf_dir, oracle):
    assert rows(QUERIES[QUERY](spark, sf_dir)) == oracle(ORACLES[QUERY], sf_dir, ["embeddings"])


def test_empty_table_and_no_usable_vector(spark, make_tables):
    assert QUERIES[QUERY](spark, make_tables()).collect() == []
    assert QUERIES[QUERY](spark, make_tables(embeddings=[(0, None), (50, [None])])).collect() == []


def test_annuli_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "PART_ROWS", 25)
    asked = []
    search = exact_search._search
    monkeypatch.setattr(exact_search, "_search", lambda asks, index, k: asked.append((asks.count(), index.select("part").distinct().count())) or search(asks, index, k))
    # Unit vectors, as embeddings are: then a high score means a small distance.
    table = [(k, [x / math.sqrt(sum(y * y for y in v)) for x in v]) for k, v in clustered(2000, 8, 5)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    found = exact_search.top_k(df, df.where(F.col("vec_id") % 50 == 0))
    assert sorted(map(tuple, found.select("query_id", "rank", "score", "vec_id").collect()), key=repr) == brute_force(table)
    visits, parts = sum(a for a, _ in asked), asked[0][1]
    assert visits < 0.5 * 40 * parts
