import hashlib
import zlib

import pytest
from llm_rows import rows
from pyspark.sql import functions as F

from vaultspark.llm import merkle
from vaultspark.llm.registry import ORACLES, QUERIES

HEAD = ("doc_id", "text", "lang", "source", "n_chars")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc, text):
    values = (doc[0], doc[3], doc[2], doc[4], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests, arity):
    """Root and, per leaf, the siblings to the left and right at each level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    level = digests
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i // arity * arity
            paths[k].append((level[run:i], level[i + 1:run + arity]))
        at = [i // arity for i in at]
        level = [h(*level[i:i + arity]) for i in range(0, len(level), arity)]
    return level[0], paths


def brute_force(docs, arity=8):
    trees = {}
    for d in docs:
        trees.setdefault(d[2], []).append((d, leaf_of(d, d[1])))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    low = {}
    for name in names:
        trees[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        low[name] = climb([leaf for _, leaf in trees[name]], arity)
    root, tops = climb([low[name][0] for name in names], arity)
    out = []
    for name, top in zip(names, tops):
        subroot, paths = low[name]
        for (d, leaf), path in zip(trees[name], paths):
            cur, proof = leaf, ""
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and d[1] is not None:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in d[1])
                cur = leaf_of(d, lowered)
            for left, right in path + top:
                cur = h(*left, cur, *right)
                proof += "".join(left) + "".join(right)
            out.append((d[0], cur, leaf, h(proof), root, subroot, cur == root))
    return sorted(out, key=repr)


def docs_of(n, lang="en"):
    return [(k, f"Text {k}" if k % 7 else None, lang, f"s{k % 3}" if k % 5 else None, k * 3 if k % 4 else None) for k in range(n)]


CASES = {
    "many levels and languages": docs_of(600) + [(10_000 + k, "É" * k, f"l{k % 70:02d}", "web", k) for k in range(150)]
    + [(-k, "Ab\x00c", None, None, None) for k in range(1, 10)],
    "one row": [(3, "Lone", "en", "a", 4)],
    "nulls, empty texts, repeated ids and rows": [
        (None, None, None, None, None), (None, "A", "", "", 0), (1, "", "de", "", 0), (5, "B", "de", "x", 1), (5, "A", "de", "x", 1),
        (5, "A", "de", "x", 1), (7, "Z" * 200_000, "de", None, None)] + [(9, "Same", "fr", "x", 4)] * 40,
}


@pytest.mark.parametrize("case", CASES)
def test_equals_brute_force_and_oracle(spark, make_tables, oracle, case):
    folder = make_tables(documents=CASES[case], extra="leaf string, root string, idx long, n long, tree string")
    names, got = rows(QUERIES["op11_merkle"](spark, folder))
    assert names == ["doc_id", "folded_root", "leaf", "proof_sha256", "root", "subroot", "verified"]
    assert got == brute_force(CASES[case])
    assert (names, got) == oracle(ORACLES["op11_merkle"], folder)


def test_whole_table_equals_oracle(spark, sf_dir, oracle):
    assert rows(QUERIES["op11_merkle"](spark, sf_dir)) == oracle(ORACLES["op11_merkle"], sf_dir)


def test_empty_table(spark, make_tables):
    assert QUERIES["op11_merkle"](spark, make_tables()).collect() == []


@pytest.mark.parametrize("arity", [2, 3])
def test_other_arities(spark, arity):
    docs = docs_of(40) + docs_of(9, "de") + docs_of(1, "fr")
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", merkle.UPPER, merkle.LOWER))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    got = merkle.verified_manifest(df, columns, "lang", "doc_id", "text", tampered, arity)
    assert rows(got.withColumnRenamed("id", "doc_id"))[1] == brute_force(docs, arity)


def test_a_change_anywhere_is_seen(spark):
    docs = docs_of(30)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    leaf = merkle.leaf_hash("doc_id", "text")
    roots = set()
    for changed in (None, 0, 29):
        df = frame.withColumn("text", F.when(F.col("doc_id") == changed, "other").otherwise(F.col("text"))) if changed is not None else frame
        hashed = df.select(F.col("lang").alias("g"), F.col("doc_id").alias("i"), leaf.alias("leaf"))
        roots.add(bytes(merkle.manifest(hashed, "g", "i", "leaf").first().root))
    assert len(roots) == 3
