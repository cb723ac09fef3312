import re
import zlib

import pytest

import corpus_pipeline as cp
from test_ngram_join import components
from test_pii import base_spans
from vaultspark.llm import toxicity


def read(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def words():
    return lambda seed, n: " ".join(f"w{zlib.crc32(f'{seed} {k}'.encode()) % 100_000}" for k in range(n))


@pytest.fixture
def folder(make_tables, words):
    docs = [(k, words(k, 40) + (" nitwit" if k % 5 == 0 else "")) for k in range(60)]
    docs += [(100, words(2, 40)), (101, words(2, 39) + " other"), (102, words(3, 20) + " " + words("item", 30) + " end"), (103, None), (104, ""),
             (105, "write to a.b@c.de or 10.0.0.1 please, card 4111 1111 1111 1111"), (None, words("null", 12)), (2, words(2, 40)), (2, words("same id", 9))]
    docs = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in docs]
    labels = [(k, 1, int(k % 5 == 0)) for k in range(60)]
    return make_tables(documents=docs, labels=labels, benchmark=[(1, words("item", 30))], extra="score double, ids string, keep array<int>")


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "sentencepieces"]
    stage = dict(cp.STAGES)
    texts = lambda frame: sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)

    clean = stage["toxicity"](spark, docs, folder)
    assert clean.columns == docs.columns
    assert texts(clean) == [x for x in texts(docs) if not (x[1] or "").endswith("nitwit")]

    single = stage["near_duplicates"](spark, docs, folder)
    assert single.columns == docs.columns
    rows = sorted(set(texts(docs)), key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))
    label, _ = components({k: t for k, (_, t) in enumerate(rows)})
    assert texts(single) == sorted((rows[k] for k in label if label[k] == k), key=repr)

    apart = stage["decontamination"](spark, docs, folder)
    assert apart.columns == docs.columns and texts(apart) == [x for x in texts(docs) if x[0] != 102]

    masked = stage["personal_data"](spark, docs, folder)
    assert masked.columns == docs.columns and masked.schema["keep"] == docs.schema["keep"]
    for r in masked.collect():
        assert (r.text is None) == (r.doc_id == 103) and r.n_chars == (None if r.text is None else len(r.text))
        assert base_spans(r.text or "") == ""
    assert "write to [EMAIL] or [IP] please, card [CARD]" in [r.text for r in masked.collect()]

    last = stage["sentencepieces"](spark, docs, folder)
    assert last.count() == docs.count() and all(r.round_trip for r in last.collect())


def test_run_is_the_stages_in_turn(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, fn in cp.STAGES:
        docs = fn(spark, docs, folder)
    assert read(cp.run(spark, folder)) == read(docs)


def test_clean_documents_stay_on_the_test_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
    kept = {r.doc_id for r in cp.drop_toxic(spark, docs, sf_dir).collect()}
    assert {r.doc_id for r in docs.collect()} - kept <= toxic | {
        r.doc_id for r in docs.collect() if re.search(r"idiot|clown|loser|worthless|scum|moron|pathetic|trash|disgusting|stupid|lowei|vequ|veju|lostra|chlla", r.text)}
    assert toxicity.THRESHOLD == 0.7


def test_empty_tables(spark, make_tables):
    folder = make_tables()
    assert cp.run(spark, folder).collect() == []
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert all(fn(spark, docs, folder).columns == docs.columns for _, fn in cp.STAGES[:-1])
