import hashlib
import random
import re

from pyspark.sql import functions as F

from vaultspark.llm import pii
from vaultspark.llm.registry import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def check(spark, make_tables, texts):
    folder = make_tables(documents=list(enumerate(texts)), extra="spans int, f_email string, t_card string, row string")
    got = QUERIES["op7_pii"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (texts[r.doc_id][:200], want, r.spans)
        for kind in PATTERNS:
            assert r[f"n_{kind}"] == len(re.findall(f"{kind}:", want))
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    return {r.doc_id: r for r in got}


def test_random_signs_against_plain_patterns(spark, make_tables):
    rng = random.Random(1)
    parts = ["a", "b.c", "@", ".", "..", "-", "_", "x@y.z", "é", "😀", " ", "  ", "\n", "1", "22", "255", "256", "4111 1111 1111 1111", "4111-1111-1111-1111",
             "1.2.3.4", "+", "+1 (555) 010-9999", "\u0002", "\u0003", "0", "12", "(", ")", "00001"]
    check(spark, make_tables, ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(1500)])


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op7_pii"](spark, sf_dir).collect():
        assert r.base_sha256 == hashlib.sha256(base_spans(texts[r.doc_id]).encode()).hexdigest()


def test_very_long_runs_and_many_spans(spark, make_tables):
    check(spark, make_tables, [
        "a@b" + ".c" * 50_000, "x" * 200_000, "1 " * 60_000, "1." * 60_000, "+" * 50_000, "me@x.org " * 1500, None, "", "a.b@" * 20_000])


def test_added_kinds_need_checksum_or_context(spark, make_tables):
    got = check(spark, make_tables, [
        "account GB82 WEST 1234 5698 7654 32 here", "account GB82 WEST 1234 5698 7654 33 here", "my ssn: 123-45-6789.", "part 123-45-6789.",
        "call 030 1234567 now", "see 030 1234567 now"])
    assert [re.sub(":.*", "", got[k].spans) for k in (0, 2, 4)] == ["iban", "ssn", "tel"]
    assert not any("iban" in got[1].spans or "ssn" in got[3].spans or "tel" in got[5].spans for _ in [0])


def test_redaction_joins_overlaps(spark):
    text = "mail a.b@c.de, host 10.0.0.1, card 4111 1111 1111 1111 and +4111111111111111 end"
    found = pii.find_pii(spark.createDataFrame([(1, text), (2, None), (3, "nothing")], "doc_id int, text string"))
    got = dict(found.select("doc_id", pii.redacted(F.col("text"), F.col("spans"))).collect())
    assert got[1].startswith("mail [EMAIL], host [IP], card [CARD] and ") and got[1].endswith(" end") and "4111" not in got[1]
    assert (got[2], got[3]) == ("", "nothing")


def test_no_python_on_the_way_and_empty_table(spark, make_tables):
    frame = QUERIES["op7_pii"](spark, make_tables())
    assert frame.collect() == []
    assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().executedPlan().toString())
