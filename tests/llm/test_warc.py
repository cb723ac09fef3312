import gzip
import hashlib

from llm_rows import rows

from vaultspark.llm import warc
from vaultspark.llm.registry import ORACLES, QUERIES

BIG = "x" * 120 + "\r\n\r\nWARC/1.1\r\n é"


def test_equals_oracle(spark, sf_dir, oracle):
    assert rows(QUERIES["op1_warc"](spark, sf_dir)) == oracle(ORACLES["op1_warc"], sf_dir)


def test_copies_nulls_and_repeats(spark, make_tables):
    folder = make_tables(
        extra="payload_bytes long, record_type string",
        pages=[(1, "http://a", BIG), (2, None, BIG), (3, "http://c", None), (4, "u\r\nX: y", ""), (5, "u", "short"),
               (6, "u", "short"), (7, "u", BIG + "z"), (None, "u", BIG), (9, "u", BIG), (9, "u", BIG)])
    got = {r.page_id: r for r in QUERIES["op1_warc"](spark, folder).collect()}
    assert len(got) == 9
    assert {k for k, r in got.items() if r.record_type == "revisit"} == {2, None, 9}
    assert {r.refers_to for r in got.values()} == {None, 1}
    for k, text in ((1, BIG), (2, BIG), (3, ""), (7, BIG + "z"), (None, BIG)):
        assert got[k].payload_digest == hashlib.sha256(text.encode()).hexdigest()
        assert got[k].payload_bytes == len(text.encode())
    assert all(r.n_requests == r.n_metadata == 1 for r in got.values())


def test_repeated_rows_equal_oracle(spark, make_tables, oracle):
    folder = make_tables(pages=[(1, "http://a", BIG)] * 3 + [(2, "u", BIG)] * 2 + [(3, "u", "short")] * 2 + [(4, "u", None), (5, "u", BIG)])
    got = rows(QUERIES["op1_warc"](spark, folder))
    assert len(got[1]) == 9 and got == oracle(ORACLES["op1_warc"], folder)


def test_empty_table(spark, make_tables):
    assert QUERIES["op1_warc"](spark, make_tables()).collect() == []


def _record(kind, name, to=(), body=b""):
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", *(f"WARC-Concurrent-To: {t}" for t in to),
            f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def test_links_in_any_direction_chains_and_orphans(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\npayload"
    (tmp_path / "a.warc").write_bytes(
        _record("response", "<r1>", ["<q1>"], http) + _record("request", "<q1>", (), b"GET /") + _record("metadata", "<m1>", ["<q1>"]))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(
        _record("request", "<q2>", ["<m2>"], b"GET /") + _record("metadata", "<m2>", ["<r2>"]) + _record("response", "<r2>", (), http))
        + gzip.compress(_record("metadata", "<m3>", ["<q3>"]) + _record("request", "<q3>")))
    got = {r.capture: r for r in warc.assemble(warc.read_records(spark, str(tmp_path))).collect()}
    assert set(got) == {"<r1>", "<r2>", "<m3>"}
    for k in "12":
        r = got[f"<r{k}>"]
        assert (r.response.record_id, [x.record_id for x in r.requests], [x.record_id for x in r.metadata]) == (f"<r{k}>", [f"<q{k}>"], [f"<m{k}>"])
        assert r.response.payload_sha256 == hashlib.sha256(b"payload").hexdigest()
    assert got["<m3>"].response is None and len(got["<m3>"].requests) == 1


def test_repeated_ids_with_other_urls_equal_oracle(spark, make_tables, oracle):
    folder = make_tables(pages=[(1, "a", BIG), (1, "b", BIG), (2, "u", BIG), (2, "v", BIG), (None, "w", BIG), (None, "x", BIG + "y"), (None, "z", BIG + "y")])
    got = rows(QUERIES["op1_warc"](spark, folder))
    assert len(got[1]) == 7 and got == oracle(ORACLES["op1_warc"], folder)


def test_deep_chains_and_orphans_of_several_hops(spark, tmp_path):
    deep = [_record("response", "<r>", (), b"HTTP/1.1 200 OK\r\n\r\np")]
    deep += [_record("metadata", f"<d{k:02d}>", [f"<d{k - 1:02d}>" if k else "<r>"]) for k in range(15)]
    # m1 < m2 < q: both name the request, which has no response; two more name a record that is missing.
    lost = [_record("request", "<q>"), _record("metadata", "<m1>", ["<q>"]), _record("metadata", "<m2>", ["<q>"]),
            _record("metadata", "<x1>", ["<z>"]), _record("request", "<x2>", ["<z>"])]
    (tmp_path / "a.warc").write_bytes(b"".join(deep + lost))
    got = {r.capture: len(r.requests) + len(r.metadata) for r in warc.assemble(warc.read_records(spark, str(tmp_path))).collect()}
    assert got == {"<r>": 15, "<m1>": 3, "<x1>": 2}
