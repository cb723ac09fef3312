"""Operator 1, WARC: transaction assembly.

``write_archive`` turns pages into WARC/1.1 records (request, response or revisit,
and metadata, bound together by WARC-Concurrent-To) and writes them as archive
files through Spark's own writer, so that any store works; a record ends with two
line ends, which is the writer's line separator. ``read_records`` reads archives
back by their Content-Length fields, whatever the payloads hold. ``assemble``
joins the records of each capture and gives one nested row per capture.

Of records with equal payloads of at least ``LEAST_BYTES``, that with the smallest
id is the response; the others are revisits, which store no payload and name the
response they repeat. Equal payloads are found by digest: digests are counted
(map-side) before any join, so a payload that a third of all pages share makes no
large group.

Records of a capture name each other in either direction, and a metadata record
may name the request instead of the response: ids are passed on, from the responses
outwards, until no record learns a new capture. What is left after ``MAX_HOPS`` rounds
is grouped by connected components, whatever its depth.

Defined cases: a null payload counts as empty; a null url writes no target; a
null id sorts last and is written as such; rows equal in id, url and payload are
captures of their own, numbered, and of one kind; requests and metadata that no response
reaches become one capture for each connected group, without a response (records that
name the same missing record belong together); an empty table gives no captures.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import kept, query, read_columns
from .graphs import connected_components

LEAST_BYTES = 100
MAX_HOPS = 8
FILE_ROWS = 4_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n"


def _uuid(kind: str, seed: Column) -> Column:
    """A record id that follows from the capture alone, so retried tasks write the same."""
    h = F.md5(F.concat(F.lit(kind), seed))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in
                    ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(head: list[Column], block: Column) -> Column:
    """A record without its two closing line ends. Lines that are null are left out."""
    lines = [F.lit("WARC/1.1"), *head, F.concat(F.lit("Content-Length: "), F.octet_length(block))]
    return F.concat(F.concat_ws(_END, *lines), F.lit(_END * 2), block)


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value)


def _plain(value: Column) -> Column:
    """A header value must stay on its line."""
    return F.regexp_replace(value, "[\\r\\n]+", " ")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``name``: the seed, and a number behind it for all but one of equal seeds."""
    repeated = kept(rows.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), "warc-repeated")
    if repeated.isEmpty():
        return rows.withColumn("name", F.col("seed"))
    # Numbers are stored before they are used, so a task that is run again finds the same.
    copies = kept(rows.join(repeated, "seed", "left_semi").withColumn("number", F.monotonically_increasing_id()), "warc-copies")
    least = copies.groupBy("seed").agg(F.min("number").alias("least"))
    named = copies.join(least, "seed").withColumn(
        "name", F.when(F.col("number") == F.col("least"), F.col("seed")).otherwise(F.concat_ws("|", "seed", "number")))
    return rows.join(repeated, "seed", "left_anti").withColumn("name", F.col("seed")).unionByName(
        named.drop("number", "least"))


def choose_kinds(pages: DataFrame) -> DataFrame:
    """``seed, id, digest, n_bytes`` to ``seed, first_seed`` of the revisits; equal rows share a seed.

    All records of the smallest id are responses, also where that id is repeated; records
    without an id revisit it, and are all responses where no record has one.
    """
    large = pages.where(F.col("n_bytes") >= LEAST_BYTES).select("seed", "id", "digest")
    first = F.min(F.struct(F.col("id").isNull(), "id", "seed"))
    firsts = (
        large.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1 and first.id is not null")
        .select("digest", F.col("first.seed").alias("first_seed"), F.col("first.id").alias("first_id"))
    )
    return large.join(firsts, "digest").where(~F.col("id").eqNullSafe(F.col("first_id"))).select("seed", "first_seed").distinct()


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the records of all pages as gzipped archive files below ``path``."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes"))
    rows = rows.withColumn("seed", F.concat_ws(
        "|", F.coalesce(F.col("id").cast("string"), F.lit("-")), F.md5(F.coalesce("url", F.lit("\u0000"))), "digest"))
    again = choose_kinds(rows.select("seed", "id", "digest", "n_bytes"))
    out = _numbered(rows).join(again, "seed", "left").withColumn("revisit", F.col("first_seed").isNotNull())
    url = _plain(F.col("url"))
    target, date = _line("WARC-Target-URI", url), _line("WARC-Date", DATE)
    main = _uuid("response", F.col("name"))
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n_bytes"), F.lit(_END * 2))
    response = _record(
        [_line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")), _line("WARC-Record-ID", main), date, target,
         digest, F.when(F.col("revisit"), F.lit(f"WARC-Profile: {PROFILE}")),
         _line("WARC-Refers-To", _uuid("response", F.col("first_seed"))),
         _line("X-Page-Id", F.col("id").cast("string")), F.lit("Content-Type: application/http; msgtype=response")],
        F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload"))))
    get = F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(" HTTP/1.1\r\nUser-Agent: archiver\r\n\r\n"))
    request = _record(
        [F.lit("WARC-Type: request"), _line("WARC-Record-ID", _uuid("request", F.col("name"))), date, target,
         _line("WARC-Concurrent-To", main), F.lit("Content-Type: application/http; msgtype=request")], get)
    metadata = _record(
        [F.lit("WARC-Type: metadata"), _line("WARC-Record-ID", _uuid("metadata", F.col("name"))), date, target,
         _line("WARC-Concurrent-To", _uuid("request", F.col("name"))), F.lit("Content-Type: application/warc-fields")],
        F.concat(F.lit("payload-bytes: "), F.col("n_bytes"), F.lit(_END)))
    # One line of output per capture: its three records, each closed by two line ends.
    records = out.select(F.concat_ws(_END * 2, request, response, metadata).alias("value"))
    (
        records.write.option("lineSep", _END * 2).option("maxRecordsPerFile", FILE_ROWS)
        .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        .text(path)
    )


RECORD = ("record_id string, type string, concurrent_to array<string>, target string, date string, page_id string, "
          "refers_to string, payload_digest string, block_bytes long, payload_bytes long, payload_sha256 string")
_FIELDS = [x.split(" ")[0] for x in RECORD.split(", ")]


def _parse(data: bytes) -> Iterator[tuple]:
    """The records of one archive file, by their Content-Length."""
    at = 0
    view = memoryview(data)
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            if data[at:].strip():
                raise ValueError(f"no end of header at byte {at}")
            return
        lines = data[at:end].decode("utf-8").split(_END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}: {lines[0][:40]!r}")
        head: dict[str, list[str]] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            head.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(head["content-length"][0])
        start = end + 4
        if start + size > len(data):
            raise ValueError(f"a record is cut off at byte {at}")
        at = start + size + 4
        one = {k: v[0] for k, v in head.items()}
        n = sha = None
        if one["warc-type"] == "response":
            body = data.find(b"\r\n\r\n", start, start + size)
            body = start + size if body < 0 else body + 4
            n, sha = start + size - body, hashlib.sha256(view[body:start + size]).hexdigest()
        digest = one.get("warc-payload-digest")
        yield (one["warc-record-id"], one["warc-type"], head.get("warc-concurrent-to", []), one.get("warc-target-uri"),
               one.get("warc-date"), one.get("x-page-id"), one.get("warc-refers-to"),
               digest and digest.partition(":")[2], size, n, sha)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below a path: header fields, and the payload's size and digest."""
    import gzip

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                data = content.as_py()
                if name.as_py().endswith(".gz"):
                    data = gzip.decompress(data)
                found = list(_parse(data))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*found), types)], names=_FIELDS)

    types = [pa.list_(pa.string()) if "array" in x else pa.int64() if x.endswith("long") else pa.string()
             for x in RECORD.split(", ")]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(parsed, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture, response, requests, metadata``.

    ``capture`` is the id of its response (or revisit), else the smallest id.
    """
    ids = records.select("record_id", F.col("type").isin("response", "revisit").alias("main"), "concurrent_to")
    edges = ids.select("record_id", F.explode("concurrent_to").alias("other"))
    both = edges.union(edges.select("other", "record_id")).distinct()
    # (record, capture) pairs known so far; responses know theirs.
    known = ids.where("main").select("record_id", F.col("record_id").alias("capture")).distinct()
    rest = ids.where("not main").select("record_id").distinct()
    for _ in range(MAX_HOPS):
        step = (
            both.join(known, "record_id").select(F.col("other").alias("record_id"), "capture")
            .join(rest, "record_id", "left_semi").groupBy("record_id").agg(F.min("capture").alias("capture"))
        )
        fresh = kept(step, "warc-hop")
        if fresh.isEmpty():
            break
        known = known.unionByName(fresh)
        rest = rest.join(fresh, "record_id", "left_anti")
    # What is left is chained deeper, or no response reaches it: whole components of the rest,
    # which go with the smallest capture they touch, else with their smallest id.
    rest = kept(rest, "warc-rest")
    alone = rest.select("record_id", F.col("record_id").alias("capture"))
    if not rest.isEmpty():
        reached = known.select("record_id")
        loose = both.join(reached, "record_id", "left_anti").join(
            reached.withColumnRenamed("record_id", "other"), "other", "left_anti")
        parts = connected_components(loose.select(F.col("record_id").alias("a"), F.col("other").alias("b")))
        groups = kept(rest.join(parts.withColumnRenamed("node", "record_id"), "record_id", "left").select(
            "record_id", F.coalesce("component", "record_id").alias("part")), "warc-parts")
        touched = both.join(known, "record_id").select(F.col("other").alias("record_id"), "capture").join(
            groups, "record_id").groupBy("part").agg(F.min("capture").alias("touched"))
        alone = groups.join(touched, "part", "left").select("record_id", F.coalesce("touched", "part").alias("capture"))
    captures = known.unionByName(alone)
    nested = records.join(captures, "record_id").select(
        "capture", "type", F.struct(*(c for c in _FIELDS if c != "concurrent_to")).alias("record"))
    of = lambda *kinds: F.array_sort(F.collect_set(F.when(F.col("type").isin(*kinds), F.col("record"))))
    return nested.groupBy("capture").agg(
        F.get(of("response", "revisit"), F.lit(0)).alias("response"), of("request").alias("requests"),
        of("metadata").alias("metadata"))


OP1_SQL = """
with p as (
  select page_id, coalesce(html, '') as payload, octet_length(encode(coalesce(html, ''))) as payload_bytes,
         sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id is distinct from first and first is not null then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id is distinct from first then first end as refers_to,
       1 as n_requests, 1 as n_metadata
from p left join f using (payload_digest)
"""


@query("op1_warc", OP1_SQL)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_columns(spark, sf_dir, "pages", page_id="long", url="string", html="string")
    path = scratch_path(spark, "warc")
    write_archive(pages, path)
    captures = assemble(kept(read_records(spark, path), "warc-records")).where("response is not null").select(
        F.col("response.page_id").cast("long").alias("page_id"), "response", "requests", "metadata")
    # A revisit's payload is that of the response it refers to.
    named = captures.select(F.col("response.refers_to").alias("o_record")).where("o_record is not null").distinct()
    originals = captures.select(
        F.col("response.record_id").alias("o_record"), F.col("page_id").alias("o_id"),
        F.col("response.payload_bytes").alias("o_bytes"), F.col("response.payload_sha256").alias("o_sha256"),
    ).join(named, "o_record", "left_semi")
    r = F.col("response")
    return captures.join(originals, r["refers_to"] == F.col("o_record"), "left").select(
        "page_id",
        F.coalesce(r["payload_bytes"], "o_bytes").alias("payload_bytes"),
        F.coalesce(r["payload_sha256"], "o_sha256").alias("payload_digest"),
        r["type"].alias("record_type"), F.col("o_id").alias("refers_to"),
        F.size("requests").alias("n_requests"), F.size("metadata").alias("n_metadata"),
    )
