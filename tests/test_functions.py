import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultspark.functions import canonical as C
from vaultspark.functions import messages as M
from vaultspark.functions import names as N


def values(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_double_text_is_shortest_and_positional(spark):
    rng = random.Random(7)
    xs = [0.0, 7.0, 0.001, 1e-4, 1.5e-5, 1e7, 12345678.9, 1e15, 2.5e22, 1e-12, -3.25e9, float("inf")]
    xs += [round(rng.uniform(-1e9, 1e9), rng.randint(0, 4)) for _ in range(2000)]
    xs += [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 14) for _ in range(2000)]
    text = C.canonical_text(F.col("x"), T.DoubleType())
    got = values(spark, "x double", [(x,) for x in xs], "x", text)
    # Python's repr is the same definition; infinity has its own spelling.
    wrong = [(x, t) for x, t in got if t != ("Infinity" if x == float("inf") else repr(x))]
    assert wrong == []


def test_nan_counts_as_missing(spark):
    text = C.canonical_text(F.col("x"), T.DoubleType())
    assert values(spark, "x double", [(float("nan"),), (None,)], text) == [(None,), (None,)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamp_text(spark, kind):
    stamps = [dt.datetime(1998, 10, 3), dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(2024, 1, 1, 5, 6, 7, 500000)]
    data_type = T.TimestampType() if kind == "timestamp" else T.TimestampNTZType()
    got = values(spark, f"x {kind}", [(s,) for s in stamps], C.canonical_text(F.col("x"), data_type), C.iso_utc(F.col("x"), data_type))
    assert got == [(str(s), s.isoformat() + "+00:00") for s in stamps]


def test_other_types(spark):
    df = spark.sql("select 5 i, true b, date'2024-01-02' d, cast(1.50 as decimal(5,2)) m, array(1,2) a, named_struct('k', 1) s, X'6869' y")
    row = C.to_text_frame(df).first()
    assert tuple(row) == ("5", "true", "2024-01-02", "1.50", "[1,2]", '{"k":1}', "aGk=")


def test_hashdiff(spark):
    df = spark.createDataFrame([("x", None, 1.5), ("x", "", 1.5), ("x", "y", 1.5)], "a string, b string, c double")
    hashes = [r[0] for r in df.select(C.hashdiff(df, ["a", "b", "c"])).collect()]
    assert hashes[0] == hashes[1] == hashlib.sha256(b"x||||1.5").hexdigest()
    assert hashes[2] == hashlib.sha256(b"x||y||1.5").hexdigest()
    assert df.select(C.hashdiff(df, [])).first()[0] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize(
    "name, single, stem, candidate",
    [
        ("categories", "category", "categories", False),
        ("address", "address", "address", False),
        ("orders", "order", "orders", False),
        ("order_id", "order_id", "order", True),
        ("CustomerKey", "customerkey", "customer", True),
        ("zip_code", "zip_code", "zip", True),
        ("id", "id", "", True),
        ("width", "width", "width", True),
        ("serial_number", "serial_number", "serial", True),
        ("invoicenr", "invoicenr", "invoice", True),
    ],
)
def test_names(spark, name, single, stem, candidate):
    c = F.col("n")
    got = values(spark, "n string", [(name,)], N.singularize(c), N.strip_key_suffix(c), N.is_key_candidate(c))
    assert got == [(single, stem, candidate)]


def test_physical_names(spark):
    rows = [("Public.Order-Lines",), ('"Quoted"',), ("a.b.c",), ("  ",), (None,), ("x" * 70,)]
    got = values(spark, "n string", rows, N.physical_name(F.col("n")), N.physical_name(F.col("n"), "rdbms"))
    assert got == [
        ("order_lines", "Order_Lines"), ("quoted", "Quoted"), ("b_c", "b_c"), ("", ""), ("", ""), ("x" * 70, "x" * 63),
    ]


def test_bronze_types_and_versions(spark):
    rows = [("bigint",), ("TIMESTAMP",), ("decimal(5,2)",), ("array<int>",)]
    assert [r[0] for r in values(spark, "t string", rows, N.bronze_type(F.col("t")))] == ["BIGINT", "TIMESTAMP", "STRING", "STRING"]
    rows = [("sat_x",), ("sat_x_v12",), ("sat_v2_x",)]
    assert [r[0] for r in values(spark, "t string", rows, N.model_version(F.col("t")))] == [0, 12, 0]


def test_messages(spark):
    rows = [("t", "p", "i"), ("", None, "")]
    got = values(spark, "t string, p string, i string", rows, M.evidence_id(F.col("t"), F.col("p"), F.col("i")))
    assert got == [("vault:t:p:i",), ("vault:unknown:no_plan:no_idem",)]
    rows = [("[DBT] boom",), ("Timed out",), ("permission denied",), (None,), ('relation "x" DOES NOT EXIST',)]
    got = values(spark, "m string", rows, M.is_transient(F.col("m")), M.is_transient_discovery(F.col("m")))
    assert got == [(True, False), (True, False), (False, False), (False, False), (True, True)]
    assert all(re.fullmatch(r"[a-z0-9_ \[\]]+", m) for m in M.TRANSIENT_MARKERS)
