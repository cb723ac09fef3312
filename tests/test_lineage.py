import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vaultspark.operators import lineage as LN
from vaultspark.operators import modelling as MD

T0 = dt.datetime(2024, 1, 1)


def bursts(rows, quiet):
    """The queue: a run starts once nothing came for ``quiet`` seconds."""
    out = []
    for key in sorted({k for k, _, _ in rows}):
        for at, value in sorted((a, v) for k, a, v in rows if k == key):
            if out and out[-1][0] == key and (at - out[-1][2]).total_seconds() < quiet:
                out[-1][2] = at
                out[-1][3] += 1
                out[-1][4].add(value)
            else:
                out.append([key, at, at, 1, {value}])
    return sorted((k, a, b + dt.timedelta(seconds=quiet), n, sorted(v)) for k, a, b, n, v in out)


@pytest.mark.parametrize("quiet, slice_seconds", [(60, 120), (60, 600), (60, 86400), (300, 200)])
def test_bursts_as_queued(spark, quiet, slice_seconds):
    rng = random.Random(quiet + slice_seconds)
    rows = []
    for key in ("a", "b", "c"):
        at = T0
        for _ in range(120):
            at += dt.timedelta(seconds=rng.choice([1, 20, 59, 60, 61, 90, 299, 300, 700]))
            rows.append((key, at, rng.choice("xyz")))
    df = spark.createDataFrame(rows, "k string, at timestamp, v string")
    out = LN.coalesce_bursts(df, "at", "v", quiet, ["k"], slice_seconds)
    assert sorted(tuple(r) for r in out.collect()) == bursts(rows, quiet)


def test_bursts_without_key(spark):
    rows = [("", T0 + dt.timedelta(seconds=s), v) for s, v in [(0, "m1"), (30, "m2"), (120, "m1"), (180, "m3")]]
    df = spark.createDataFrame([(a, v) for _, a, v in rows], "at timestamp, v string")
    out = LN.coalesce_bursts(df, "at", "v", 60)
    assert sorted(("", *r) for r in out.collect()) == bursts(rows, 60)


def test_chunks(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c", "d", "e"]), (2, ["a"])], "burst int, values array<string>")
    got = sorted(tuple(r) for r in LN.chunk_bursts(df, 2).collect())
    assert got == [(1, 0, ["a", "b"]), (1, 1, ["c", "d"]), (1, 2, ["e"]), (2, 0, ["a"])]


def test_reconcile(spark):
    schema = "table string, n_rows bigint"
    expected = spark.createDataFrame([("a", 5), ("b", 5)], schema)
    landed = spark.createDataFrame([("a", 7), ("c", 1)], schema)
    base = spark.createDataFrame([("a", 2), ("d", 1)], schema)
    got = sorted(tuple(r) for r in LN.reconcile(expected, landed, base).collect())
    assert got == [("a", 7, 7, True, 0), ("b", 5, 0, False, 5), ("c", 0, 1, True, 0), ("d", 1, 0, False, 1)]
    assert {r.table: r.reached for r in LN.reconcile(expected, landed).collect()} == {"a": True, "b": False, "c": True}


def test_lineage_and_impact(spark):
    cat = spark.createDataFrame(
        [("orders", 1, "order_id", "int"), ("orders", 2, "n", "int"), ("pages", 1, "page_id", "int")],
        "table_name string, ordinal int, column_name string, data_type string",
    )
    reg = MD.model_lake(cat)
    one, two = LN.lineage(reg), LN.lineage(reg, F.lit(T0).cast("timestamp"))
    assert {r.lineage_id for r in one.collect()} == {r.lineage_id for r in two.collect()}
    assert one.select("lineage_id").distinct().count() == 3
    touched = spark.createDataFrame([("ORDERS",), ("absent",)], "table string")
    assert sorted(r[0] for r in LN.impacted_models(touched, reg).collect()) == ["hub_order", "sat_order"]
    known = spark.createDataFrame([(" Old ",), ("",)], "table_name string")
    names = spark.createDataFrame([("hub_page",)], "model_name string")
    assert sorted(r[0] for r in LN.referenced_sources(reg, known, names).collect()) == ["old", "orders", "pages"]
