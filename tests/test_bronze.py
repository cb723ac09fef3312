import datetime as dt
import random

from pyspark.sql import types as T

from vaultspark.operators import bronze as B

CAT = "table_name string, ordinal int, column_name string"


def test_lake_columns_first_then_extras(spark):
    lake = spark.createDataFrame([("t", 1, "B"), ("t", 2, "a"), ("t", 3, "__record_source"), ("n", 1, "x")], CAT)
    have = spark.createDataFrame([("t", 1, "old"), ("t", 2, "b"), ("t", 3, "__ingested_at"), ("t", 4, " ")], CAT)
    got = sorted(tuple(r) for r in B.bronze_columns(lake, have).collect())
    assert got == [("n", 1, "x"), ("t", 1, "b"), ("t", 2, "a"), ("t", 3, "old")]
    assert sorted(tuple(r) for r in B.match_lake(lake, have).collect()) == [("n", 1, "x", "create"), ("t", 2, "a", "add")]


def test_payload_keys_come_after_bronze(spark):
    have = spark.createDataFrame([("t", 1, "b"), ("t", 2, "a")], CAT)
    keys = spark.createDataFrame([("t", 0, "new"), ("t", 1, "a")], "table string, position int, column_name string")
    assert [r.column_name for r in B.payload_columns(have, keys).orderBy("ordinal").collect()] == ["b", "a", "new"]


def test_align(spark):
    df = spark.createDataFrame([("1", "x", 2)], "ID string, n string, gone int")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("id", T.IntegerType()), T.StructField("e", T.DateType())])
    out = B.bronze_align(df, schema)
    assert out.dtypes == [("n", "bigint"), ("id", "int"), ("e", "date")]
    assert tuple(out.first()) == (None, 1, None)


def test_prune_keeps_untimed_rows(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (3, None)], "id int, __ingested_at timestamp")
    assert sorted(r.id for r in B.prune_bronze(df, dt.datetime(2024, 1, 2)).collect()) == [2, 3]
    plain = df.select("id")
    assert B.prune_bronze(plain, dt.datetime(2024, 1, 2)) is plain


def settle(polls, checks, min_rows):
    last, stable = None, 0
    for poll, rows in polls:
        if rows < min_rows:
            continue
        stable = stable + 1 if rows == last else 0
        last = rows
        if stable >= checks - 1:
            return True, poll, rows
    return False, None, last or 0


def test_stable_counts_as_polled(spark):
    rng = random.Random(3)
    samples = {f"t{i}": [(p, rng.choice([0, 1, 2, 2])) for p in range(12)] for i in range(40)}
    frame = spark.createDataFrame([(t, p, n) for t, ps in samples.items() for p, n in ps], "table string, poll int, rows int")
    for checks in (1, 2, 3):
        got = {r.table: (r.ready, r.ready_at, r.rows) for r in B.stable_counts(frame, checks).collect()}
        assert got == {t: settle(ps, checks, 1) for t, ps in samples.items()}


def test_adopt_and_without_schema(spark):
    df = spark.createDataFrame([(1,)], "Id int")
    row = B.adopt_parquet(df, ["ID", "Name"], dt.datetime(2024, 1, 1), "src").first()
    assert row.asDict() == {"id": 1, "name": None, "__ingested_at": dt.datetime(2024, 1, 1), "__record_source": "src"}
    want = spark.createDataFrame([("A ",), ("b",), ("",), (None,)], "table_name string")
    catalog = spark.createDataFrame([("a", 1, "x")], CAT)
    assert [r[0] for r in B.tables_without_schema(want, catalog).collect()] == ["b"]
