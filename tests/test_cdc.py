import datetime as dt
import json


from vaultspark.operators import cdc
from vaultspark.plans.capture import capture, initial_load

D = dt.datetime
MARKS = "table_name string, watermark timestamp"


def rows(spark):
    return spark.createDataFrame(
        [(1, D(2024, 1, 1), "a"), (2, D(2024, 1, 2), None), (3, D(2024, 1, 3), "c"), (4, None, "d")],
        "id int, at timestamp, note string",
    )


def ids(envelopes):
    return sorted(int(json.loads(r.payload)["id"]) for r in envelopes.collect())


def test_full_takes_rows_with_a_time(spark):
    out = cdc.cdc_full(rows(spark), "t", "at")
    assert out.columns == ["table", "payload", "cdc_type", "cdc_ingestion_timestamp"]
    assert ids(out) == [1, 2, 3]
    second = [json.loads(r.payload) for r in out.collect() if '"id":"2"' in r.payload]
    assert second == [{"id": "2", "at": "2024-01-02T00:00:00+00:00"}]


def test_mark_is_exclusive(spark):
    assert ids(cdc.cdc_incremental(rows(spark), "t", "at", D(2024, 1, 2))) == [3]
    assert ids(cdc.cdc_incremental(rows(spark), "t", "at", None)) == [1, 2, 3]


def test_text_times_that_do_not_parse(spark):
    df = spark.createDataFrame([(1, "2024-01-05"), (2, "soon"), (3, None)], "id int, at string")
    assert ids(cdc.cdc_full(df, "t", "at")) == [1, 2]
    assert ids(cdc.cdc_incremental(df, "t", "at", D(2024, 1, 1))) == [1]


def test_marks_advance_and_stay(spark):
    marks = spark.createDataFrame([("old", D(2020, 1, 1)), ("t", D(2024, 1, 1))], MARKS)
    changes = cdc.change_marks(rows(spark), "t", "at").unionByName(
        cdc.change_marks(rows(spark).limit(0), "empty", "at")
    )
    got = {r.table_name: r.watermark for r in cdc.advance_watermarks(changes, marks).collect()}
    assert got == {"old": D(2020, 1, 1), "t": D(2024, 1, 3)}


def test_marks_load_and_save(spark):
    raw = spark.createDataFrame([("a", "2024-01-01T00:00:00+00:00"), ("b", "nonsense"), ("c", None)], "table_name string, watermark string")
    loaded = cdc.load_watermarks(raw)
    assert [tuple(r) for r in loaded.collect()] == [("a", D(2024, 1, 1))]
    again = loaded.unionByName(spark.createDataFrame([("n", None)], MARKS))
    assert [tuple(r) for r in cdc.save_watermarks(again).collect()] == [("a", "2024-01-01T00:00:00+00:00")]


def test_capture_skips_claimed_and_unmarked(spark):
    tables = {"marked": rows(spark), "claimed": rows(spark), "fresh": rows(spark), "timeless": rows(spark)}
    ts = {"marked": "at", "claimed": "at", "fresh": "at", "timeless": "not_there"}
    marks = spark.createDataFrame([("marked", D(2024, 1, 2))], MARKS)
    out, after = capture(tables, ts, marks, {"claimed", "marked"})
    assert {r.table: r.n_rows for r in cdc.cdc_counts(out).collect()} == {"marked": 1, "fresh": 3}
    assert {r.table_name: r.watermark for r in after.collect()} == {"marked": D(2024, 1, 3), "fresh": D(2024, 1, 3)}
    once, marks_after = initial_load(tables, ts, marks)
    assert {r.table for r in once.select("table").distinct().collect()} == {"claimed", "fresh"}
    again, _ = initial_load({k: tables[k] for k in ("claimed", "fresh")}, ts, marks_after)
    assert again is None


def test_initial_load_tables(spark):
    tables = spark.createDataFrame([("a",), ("b",)], "table_name string")
    marks = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", None)], MARKS)
    assert [r[0] for r in cdc.initial_load_tables(tables, marks).collect()] == ["b"]


def test_mark_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = cdc.new_rows(events, "ts", D(2024, 1, 15))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-01-15T00:00)" in plan


def test_eligible_tables(spark):
    catalog = spark.createDataFrame([("a", "x"), ("a", "AT"), ("b", "x")], "table_name string, column_name string")
    assert [r[0] for r in cdc.tables_with_cdc_column(catalog, ["at"]).collect()] == ["a"]
