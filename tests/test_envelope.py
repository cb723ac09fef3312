import datetime as dt
import json

from vaultspark.operators import cdc
from vaultspark.operators import envelope as EV
from vaultspark.sources.envelopes import as_messages
from vaultspark.sources.lake import bronze_schema

ENVELOPE = "table string, payload string, cdc_type string, cdc_modified_at string"


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_broken_messages_are_dropped(spark):
    good = json.dumps({"table": "T", "payload": "{}", "cdc_type": "insert", "cdc_modified_at": "x"})
    out = EV.parse_envelopes(messages(spark, good, good[:20], "[1]", "text", "", None, '{"payload": "{}"}', '{"table": null}'))
    assert [tuple(r) for r in out.collect()] == [("T", "{}", "insert", "x")]


def test_change_time_under_any_spelling(spark):
    texts = [json.dumps({"table": "t", name: name}) for name in EV.CHANGE_TIME_FIELDS]
    out = EV.parse_envelopes(messages(spark, *texts))
    assert sorted(r.cdc_modified_at for r in out.collect()) == sorted(EV.CHANGE_TIME_FIELDS)


def test_round_trip(spark):
    rows = [("t", '{"a":"1"}', "insert", "2024"), ("t", None, "insert", None)]
    df = spark.createDataFrame(rows, ENVELOPE)
    assert sorted(map(str, EV.parse_envelopes(as_messages(df)).collect())) == sorted(map(str, df.collect()))


def test_keys_of_all_payloads(spark):
    rows = [
        ("T", '{"b":1}', None, None), ("t", '{"A":1,"b":2,"late":3}', None, None),
        ("t", "broken", None, None), ("t", None, None, None), ("u", '{"x":1}', None, None), ("u", "{}", None, None),
    ]
    df = spark.createDataFrame(rows, ENVELOPE)
    got = sorted(tuple(r) for r in EV.payload_keys(df).collect())
    assert got == [("t", 0, "a"), ("t", 1, "b"), ("t", 2, "late"), ("u", 0, "x")]
    known = spark.createDataFrame([("t",)], "table string")
    assert [tuple(r) for r in EV.payload_keys_from_history(df, known).collect()] == [("u", 0, "x")]


def test_known_names_come_to_the_history(spark):
    rows = [("Big", '{"a":1}', None, None)] * 50 + [("known", '{"b":1}', None, None), (None, '{"c":1}', None, None)]
    history = spark.createDataFrame(rows, ENVELOPE)
    known = spark.createDataFrame([("known",), ("known",), (None,)], "table string")
    out = EV.payload_keys_from_history(history, known)
    assert sorted(map(tuple, out.collect()), key=str) == [("big", 0, "a"), (None, 0, "c")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # else a table's messages meet in one task


def test_widen_any_spelling(spark):
    payload = '{"a":"1","B":2,"c":"low","C":"up","D":null,"n":{"k":[1]}}'
    df = spark.createDataFrame([("t", payload, "insert", "m")], ENVELOPE)
    out = EV.parse_payload(df, ["A", "b", "c", "d", "n", "none"])
    assert out.columns == ["a", "b", "c", "d", "n", "none", "cdc_type", "cdc_modified_at"]
    assert tuple(out.first()) == ("1", "2", "low", None, '{"k":[1]}', None, "insert", "m")


def test_keys_land_in_lower_case(spark):
    payloads = [
        '{"A":"1","b":"2"}', '{"x":"low","X":"up"}', '{"Q":"1","q":null,"z":"3"}', '{"y":"1","Y":"2","w":null}', '{"V":"1","v":"2"}',
        '{"R":"first","rR":"no","r":null}', '{"Mm":"1","MM":"2"}', "{}", "broken"]
    df = spark.createDataFrame([("T", p, "i", str(n)) for n, p in enumerate(payloads)], ENVELOPE)
    got = {int(r.cdc_modified_at): r.fields for r in EV.land_payload(df).collect()}
    assert got[0] == {"a": "1", "b": "2"}
    assert got[1] == {"x": "low"}
    assert got[2] == {"q": None, "z": "3"}  # without a lower-case value the last spelling counts
    assert got[3] == {"y": "1", "w": None}
    assert got[4] == {"v": "2"}
    assert got[5] == {"r": None, "rr": "no"}
    assert got[6] == {"mm": "2"}
    assert got[7] == {} and got.get(8) is None
    wide = EV.widen(EV.land_payload(df).select("fields"), ["A", "x"])
    assert {(r.a, r.x) for r in wide.collect()} == {("1", None), (None, "low"), (None, None)}
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("map_entries") <= 1  # no look through the map per column


def test_spellings_beyond_ascii_land_in_lower_case(spark):
    payloads = ['{"ς":"1","é":"2"}', '{"a":"1","É":"2"}', '{"ΑΣ":"1"}', '{"ε":"0","Σ":"1","σ":"2"}', '{"İ":"1"}', '{"":"1","K":"2"}']
    df = spark.createDataFrame([("t", p, "i", str(n)) for n, p in enumerate(payloads)], ENVELOPE)
    low = {r[0]: r[1] for r in spark.sql("select k, lower(k) from values ('É'), ('ΑΣ'), ('İ'), ('K') t(k)").collect()}
    got = {int(r.cdc_modified_at): r.fields for r in EV.land_payload(df).collect()}
    assert got[0] == {"ς": "1", "é": "2"} and got[1] == {"a": "1", low["É"]: "2"}
    assert got[2] == {low["ΑΣ"]: "1"} and got[3] == {"ε": "0", "σ": "2"}
    assert got[4] == {low["İ"]: "1"} and got[5] == {"": "1", low["K"]: "2"}


def test_landing_makes_each_payload_once(spark):
    rows = spark.createDataFrame([(1, 2.5, dt.datetime(2024, 1, 2)), (2, None, None)], "k long, x double, ts timestamp_ntz")
    sent = cdc.cdc_full(rows, "t", "ts").withColumnRenamed("cdc_ingestion_timestamp", "cdc_modified_at")
    out = EV.land_payload(EV.add_audit(sent, dt.datetime(2024, 5, 6)))
    assert [r.fields for r in out.collect()] == [{"k": "1", "x": "2.5", "ts": "2024-01-02T00:00:00+00:00"}]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJson") == 1 and "forall" not in plan


def test_route_and_allow(spark):
    df = spark.createDataFrame([("t", '{"a":"1"}', "i", None), ("T", '{"a":"2"}', "i", None), (None, "{}", "i", None)], ENVELOPE)
    assert [tuple(r) for r in EV.route_one(df, "t", bronze_schema(["a"])).collect()] == [("1",)]
    assert EV.allow_tables(df, ["T "]).count() == 2
    assert [r.table for r in EV.normalize_table(df).collect()] == ["t", "t"]


def test_audit_and_landing(spark):
    df = spark.createDataFrame([("T", '{"a":"1"}', "i", None), ("t", None, "i", None), ("", "{}", "i", None)], ENVELOPE)
    now = dt.datetime(2024, 5, 6, 7)
    out = EV.land_payload(EV.add_audit(df, now))
    assert out.columns == ["table", "fields", "cdc_type", "cdc_modified_at", "__ingested_at", "__record_source"]
    assert [tuple(r) for r in out.collect()] == [("t", {"a": "1"}, "i", None, now, "kafka_cdc")]


def test_touched_leaves_out_empty_tables(spark):
    df = spark.createDataFrame([("T", "{}", "i", None), ("t", None, "i", None), ("e", None, "i", None)], ENVELOPE)
    assert [tuple(r) for r in EV.touched_tables(df).collect()] == [("t", 2)]
    assert EV.missing_required(df.drop("payload")) == ["payload"]


def test_one_parse_per_message(spark):
    plan = EV.parse_envelopes(messages(spark, "{}"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
