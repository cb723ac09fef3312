import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultspark.operators import envelope as EV
from vaultspark.operators import evolve as E
from vaultspark.operators import lineage as LN
from vaultspark.operators import modelling as MD
from vaultspark.operators import vault as V
from vaultspark.plans.load import load_outcomes, load_vault, reload_models, vault_row_counts
from vaultspark.sources import bronze_schema as BS
from vaultspark.sources import storage as S
from vaultspark.sources.jdbc import columns_query, table_source, tables_query
from vaultspark.sources.lake import lake_catalog, read_lake_tables

DAY = dt.datetime(2024, 3, 1)


def landed(spark, rows, at):
    df = spark.createDataFrame([(t, p, "insert", None) for t, p in rows], "table string, payload string, cdc_type string, cdc_modified_at string")
    return EV.land_payload(EV.add_audit(df, at))


def test_replayed_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    batch = landed(spark, [("a", '{"x":"1"}'), ("a", '{"x":"2"}'), ("b", '{"y":"1"}')], DAY)
    S.write_bronze(batch, root, 7)
    S.write_bronze(batch, root, 7)
    S.write_bronze(landed(spark, [("a", '{"x":"3"}')], DAY), root, 8)
    assert S.read_bronze(spark, root).count() == 4
    wide = EV.widen(S.read_bronze(spark, root, "A").select("fields"), ["x"])
    assert sorted(r.x for r in wide.collect()) == ["1", "2", "3"]
    assert S.truncate_bronze(spark, root, "A") and not S.truncate_bronze(spark, root, "a")
    assert S.read_bronze(spark, root).count() == 1


def test_envelopes_land_as_their_payloads_do(spark, tmp_path):
    rows = [("A", '{"X":"1"}'), ("a", '{"x":"2","y":"3"}'), ("b", "broken"), ("b", None), ("", '{"x":"4"}'), (None, '{"x":"5"}'), ("c", '{"Z":"6"}')]
    sent = EV.add_audit(spark.createDataFrame(
        [(t, p, "insert", None) for t, p in rows], "table string, payload string, cdc_type string, cdc_modified_at string"), DAY)
    for batch, parts in ((1, 8), (1, 8), (2, 1)):
        S.land_bronze(sent, str(tmp_path / "text"), batch, "s", parts)
        S.write_bronze(EV.land_payload(sent), str(tmp_path / "maps"), batch, "s")
    text, maps = (S.read_bronze(spark, str(tmp_path / name)) for name in ("text", "maps"))
    assert text.schema == maps.schema
    assert sorted(map(str, text.collect())) == sorted(map(str, maps.collect())) and text.count() == 8


def test_prune_drops_days_and_cuts_the_boundary(spark, tmp_path):
    root = str(tmp_path)
    hours = {1: -30, 2: -1, 3: 1, 5: 30}
    for batch, h in hours.items():
        at = dt.datetime(2024, 3, 2, 12) + dt.timedelta(hours=h)
        S.write_bronze(landed(spark, [("a", '{"x":"%d"}' % batch)], at), root, batch)
    mixed = landed(spark, [("a", '{"x":"4"}')], dt.datetime(2024, 3, 2, 11)).unionByName(
        landed(spark, [("a", '{"x":"44"}')], dt.datetime(2024, 3, 2, 13)))
    S.write_bronze(mixed, root, 4)
    cutoff = dt.datetime(2024, 3, 2, 12)
    assert S.prune_bronze_store(spark, root, cutoff) == 3
    rows = S.read_bronze(spark, root)
    assert sorted(r.x for r in EV.widen(rows.select("fields"), ["x"]).collect()) == ["3", "44", "5"]
    assert rows.filter(F.col("__ingested_at") < F.lit(cutoff)).count() == 0
    assert S.prune_bronze_store(spark, root, cutoff) == 0


@pytest.mark.parametrize("others", [False, True])
def test_interrupted_prune_hides_nothing_and_is_finished(spark, tmp_path, others):
    root = str(tmp_path)
    at = [dt.datetime(2024, 3, 2, h) for h in (11, 13)]
    S.write_bronze(landed(spark, [("a", '{"x":"1"}')], at[0]).unionByName(landed(spark, [("a", '{"x":"2"}')], at[1])), root, 4)
    if others:
        S.write_bronze(landed(spark, [("a", '{"x":"3"}'), ("b", '{"x":"4"}')], at[1]), root, 5)
    place = "table=a/ingest_date=2024-03-02/stream=s-direct/batch=4"
    whole = S.read_bronze(spark, root)
    # As if the prune had stopped after deleting the live folder.
    spark.read.parquet(f"{root}/{place}").filter("fields['x'] = '2'").write.parquet(f"{root}/_staged/{place.replace('/', '!')}")
    S._delete(spark, f"{root}/{place}")
    want = ["2", "3", "4"] if others else ["2"]
    batches = {("2024-03-02", "s-direct", "4")} | ({("2024-03-02", "s-direct", "5")} if others else set())

    def check():
        rows = S.read_bronze(spark, root)
        assert sorted(r.fields["x"] for r in rows.collect()) == want and rows.schema.simpleString() == whole.schema.simpleString()
        assert [r.batch for r in S.read_bronze(spark, root, "A").filter("fields['x'] = '2'").collect()] == [4]
        assert S.bronze_batches(spark, root, "a") == batches
        for some in (batches, {b for b in batches if b[2] == "4"}):
            got = S.read_batches(spark, root, "a", some, batches)
            assert sorted(r.fields["x"] for r in got.collect()) == ["2", "3"][:len(some)]

    check()
    S.prune_bronze_store(spark, root, dt.datetime(2024, 3, 2, 12))
    check()
    assert S._switching(spark, root) == {}


def test_zone_of_session_and_driver_changes_nothing(spark):
    from vaultspark.functions.canonical import canonical_text, hashdiff
    from vaultspark.operators import cdc

    frame = spark.sql("select timestamp'2024-11-03T05:30:00.5Z' a, timestamp_ntz'2024-01-01 00:00:00' b, 'k' k")
    seen = set()
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            [r] = frame.select(
                canonical_text(F.col("a"), frame.schema["a"].dataType), canonical_text(F.col("b"), frame.schema["b"].dataType),
                hashdiff(frame, ["a", "b"]), cdc.payload(frame, "a")).collect()
            [stamp] = V.load_hub(frame, ["k"], "t", DAY).select(F.unix_micros("load_datetime")).first()
            marks = cdc.change_marks(frame, "t", "b")
            seen.add((*r, stamp, cdc.watermark_of(marks, "t"), cdc.new_rows(frame, "b", cdc.watermark_of(marks, "t")).count()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    [one] = seen
    assert one[:2] == ("2024-11-03 05:30:00.500000", "2024-01-01 00:00:00") and one[4] == 1709251200 * 10**6 and one[-1] == 0


def test_vault_load_twice_is_a_no_op(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    tables = read_lake_tables(spark, sf_dir)
    sources = {t: tables[t] for t in ("customer", "orders")}
    reg = MD.model_lake(lake_catalog(spark, sf_dir))
    names = load_vault(reg, sources, root, "1", DAY)
    assert names == ["hub_customer", "hub_order", "link_customer_c_nation", "link_order_o_cust", "sat_customer", "sat_order"]
    assert sorted(r.table_name for r in S.list_vault_tables(spark, root).collect()) == names
    gap = V.vault_gap(reg.select("table_name").distinct(), reg, S.list_vault_tables(spark, root))
    assert gap.filter("table_name in ('customer', 'orders')").count() == 0
    first = {n: S.read_vault(spark, f"{root}/{n}").count() for n in names}
    expected = {r.model_name: r.n_rows for r in vault_row_counts(reg, sources).collect()}
    assert first == expected
    load_vault(reg, sources, root, "2", DAY)
    load_vault(reg, sources, root, "1", DAY)
    assert {n: S.read_vault(spark, f"{root}/{n}").count() for n in names} == first
    assert S.read_vault(spark, root + "/absent") is None


def test_new_version_is_filled_and_old_one_kept(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    events = read_lake_tables(spark, sf_dir)["events"]
    cat = lake_catalog(spark, sf_dir).filter("table_name = 'events'")
    reg = MD.model_lake(cat)
    load_vault(reg, {"events": events}, root, "1", DAY)
    ops = spark.createDataFrame(
        [(1, "c", "p", "i", "LAYER_VAULT", E.ADD_COLUMN, "events", {"column_name": "channel"})],
        "seq bigint, correlation_id string, plan_id string, idempotency_key string, layer string, kind string, target string, params map<string,string>",
    )
    out = E.apply_add_column(ops, reg, cat)
    wider = events.withColumn("channel", F.lit("web"))
    assert reload_models(out.queued, out.registry, {"events": wider}, root, "2", DAY) == ["sat_event_v2"]
    v1, v2 = (S.read_vault(spark, f"{root}/{n}") for n in ("sat_event", "sat_event_v2"))
    assert v1.count() == v2.count() == events.count()
    assert "channel" in v2.columns and "channel" not in v1.columns
    S.append_log(E.evolution_log(out.results), f"{root}/log")
    S.append_log(E.evolution_log(out.results), f"{root}/log")
    assert spark.read.parquet(f"{root}/log").count() == 2
    S.append_log(LN.lineage(out.registry), f"{root}/lineage")
    assert spark.read.parquet(f"{root}/lineage").count() == 4


def test_column_added_later_reads_as_null(spark, tmp_path):
    path = str(tmp_path / "sat")
    old = spark.createDataFrame([("1", "x")], "k string, a string")
    new = spark.createDataFrame([("2", "y", "z")], "k string, a string, b string")
    S.append_vault(V.load_satellite(old, ["k"], ["a"], "t", DAY), path, "1")
    S.append_vault(V.load_satellite(new, ["k"], ["a", "b"], "t", DAY), path, "2")
    assert sorted((r.k, r.b) for r in S.read_vault(spark, path).collect()) == [("1", None), ("2", "z")]
    assert [r.k for r in S.read_vault(spark, path, without="2").collect()] == ["1"]


def test_create_and_snapshots(spark, tmp_path):
    df = spark.createDataFrame([("1",)], "k string")
    path = str(tmp_path / "hub")
    assert S.create_if_absent(df, path, "1") and not S.create_if_absent(df.unionAll(df), path, "2")
    assert S.read_vault(spark, path).count() == 1
    snap = str(tmp_path / "snap")
    assert S.read_snapshot(spark, snap) is None
    S.write_snapshot(df, snap, 1)
    S.write_snapshot(df.unionAll(df), snap, 2)
    assert S.read_snapshot(spark, snap).count() == 2
    (tmp_path / "snap" / "version=000000000003").mkdir()
    assert S.read_snapshot(spark, snap).count() == 2


def test_jdbc_sources_quote():
    assert table_source("public", 'a"b') == '"public"."a""b"'
    assert table_source("s", "t", ["x", "y"]) == '(SELECT "x", "y" FROM "s"."t") t'
    assert "lower('O''Brien')" in columns_query("s", "O'Brien")
    assert "'BASE TABLE'" in tables_query("s")
    assert len(table_source("s", "x" * 70)) == len('"s".""') + 63


def test_failing_model_fails_the_load(spark, tmp_path):
    reg = spark.createDataFrame(
        [("hub_t", "t", "hub", ["k"], [], ["k"]), ("sat_t", "t", "sat", ["k"], ["gone"], ["k", "gone"])],
        "model_name string, table_name string, model_type string, business_keys array<string>, attributes array<string>, columns array<string>",
    )
    with pytest.raises(Exception, match="gone"):
        load_vault(reg, {"t": spark.createDataFrame([("1",)], "k string")}, str(tmp_path), "1")
    assert S.read_vault(spark, f"{tmp_path}/hub_t").count() == 1


def test_outcomes_are_kept_per_model(spark, tmp_path):
    reg = spark.createDataFrame(
        [("hub_t", "t", "hub", ["k"], [], ["k"]), ("sat_t", "t", "sat", ["k"], ["gone"], ["k", "gone"])],
        "model_name string, table_name string, model_type string, business_keys array<string>, attributes array<string>, columns array<string>",
    )
    out = load_outcomes(reg, {"t": spark.createDataFrame([("1",)], "k string")}, str(tmp_path), "1")
    assert {r.model_name: r.ok for r in out.collect()} == {"hub_t": True, "sat_t": False}
    log = spark.read.parquet(f"{tmp_path}/_outcomes")
    assert [(r.load_id, "gone" in r.message) for r in log.filter("not ok").collect()] == [("1", True)]
    results = spark.createDataFrame(
        [(1, E.ADD_COLUMN, "t", "OPERATION_STATUS_OK", "", "", "e"), (2, E.ADD_COLUMN, "t", "OPERATION_STATUS_ALREADY_APPLIED", "", "", "e"),
         (3, E.NEW_LINK, "t", "OPERATION_STATUS_OK", "", "", "e"), (4, E.CHANGE_TYPE, "t", "OPERATION_STATUS_OK", "", "", "e"),
         (5, E.ADD_COLUMN, "u", "OPERATION_STATUS_OK", "", "", "e")],
        "seq int, kind string, table_name string, status string, error_code string, error_message string, evidence_snapshot_id string")
    got = {r.seq: r for r in E.with_load_outcomes(results, reg, out).collect()}
    assert [got[k].error_code for k in range(1, 6)] == ["VAULT_ADD_COLUMN_TRANSIENT", "", "", "DV_CHANGE_TYPE_FAILED", ""]
    assert "gone" in got[1].error_message and got[1].evidence_snapshot_id == "" and got[4].evidence_snapshot_id == "e"


def test_schema_log_only_grows(spark, tmp_path):
    root = str(tmp_path)
    cat = lambda *names: spark.createDataFrame([("T", i, c) for i, c in enumerate(names, 1)], "table_name string, ordinal int, column_name string")
    names = lambda: [r.column_name for r in BS.bronze_catalog(spark, root).orderBy("ordinal").collect()]
    with pytest.raises(ValueError):
        BS.read_table(spark, root, "t")
    assert BS.match_lake(spark, root, cat("b", "a").withColumn("table_name", F.lower("table_name"))).count() == 2
    assert BS.read_table(spark, root, "T").columns == ["b", "a", "__ingested_at", "__record_source"] and BS.read_table(spark, root, "t").count() == 0
    low = cat("A", "c", "b").withColumn("table_name", F.lower("table_name"))
    assert [(r.column_name, r.action) for r in BS.match_lake(spark, root, low).collect()] == [("c", "add")]
    assert BS.match_lake(spark, root, low).count() == 0 and names() == ["b", "a", "c"]
    BS.adopt_table(spark.createDataFrame([("1", None), ("2", 3.5)], "b string, D double"), root, "t", DAY, "old")
    BS.adopt_table(spark.createDataFrame([("1", None), ("2", 3.5)], "b string, D double"), root, "t", DAY, "old")
    assert names() == ["b", "a", "c", "d"]
    assert sorted((r.b, r.a, r.d) for r in BS.read_table(spark, root, "t").collect()) == [("1", None, None), ("2", None, "3.5")]
