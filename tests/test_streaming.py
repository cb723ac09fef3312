import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from vaultspark.operators import cdc, vault
from vaultspark.operators import envelope as EV
from vaultspark.operators import lineage as LN
from vaultspark.operators import modelling as MD
from vaultspark.plans import capture
from vaultspark.plans.load import load_vault
from vaultspark.sources import envelopes as ES
from vaultspark.sources import storage as S
from vaultspark.sources.lake import catalog_of, read_lake_tables
from vaultspark.streaming import ProgressRecorder, start_bronze_stream, vault_refresher


def publish(spark, sf_dir, path, tables):
    lake = read_lake_tables(spark, sf_dir)
    for table, ts in tables.items():
        half = lake[table].repartition(3)
        ES.publish_envelopes(cdc.cdc_full(half, table, ts), "text", path)
    return lake


def run(spark, path, root, checkpoint, **kwargs):
    stream = ES.envelope_stream(spark, "text", path, maxFilesPerTrigger="2")
    query = start_bronze_stream(stream, root, checkpoint, trigger=None, **kwargs)
    assert query.awaitTermination(180)
    return query


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    path, root, checkpoint, vault_root = (str(tmp_path / d) for d in ("topic", "bronze", "check", "vault"))
    lake = publish(spark, sf_dir, path, {"events": "ts", "orders": "o_orderdate"})
    spark.createDataFrame([("broken",), ('{"table":"events"}',)], "value string").write.mode("append").text(path)
    cat = catalog_of(spark, {t: lake[t] for t in ("events", "orders")})
    registry = MD.model_lake(cat)
    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    batches = []
    refresh = vault_refresher(spark, registry, root, vault_root)

    def after(touched, batch_id):
        batches.append(touched)
        refresh(touched, batch_id)

    run(spark, path, root, checkpoint, name="topic_test", on_after_write=after)
    counts = {t: lake[t].count() for t in ("events", "orders")}
    landed = {r.table: r["count"] for r in S.read_bronze(spark, root).groupBy("table").count().collect()}
    assert landed == counts
    assert len(batches) > 1
    total = {t: sum(b.get(t, 0) for b in batches) for t in counts}
    assert total["orders"] == counts["orders"] and total["events"] >= counts["events"]

    # The stream reads text, the batch typed columns: hashes must agree. The
    # change column itself is ISO text in a payload, so compare orders without it.
    attrs = ["o_orderstatus", "o_totalprice", "o_orderpriority"]
    streamed = S.read_vault(spark, f"{vault_root}/sat_order")
    batch = vault.load_satellite(lake["orders"], ["o_orderkey"], attrs, "orders")
    again = vault.load_satellite(streamed, ["o_orderkey"], attrs, "orders")
    hashes = lambda df: {(str(r.o_orderkey), r.hashdiff) for r in df.collect()}
    assert hashes(again) == hashes(batch)
    assert S.read_vault(spark, f"{vault_root}/hub_event").count() == counts["events"]

    # Nothing new: nothing changes.
    run(spark, path, root, checkpoint, name="topic_test")
    assert S.read_bronze(spark, root).count() == sum(counts.values())

    deadline = time.time() + 20
    while recorder.frame(spark).count() < len(batches) and time.time() < deadline:
        time.sleep(0.2)
    seen = recorder.frame(spark).filter("name = 'topic_test' and num_input_rows > 0")
    assert seen.agg(F.sum("num_input_rows")).first()[0] == sum(counts.values()) + 2
    spark.streams.removeListener(recorder)


def test_two_streams_into_one_root_keep_all_rows(spark, sf_dir, tmp_path):
    root, vault_root = str(tmp_path / "bronze"), str(tmp_path / "vault")
    orders = read_lake_tables(spark, sf_dir)["orders"]
    registry = MD.model_lake(catalog_of(spark, {"orders": orders}))
    refresh = vault_refresher(spark, registry, root, vault_root)
    for part in (0, 1):
        topic = str(tmp_path / f"topic{part}")
        ES.publish_envelopes(cdc.cdc_full(orders.filter(F.col("o_orderkey") % 2 == part), "orders", "o_orderdate"), "text", topic)
        run(spark, topic, root, str(tmp_path / f"check{part}"), name=f"two_{part}", on_after_write=refresh)
    n = orders.count()
    assert S.read_bronze(spark, root).count() == n
    assert S.read_vault(spark, f"{vault_root}/hub_order").count() == n


def test_failed_refresh_is_caught_up(spark, sf_dir, tmp_path):
    path, root, vault_root = (str(tmp_path / d) for d in ("topic", "bronze", "vault"))
    lake = publish(spark, sf_dir, path, {"orders": "o_orderdate"})
    registry = MD.model_lake(catalog_of(spark, {"orders": lake["orders"]}))
    refresh = vault_refresher(spark, registry, root, vault_root)
    calls = []

    def fails_once(touched, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("once")
        refresh(touched, batch_id)

    run(spark, path, root, str(tmp_path / "c"), name="catch_up", on_after_write=fails_once)
    n = lake["orders"].count()
    assert len(calls) > 1 and S.read_vault(spark, f"{vault_root}/hub_order").count() == n

    # Left out altogether, then caught up without a new batch; and nothing twice.
    other = str(tmp_path / "vault2")
    late = vault_refresher(spark, registry, root, other)
    late.flush()
    late.flush()
    assert S.read_vault(spark, f"{other}/sat_order").count() == n


def test_batch_load_then_stream_load(spark, sf_dir, tmp_path):
    path, root, vault_root = (str(tmp_path / d) for d in ("topic", "bronze", "vault"))
    lake = publish(spark, sf_dir, path, {"orders": "o_orderdate"})
    registry = MD.model_lake(catalog_of(spark, {"orders": lake["orders"].drop("o_orderdate")}))
    load_vault(registry, {"orders": lake["orders"]}, vault_root, "2024-03-01T00-00")
    before = {m: S.read_vault(spark, f"{vault_root}/{m}").count() for m in ("hub_order", "sat_order", "link_order_o_cust")}
    run(spark, path, root, str(tmp_path / "c"), name="mixed", on_after_write=vault_refresher(spark, registry, root, vault_root))
    assert {m: S.read_vault(spark, f"{vault_root}/{m}").count() for m in before} == before


def test_progress_is_stored_not_dropped(spark, tmp_path):
    class Event:
        def __init__(self, k):
            self.progress = type("P", (), dict(
                name="q", batchId=k, numInputRows=1, inputRowsPerSecond=float("nan"), processedRowsPerSecond=2.0, durationMs={}, stateOperators=[]))

    log = str(tmp_path / "log")
    recorder = ProgressRecorder(spark, log, flush_every=3)
    for k in range(7):
        recorder.onQueryProgress(Event(k))
    assert recorder.frame(spark).count() == 1
    recorder.flush(spark, log)
    stored = spark.read.parquet(log)
    assert sorted(r.batch_id for r in stored.collect()) == list(range(7))
    assert stored.filter("input_rows_per_second is not null").count() == 0


def test_lost_checkpoint_replays_without_duplicates(spark, sf_dir, tmp_path):
    path, root = str(tmp_path / "topic"), str(tmp_path / "bronze")
    lake = publish(spark, sf_dir, path, {"orders": "o_orderdate"})
    fixed = ES.envelope_stream(spark, "text", path)
    for check in ("one", "two"):
        query = start_bronze_stream(fixed, root, str(tmp_path / check), name=f"replay_{check}", trigger=None)
        assert query.awaitTermination(120)
    assert S.read_bronze(spark, root).count() == lake["orders"].count()


def test_callback_error_is_not_fatal_and_tables_are_allowed(spark, sf_dir, tmp_path):
    path, root = str(tmp_path / "topic"), str(tmp_path / "bronze")
    lake = publish(spark, sf_dir, path, {"events": "ts", "orders": "o_orderdate"})

    def fail(touched, batch_id):
        raise RuntimeError("callback")

    run(spark, path, root, str(tmp_path / "c"), name="failing", on_after_write=fail, allowed_tables=["ORDERS"])
    assert {r.table for r in S.read_bronze(spark, root).select("table").distinct().collect()} == {"orders"}
    assert S.read_bronze(spark, root).count() == lake["orders"].count()


def test_publish_as_stream(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([("t", '{"a":"1"}', "insert", "x")], "table string, payload string, cdc_type string, cdc_ingestion_timestamp string").write.parquet(src)
    rows = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    query = ES.publish_envelopes(rows, "text", out, str(tmp_path / "check"))
    query.processAllAvailable()
    query.stop()
    assert ES.envelope_batch(spark, "text", out).count() == 1


def test_bursts_on_a_stream(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = "select timestamp_seconds(1704067200 + id * 10) at, concat('m', id % 2) m from range(5) union all " \
           "select timestamp_seconds(1704067200 + 3600), 'late'"
    spark.sql(rows).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("at timestamp, m string").parquet(src).withWatermark("at", "1 minute")
    out = LN.coalesce_bursts(stream, "at", "m", 60)
    query = out.writeStream.format("memory").queryName("burst_out").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    [row] = spark.table("burst_out").collect()
    assert (row.n_requests, row["values"]) == (5, ["m0", "m1"])


def stream_of(spark, folder, batches, quiet, keys):
    """Bursts that a stream over one file a micro-batch emits."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "k string, at timestamp, v string").coalesce(1).write.parquet(f"{folder}/in/{k:03d}")
    stream = (spark.readStream.schema("k string, at timestamp, v string").option("maxFilesPerTrigger", 1)
              .parquet(f"{folder}/in/*").withWatermark("at", "30 seconds"))
    out = LN.coalesce_bursts(stream, "at", "v", quiet, keys)
    name = f"bursts_{abs(hash(folder))}"
    query = out.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start()
    try:
        assert query.awaitTermination(240)
    finally:
        query.stop()
    return spark.table(name), out


@pytest.mark.parametrize("keys", [["k"], []])
def test_bursts_of_a_stream_equal_those_of_a_batch(spark, tmp_path, keys):
    """Gaps below, at and above the quiet time, sessions over many bins, rows late within the watermark."""
    rng = random.Random(len(keys))
    quiet, at, rows = 60, dt.datetime(2024, 1, 1), []
    for _ in range(160):
        at += dt.timedelta(seconds=rng.choice([0, 5, 20, 31, 59, 59.999999, 60, 61, 130] if keys else [0, 20, 31, 40, 59, 60, 150]))
        rows.append((rng.choice("ab"), at, rng.choice("xyz")))
    for k in range(0, len(rows) - 1, 7):  # out of order
        if (rows[k + 1][1] - rows[k][1]).total_seconds() < 30:
            rows[k], rows[k + 1] = rows[k + 1], rows[k]
    # Twenty rows a micro-batch; a last row far ahead closes all that came before.
    batches = [rows[k:k + 20] for k in range(0, len(rows), 20)]
    far = at + dt.timedelta(days=1)
    batches += [[("z", far, "end")], [("z", far + dt.timedelta(days=1), "end")]]
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got, out = stream_of(spark, str(tmp_path), batches, quiet, keys)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    frame = spark.createDataFrame([r for b in batches for r in b], "k string, at timestamp, v string")
    want = LN.coalesce_bursts(frame, "at", "v", quiet, keys)
    closed = lambda df: sorted(tuple(r) for r in df.filter("not array_contains(values, 'end')").collect())
    assert closed(got) == closed(want) and len(closed(want)) > 5
    assert got.columns == want.columns


def test_a_capture_that_stops_lands_each_row_once(spark, sf_dir, tmp_path, monkeypatch):
    topic, marks = str(tmp_path / "topic"), str(tmp_path / "marks")
    orders = read_lake_tables(spark, sf_dir)["orders"]
    early = orders.filter("o_orderkey % 3 <> 0").unionByName(orders.filter("o_orderkey % 3 = 1"))  # with repeated rows
    ts = {"orders": "o_orderdate"}
    write = capture.write_snapshot

    def stops(df, path, version):
        if path == marks:
            raise OSError("stopped")
        write(df, path, version)

    monkeypatch.setattr(capture, "write_snapshot", stops)
    for _ in range(2):
        with pytest.raises(OSError):
            capture.capture_job(spark, {"orders": early}, ts, marks, "text", topic)
    monkeypatch.undo()
    n = early.count()
    # What came meanwhile waits; the repeat publishes the outbox of the run that stopped.
    assert capture.capture_job(spark, {"orders": early.limit(0)}, ts, marks, "text", topic) == n
    assert capture.capture_job(spark, {"orders": early}, ts, marks, "text", topic) == 0
    messages = EV.parse_envelopes(ES.envelope_batch(spark, "text", topic), with_id=True)
    assert (messages.count(), messages.select("message_id").distinct().count()) == (3 * n, n)
    spark.createDataFrame([('{"table":"orders","payload":"{}"}',)] * 2, "value string").write.mode("append").text(topic)

    for name, window, rows in (("once", "1 hour", n + 2), ("plain", None, 3 * n + 2)):
        root = str(tmp_path / name)
        run(spark, topic, root, str(tmp_path / f"check_{name}"), name=f"replays_{name}", replay_window=window)
        assert S.read_bronze(spark, root).count() == rows  # messages without an id all stay
