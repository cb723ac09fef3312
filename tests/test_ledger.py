import time

import pytest
from pyspark.sql import functions as F

from vaultspark.operators import modelling as MD
from vaultspark.sources import storage as S
from vaultspark.sources.lake import catalog_of, read_lake_tables
from vaultspark.streaming import vault_refresher
from vaultspark.streaming import bronze_stream as BS
from vaultspark.streaming.ledger import BatchLedger, covers, merge_intervals


def test_intervals():
    assert merge_intervals([], [1, 2, 5], [], True) == [(1, 5)]
    assert merge_intervals([], [1, 2, 5], [4], True) == [(1, 2), (5, 5)]
    assert merge_intervals([(1, 2)], [5, 4], [], False) == [(1, 2), (4, 5)]
    assert merge_intervals([(1, 4), (9, 9)], [7], [6], True) == [(1, 4), (7, 9)]
    assert [covers([(1, 2), (4, 9)], n) for n in (0, 1, 3, 4, 9, 10)] == [False, True, False, True, True, False]


def test_ledger_is_small_and_survives(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger = BatchLedger(spark, path)
    landed = {("2024-01-01", s, str(n)) for s in ("s-a", "s-b") for n in range(0, 3000, 3)}
    assert ledger.pending("hub", landed) == landed
    some = {b for b in landed if int(b[2]) < 600}
    for _ in range(5):
        ledger.add("hub", some, landed)
    again = BatchLedger(spark, path)
    assert again.pending("hub", landed) == landed - some
    assert S.read_snapshot(spark, path).count() == 2
    assert len(S._children(spark, path)) == 3
    # Without a stream, numbers may come in any order: gaps stay open.
    again.add("sat", {("2024-01-01", "s-direct", n) for n in ("8", "6")}, {("2024-01-01", "s-direct", n) for n in ("8", "6")})
    assert again.pending("sat", {("2024-01-01", "s-direct", n) for n in ("6", "7", "8")}) == {("2024-01-01", "s-direct", "7")}


def test_folders_are_as_few_as_possible():
    landed = {(d, s, str(n)) for d in ("1", "2") for s in ("a", "b") for n in range(3)}
    assert S.batch_folders(landed, landed) == ["ingest_date=1", "ingest_date=2"]
    wanted = {b for b in landed if b[0] == "1" or b[1] == "a"} - {("2", "a", "0")}
    assert S.batch_folders(wanted, landed) == ["ingest_date=1", "ingest_date=2/stream=a/batch=1", "ingest_date=2/stream=a/batch=2"]


def many_batches(spark, orders, root, n):
    """One write that looks like ``n`` landed batches of one stream."""
    rows = orders.withColumn("batch", F.pmod(F.xxhash64("o_orderkey"), F.lit(n))).select(
        F.create_map(*(x for c in orders.columns for x in (F.lit(c), F.col(c).cast("string")))).alias("fields"),
        F.lit("orders").alias("table"), F.lit("2024-01-01").alias("ingest_date"), F.lit("s-x").alias("stream"), "batch")
    rows.repartition("batch").write.mode("append").partitionBy("table", "ingest_date", "stream", "batch").parquet(root)


@pytest.fixture
def vault(spark, sf_dir, tmp_path):
    orders = read_lake_tables(spark, sf_dir)["orders"].drop("o_orderdate")
    registry = MD.model_lake(catalog_of(spark, {"orders": orders})).filter("model_type <> 'link'")
    return orders, registry, str(tmp_path / "bronze"), str(tmp_path / "vault")


def test_catches_up_on_thousands_of_batches(spark, sf_dir, vault):
    _, registry, root, vault_root = vault
    lines = read_lake_tables(spark, sf_dir)["lineitem"].select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o_orderkey"), F.col("l_quantity").alias("o_totalprice"))
    many_batches(spark, lines, root, 5000)
    landed = S.bronze_batches(spark, root, "orders")
    assert len(landed) > 2900
    refresh = vault_refresher(spark, registry.filter("model_type = 'hub'"), root, vault_root)
    # One batch was loaded before: all others are read by name, not with their day.
    refresh._load(registry.filter("model_type = 'hub'").first(), {min(landed)}, landed)
    refresh.ledger.add("hub_order", {min(landed)}, landed)
    assert len(refresh.ledger.pending("hub_order", landed)) == len(landed) - 1
    refresh({"orders": 1}, 0)
    assert S.read_vault(spark, f"{vault_root}/hub_order").count() == lines.select("o_orderkey").distinct().count()
    assert refresh.ledger.known() == {"hub_order": {"s-x": [(min(int(b[2]) for b in landed), max(int(b[2]) for b in landed))]}}


def test_failing_loads_are_made_good(spark, vault, monkeypatch):
    orders, registry, root, vault_root = vault
    many_batches(spark, orders, root, 6)
    load, calls = BS.load_one, []

    def fails_first(source, model, *args, **kwargs):
        calls.append(model["model_name"])
        if calls.count(model["model_name"]) == 1 and model["model_name"].startswith("sat"):
            raise RuntimeError("first")
        load(source, model, *args, **kwargs)

    monkeypatch.setattr(BS, "load_one", fails_first)
    refresh = vault_refresher(spark, registry, root, vault_root, max_models=1)
    with pytest.raises(RuntimeError):
        refresh({"orders": 1}, 0)
    assert refresh.waiting == {"orders"}
    refresh({}, 1)
    assert refresh.waiting == set() and sorted(calls) == ["hub_order", "sat_order", "sat_order"]
    assert S.read_vault(spark, f"{vault_root}/sat_order").count() == orders.count()


def test_waits_for_quiet_and_fires_when_the_stream_is_silent(spark, vault, monkeypatch):
    orders, registry, root, vault_root = vault
    many_batches(spark, orders, root, 3)
    refresh = vault_refresher(spark, registry, root, vault_root, quiet_seconds=1.5)
    started, real, failures = [], refresh._refresh, [RuntimeError("once")]

    def noted(tables):
        started.append(time.monotonic())
        if failures:
            raise failures.pop()
        return real(tables)

    monkeypatch.setattr(refresh, "_refresh", noted)
    for k in range(4):  # each call comes before the quiet time is over
        refresh({"orders": 1}, k)
        last = time.monotonic()
        time.sleep(0.6)
    deadline = time.monotonic() + 60
    while (refresh.waiting or len(started) < 2) and time.monotonic() < deadline:
        time.sleep(0.1)
    # First after the last arrival (that one fails), then again by itself.
    assert len(started) == 2 and started[0] - last >= 1.4 and started[1] - started[0] >= 1.4
    with refresh._work:
        pass
    assert S.read_vault(spark, f"{vault_root}/hub_order").count() == orders.count()


def test_longest_wait_and_close(spark, vault, monkeypatch):
    _, registry, root, vault_root = vault
    refresh = vault_refresher(spark, registry, root, vault_root, quiet_seconds=30, longest_wait=0.5)
    done = []
    monkeypatch.setattr(refresh, "_refresh", lambda tables: done.append(set(tables)) or tables)
    refresh({"orders": 1}, 0)
    deadline = time.monotonic() + 20
    while not done and time.monotonic() < deadline:
        time.sleep(0.05)
    assert done == [{"orders"}]
    refresh.longest_wait = None
    refresh({"part": 1}, 1)
    refresh.close()
    assert done == [{"orders"}, {"part"}] and refresh._timer is None
