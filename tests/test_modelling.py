import pytest
from pyspark.errors import PySparkException

from vaultspark.operators import modelling as MD
from vaultspark.sources.lake import catalog_of, lake_catalog, list_lake_tables, observe_lake, read_lake

CAT = "table_name string, ordinal int, column_name string, data_type string"


def catalog(spark, **tables):
    rows = [(t, i, c, "string") for t, cols in tables.items() for i, c in enumerate(cols, 1)]
    return spark.createDataFrame(rows, CAT)


def models(cat):
    return {r.model_name: (r.model_type, r.business_keys, r.attributes) for r in MD.model_lake(cat).collect()}


def test_the_given_lake(spark, sf_dir):
    got = models(lake_catalog(spark, sf_dir))
    assert got["hub_event"] == ("hub", ["event_id"], [])
    assert got["link_event_user"] == ("link", ["event_id", "user_id"], [])
    assert got["sat_event"] == ("sat", ["event_id"], ["ts", "event_type", "value", "props"])
    assert got["sat_order"][2] == ["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    links = {n for n, m in got.items() if m[0] == "link"}
    assert links == {
        "link_event_user", "link_customer_c_nation", "link_order_o_cust", "link_lineitem_l_part",
        "link_lineitem_l_supp", "link_lineitem_l_line", "link_supplier_s_nation", "link_nation_n_region",
    }
    assert len(got) == 14 + 14 + 8


def test_prefix_match_beats_order(spark):
    got = models(catalog(spark, orders=["width", "customer_id", "Order_Id", "note"]))
    assert got["hub_order"][1] == ["Order_Id"]
    assert got["link_order_customer"][1] == ["Order_Id", "customer_id"]
    assert got["link_order_width"][1] == ["Order_Id", "width"]
    assert got["sat_order"][2] == ["note"]


def test_odd_names(spark):
    # A token with underscores never starts a stripped column name.
    got = models(catalog(spark, order_items=["item_nr", "order_item_id"]))
    assert got["hub_order_item"][1] == ["item_nr"]
    # A bare "id" as foreign key leaves no suffix.
    assert "link_user_" in models(catalog(spark, users=["user_code", "id"]))


def test_no_key_no_model(spark):
    cat = catalog(spark, logs=["line", "modified_at"])
    assert models(cat) == {}
    [meta] = MD.table_metadata(cat).collect()
    assert (meta.hub_key, meta.business_keys, meta.foreign_keys, meta.attributes) == (None, [], [], ["line"])
    assert MD.hub_key(cat).count() == 0


def test_last_spec_of_a_name_wins(spark):
    got = models(catalog(spark, order=["order_id", "a"], orders=["order_id", "b"]))
    assert got["sat_order"][2] == ["b"]


@pytest.mark.parametrize(
    "columns, kind",
    [(["a_id"], "hub"), (["a_id", "x"], "hub"), (["a_id", "b_id", "created_at"], "link"), (["a_id", "b_id", "x"], "sat"), (["x"], "sat")],
)
def test_model_type(spark, columns, kind):
    [row] = MD.model_type(MD.table_metadata(catalog(spark, t=columns))).collect()
    assert row.model_type == kind


def keys(spark, table, columns, registry=None):
    cat = catalog(spark, **({table: columns} if columns else {"other": ["x"]}))
    reg = registry or MD.model_lake(cat).limit(0)
    tables = spark.createDataFrame([(table,)], "table_name string")
    return MD.infer_business_keys(tables, cat, reg).first().business_keys


def test_business_keys(spark):
    assert keys(spark, "e2e_accounts-x", ["a", "accountid", "id"]) == ["accountid"]
    assert keys(spark, "things", ["x", "Thing_ID", "id"]) == ["thing_id"]
    assert keys(spark, "things", ["x", "order_id", "customer_id"]) == ["customer_id"]
    assert keys(spark, "things", ["x", "paid", "uuid"]) == ["paid"]
    assert keys(spark, "things", ["x", "y"]) == ["x"]
    assert keys(spark, "things", []) == ["id"]


def test_registered_keys_come_from_the_hub(spark):
    cat = catalog(spark, orders=["order_id", "customer_id", "n"])
    reg = MD.model_lake(cat)
    assert keys(spark, "orders", ["id"], reg) == ["order_id"]
    assert keys(spark, "orders", ["id"], reg.filter("model_type = 'link'")) == ["order_id", "customer_id"]


SPEC = "model_name string, table_name string, model_type string, business_keys array<string>, attributes array<string>, columns array<string>"


def test_registry_rows(spark):
    df = spark.createDataFrame([("s", "t", "Satellite", ["k"], ["a", "k", "a", "b"], ["k", "a", "k"])], SPEC)
    row = MD.registry_rows(df).first()
    assert (row.model_type, row.attributes, row.columns) == ("sat", ["a", "b"], ["k", "a"])


@pytest.mark.parametrize("kind, key", [("pit", ["k"]), ("hub", []), ("link", [])])
def test_registry_refuses(spark, kind, key):
    df = spark.createDataFrame([("s", "t", kind, key, [], [])], SPEC)
    with pytest.raises(PySparkException):
        MD.registry_rows(df).collect()


def test_registry_changed(spark):
    cat = catalog(spark, orders=["order_id", "n"])
    reg = MD.model_lake(cat)
    assert MD.registry_changed(reg, reg).count() == 0
    wider = MD.model_lake(catalog(spark, orders=["order_id", "n", "m"]))
    assert [r.model_name for r in MD.registry_changed(wider, reg).collect()] == ["sat_order"]


def test_lake_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x")], "Id int, empty string, v string")
    df.write.parquet(str(tmp_path / "Things"))
    df.coalesce(1).write.parquet(str(tmp_path / "_parts"))
    [part] = (tmp_path / "_parts").glob("*.parquet")
    (tmp_path / "single.parquet").write_bytes(part.read_bytes())
    (tmp_path / ".hidden").mkdir()
    root = str(tmp_path)
    assert list_lake_tables(spark, root) == ["single", "things"]
    assert read_lake(spark, root, "public.THINGS", ["v"]).first().v == "x"
    with pytest.raises(FileNotFoundError):
        read_lake(spark, root, "nope")
    seen = {(r.table_name, r.column_name): r.n_values for r in observe_lake(spark, root).collect()}
    assert seen[("things", "id")] == 1 and seen[("single", "empty")] == 0
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert catalog_of(spark, {"t": df}).count() == 3
    assert list_lake_tables(spark, root + "/absent") == []


def test_empty_tables_and_null_columns_are_modelled(spark, tmp_path):
    from vaultspark.sources.lake import lake_catalog, observe_lake

    spark.createDataFrame([], "x_id int, note string").write.parquet(str(tmp_path / "t1.parquet"))
    spark.createDataFrame([(1, None)], "y_id int, note string").write.parquet(str(tmp_path / "t2.parquet"))
    models = MD.model_lake(lake_catalog(spark, str(tmp_path)))
    assert sorted(r.model_name for r in models.collect()) == ["hub_t1", "hub_t2", "sat_t1", "sat_t2"]
    counts = {(r.table_name, r.column_name): r.n_values for r in observe_lake(spark, str(tmp_path)).collect()}
    assert counts == {("t1", "x_id"): 0, ("t1", "note"): 0, ("t2", "y_id"): 1, ("t2", "note"): 0}
