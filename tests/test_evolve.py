"""Evolution as sets against the same rules applied one operation at a time."""

import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from vaultspark.operators import evolve as E
from vaultspark.operators import modelling as MD

OPS = (
    "seq bigint, correlation_id string, plan_id string, idempotency_key string, layer string, "
    "kind string, target string, params map<string,string>"
)
CATALOG = {
    "orders": ["order_id", "customer_id", "region_code", "note", "total"],
    "pages": ["page_id", "url"],
    "bridge": ["a_id", "b_id"],
    "logs": ["line"],
}


def make_catalog(spark, tables=CATALOG):
    rows = [(t, i, c, "string") for t, cols in tables.items() for i, c in enumerate(cols, 1)]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, data_type string")


def op(seq, kind, target, plan="", layer="LAYER_VAULT", **params):
    return (seq, f"c{seq}", plan, f"i{seq}", layer, kind, target, {k: v for k, v in params.items()})


class OneByOne:
    """The rules of evolution with explicit state."""

    def __init__(self, registry, catalog, keys):
        self.models = [dict(r.asDict()) for r in registry]
        self.catalog, self.keys = catalog, keys
        self.plan_sat = {}
        for m in self.models:
            if m["model_type"] == "sat" and (m.get("plan_id") or "").strip():
                self.plan_sat[(m["plan_id"].strip(), m["table_name"])] = m["model_name"]
        self.touched = set()
        self.queued = set()

    def of(self, table, kind):
        return [m for m in self.models if m["table_name"] == table and m["model_type"] == kind]

    @staticmethod
    def singular(t):
        if t.endswith("ies"):
            return t[:-3] + "y"
        return t[:-1] if t.endswith("s") and not t.endswith("ss") else t

    @staticmethod
    def next_name(base, names):
        if base not in names:
            return base
        found = [int(m.group(1)) for n in names if (m := re.fullmatch(re.escape(base) + r"_v(\d+)", n))]
        return f"{base}_v{max([1, *found]) + 1}"

    def add(self, name, table, kind, keys, attrs):
        self.models.append(
            dict(model_name=name, table_name=table, model_type=kind, business_keys=list(keys),
                 attributes=list(attrs), columns=list(keys) + list(attrs))
        )
        self.touched.add(name)

    def template(self, table):
        cols = self.catalog[table]
        cands = [c for c in cols if re.search("id|nr|key|number|code", c)]
        hub = next((c for c in cands if re.sub("[^a-z0-9]", "", c).startswith(self.singular(table))),
                   cands[0] if cands else None)
        fks = [c for c in cands if c != hub]
        return hub, fks, [c for c in cols if c not in cands]

    def hub(self, table):
        done = False
        name = "hub_" + self.singular(table)
        if name not in [m["model_name"] for m in self.of(table, "hub")]:
            self.add(name, table, "hub", self.keys[table], [])
            done = True
        if not self.of(table, "sat"):
            self.add("sat_" + self.singular(table), table, "sat", self.keys[table], [])
            done = True
        return done

    def link(self, table, fk_filter):
        hub, fks, _ = self.template(table)
        done = False
        for fk in fks if hub else []:
            if fk_filter and fk != fk_filter:
                continue
            if any(sorted(m["business_keys"]) == sorted([hub, fk]) for m in self.of(table, "link")):
                continue
            stem = fk
            for token in ["id", "nr", "key", "number", "code"]:
                if stem.endswith(token):
                    stem = re.sub(f"_?{token}$", "", stem)
                    break
            base = f"link_{self.singular(table)}_{self.singular(stem)}"
            self.add(self.next_name(base, [m["model_name"] for m in self.of(table, "link")]),
                     table, "link", [hub, fk], [])
            done = True
        return done

    def run(self, o):
        seq, _, plan, _, layer, kind, target, params = o
        if layer != "LAYER_VAULT":
            return "ALREADY_APPLIED", "WRONG_LAYER"
        if kind not in E.HANDLED:
            return "PERMANENT_ERROR", "UNSUPPORTED_OPERATION"
        col = params.get("column_name")
        if kind in E.NEED_COLUMN and not col:
            return "PERMANENT_ERROR", "MISSING_PARAM"
        if kind in E.TARGET_OR_PARAM:
            target = target or params.get("table_name")
        if not target:
            return "PERMANENT_ERROR", "MISSING_TARGET"
        table = target.lower()
        if kind == E.ADD_COLUMN:
            sats = self.of(table, "sat")
            if any(col in m["attributes"] for m in sats):
                return "ALREADY_APPLIED", ""
            keys = self.keys[table]
            if col in keys:
                return "OK", ""
            own = self.plan_sat.get((plan.strip(), table)) if plan.strip() else None
            if own:
                m = next(m for m in sats if m["model_name"] == own)
                m["attributes"].append(col)
                m["columns"].append(col)
                self.touched.add(own)
            else:
                latest = max(sats, key=lambda m: (
                    int((re.search(r"_v(\d+)$", m["model_name"]) or [0, 0])[1]),
                    len(m["attributes"]), m["model_name"]), default={"attributes": []})
                attrs = [a for a in dict.fromkeys(latest["attributes"]) if a not in keys] + [col]
                name = self.next_name("sat_" + self.singular(table), [m["model_name"] for m in sats])
                self.add(name, table, "sat", keys, attrs)
                if plan.strip():
                    self.plan_sat[(plan.strip(), table)] = name
            return "OK", ""
        if kind == E.NEW_HUB:
            return ("OK" if self.hub(table) else "ALREADY_APPLIED"), ""
        if kind == E.CHANGE_TYPE:
            self.queued |= {m["model_name"] for m in self.models if m["table_name"] == table}
            return "OK", ""
        if table not in self.catalog:
            return "TRANSIENT_ERROR", "DV_DISCOVERY_FAILED" if kind == E.NEW_LINK else "DV_DROP_FAILED"
        hub, fks, attrs = self.template(table)
        fk = params.get("fk_column")
        if kind == E.NEW_LINK:
            if not [f for f in fks if hub and (not fk or f == fk)]:
                return "ALREADY_APPLIED", "NO_LINK_CANDIDATE"
            return ("OK" if self.link(table, fk) else "ALREADY_APPLIED"), ""
        done = False
        if hub and attrs:
            name = "hub_" + self.singular(table)
            if name not in [m["model_name"] for m in self.of(table, "hub")]:
                self.add(name, table, "hub", self.keys[table], [])
                done = True
            sats = self.of(table, "sat")
            if not any(sorted(m["business_keys"]) == [hub] and sorted(m["attributes"]) == sorted(attrs) for m in sats):
                self.add(self.next_name("sat_" + self.singular(table), [m["model_name"] for m in sats]),
                         table, "sat", [hub], attrs)
                done = True
        elif hub:
            done = self.hub(table)
        done = self.link(table, fk) or done
        return ("OK" if done else "ALREADY_APPLIED"), ""


def random_ops(rng, n):
    kinds = E.HANDLED * 3 + [E.ADD_COLUMN] * 10 + ["OPERATION_RENAME_COLUMN"]
    columns = ["note", "total", "url", "email", "phone", "order_id", "vip", "tag", "line", "page_id"]
    ops = []
    for seq in range(1, n + 1):
        params = {}
        if rng.random() < 0.95:
            params["column_name"] = rng.choice(columns)
        if rng.random() < 0.3:
            params["fk_column"] = rng.choice(["customer_id", "region_code", "b_id", "zz"])
        target = rng.choice(["orders", "orders", "Pages", "bridge", "logs", "ghosts", ""])
        if not target and rng.random() < 0.5:
            params["table_name"] = "orders"
        layer = "LAYER_LAKE" if rng.random() < 0.03 else "LAYER_VAULT"
        ops.append((seq, f"c{seq}", rng.choice(["", "p1", "p2", "p3", " p1 "]), f"i{seq}", layer,
                    rng.choice(kinds), target, params))
    return ops


REGISTRIES = ["none", "all", "some"]


def make_registry(spark, kind, catalog):
    full = MD.model_lake(catalog).withColumn("plan_id", F.lit(None).cast("string"))
    if kind == "none":
        return full.limit(0)
    if kind == "all":
        return full
    extra = spark.createDataFrame(
        [
            Row(model_name="sat_order_v3", table_name="orders", model_type="sat", business_keys=["order_id"],
                attributes=["note", "vip"], columns=["order_id", "note", "vip"], plan_id="p2"),
            Row(model_name="link_bridge_b", table_name="bridge", model_type="link", business_keys=["x", "y"],
                attributes=[], columns=["x", "y"], plan_id=None),
        ],
        full.schema,
    )
    return full.filter("table_name = 'orders' and model_type <> 'link'").unionByName(extra)


@pytest.mark.parametrize("kind", REGISTRIES)
@pytest.mark.parametrize("seed", [1, 2])
def test_batch_equals_one_by_one(spark, kind, seed):
    catalog = make_catalog(spark)
    registry = spark.createDataFrame(make_registry(spark, kind, catalog).collect(),
                                     make_registry(spark, kind, catalog).schema)
    ops = random_ops(random.Random(f"{kind}{seed}"), 60)
    tables = spark.createDataFrame([(t,) for t in [*CATALOG, "ghosts"]], "table_name string")
    keys = {r.table_name: r.business_keys
            for r in MD.infer_business_keys(tables, catalog, registry).collect()}
    model = OneByOne(registry.collect(), CATALOG, keys)
    want = [(o[0], *model.run(o)) for o in ops]

    out = E.apply_batch(spark.createDataFrame(ops, OPS), registry, catalog)
    got = sorted(
        (r.seq, r.status.removeprefix("OPERATION_STATUS_"), r.error_code) for r in out.results.collect()
    )
    assert got == want

    state = {(r.table_name, r.model_name): (r.model_type, list(r.business_keys), list(r.attributes), list(r.columns))
             for r in out.registry.collect()}
    expected = {(m["table_name"], m["model_name"]): (m["model_type"], m["business_keys"], m["attributes"], m["columns"])
                for m in model.models}
    assert state == expected
    assert {r.model_name for r in out.models.collect()} == model.touched
    assert {r.model_name for r in out.queued.collect()} == model.touched | model.queued


def test_next_version(spark):
    bases = spark.createDataFrame([("sat_x",), ("sat_y",), ("sat_z",)], "base string")
    names = spark.createDataFrame([("sat_x",), ("sat_x_v3",), ("sat_y",), ("sat_zz",)], "model_name string")
    got = {r.base: r.next_name for r in E.next_version(bases, names).collect()}
    assert got == {"sat_x": "sat_x_v4", "sat_y": "sat_y_v2", "sat_z": "sat_z"}


def test_ensure_satellite_ignores_order(spark):
    catalog = make_catalog(spark)
    specs = MD.split_vault(MD.table_metadata(catalog)).filter("model_type = 'sat' and table_name = 'orders'")
    same = specs.withColumn("attributes", F.reverse("attributes"))
    assert E.ensure_satellite(specs, same).count() == 0
    other = specs.withColumn("attributes", F.array(F.lit("note")))
    assert [r.model_name for r in E.ensure_satellite(specs, other).collect()] == ["sat_order_v2"]


def test_two_columns_one_plan_make_one_version(spark):
    catalog = make_catalog(spark)
    registry = MD.model_lake(catalog)
    ops = spark.createDataFrame(
        [op(1, E.ADD_COLUMN, "orders", "p", column_name="email"),
         op(2, E.ADD_COLUMN, "orders", "p", column_name="phone"),
         op(3, E.ADD_COLUMN, "orders", "q", column_name="email")], OPS)
    out = E.apply_add_column(ops, registry, catalog)
    [model] = out.models.collect()
    assert model.model_name == "sat_order_v2"
    assert model.attributes == ["note", "total", "email", "phone"]
    assert [r.status[17:] for r in out.results.orderBy("seq").collect()] == ["OK", "OK", "ALREADY_APPLIED"]


def test_plan_version_extended_in_a_later_batch(spark):
    catalog = make_catalog(spark)
    first = E.apply_add_column(
        spark.createDataFrame([op(1, E.ADD_COLUMN, "orders", "p", column_name="email")], OPS),
        MD.model_lake(catalog), catalog)
    registry = spark.createDataFrame(first.registry.collect(), first.registry.schema)
    second = E.apply_add_column(
        spark.createDataFrame([op(2, E.ADD_COLUMN, "orders", "p", column_name="phone")], OPS),
        registry, catalog)
    [model] = second.models.collect()
    assert (model.model_name, model.attributes) == ("sat_order_v2", ["note", "total", "email", "phone"])


def test_introspection_is_empty_without_hub(spark):
    catalog = make_catalog(spark)
    rows = {r.table_name: r for r in E.introspect_vault(MD.model_lake(catalog).filter("model_type <> 'hub' or table_name = 'pages'")).collect()}
    assert rows["orders"].vaults == []
    assert rows["pages"].vaults[0].hub == "hub_page"
    assert '"dataset_id":"pages"' in rows["pages"].raw_evidence_json
