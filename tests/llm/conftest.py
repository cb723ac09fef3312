import os

import duckdb
import pytest
from pyspark.sql import types as T

from vaultspark.llm.common import prepare

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "embeddings": "vec_id long, embedding array<double>, label int",
    "conversations": "conv_id long, turn long, role string, text string",
}


@pytest.fixture(autouse=True, scope="session")
def workers(spark):
    prepare(spark)


@pytest.fixture
def make_tables(spark, tmp_path):
    """Write small tables (missing ones empty, with extra columns if asked) and name their folder."""

    def make(extra: str = "", **rows) -> str:
        for table, schema in SCHEMAS.items():
            wide = T.StructType.fromDDL(schema)
            for field in T.StructType.fromDDL(extra) if extra else ():
                if field.name not in wide.names:
                    wide = wide.add(field)
            data = [tuple(r) + (None,) * (len(wide) - len(r)) for r in rows.get(table, [])]
            spark.createDataFrame(data, wide).write.mode("overwrite").parquet(str(tmp_path / f"{table}.parquet"))
        return str(tmp_path)

    return make


@pytest.fixture
def oracle():
    """Rows of an oracle query over the Parquet tables of a folder, columns in name order."""

    def ask(sql: str, folder: str, tables=tuple(SCHEMAS)):
        db = duckdb.connect()
        for t in tables:
            path = f"{folder}/{t}.parquet"
            path += "/*.parquet" if os.path.isdir(path) else ""
            db.execute(f"create view {t} as select * from read_parquet('{path}')")
        found = db.execute(sql)
        names = [d[0] for d in found.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        return sorted(names), sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr)

    return ask

