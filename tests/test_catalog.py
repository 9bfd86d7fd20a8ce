"""Every query against DuckDB on the same tables, as the driver compares them."""

import duckdb
import pytest

from lumengrid.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or isinstance(v, float) and v != v:
        return "null"
    if isinstance(v, float):
        return f"{v:.6g}" if v else "0"
    if isinstance(v, list):
        return "[" + ",".join(map(canon, v)) + "]"
    return str(v)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(map(canon, r)) for r in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    if name not in registry.ORACLES:
        assert len(got)
        return
    assert rows(got) == rows(duck.execute(registry.ORACLES[name]).df())


def test_flagship_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
