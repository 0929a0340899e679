"""Every registered query against its DuckDB oracle (sf0.001), and the entry point."""

import duckdb
import pytest

from beatline.plans.registry import QUERIES
from conftest import SF_SMALL

TABLES = ["events", "pages", "lineitem"]


def canon(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple("None" if v is None or (isinstance(v, float) and v != v) else str(v) for v in r)
                  for r in pdf.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    q = QUERIES[name]
    got = q.run(spark, SF_SMALL).toPandas()
    want = duck.execute(q.oracle).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns[:4] == ["src_ip", "dst_ip", "dst_domain", "dst_port"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
