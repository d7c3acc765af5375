import os

import pytest

import __spark_entry__

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_names():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 60


def test_flagship(spark):
    rows = __spark_entry__.entry(spark)
    assert rows.count() > 0 and rows.columns == __spark_entry__.entry(spark).columns


@pytest.mark.parametrize("name", ["public_ip_pool", "decode_packets", "incidents_with_hysteresis", "spool_inventory"])
def test_equal_to_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("lineitem", "orders", "events"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = __spark_entry__.queries()[name](spark, DATA)
    columns = ", ".join(got.columns)
    want = con.execute(f"select {columns} from ({__spark_entry__.oracle_sql()[name]}) t").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
