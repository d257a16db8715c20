import os

import duckdb
import pytest

from tidegrid import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name, tmp_path):
    df = registry.QUERIES[name](spark, SF)
    df.write.parquet(f"file://{tmp_path}/out")
    columns = ", ".join(f'"{c}"' for c in sorted(df.columns))
    ours, sql = f"SELECT {columns} FROM '{tmp_path}/out/*.parquet'", f"SELECT {columns} FROM ({registry.ORACLES[name]})"
    for a, b in ((ours, sql), (sql, ours)):
        assert duck.execute(f"({a}) EXCEPT ALL ({b}) LIMIT 3").fetchall() == []


@pytest.mark.parametrize("name", sorted(registry.QUERIES.keys() - registry.ORACLES.keys() - {"gbt_predictions", "candidate_selection"}))
def test_query_without_sql_has_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
