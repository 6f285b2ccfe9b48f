import duckdb
import pytest

from tabforge.llm.queries import oracle_sql, queries
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert digest(queries()[name](spark, SF).toPandas()) == digest(con.sql(oracle_sql()[name]).df())
