"""Every registered query against its DuckDB oracle at sf0.001 (the driver uses sf0.01)."""

import sys

import duckdb
import pytest

from conftest import SF_SMALL, plan_text

sys.path.insert(0, "tools")
from check_oracle import TABLES, digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from monthlake.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = plan_text(df)
    assert "EvalPython" not in plan and "PythonUDF" not in plan  # everything stays JVM-side
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id_terceirizado", "cnpj", "cpf", "orgao_superior_sigla"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows and rows == sorted(tuple(r) for r in E.queries()["mart_latest"](spark, SF_SMALL).collect())
