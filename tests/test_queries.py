"""Every query that has SQL against DuckDB, on the smallest tables where they are at hand."""

import numbers
import os

import duckdb
import pandas as pd
import pytest

from lodestar.plans import registry

SF = os.environ.get("LODESTAR_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows_of(frame: pd.DataFrame) -> list[str]:
    def plain(v):
        if not isinstance(v, (list, dict)) and pd.isna(v) is True:
            return None
        return float(v) if isinstance(v, numbers.Number) and not isinstance(v, bool) else v

    columns = sorted(frame.columns)
    return [str(columns), *sorted(str(tuple(map(plain, r))) for r in frame[columns].astype(object).itertuples(index=False, name=None))]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    assert rows_of(registry.queries()[name](spark, SF).toPandas()) == rows_of(duck.execute(registry.oracle_sql()[name]).df())


def test_queries_without_sql(spark):
    for name in set(registry.queries()) - set(registry.oracle_sql()):
        assert registry.queries()[name](spark, SF).count() > 0
