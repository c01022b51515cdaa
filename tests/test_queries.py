"""Every query against its SQL counterpart on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import canonical, column_types
from tidewell.workload.oracles import ORACLES
from tidewell.workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= queries().items()
    assert ORACLES.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf).toArrow()
    want = duck.sql(ORACLES[name]).to_arrow_table()
    assert column_types(got) == column_types(want)
    assert canonical(got.to_pandas()) == canonical(want.to_pandas())


def test_entry_gives_ranked_games(spark):
    df = entry(spark)
    assert df.columns == ["Game", "Concurrent players"]
    assert df.count() >= 10
