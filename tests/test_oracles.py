"""Every registered query against its SQL, over whole tables at the smallest scale."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from keyrill.plans import oracles, registry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def ordered(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(oracles.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    got = ordered(entry.queries()[name](spark, SF).toPandas())
    want = ordered(duck.execute(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "key",
        "ts_us",
        "electronic_order_id",
        "appliance_order_id",
        "appliance_id",
        "user_name",
        "time",
    ]
