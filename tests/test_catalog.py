"""Every catalog query against its SQL, over the smallest tables."""

import math
import os

import duckdb
import pytest

from topicloom.plans import catalog, catalog2  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(data):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{data}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def rows(df):
    def show(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(round(v, 8) + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(show(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(name, spark, data, con):
    got, want = catalog.QUERIES[name](spark, data).toPandas(), con.sql(catalog.ORACLES[name]).df()
    assert set(got.columns) == set(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.queries()["w03_f19_h03_composite_shortlist"] is catalog.QUERIES["w03_f19_h03_composite_shortlist"]
