"""Every query of the library against its SQL on DuckDB, over the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import lakemill.plans  # noqa: F401
from lakemill.plans.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the synthetic tables are not here")


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return round(value, 9)
    return str(value).removesuffix(" 00:00:00") if hasattr(value, "isoformat") else value


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([tuple(plain(r[i]) for i in order) for r in found]), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
