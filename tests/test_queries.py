"""Every registered query of the library against its SQL, on arrival blocks
small enough that every scan carries across several of them."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from clickspark.model import TABLES
from clickspark.operators import scan
from clickspark.plans import oracles, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (dt.datetime, decimal.Decimal)):
        return str(v)
    return v


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_equals_its_sql(spark, sf_dir, con, name):
    want = con.sql(oracles()[name])
    got = queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [plain(r.asDict(recursive=True)) for r in got.collect()]
    expect = [plain(dict(zip(want.columns, r))) for r in want.fetchall()]
    assert sorted(rows, key=repr) == sorted(expect, key=repr)


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracles())


def test_the_scans_of_the_queries_span_several_blocks(spark, sf_dir):
    from clickspark.plans.catalog.common import event_cuts
    from clickspark.plans.catalog.replay import ARRIVAL, arriving
    assert len(event_cuts(spark, sf_dir)) >= 7
    assert len(scan.order_cuts(arriving(spark, sf_dir), ARRIVAL)) >= 7
