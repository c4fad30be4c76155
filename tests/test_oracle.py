"""Every registered query against its SQL twin."""

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from newszones.plans.catalog import QUERIES
from newszones.plans.catalog_sql import ORACLE

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "boolean": "BOOLEAN",
}


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    cur = db.execute(ORACLE[name])
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(want_names)
    types = {d[0]: str(d[1]) for d in cur.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert want, "an oracle without rows proves nothing"
    a, b = _bag(df.columns, got), _bag(want_names, want)
    assert len(got) == len(want)
    assert a == b, f"only Spark: {list((a - b).items())[:3]}\nonly SQL: {list((b - a).items())[:3]}"


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_contract_holds_the_catalogue():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())
