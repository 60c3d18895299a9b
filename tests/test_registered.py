"""Every registered query against its SQL, on whole tables."""

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from runsift.plans.oracles import ORACLES
from runsift.plans.registered import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_agrees_with_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    ours = bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(oracle_sql()[name])
    theirs = bag([d[0] for d in cursor.description], cursor.fetchall())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
