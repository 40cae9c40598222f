"""Every query of the object-store jobs against its SQL in DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from stowage.plans import catalogue, written  # noqa: F401  the second adds to the first


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for f in os.listdir(small):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{small}/{f}'")
    return con


def rows_of(db, sql, columns):
    return sorted(map(repr, db.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, small, db, name):
    got = catalogue.QUERIES[name](spark, small)
    columns = sorted(f'"{c}"' for c in got.columns)
    assert sorted(f'"{c}"' for c in db.sql(catalogue.ORACLES[name]).columns) == columns
    ours = sorted(repr(tuple(r)) for r in got.select(*[c.strip('"') for c in columns]).collect())
    assert ours == rows_of(db, catalogue.ORACLES[name], columns)
    assert ours


def test_entry_gives_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("n", [1, 7, 50])
def test_results_do_not_depend_on_partitions(spark, small, n):
    from stowage.operators import gc
    from stowage.plans import derived

    def keys(parts):
        return sorted(map(tuple, gc.dedup_keys(gc.expand_targets(derived.gc_targets(spark, small).repartition(parts))).collect()))

    assert keys(n) == keys(3)
