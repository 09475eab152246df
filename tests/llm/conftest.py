from __future__ import annotations

import glob
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402


def comparable(names, rows):
    """Rows by column name, in a fixed order; floats as they are."""
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(r[k] for k in order) for r in rows), key=repr)


@pytest.fixture
def same_as_sql(spark):
    """Compare a registered query with its SQL in DuckDB."""

    def check(name, sf_dir):
        df = entry.queries()[name](spark, sf_dir)
        got = comparable(df.columns, [tuple(r) for r in df.collect()])
        db = duckdb.connect()
        for path in glob.glob(f"{sf_dir}/*.parquet"):
            db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        said = db.execute(entry.oracle_sql()[name])
        expected = comparable([c[0] for c in said.description], said.fetchall())
        assert sorted(df.columns) == sorted(c[0] for c in said.description)
        assert got == expected
        assert got

    return check


@pytest.fixture
def query(spark):
    """Result of a registered query."""
    return lambda name, sf_dir: entry.queries()[name](spark, sf_dir)
