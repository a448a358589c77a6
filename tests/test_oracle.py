"""Every registered query against its SQL definition on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import leadmill.workload.flow_queries  # noqa: F401 - registers its queries and those it builds on
from leadmill.workload.queries import ORACLE, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{file}'")
    return con


def compare(duck, df, sql, out):
    df.write.parquet(out)
    duck.execute(f"CREATE OR REPLACE TEMP TABLE want AS {sql}")
    duck.execute(f"CREATE OR REPLACE TEMP VIEW got AS SELECT * FROM read_parquet('{out}/*.parquet')")
    want = dict(r[:2] for r in duck.execute("DESCRIBE want").fetchall())
    got = dict(r[:2] for r in duck.execute("DESCRIBE got").fetchall())
    assert got == want
    cols = ", ".join(f'"{c}"' for c in sorted(want))
    for a, b in (("got", "want"), ("want", "got")):
        extra = duck.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b} LIMIT 3").fetchall()
        assert extra == [], f"only in {a}"


def test_all_queries_have_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert ORACLE.items() <= entry.oracle_sql().items() and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, tmp_path, name):
    compare(duck, QUERIES[name](spark, DIR), ORACLE[name], str(tmp_path / "out"))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "unique_recipients" in df.columns
