import duckdb
import pytest

from corpus_pipeline import STAGES, run
from leadmill.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_names():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert ORACLE.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    base = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        base.execute(f"CREATE VIEW {table} AS FROM '{SMALL}/{table}.parquet'")
    want = base.execute(ORACLE[name]).to_arrow_table()
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.column_names)
    columns = sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted((tuple(r[c] for c in columns) for r in want.to_pylist()), key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows, left = run(spark, SMALL).collect(), docs.count()
    assert [name for name, _ in STAGES] == ["toxicity", "simhash", "suffix_dedup", "decontaminate", "sentencepiece"]
    assert 0.6 * left < len(rows) < left
    assert all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_each_stage_keeps_the_columns_and_bears_odd_tables(spark):
    odd = spark.createDataFrame(
        [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, "x"), (1, "", "en", "s", 0, "x"), (2, "a b c " * 40, "en", None, 240, "x"), (3, "a b c " * 40, "en", None, 240, "x")],
        "doc_id long, text string, lang string, source string, n_chars long, ids string",
    )
    for docs in (odd, odd.limit(0)):
        for name, stage in STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == odd.columns, name
            docs = docs.checkpoint()
        assert STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
