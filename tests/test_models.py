"""Models on NULL-heavy, skewed data against their plain SQL definitions."""

import duckdb
import pytest

from fixtures import frames, random_tables
from leadmill.plans import facts
from leadmill.plans.models import DIMENSION_MODELS, FACT_MODELS, STAGING_MODELS, build_order, derive
from leadmill.workload.oracle import with_ctes
from leadmill.workload.views import AS_OF
from test_oracle import compare

MODELS = [f"staging.{m}" for m in STAGING_MODELS] + [f"marketing.{m}" for m in [*DIMENSION_MODELS, *FACT_MODELS]]


@pytest.fixture(scope="module", params=[1, 2])
def world(spark, request, tmp_path_factory):
    raw = frames(spark, random_tables(request.param, AS_OF))
    base = tmp_path_factory.mktemp("raw")
    con = duckdb.connect()
    for name, df in raw.items():
        df.write.parquet(str(base / name))
        con.execute(f"CREATE VIEW fixture_{name} AS SELECT * FROM '{base}/{name}/*.parquet'")
    return {n: spark.read.parquet(str(base / n)) for n in raw}, con, {}


@pytest.mark.parametrize("ref", MODELS)
def test_model(world, ref, tmp_path):
    raw, con, memo = world
    database, name = ref.split(".")
    table = f"stg_{name}" if database == "staging" else name
    sql = with_ctes(f"SELECT * FROM {table}", {f"raw_{e}": f"SELECT * FROM fixture_{e}" for e in raw})
    compare(con, derive(ref, raw, AS_OF, memo), sql, str(tmp_path / "out"))


@pytest.mark.parametrize("model", ["fct_daily_performance", "fact_marketing_performance"])
def test_facts_with_split_keys(world, model, tmp_path, monkeypatch):
    raw, con, _ = world
    plain = facts.fanout_left_join
    monkeypatch.setattr(
        facts, "fanout_left_join", lambda *args, **kw: plain(*args, **{**kw, "parts": 5, "min_rows": 2})
    )
    sql = with_ctes(f"SELECT * FROM {model}", {f"raw_{e}": f"SELECT * FROM fixture_{e}" for e in raw})
    compare(con, derive(f"marketing.{model}", raw, AS_OF), sql, str(tmp_path / "out"))


def test_build_order():
    for layer in ("staging", "dimensions", "facts"):
        seen = set()
        for spec in build_order(layer):
            for source in spec.inputs.values():
                database, name = source.split(".")
                if layer == "staging" and database == "staging":
                    assert source in seen
            seen.add(f"{spec.database}.{spec.name}")
    assert [s.name for s in build_order("staging")].index("contact") < [
        s.name for s in build_order("staging")
    ].index("email_engagement")


def test_calendar_has_every_day(spark):
    from datetime import datetime

    from leadmill.plans.dimensions import dim_date

    account = spark.sql("SELECT TIMESTAMP_NTZ'1990-01-01 00:00:00' AS created_date")
    days = dim_date(account, datetime(2024, 1, 1))
    assert days.count() == days.distinct().count() == 12_419
    assert days.agg({"date_key": "max"}).first()[0].isoformat() == "2024-01-01"
    assert dim_date(account, datetime(1980, 1, 1)).count() == 0
