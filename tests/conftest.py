import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from leadmill.session import build_session

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoint"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def databases(spark):
    """Empty databases and a warehouse over them. Code generation costs more than it saves here."""
    from leadmill.operators.tables import Warehouse

    for db in ("raw", "staging", "marketing"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    off = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    for key, value in off.items():
        spark.conf.set(key, value)
    yield Warehouse(spark, buckets=0)
    for key in off:
        spark.conf.unset(key)


def tables_in(spark, database):
    return sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect())


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_rows(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    a, b = a.select(*cols), b.select(*cols)
    assert a.exceptAll(b).limit(3).collect() == []
    assert b.exceptAll(a).limit(3).collect() == []
