"""Registered queries: each reads the given tables whole and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadmill.plans.models import DIMENSION_MODELS, FACT_MODELS, STAGING_MODELS, derive
from leadmill.session import compact, tune
from leadmill.workload.oracle import with_ctes
from leadmill.workload.views import AS_OF, BaseTables, view

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class RawViews(dict):
    """Raw marketing tables, each made when it is first asked for."""

    def __init__(self, base: BaseTables):
        super().__init__()
        self.base = base

    def __missing__(self, name: str) -> DataFrame:
        self[name] = view(self.base, name)
        return self[name]


class Tables:
    """Tables by reference (``raw.x``, ``staging.x``, ``marketing.x``), derived from the raw views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = compact(tune(spark))
        self.base = BaseTables(spark, sf_dir)
        self.raw, self._memo = RawViews(self.base), {}

    def __call__(self, ref: str) -> DataFrame:
        return derive(ref, self.raw, AS_OF, self._memo)


def register(name: str, oracle: str | None = None, extra: dict[str, str] | None = None):
    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLE[name] = with_ctes(oracle, extra)
        return fn

    return wrap


for _name in STAGING_MODELS:
    register(f"staging_{_name}", f"SELECT * FROM stg_{_name}")(lambda t, n=_name: t(f"staging.{n}"))
for _name in [*DIMENSION_MODELS, *FACT_MODELS]:
    register(_name, f"SELECT * FROM {_name}")(lambda t, n=_name: t(f"marketing.{n}"))
