"""Registered queries that go through tables of the catalog: upserts, replaced keys, moved partitions, streams, deltas.

Each query has a database of its own below the shared scratch folder, so it touches no table of anyone else.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadmill.operators.tables import Warehouse
from leadmill.plans.build import run_model
from leadmill.plans.flow import AT_ONCE
from leadmill.plans.models import DIMENSION_MODELS, FACT_MODELS, MARKETING, MODELS_BY_REF, ModelSpec
from leadmill.session import scratch_dir
from leadmill.streaming.ingest import ingest
from leadmill.workload.flow_queries import _BATCH, land_mixed
from leadmill.workload.operator_queries import EXTRA, OPP
from leadmill.workload.queries import Tables, register
from leadmill.workload.views import AS_OF

# Parts of tables that are cut by key; the given tables are small.
BUCKETS = 4
# Staging models that take a join. The others are row by row, so reading them again costs less than a copy.
JOINED = ("staging.email_engagement",)


def own_database(spark: SparkSession) -> str:
    name = f"leadmill_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, 'database')}'")
    return name


def own_warehouse(t: Tables) -> tuple[Warehouse, str]:
    return Warehouse(t.spark, (), BUCKETS, gather=False), own_database(t.spark)


_NUMBER = "CAST(opportunity_id AS BIGINT)"
_OPPORTUNITY = "opportunity_id, account_id, stage_name, amount"


def _opportunities(t: Tables) -> tuple[Warehouse, str]:
    """Opportunities as a table with a partition for each stage."""
    warehouse, database = own_warehouse(t)
    table = f"{database}.opportunity"
    warehouse.upsert(table, t("raw.opportunity").selectExpr(*_OPPORTUNITY.split(", ")), "opportunity_id", partition_by=["stage_name"])
    return warehouse, table


@register(
    "table_upsert",
    f"""SELECT opportunity_id, account_id, CASE WHEN {_NUMBER} % 9 = 0 THEN 'Reopened' ELSE stage_name END AS stage_name,
               CASE WHEN {_NUMBER} % 3 = 0 THEN CAST(amount + 1 AS DECIMAL(15,2)) ELSE amount END AS amount
        FROM raw_opportunity
        UNION ALL
        SELECT 'new ' || opportunity_id, account_id, 'Reopened', amount FROM raw_opportunity WHERE {_NUMBER} % 7 = 0""",
)
def table_upsert(t: Tables) -> DataFrame:
    """A third of the rows change, some of them their partition, and others come in."""
    warehouse, table = _opportunities(t)
    old = t("raw.opportunity").selectExpr(*_OPPORTUNITY.split(", "))
    stage = F.when(F.expr(f"{_NUMBER} % 9 = 0"), "Reopened").otherwise(F.col("stage_name"))
    changed = old.where(f"{_NUMBER} % 3 = 0").withColumns({"stage_name": stage, "amount": F.expr("CAST(amount + 1 AS DECIMAL(15,2))")})
    new = old.where(f"{_NUMBER} % 7 = 0").withColumns({"opportunity_id": F.concat(F.lit("new "), "opportunity_id"), "stage_name": F.lit("Reopened")})
    warehouse.upsert(table, changed.unionByName(new), "opportunity_id", partition_by=["stage_name"])
    return warehouse.read(table)


@register(
    "table_replace_keys",
    f"""SELECT opportunity_id, account_id, stage_name, amount FROM raw_opportunity
        WHERE stage_name <> 'Proposal' AND {_NUMBER} % 5 <> 0
        UNION ALL
        SELECT opportunity_id, account_id, stage_name, CAST(amount * part AS DECIMAL(15,2))
        FROM raw_opportunity, (SELECT 1 AS part UNION ALL SELECT 2) WHERE stage_name <> 'Proposal' AND {_NUMBER} % 5 = 0""",
)
def table_replace_keys(t: Tables) -> DataFrame:
    """Some keys get two rows for one, and all keys of one partition get none, so it is empty."""
    warehouse, table = _opportunities(t)
    old = t("raw.opportunity").selectExpr(*_OPPORTUNITY.split(", "))
    keys = old.where(f"stage_name = 'Proposal' OR {_NUMBER} % 5 = 0")
    twice = keys.where("stage_name <> 'Proposal'").withColumn("part", F.explode(F.array(F.lit(1), F.lit(2))))
    twice = twice.withColumn("amount", F.expr("CAST(amount * part AS DECIMAL(15,2))")).drop("part")
    warehouse.replace_keys(table, twice, keys.select("opportunity_id"), "opportunity_id")
    return warehouse.read(table)


@register(
    "table_moved_partition",
    """SELECT opportunity_id, account_id, CASE stage_name WHEN 'Prospecting' THEN 'Closed Won' ELSE stage_name END AS stage_name, amount
       FROM raw_opportunity""",
)
def table_moved_partition(t: Tables) -> DataFrame:
    """All rows of a partition go to another one."""
    warehouse, table = _opportunities(t)
    moved = t("raw.opportunity").selectExpr(*_OPPORTUNITY.split(", ")).where("stage_name = 'Prospecting'")
    warehouse.upsert(table, moved.withColumn("stage_name", F.lit("Closed Won")), "opportunity_id", partition_by=["stage_name"])
    return warehouse.read(table)


@register(
    "stream_mixed_batches",
    f"""SELECT opportunity_id, opportunity_name, account_id,
               CASE WHEN source_note <> '3-MEDIUM' THEN stage_name END AS stage_name,
               TRY_CAST(amount AS DECIMAL(15,2)) AS amount, close_date, CAST(NULL AS VARCHAR) AS campaign_id, created_date,
               CASE source_note {_BATCH} END AS batch_id
        FROM cleaned_opportunity WHERE source_note <> '5-LOW'""",
    EXTRA,
)
def stream_mixed_batches(t: Tables) -> DataFrame:
    """Batches that differ in types and columns, upserted as a stream of a few files at a time."""
    warehouse, database = own_warehouse(t)
    ingest(warehouse, land_mixed(t), OPP, scratch_dir(t.spark, "ingest-checkpoint"), lambda: AS_OF, database, at_once=2)
    return warehouse.read(f"{database}.{OPP.name}").select(*OPP.fields, "batch_id")


def side_by_side(job: Callable, names: Iterable[str]) -> list:
    """Results of a job for each name, in their order; tables of different names load at the same time."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(job, names))


def delta_run(t: Tables, spec: ModelSpec) -> DataFrame:
    """A model's table after a full build and a delta run, over input tables whose rows come in two loads.

    A quarter of an input's rows come with the second load, and another quarter come twice, at first with nothing
    but their keys. Rows' stamps have nothing to do with the loads. The inputs of a load are loaded side by side.
    """
    warehouse, database = own_warehouse(t)
    own = replace(spec, database=database, inputs={name: f"{database}.{name}" for name in spec.inputs}, alias=None)
    whole = {name: t(ref) for name, ref in spec.inputs.items()}

    def load(name: str) -> tuple[DataFrame, str] | None:
        """The first load of an input; its second one and key, where it has one."""
        rows, ref = whole[name], spec.inputs[name]
        key = MODELS_BY_REF[ref].key
        if key is None:
            warehouse.replace(f"{database}.{name}", rows)
            return None
        if ref.startswith(f"{MARKETING}.") or ref in JOINED:
            # What takes joins to derive is derived once; the loads read it several times.
            warehouse.write(f"{database}.{name}__rows", rows)
            rows = t.spark.table(f"{database}.{name}__rows")
        share = F.pmod(F.xxhash64(key), F.lit(4))
        kept = (key, spec.driver_key) if name == spec.driver else (key,)
        first = [F.col(c) if c in kept else F.when(share > 1, F.col(c)).alias(c) for c in rows.columns]
        warehouse.upsert(f"{database}.{name}", rows.where(share > 0).select(*first), key, bucket_key=key)
        return rows.where(share < 2), key

    def load_again(name: str) -> None:
        if second[name]:
            rows, key = second[name]
            warehouse.upsert(f"{database}.{name}", rows, key, track=AS_OF, stored=True)

    second = dict(zip(whole, side_by_side(load, whole)))
    run_model(warehouse, own, AS_OF)
    side_by_side(load_again, whole)
    run_model(warehouse, own, AS_OF)
    return warehouse.read(own.table)


for _spec in [*DIMENSION_MODELS.values(), *FACT_MODELS.values()]:
    if _spec.driver and not _spec.full_refresh:
        register(f"delta_{_spec.name}", f"SELECT * FROM {_spec.name}")(lambda t, spec=_spec: delta_run(t, spec))
