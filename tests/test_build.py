"""Incremental builds over two batches: reruns, deltas against full builds, faithful deltas."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows, same_rows, tables_in
from fixtures import frames, random_changes, random_tables
from leadmill.operators.tables import Warehouse
from leadmill.operators.upsert import DuplicateKeyError, merge_rows
from leadmill.plans.build import build, build_all, run_model
from leadmill.plans.models import DIMENSION_MODELS, FACT_MODELS, MODELS_BY_REF, STAGING_MODELS, derive
from leadmill.registry import ENTITIES, STAMP

LOAD1, RUN1 = datetime(2024, 2, 1, 6), datetime(2024, 2, 1, 7)
LOAD2, RUN2 = datetime(2024, 2, 3, 6), datetime(2024, 2, 3, 7)
TABLES = [*[f"staging.{m}" for m in STAGING_MODELS], *[f"marketing.{m}" for m in [*DIMENSION_MODELS, *FACT_MODELS]]]


def load(warehouse: Warehouse, data, at: datetime) -> None:
    for name, df in frames(warehouse.spark, data).items():
        warehouse.upsert(f"raw.{name}", df.drop(STAMP), ENTITIES[name].key, loaded_at=at)


def values(df):
    return df.drop(STAMP)


def test_two_batches_by_affected_keys(spark, databases):
    w = Warehouse(spark, buckets=3)
    load(w, random_tables(5, LOAD1), LOAD1)
    assert build_all(w, RUN1)[:1] == ["staging.account"]
    first = {t: w.read(MODELS_BY_REF[t].table).count() for t in TABLES}
    assert first["staging.email_engagement"] == 80

    # Nothing new: everything stays as it is, stamps included.
    for ref in ("staging.lead", "marketing.dim_contact_engagement", "marketing.dim_campaign_performance"):
        spec = MODELS_BY_REF[ref]
        before = rows(w.read(spec.table))
        run_model(w, spec, RUN1 + timedelta(hours=1))
        assert rows(w.read(spec.table)) == before, ref

    load(w, random_changes(6, LOAD2), LOAD2)
    build_all(w, RUN2)
    raw = {e: w.read(f"raw.{e}") for e in ENTITIES}
    memo = {}
    for table in TABLES:
        want = derive(table, raw, RUN2, memo)
        same_rows(values(w.read(MODELS_BY_REF[table].table)), values(want))

    touched = w.read("marketing.dim_contact_engagement").groupBy(STAMP).count().count()
    assert touched == 2, "some contacts are recomputed, others are left alone"
    leftovers = [t for db in ("raw", "staging", "marketing") for t in tables_in(spark, db)]
    assert not [t for t in leftovers if t.endswith(("__next", "__delta", "__affected", "__keys", "__touched", "__old"))]


def test_both_sides_drops_unchanged_partners(spark, databases):
    w = databases
    contact = "contact_id string, first_name string, last_name string, email string, phone string, created_date timestamp_ntz"
    lead_ddl = ENTITIES["lead"].schema()
    contacts = [("c1", "Ann", "A", None, None, LOAD1)]
    lead = ("l1", "L", "L", None, None, None, "New", "c1", LOAD1)
    w.upsert("raw.contact", spark.createDataFrame(contacts, contact), "contact_id", loaded_at=LOAD1)
    w.upsert("raw.lead", spark.createDataFrame([lead], lead_ddl), "lead_id", loaded_at=LOAD1)
    specs = [STAGING_MODELS["contact"], STAGING_MODELS["lead"], DIMENSION_MODELS["dim_lead"]]
    for spec in specs:
        run_model(w, spec, RUN1)
    assert w.read("marketing.dim_lead").first()["converted_first_name"] == "Ann"

    renamed = spark.createDataFrame([(*lead[:6], "Working", *lead[7:])], lead_ddl)
    w.upsert("raw.lead", renamed, "lead_id", loaded_at=LOAD2)
    for spec in specs:
        run_model(w, spec, RUN2, delta="both_sides")
    row = w.read("marketing.dim_lead").first()
    # The lead is new, its contact is not, so the join sees no contact.
    assert (row["status"], row["converted_first_name"]) == ("Working", None)


def test_business_watermark_skips_late_rows(spark, databases):
    w = databases
    spec = DIMENSION_MODELS["dim_opportunity"]
    for entity in ("account", "campaign"):
        w.upsert(f"raw.{entity}", spark.createDataFrame([], ENTITIES[entity].schema()), ENTITIES[entity].key, loaded_at=LOAD1)
    opportunity = lambda i, close: (i, i, None, None, None, close, None, LOAD1)
    schema = ENTITIES["opportunity"].schema()
    w.upsert("raw.opportunity", spark.createDataFrame([opportunity("1", LOAD1)], schema), "opportunity_id", loaded_at=LOAD1)
    models = [STAGING_MODELS[e] for e in ("account", "campaign", "opportunity")] + [spec]
    for m in models:
        run_model(w, m, RUN1)
    late, due = opportunity("2", LOAD1 - timedelta(days=9)), opportunity("3", LOAD2)
    w.upsert("raw.opportunity", spark.createDataFrame([late, due], schema), "opportunity_id", loaded_at=LOAD2)
    for m in models:
        run_model(w, m, RUN2, delta="both_sides")
    assert [r["opportunity_id"] for r in w.read(spec.table).orderBy("opportunity_id").collect()] == ["1", "3"]


@pytest.mark.parametrize("moved, rebuilt", [(("0", "1", "2", "3"), True), (("0",), False)])
def test_many_affected_keys_recompute_all_rows(spark, databases, monkeypatch, moved, rebuilt):
    """Where most rows are due, none of the old ones is looked for; a few keys leave the others alone."""
    w, spec = Warehouse(spark, buckets=2), DIMENSION_MODELS["dim_opportunity"]
    account = lambda i, name: (i, name, None, None, None, LOAD1)
    opportunity = lambda i: (i, i, str(int(i) % 5), None, None, None, None, LOAD1)
    put = lambda e, rows, at: w.upsert(f"raw.{e}", spark.createDataFrame(rows, ENTITIES[e].schema()), ENTITIES[e].key, loaded_at=at)
    put("campaign", [], LOAD1)
    put("account", [account(str(i), "old") for i in range(5)], LOAD1)
    put("opportunity", [opportunity(str(i)) for i in range(20)], LOAD1)
    models = [STAGING_MODELS[e] for e in ("account", "campaign", "opportunity")] + [spec]
    for m in models:
        run_model(w, m, RUN1)
    put("account", [account(i, "new") for i in moved], LOAD2)
    for m in models[:3]:
        run_model(w, m, RUN2)
    replaced = []
    replace_keys = Warehouse.replace_keys
    monkeypatch.setattr(Warehouse, "replace_keys", lambda self, *a, **k: (replaced.append(a[0]), replace_keys(self, *a, **k)))
    run_model(w, spec, RUN2)
    assert replaced == ([] if rebuilt else [spec.table])
    raw = {e: w.read(f"raw.{e}") for e in ("account", "campaign", "opportunity")}
    same_rows(values(w.read(spec.table)), values(derive("marketing.dim_opportunity", raw, RUN2)))
    # The versions that were replaced are kept for the models that read this one.
    assert w.read(f"{spec.table}__before").count() == (20 if rebuilt else 4)
    assert w.bucketing(spec.table) == (2, "opportunity_id")
    assert w.newest_load(spec.table) == 2


def test_duplicate_model_keys_fail_loudly(spark, databases):
    w = databases
    load(w, random_tables(5, LOAD1), LOAD1)
    build_all(w, RUN1)
    spec = FACT_MODELS["fct_event_performance"]
    with pytest.raises(DuplicateKeyError):
        run_model(w, spec, RUN2, delta="full")
    run_model(w, spec, RUN2, delta="full", on_duplicate_key="latest")


def test_alias_and_schema(spark, databases):
    spec = FACT_MODELS["fact_marketing_performance"]
    assert spec.table == "marketing.FACT_MARKETING_PERFORMANCE"
    assert STAGING_MODELS["lead"].table == "staging.lead"


def test_unknown_delta(spark, databases):
    w = databases
    w.upsert("raw.account", spark.createDataFrame([], ENTITIES["account"].schema()), "account_id", loaded_at=LOAD1)
    build_model = lambda delta: run_model(w, STAGING_MODELS["account"], RUN1, delta)
    build_model("affected_keys")
    with pytest.raises(ValueError):
        build_model("sideways")


def test_rows_committed_late_are_staged(spark, databases):
    """A raw row with a stamp before the last run, committed after it."""
    w, spec = databases, STAGING_MODELS["account"]
    schema = ENTITIES["account"].schema()
    row = lambda i: (i, "name", None, None, None, LOAD1)
    w.upsert("raw.account", spark.createDataFrame([row("1")], schema), "account_id", loaded_at=LOAD1)
    run_model(w, spec, RUN1)
    w.upsert("raw.account", spark.createDataFrame([row("2")], schema), "account_id", loaded_at=RUN1 - timedelta(minutes=30))
    run_model(w, spec, RUN2)
    assert rows(w.read(spec.table).select("account_id")) == [("1",), ("2",)]


def test_loads_committed_out_of_order_are_staged(spark, databases):
    """A load with an earlier stamp that is committed after a later-stamped one was read."""
    w, spec = databases, STAGING_MODELS["account"]
    schema = ENTITIES["account"].schema()
    row = lambda i: (i, "name", None, None, None, LOAD1)

    def load(i, at):
        w.upsert("raw.account", spark.createDataFrame([row(i)], schema), "account_id", loaded_at=at)

    load("1", datetime(2024, 2, 1, 6))
    run_model(w, spec, datetime(2024, 2, 1, 7))
    load("3", datetime(2024, 2, 1, 6, 45))
    run_model(w, spec, datetime(2024, 2, 1, 8))
    load("2", datetime(2024, 2, 1, 6, 30))
    run_model(w, spec, datetime(2024, 2, 1, 9))
    assert rows(w.read(spec.table).select("account_id")) == [("1",), ("2",), ("3",)]


def test_load_numbers_survive_replacement_and_loss_of_rows(spark, databases):
    w, ddl = Warehouse(spark, buckets=2), "k bigint, v string, last_modified_timestamp timestamp_ntz"
    one = lambda k, v: spark.createDataFrame([(k, v, LOAD1)], ddl)
    w.upsert("raw.n", one(1, "a"), "k")
    w.upsert("raw.n", one(2, "b"), "k")
    assert w.newest_load("raw.n") == 2 and w.read("raw.n").columns == ["k", "v", "last_modified_timestamp"]
    w.replace_keys("raw.n", one(9, "z").limit(0), one(2, "b").select("k"), "k")
    w.upsert("raw.n", one(3, "c"), "k")
    assert rows(w.changed_since("raw.n", "load_no", F.lit(2)).select("k")) == [(3,)]
    w.replace("raw.n", w.read("raw.n").unionByName(one(4, "d")), unchanged_by="k")
    assert rows(w.changed_since("raw.n", "load_no", F.lit(4)).select("k")) == [(4,)]


def test_tracked_versions_are_forgotten(spark, databases):
    w = Warehouse(spark, buckets=2)
    load(w, random_tables(5, LOAD1), LOAD1)
    build_all(w, RUN1)
    load(w, random_changes(6, LOAD2), LOAD2)
    build_all(w, RUN2)
    build_all(w, RUN2 + timedelta(hours=1))
    for table in tables_in(spark, "staging"):
        if table.endswith("__before"):
            assert w.read(f"staging.{table}").count() == 0, table
