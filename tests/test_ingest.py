"""Landed batch folders into raw tables, as a batch job and as a stream."""

import json
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from leadmill.operators.rejects import write_reject_log
from leadmill.plans.flow import clean_all, load_all, load_batch, read_state, watermark_of, write_clean_batches
from leadmill.registry import ENTITIES, STAMP
from leadmill.sources import batches
from leadmill.sources.batches import added_files, by_footer, change_summary, discover_batches, list_files, read_cleaned, read_entity
from leadmill.streaming.ingest import ingest

B1, B2, B3 = "2025-05-31_123456", "2025-06-01_000000", "2025-06-02_000000"
NS = 1_700_000_000_000_000_000


def land(root, batch, amounts, created=NS, **extra):
    """One batch of opportunities with nanosecond times: id -> amount text."""
    folder = root / batch
    folder.mkdir(parents=True, exist_ok=True)
    n = len(amounts)
    table = pa.table(
        {
            "OPPORTUNITY_ID": list(amounts), "OPPORTUNITY_NAME": [f"deal {batch}"] * n, "ACCOUNT_ID": ["a"] * n,
            "STAGE_NAME": ["Proposal"] * n, "AMOUNT": list(amounts.values()),
            "CLOSE_DATE": pa.array([created] * n, pa.timestamp("ns")), "CAMPAIGN_ID": ["c"] * n,
            "CREATED_DATE": pa.array([created] * n, pa.timestamp("ns")), **{k: [v] * n for k, v in extra.items()},
        }
    )
    pq.write_table(table, folder / "opportunity.parquet", version="2.6")


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    land(root, B1, {"1": "10.00", "2": "20.50"})
    land(root, B2, {"2": "25.00", "3": "oops"})
    land(root, "not_a_batch", {"9": "1"})
    return root


AT1, AT2 = datetime(2025, 6, 1, 1), datetime(2025, 6, 2, 1)


def test_listing_and_scan(spark, landing):
    files = list_files(spark, str(landing), "opportunity")
    assert files.count() == 3 and files.where("file_size > 0").count() == 3
    assert [r["batch_id"] for r in discover_batches(files).collect()] == [B1, B2]
    assert added_files(spark, str(landing), "opportunity", datetime(2000, 1, 1)).count() == 3
    assert added_files(spark, str(landing), "opportunity", datetime(2100, 1, 1)).count() == 0
    assert change_summary(files).first()["num_files"] == 3
    df = read_entity(spark, str(landing), "opportunity")
    assert rows(df.groupBy("batch_id").count()) == [(B1, 2), (B2, 2)]
    newer = read_entity(spark, str(landing), "opportunity", after=B1)
    assert rows(newer.select("OPPORTUNITY_ID")) == [("2",), ("3",)]
    scan = newer._jdf.queryExecution().executedPlan()
    newer.collect()
    assert dict(df.dtypes)["CREATED_DATE"] == "bigint"
    assert "file_path" in scan.toString()


def state_of(warehouse):
    cols = ("opportunity_id", "opportunity_name", "amount", STAMP)
    return [tuple(str(v) for v in r) for r in warehouse.read("raw.opportunity").select(*cols).orderBy(cols[0]).collect()]


def test_load_all(spark, databases, landing):
    w = databases
    results, summary = load_all(w, str(landing), AT1, entities=("opportunity", "lead"))
    assert summary.first().asDict() == dict(
        tables_processed=2, tables_successful=2, tables_with_new_files=1, load_success=1, total_files_loaded=2
    )
    assert results.where("table = 'lead'").first()["load_status"] == "skipped"
    assert state_of(w) == [
        ("1", f"deal {B1}", "10.00", str(AT1)), ("2", f"deal {B2}", "25.00", str(AT1)),
        ("3", f"deal {B2}", "None", str(AT1)),
    ]
    errors = w.read("raw.load_errors").select("entity", "message", "count", "batch_id").collect()
    assert [tuple(r) for r in errors] == [("opportunity", "cannot read amount as decimal(15,2)", 1, B2)]
    assert watermark_of(w, "opportunity") == B2 and watermark_of(w, "lead") is None

    # Nothing new, then a batch with an update; a failed table keeps its watermark.
    _, summary = load_all(w, str(landing), AT2, entities=("opportunity",))
    assert summary.first()["total_files_loaded"] == 0
    land(landing, B3, {"1": "11.00", "4": "40.00"})
    load_all(w, str(landing), AT2, entities=("opportunity",), touch_on_update=False)
    assert state_of(w) == [
        ("1", f"deal {B3}", "11.00", str(AT1)), ("2", f"deal {B2}", "25.00", str(AT1)),
        ("3", f"deal {B2}", "None", str(AT1)), ("4", f"deal {B3}", "40.00", str(AT2)),
    ]
    assert watermark_of(w, "opportunity") == B3
    assert read_state(w).count() == 1


def test_unset_times_are_dropped(spark, databases, tmp_path):
    w, root = databases, tmp_path / "landing"
    land(root, B1, {"1": "1.00"}, created=0)
    land(root, B2, {"2": "2.00"})
    load_all(w, str(root), AT1, entities=("opportunity",))
    assert [r[0] for r in state_of(w)] == ["2"]


def test_corrupt_files_are_listed(spark, databases, landing):
    w = databases
    (landing / B3).mkdir()
    (landing / B3 / "opportunity.parquet").write_bytes(b"not parquet at all, but long enough to look")
    results, _ = load_all(w, str(landing), AT1, entities=("opportunity",))
    assert results.first()["status"] == "error" and watermark_of(w, "opportunity") is None
    results, _ = load_all(w, str(landing), AT1, entities=("opportunity",), skip_corrupt=True)
    assert results.first()["status"] == "success" and len(state_of(w)) == 3
    errors = rows(w.read("raw.load_errors").select("message", "batch_id"))
    assert errors == [("cannot read amount as decimal(15,2)", B2), ("unreadable file", B3)]


def test_clean_all(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    run = clean_all(spark, str(landing), out, entities=("opportunity", "lead"))
    assert [r.ok for r in run.reports] == [True] and run.newest == B2
    assert run.skipped == ["lead"] and run.errors == {}
    land(landing, B3, {"1": "11.00"}, EXTRA="x")
    run = clean_all(spark, str(landing), out, after=run.newest, entities=("opportunity",))
    assert run.reports[0].extra == ["extra"] and run.newest == B3
    got = read_cleaned(spark, out, "opportunity")
    assert rows(got.groupBy("batch_id").count()) == [(B1, 2), (B2, 2), (B3, 1)]
    assert rows(read_cleaned(spark, out, "opportunity", B2).select("batch_id")) == [(B3,)]


def test_stream_equals_batch(spark, databases, landing, tmp_path):
    w, checkpoint = databases, str(tmp_path / "checkpoint")
    spec = ENTITIES["opportunity"]

    def run(at):
        ingest(w, str(landing), spec, checkpoint, loaded_at=lambda: at)

    run(AT1)
    first = state_of(w)
    assert [r[:3] for r in first] == [("1", f"deal {B1}", "10.00"), ("2", f"deal {B2}", "25.00"), ("3", f"deal {B2}", "None")]
    run(AT2)
    assert state_of(w) == first, "no new files, nothing happens"
    land(landing, B3, {"3": "30.00"})
    run(AT2)
    assert state_of(w)[2] == ("3", f"deal {B3}", "30.00", str(AT2))
    assert state_of(w)[:2] == first[:2]
    assert w.read("raw.load_errors").count() == 1


def test_clean_batches_and_reject_log(spark, landing, tmp_path):
    out = str(tmp_path / "clean")
    raw = read_entity(spark, str(landing), "opportunity")
    for _ in range(2):
        write_clean_batches(ENTITIES["opportunity"], raw, out)
    clean = spark.read.parquet(f"{out}/opportunity")
    assert rows(clean.groupBy("batch_id").count()) == [(B1, 2), (B2, 2)]
    assert dict(clean.dtypes)["created_date"] == "timestamp_ntz"
    log = tmp_path / "log"
    write_reject_log(clean.select(F.lit("f").alias("file_path"), F.lit(2).alias("count")).limit(1), str(log))
    (part,) = log.glob("part-*.json")
    assert json.loads(part.read_text()) == {"file_path": "f", "count": 2}


def test_one_broken_part_of_a_folder_is_listed_and_not_counted(spark, databases, tmp_path):
    root = tmp_path / "landing"
    land(root, B1, {"1": "1.00"})
    land(root, B2, {"2": "2.00"})
    land(root, B3, {})
    whole = root / B1 / "opportunity.parquet"
    parts = root / B1 / "parts"
    parts.mkdir()
    whole.rename(parts / "part-0.parquet")
    (root / B2 / "opportunity.parquet").rename(parts / "part-1.parquet")
    (parts / "part-2.parquet").write_bytes(b"PAR1 no parquet at all PAR1")
    parts.rename(whole)
    (root / B2).rmdir()
    results, _ = load_all(databases, str(root), AT1, entities=("opportunity",), skip_corrupt=True)
    row = results.first()
    assert (row["status"], row["new_files"], row["loaded_files"]) == ("success", 4, 3)
    assert [r[0] for r in state_of(databases)] == ["1", "2"]
    # The empty file of the last batch is no broken one.
    errors = rows(databases.read("raw.load_errors").select("file_path", "message", "batch_id"))
    assert [(e[0].rsplit("/", 1)[1], *e[1:]) for e in errors] == [("part-2.parquet", "unreadable file", B1)]


def test_batches_of_other_types_load_together(spark, databases, landing):
    folder = landing / B3
    folder.mkdir()
    when = [datetime(2025, 6, 2)]
    odd = pa.table(
        {
            "opportunity_id": ["5"], "AMOUNT": pa.array([7.5], pa.float64()), "CLOSE_DATE": pa.array(when, pa.timestamp("us")),
            "CREATED_DATE": pa.array(when, pa.timestamp("us")), "STAGE_NAME": ["Proposal"],
        }
    )
    pq.write_table(odd, folder / "opportunity.parquet")
    results, _ = load_all(databases, str(landing), AT1, entities=("opportunity",))
    assert results.first()["status"] == "success", results.first()["error"]
    assert [r[:3] for r in state_of(databases)][-1] == ("5", "None", "7.50")
    assert databases.read("raw.opportunity").where("opportunity_id = '5'").first()["close_date"] == when[0]


def test_old_broken_files_are_not_opened(spark, landing):
    (landing / B1 / "opportunity.parquet").write_bytes(b"broken since")
    newer = read_entity(spark, str(landing), "opportunity", after=B1)
    assert rows(newer.select("OPPORTUNITY_ID")) == [("2",), ("3",)]
    with pytest.raises(ValueError, match="unreadable"):
        read_entity(spark, str(landing), "opportunity")


def test_each_batch_is_judged_by_its_own_columns(spark, landing, tmp_path):
    folder = landing / B3
    folder.mkdir()
    table = pq.read_table(landing / B2 / "opportunity.parquet").drop_columns(["CAMPAIGN_ID"])
    pq.write_table(table, folder / "opportunity.parquet", version="2.6")
    run = clean_all(spark, str(landing), str(tmp_path / "out"), entities=("opportunity",))
    assert [(r.batches, r.missing) for r in run.reports] == [((B1, B2), []), ((B3,), ["campaign_id"])]


def test_cleaned_batches_keep_columns_that_come_later(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    land(landing, B3, {"1": "11.00"}, EXTRA="x")
    clean_all(spark, str(landing), out, entities=("opportunity",))
    got = read_cleaned(spark, out, "opportunity")
    assert rows(got.select("batch_id", "extra")) == sorted([(B1, None)] * 2 + [(B2, None)] * 2 + [(B3, "x")], key=repr)


def test_a_failing_entity_does_not_stop_the_others(spark, landing, tmp_path):
    (landing / B1 / "lead.parquet").write_bytes(b"broken")
    run = clean_all(spark, str(landing), str(tmp_path / "out"), entities=("lead", "opportunity"))
    assert list(run.errors) == ["lead"] and run.newest is None
    assert read_cleaned(spark, str(tmp_path / "out"), "opportunity").count() == 4


def test_rejects_of_a_corrected_file_go(spark, databases, landing):
    w, spec = databases, ENTITIES["opportunity"]
    load = lambda at: load_batch(w, spec, read_entity(spark, str(landing), "opportunity"), at)
    load(AT1)
    assert w.read("raw.load_errors").count() == 1
    land(landing, B2, {"2": "25.00", "3": "3.00"})
    spark.catalog.clearCache()
    load(AT2)
    assert w.read("raw.load_errors").count() == 0
    # Two files of one batch that come one after the other keep a line each.
    for name in ("a", "b"):
        raw = read_entity(spark, str(landing), "opportunity", after=B1).withColumn("AMOUNT", F.lit("bad"))
        load_batch(w, spec, raw.withColumn("file_path", F.concat("file_path", F.lit(f"/part-{name}.parquet"))), AT2)
    assert w.read("raw.load_errors").count() == 2


def test_an_older_batch_does_not_undo_a_newer_one(spark, databases, landing, tmp_path):
    w, spec, checkpoint = databases, ENTITIES["opportunity"], str(tmp_path / "checkpoint")
    land(landing, B3, {"1": "30.00"})
    ingest(w, str(landing), spec, checkpoint, loaded_at=lambda: AT1)
    streamed = state_of(w)
    late = "2025-05-31_235959"
    land(landing, late, {"1": "20.00", "2": "9.00"})
    ingest(w, str(landing), spec, checkpoint, loaded_at=lambda: AT2)
    assert state_of(w) == streamed
    assert rows(w.read("raw.opportunity").select("opportunity_id", "batch_id")) == [("1", B3), ("2", B2), ("3", B2)]
    w.drop("raw.opportunity")
    w.drop("raw.load_errors")
    load_all(w, str(landing), AT1, entities=("opportunity",))
    assert state_of(w) == streamed


def test_rejects_go_to_the_log(spark, databases, landing, tmp_path, caplog):
    load_all(databases, str(landing), AT1, entities=("opportunity",), reject_log=str(tmp_path / "log"))
    assert "cannot read amount" in caplog.text
    (part,) = (tmp_path / "log").glob("part-*.json")
    assert json.loads(part.read_text())["batch_id"] == B2


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_footers_are_read_by_one_job(spark, tmp_path, monkeypatch):
    root = tmp_path / "many"
    for i in range(30):
        land(root, f"2025-06-{i + 1:02}_000000", {"1": "1", "2": "2"}, **({"EXTRA": "x"} if i % 3 == 0 else {}))
    paths = [str(p) for p in root.glob("*/opportunity.parquet")]
    asked, infer = [], batches._inferred
    monkeypatch.setattr(batches, "_inferred", lambda spark, path: asked.append(path) or infer(spark, path))
    found, jobs = jobs_of(spark, "footers", lambda: by_footer(spark, paths))
    assert jobs <= 2 and len(asked) == 2  # the job may shuffle the names first; schemas are inferred in other threads
    assert [len(files) for _, files in found.groups] == [10, 20] and found.unreadable == []
    assert found.rows == dict.fromkeys(paths, 2)
    for schema, files in found.groups:
        for path in files:
            assert spark.read.parquet(path).schema == schema


def test_only_what_is_no_parquet_file_is_unreadable(spark, tmp_path):
    root = tmp_path / "a b%20c+d#e"
    land(root, B1, {"1": "1"})
    good = root / B1 / "opportunity.parquet"
    body = good.read_bytes()
    broken = {
        "empty": b"", "short": b"PAR1", "text": b"not parquet at all, but long enough to look", "cut": body[:-20],
        "long": b"PAR1" + (1 << 30).to_bytes(4, "little") + b"PAR1", "garbled": body[:-60] + b"\xff" * 52 + body[-8:],
    }
    for name, content in broken.items():
        (root / f"{name}.parquet").write_bytes(content)
    found = by_footer(spark, [f"file:{p}" for p in root.glob("*.parquet")] + [f"file:{good}"])
    assert [p.rsplit("/", 1)[1].removesuffix(".parquet") for p, _ in found.unreadable] == sorted(broken)
    assert all(message for _, message in found.unreadable)
    assert [files for _, files in found.groups] == [[f"file:{good}"]] and found.rows == {f"file:{good}": 1}
    # A file that is gone, or a store that Arrow does not know, says nothing about the file.
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        by_footer(spark, [f"file:{root}/gone.parquet"])
    with pytest.raises(Exception, match="nostore"):
        by_footer(spark, ["nostore://host/x.parquet"])
    assert by_footer(spark, []).groups == []


def test_kinds_of_schema(spark, tmp_path):
    """Files whose schemas differ only within a type are told apart."""
    made = {
        "d1": "CAST(1 AS DECIMAL(9,2)) AS v", "d2": "CAST(1 AS DECIMAL(9,3)) AS v", "n": "CAST(1 AS INT) AS v",
        "s": "named_struct('a', 1) AS v", "s2": "named_struct('a', 1L) AS v", "a": "array(1) AS v", "n2": "CAST(2 AS INT) AS v",
        "t": "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS v", "z": "TIMESTAMP '2020-01-01 00:00:00' AS v", "none": "1 AS v LIMIT 0",
    }
    for name, value in made.items():
        spark.sql(f"SELECT {value}").coalesce(1).write.parquet(str(tmp_path / name))
    found = by_footer(spark, [str(tmp_path / name) for name in made])
    for schema, files in found.groups:
        for path in files:
            assert spark.read.parquet(path).schema == schema
    assert sorted(len(files) for _, files in found.groups) == [1, 1, 1, 1, 1, 1, 1, 3]


def test_reject_lines_of_odd_paths_are_replaced(spark, databases, tmp_path):
    root = tmp_path / "a b%20c+d"
    land(root, B1, {"1": "oops"})
    for at in (AT1, AT2):
        load_all(databases, str(root), at, entities=("opportunity",), skip_corrupt=True)
        databases.spark.sql("DROP TABLE IF EXISTS raw.load_state")
    lines = databases.read("raw.load_errors").select("file_path", "message", "count").collect()
    assert [tuple(r) for r in lines] == [(f"file:{root}/{B1}/opportunity.parquet", "cannot read amount as decimal(15,2)", 1)]


def test_the_parts_of_a_landed_file_are_loaded_at_once(spark, databases, tmp_path):
    """A folder of parts is one landed file, however many parts the writer's cores made of it."""
    w, spec, root = databases, ENTITIES["opportunity"], tmp_path / "parts"
    for i, batch in enumerate((B1, B2)):
        rows = spark.range(i * 4, i * 4 + 4, numPartitions=4).select(F.col("id").cast("string").alias("OPPORTUNITY_ID"))
        rows.write.parquet(str(root / batch / "opportunity.parquet"))
    ingest(w, str(root), spec, str(tmp_path / "checkpoint"), loaded_at=lambda: AT1, at_once=2)
    assert w.read("raw.opportunity").count() == 8 and w.newest_load("raw.opportunity") == 1
