import os
from datetime import datetime
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from leadmill.operators.tables import BUCKET, OPEN_FILES, Warehouse, publish
from leadmill.operators.upsert import DuplicateKeyError, keep_stamps, merge_rows
from leadmill.registry import ENTITIES, STAMP
from leadmill.workload.table_queries import side_by_side

from conftest import rows, tables_in

DAY1, DAY2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def frame(spark, data, ddl="k int, v string, p string"):
    return spark.createDataFrame(data, ddl)


def test_merge_rows_stamps(spark):
    old = frame(spark, [(1, "a", DAY1), (2, "b", DAY1)], f"k int, v string, {STAMP} timestamp_ntz")
    new = frame(spark, [(2, "B", None), (3, "C", None)], f"k int, v string, {STAMP} timestamp_ntz")
    assert rows(merge_rows(old, new, "k", DAY2)) == [(1, "a", DAY1), (2, "B", DAY2), (3, "C", DAY2)]
    kept = merge_rows(old, new, "k", DAY2, touch_on_update=False)
    assert rows(kept) == [(1, "a", DAY1), (2, "B", DAY1), (3, "C", DAY2)]


def test_keep_stamps(spark):
    ddl = f"k int, v string, {STAMP} timestamp_ntz"
    old = frame(spark, [(1, "a", DAY1), (2, None, DAY1)], ddl)
    new = frame(spark, [(1, "A", DAY2), (2, None, DAY2), (3, "c", DAY2)], ddl)
    assert rows(keep_stamps(new, old, "k")) == [(1, "A", DAY2), (2, None, DAY1), (3, "c", DAY2)]


@pytest.mark.parametrize("parts", [(), ("p",)])
def test_upsert(spark, databases, parts):
    w = databases
    w.upsert("raw.t", frame(spark, [(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", "z")]), "k", partition_by=parts)
    w.upsert("raw.t", frame(spark, [(3, "C", "x"), (5, "e", "w"), (2, "B", None)]), "k", partition_by=parts)
    want = [(1, "a", "x"), (2, "B", None), (3, "C", "x"), (4, "d", "z"), (5, "e", "w")]
    assert rows(w.read("raw.t")) == want
    w.upsert("raw.t", frame(spark, [(2, "b2", "z")]), "k", partition_by=parts)
    assert rows(w.read("raw.t").where("k = 2")) == [(2, "b2", "z")]
    assert tables_in(spark, "raw") == ["t"]
    if parts:
        assert {r[0] for r in w.read("raw.t").select("p").distinct().collect()} == {"x", "w", "z"}


def test_tables_cut_by_key(spark, databases):
    w = Warehouse(spark, buckets=4)
    data = [(i, f"v{i}", i % 5) for i in range(40)]
    w.upsert("raw.t", frame(spark, data, "k int, v string, d int"), "k", bucket_key="k")
    assert w.partition_columns("raw.t") == [BUCKET] and w.read("raw.t").columns == ["k", "v", "d"]
    assert w.bucketing("raw.t") == (4, "k")
    files = lambda: {tuple(r) for r in spark.table("raw.t").select(BUCKET, "_metadata.file_path").distinct().collect()}
    before = files()
    w.upsert("raw.t", frame(spark, [(7, "new", 1)], "k int, v string, d int"), "k")
    rewritten = {b for b, _ in files() - before}
    assert len(rewritten) == 1 and w.read("raw.t").where("k = 7").first()["v"] == "new"
    keys = frame(spark, [(8,), (9,), (99,)], "k int")
    w.replace_keys("raw.t", frame(spark, [(8, "a", 0), (8, "b", 0)], "k int, v string, d int"), keys, "k")
    assert rows(w.read("raw.t").where("k in (8, 9)").select("v")) == [("a",), ("b",)]
    assert w.read("raw.t").count() == 40
    w.upsert("raw.t", frame(spark, [(1, 2)], "k int, extra int"), "k", on_schema_change="sync_all_columns")
    assert w.read("raw.t").columns == ["k", "extra"] and w.bucketing("raw.t") == (4, "k")
    w.replace_keys("raw.t", frame(spark, [], "k int, extra int"), w.read("raw.t").select("k").distinct(), "k")
    assert w.read("raw.t").count() == 0 and spark.table("raw.t").select(BUCKET).distinct().count() == 0


def test_forget(spark, databases):
    w = databases
    ddl = f"k int, v string, {STAMP} timestamp_ntz"
    w.upsert("raw.t", frame(spark, [(1, "a", DAY1)], ddl), "k")
    w.upsert("raw.t", frame(spark, [(1, "b", DAY2)], ddl), "k", track=DAY2)
    w.forget("raw.t", DAY1)
    assert w.read("raw.t__before").count() == 1
    w.forget("raw.t", DAY2)
    assert w.read("raw.t__before").count() == 0


def test_untouched_partitions_are_left_alone(spark, databases):
    w = databases
    w.upsert("raw.t", frame(spark, [(1, "a", "x"), (2, "b", "y")]), "k", partition_by=("p",))
    files = lambda: {r[0] for r in w.read("raw.t").where("p = 'y'").select("_metadata.file_path").collect()}
    before = files()
    w.upsert("raw.t", frame(spark, [(1, "A", "x")]), "k", partition_by=("p",))
    assert files() == before


def test_duplicate_source_keys(spark, databases):
    w = databases
    data = frame(spark, [(1, "a", DAY1), (1, "b", DAY2)], f"k int, v string, {STAMP} timestamp_ntz")
    with pytest.raises(DuplicateKeyError):
        w.upsert("raw.t", data, "k")
    w.upsert("raw.t", data, "k", on_duplicate_key="latest")
    assert rows(w.read("raw.t").select("k", "v")) == [(1, "b")]
    with pytest.raises(DuplicateKeyError):
        w.upsert("raw.t", data, "k")
    assert rows(w.read("raw.t").select("k", "v")) == [(1, "b")]


def test_schema_change(spark, databases):
    w = databases
    w.upsert("raw.t", frame(spark, [(1, "a", "x")]), "k")
    changed = frame(spark, [(2, "b", 7)], "k int, v string, n int")
    w.upsert("raw.t", changed, "k")
    assert rows(w.read("raw.t")) == [(1, "a", "x"), (2, "b", None)]
    w.upsert("raw.t", changed, "k", on_schema_change="sync_all_columns")
    assert w.read("raw.t").columns == ["k", "v", "n"]
    assert rows(w.read("raw.t")) == [(1, "a", None), (2, "b", 7)]


def test_only_changes_and_track(spark, databases):
    w = databases
    ddl = f"k int, v string, {STAMP} timestamp_ntz"
    w.upsert("raw.t", frame(spark, [(1, "a", DAY1), (2, "b", DAY1)], ddl), "k")
    w.upsert("raw.t", frame(spark, [(1, "a", DAY2), (2, "B", DAY2)], ddl), "k", only_changes=True, track=DAY2)
    assert rows(w.read("raw.t")) == [(1, "a", DAY1), (2, "B", DAY2)]
    assert rows(w.changed_since("raw.t", STAMP, F.lit(DAY1))) == [(2, "B", DAY2), (2, "b", DAY1)]


@pytest.mark.parametrize("mode", ["replace", "upsert"])
def test_publish(spark, databases, mode):
    w, spec = databases, ENTITIES["campaign"]
    first = spark.createDataFrame(
        [("1", "one", DAY1, None, "Planned", None), ("2", "two", DAY1, DAY2, None, None)], spec.schema()
    )
    publish(w, spec, first, mode=mode, loaded_at=DAY1)
    assert w.partition_columns("raw.campaign") == ["status", "start_month"]
    second = spark.createDataFrame([("1", "one", DAY1, None, "Completed", None)], spec.schema())
    publish(w, spec, second, mode=mode, loaded_at=DAY2)
    got = rows(w.read("raw.campaign").select("campaign_id", "status", STAMP))
    kept = [("2", None, DAY1)] if mode == "upsert" else []
    assert got == [("1", "Completed", DAY2), *kept]


def test_recovery_after_a_lost_driver(spark, databases):
    """The next version is complete, the table is out of the catalog, its folder holds half a file."""
    w = databases
    w.write("raw.t", spark.range(3).withColumn("p", F.col("id") % 2), ["p"])
    w.write("raw.t__next", spark.range(5).withColumn("p", F.col("id") % 2), ["p"])
    folder = spark.sql("DESCRIBE EXTENDED raw.t").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    w.drop("raw.t")
    os.makedirs(f"{folder}/p=0", exist_ok=True)
    with open(f"{folder}/p=0/part-0.parquet", "wb") as half:
        half.write(b"PAR1")
    w.upsert("raw.t", spark.createDataFrame([(9, 1)], "id long, p long"), "id", partition_by=["p"])
    assert rows(w.read("raw.t").select("id")) == [(i,) for i in (0, 1, 2, 3, 4, 9)]
    assert tables_in(spark, "raw") == ["t"]


def test_a_delta_writes_its_rows_once(spark, databases):
    w = Warehouse(spark, buckets=4)
    w.upsert("raw.t", spark.range(1000).withColumn("v", F.lit(0)), "id", bucket_key="id")
    before = {r[0] for r in spark.table("raw.t").select(F.input_file_name()).distinct().collect()}
    written = []
    plain = Warehouse.write
    try:
        Warehouse.write = lambda self, table, df, *a, **k: (written.append(table), plain(self, table, df, *a, **k))[1]
        w.upsert("raw.t", spark.createDataFrame([(3, 7)], "id long, v int"), "id")
    finally:
        Warehouse.write = plain
    after = {r[0] for r in spark.table("raw.t").select(F.input_file_name()).distinct().collect()}
    assert not any(t.endswith("__next") for t in written)
    assert len(before & after) == 3, "only one of four parts is rewritten"
    assert w.read("raw.t").agg(F.sum("v"), F.count("*")).first() == (7, 1000)


@pytest.mark.parametrize("gather", [True, False])
def test_replaced_rows_are_computed_once(spark, databases, monkeypatch, gather):
    w = Warehouse(spark, buckets=4, gather=gather)
    w.replace("raw.t", frame(spark, [(k, "old") for k in range(40)], "k int, v string"), bucket_key="k")
    computed, written = spark.sparkContext.accumulator(0), []

    def note(part):
        for batch in part:
            computed.add(batch.num_rows)
            yield batch

    source = frame(spark, [(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    source = source.mapInArrow(note, source.schema)
    plain = Warehouse.write
    monkeypatch.setattr(Warehouse, "write", lambda self, table, *a, **b: written.append(table) or plain(self, table, *a, **b))
    w.replace_keys("raw.t", source, frame(spark, [(1,), (2,), (3,)], "k int"), "k")
    assert computed.value == 3 and "raw.t__delta" not in written
    assert rows(w.read("raw.t").where("k < 5")) == [(0, "old"), (1, "a"), (1, "b"), (2, "c"), (4, "old")]
    every = w.read("raw.t").select("k").distinct()
    w.replace_keys("raw.t", frame(spark, [(7, "x")], "k int, v string"), every, "k")
    assert rows(w.read("raw.t")) == [(7, "x")] and spark.table("raw.t").select(BUCKET).distinct().count() == 1
    w.replace("raw.t", frame(spark, [(8, "y")], "k int, v string"))
    assert rows(w.read("raw.t")) == [(8, "y")] and tables_in(spark, "raw") == ["t"]


def test_only_tables_with_readers_keep_versions():
    from leadmill.plans.build import is_read
    from leadmill.plans.models import DIMENSION_MODELS, FACT_MODELS

    assert not [m.name for m in FACT_MODELS.values() if is_read(m)]
    assert is_read(DIMENSION_MODELS["dim_opportunity"])


def test_a_stored_source_is_not_copied(spark, databases, monkeypatch):
    w, written = databases, []
    w.upsert("raw.t", frame(spark, [(1, "a", "x"), (2, "b", "x")]), "k")
    w.write("raw.source", frame(spark, [(2, "B", "y"), (3, "c", "y")]))
    write = Warehouse.write
    monkeypatch.setattr(Warehouse, "write", lambda self, table, *args, **kw: written.append(table) or write(self, table, *args, **kw))
    w.upsert("raw.t", spark.table("raw.source"), "k", stored=True)
    assert "raw.t__delta" not in written
    assert rows(w.read("raw.t")) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "y")]


@pytest.mark.parametrize("gone", [1, 39])
def test_rows_that_stay_are_told_by_the_shorter_list(spark, databases, monkeypatch, gone):
    w, joins = Warehouse(spark, buckets=2), []
    data = [(i, f"v{i}", "old") for i in range(40)] + [(None, "no key", "old")]
    w.replace("raw.t", frame(spark, data), bucket_key="k")
    keys = frame(spark, [(i,) for i in range(gone)], "k int")
    join = type(keys).join
    monkeypatch.setattr(type(keys), "join", lambda self, other, on=None, how=None: joins.append((how, self.columns)) or join(self, other, on, how))
    w.replace_keys("raw.t", frame(spark, [(0, "n1", "new"), (0, "n2", "new")]), keys, "k")
    assert [how for how, columns in joins if "v" in columns and "key_bucket" not in columns] == ["left_semi" if gone > 20 else "left_anti"]
    want = [(0, "n1", "new"), (0, "n2", "new")] + [r for r in data if r[0] is None or r[0] >= gone]
    assert rows(w.read("raw.t")) == sorted(want, key=repr)


def test_tables_halve_hashes(spark, databases):
    w = Warehouse(spark, buckets=2, gather=False)
    hashes = spark.range(20_000).selectExpr("id AS k", "md5(CAST(id AS STRING)) AS v", "'x' AS p")
    w.replace("raw.t", hashes, bucket_key="k")
    w.replace_keys("raw.t", hashes, hashes.select("k"), "k")
    files = [r[0] for r in spark.table("raw.t").select("_metadata.file_path").distinct().collect()]
    assert files and sum(os.path.getsize(f.removeprefix("file:")) for f in files) < 20_000 * 30


def test_unique_keys_are_checked_by_hash(spark, databases, monkeypatch):
    from leadmill.operators import upsert

    counted, duplicates = [], upsert.duplicate_keys
    monkeypatch.setattr(upsert, "duplicate_keys", lambda df, key: counted.append(key) or duplicates(df, key))
    upsert.single_source_rows(frame(spark, [(1, "a", "x"), (None, "b", "x"), (None, "c", "x")]), "k")
    assert counted == ["hash"]


def test_tables_written_side_by_side_leave_the_session_as_it_was(spark, databases):
    """The setting for open files is the session's; the second of two writers must not put back the first one's."""
    w = Warehouse(spark, buckets=4, gather=False)
    before = spark.conf.get(OPEN_FILES)
    first, second = w._open_files(4), w._open_files(3)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(OPEN_FILES) == "3"
    second.__exit__(None, None, None)
    assert spark.conf.get(OPEN_FILES) == before


def test_inputs_load_side_by_side():
    both = Barrier(2, timeout=10)
    assert side_by_side(lambda name: (both.wait(), name)[1], ["a", "b"]) == ["a", "b"]


def test_tasks_may_open_more_files_than_there_are_buckets(spark, databases, monkeypatch):
    """With the last file that a task may open, Spark begins to sort all rows that follow."""
    w = Warehouse(spark, buckets=4, gather=False)
    opened, plain = [], Warehouse._open_files
    monkeypatch.setattr(Warehouse, "_open_files", lambda self, n: opened.append(n) or plain(self, n))
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    w.replace("raw.few", rows, bucket_key="k")
    w.replace("raw.few", rows.withColumn("v", F.col("v") + 1), bucket_key="k")
    files = spark.table("raw.few").select(BUCKET).distinct().count()
    assert files == 4 and len(opened) == 2 and min(opened) > files
    assert w.read("raw.few").agg(F.sum("v")).first()[0] == 5050
