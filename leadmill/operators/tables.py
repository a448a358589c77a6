"""Catalog tables: partitioned writes, replacement, and upserts that rewrite only what they touch.

Plain parquet tables have no MERGE. An upsert first writes its source as a table of its own, and then the
partitions that it changes over the old ones, once: a lost executor costs a task retry, a lost driver
leaves the target as it was or is healed by running the same upsert again.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime
from functools import reduce
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadmill.functions import stamp
from leadmill.operators.conform import with_partitions
from leadmill.operators.upsert import keep_stamps, merge_rows, single_source_rows, sync_columns
from leadmill.registry import STAMP, EntitySpec
from leadmill.session import tune

BEFORE_SUFFIX = "__before"
REPLACED_AT = "replaced_at"
BUCKET = "key_bucket"
BUCKETS_PROPERTY = "leadmill.key_buckets"
BUCKET_KEY_PROPERTY = "leadmill.bucket_key"
# Number of the load that wrote a row, or that replaced a tracked version; and the table's last one.
LOAD = "load_no"
LOADS_PROPERTY = "leadmill.loads"
# Every task can write to so many key buckets at once: no shuffle or sort has to bring a bucket's rows together. Smaller
# row groups keep the open files of a task within 256 MB.
FEW_BUCKETS = 8
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
ROW_GROUP = 32 << 20
# Surrogate keys are hashes in hex, which the default codec leaves as long as they are and this one halves. An option of
# a table holds for all later writes into it.
CODEC = "zstd"


class Warehouse:
    """Tables of the session's catalog.

    ``buckets`` is the number of parts into which a table without partition columns of its own is cut by
    a hash of its key. A delta then rewrites the parts its keys fall into and no others; zero leaves such
    tables whole. The parts are a physical matter: ``read`` does not show them. Without ``gather``, tasks write what they
    have to all of a few parts at once: more files, but no shuffle and sort of whole rows before each write.

    Every write of a table is a load, numbered in the order in which the loads are committed, and rows carry the number
    of the load that wrote them (which ``read`` does not show either). Deltas go by these numbers: unlike stamps they
    say what came after what was read. A table has one writer at a time; within a process a lock sees to that.
    """

    def __init__(
        self,
        spark: SparkSession,
        databases: Sequence[str] = ("raw", "staging", "marketing"),
        buckets: int = 64,
        gather: bool = True,
    ):
        self.spark = tune(spark)
        self.buckets, self.gather = buckets, gather
        self._writers: defaultdict[str, RLock] = defaultdict(RLock)
        self._opening, self._open, self._open_before = RLock(), [], "0"
        for db in databases:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(table)

    def read(self, table: str) -> DataFrame:
        return self.spark.table(table).drop(BUCKET, LOAD)

    def newest_load(self, table: str) -> int:
        """The last load of which the table, or its tracked versions, hold a row; 0 without any."""
        found = 0
        for name in (table, f"{table}{BEFORE_SUFFIX}"):
            if self.exists(name) and LOAD in self.spark.table(name).columns:
                found = max(found, self.spark.table(name).agg(F.max(LOAD)).first()[0] or 0)
        return found

    def _next_load(self, table: str) -> int:
        """A number beyond all that the table has given out. Rows can go, so the last one is noted with the table."""
        noted = self.properties(table).get(LOADS_PROPERTY, "0") if self.exists(table) else "0"
        return max(int(noted), self.newest_load(table)) + 1

    def bucketing(self, table: str) -> tuple[int, str] | None:
        """Number of parts and the key they hash, for a table that is cut by key."""
        found = self.properties(table)
        if BUCKETS_PROPERTY not in found:
            return None
        return int(found[BUCKETS_PROPERTY]), found[BUCKET_KEY_PROPERTY]

    def properties(self, table: str) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}

    def set_properties(self, table: str, **properties: str) -> None:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def partition_columns(self, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(table) if c.isPartition]

    def write(
        self,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        rebalance: bool = True,
        open_files: int = 0,
    ) -> None:
        """Write a table whose input does not read it.

        Rows of a partition are brought together and sorted, so that each partition gets few files
        with narrow value ranges. The rebalancing splits partitions that are too big for one task. With ``open_files``,
        more than there are partitions, tasks write what they have to all of them instead.
        """
        if open_files:
            writer = df.write.mode("overwrite").format("parquet").options(compression=CODEC, **{"parquet.block.size": ROW_GROUP})
            with self._open_files(open_files):
                writer.partitionBy(*partition_by).saveAsTable(table)
            return
        if partition_by and rebalance:
            df = df.hint("rebalance", *partition_by)
        order = [*partition_by, *[c for c in sort_by if c not in partition_by]]
        if order:
            df = df.sortWithinPartitions(*order)
        writer = df.write.mode("overwrite").format("parquet").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(table)

    @contextmanager
    def _open_files(self, n: int) -> Iterator[None]:
        """Lets tasks write to ``n`` partitions at once.

        The setting is the session's, so tables that are written side by side share the largest number, and the last one
        puts back what was there before.
        """
        with self._opening:
            if not self._open:
                self._open_before = self.spark.conf.get(OPEN_FILES)
            self._open.append(n)
            self.spark.conf.set(OPEN_FILES, max(self._open))
        try:
            yield
        finally:
            with self._opening:
                self._open.remove(n)
                self.spark.conf.set(OPEN_FILES, max(self._open) if self._open else self._open_before)

    def _few(self, cut: tuple[int, str] | None, sort_by: Sequence[str]) -> int:
        """How many files a task may have open, if every task is to write to all buckets at once, else 0.

        That is one more than there are buckets: with the last file that it may open, Spark sorts all rows that follow.
        """
        return cut[0] + 1 if not self.gather and cut and cut[0] <= FEW_BUCKETS and not sort_by else 0

    def replace(
        self,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        bucket_key: str | None = None,
        unchanged_by: str | None = None,
        track: datetime | None = None,
    ) -> None:
        """Replace a table, also by rows computed from itself.

        The new rows are complete as ``<table>__next`` before the old ones go. With ``unchanged_by``, a key, rows that
        stay as they are keep their stamp and the number of their load. ``track`` keeps all old rows as replaced versions.
        """
        with self._writers[table]:
            self.recover(table)
            number = self._next_load(table)
            if track is not None and self.exists(table):
                self._track(table, self.spark.table(table), track, number)
            if LOAD not in df.columns:
                df = df.withColumn(LOAD, F.lit(number).cast("bigint"))
                if unchanged_by and self.exists(table) and LOAD in self.spark.table(table).columns:
                    df = keep_stamps(df, self.spark.table(table).drop(BUCKET), unchanged_by, STAMP, LOAD)
            self._replace(table, df, partition_by, sort_by, bucket_key)
            self.set_properties(table, **{LOADS_PROPERTY: str(number)})

    def _replace(
        self, table: str, df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str], bucket_key: str | None
    ) -> None:
        cut = None
        if bucket_key and self.buckets and not partition_by:
            cut = self.buckets, bucket_key
        if self.exists(table):
            cut = self.bucketing(table) or cut
        if cut:
            df, partition_by = in_buckets(df, *cut), [BUCKET]
        few = self._few(cut, sort_by)
        if not self.exists(table):
            self.write(table, df, partition_by, sort_by, open_files=few)
        elif partition_by and self._same_layout(table, df, partition_by):
            self._overwrite(table, df, list(partition_by), sort_by, open_files=few)
        else:
            self.write(f"{table}__next", df, partition_by, sort_by, open_files=few)
            self._swap(table, partition_by, sort_by)
        if cut:
            self.set_properties(table, **{BUCKETS_PROPERTY: str(cut[0]), BUCKET_KEY_PROPERTY: cut[1]})

    def _same_layout(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> bool:
        stored = dict(self.spark.table(table).dtypes)
        return list(partition_by) == self.partition_columns(table) and stored == dict(df.dtypes)

    def _overwrite(
        self,
        table: str,
        new: DataFrame,
        parts: list[str],
        sort_by: Sequence[str],
        before: DataFrame | None = None,
        open_files: int = 0,
    ) -> None:
        """Write the new rows of partitions once, over the old ones, and drop those of ``before`` (all) that got none.

        The rows may come from the table itself: Spark stages them and puts a partition in place when all are
        written. So they are computed once: a partition that still has its old files got no row. Such partitions go by
        name, in one statement for each thousand.
        """
        new = new.select(*self.spark.table(table).columns)
        marks = [F.col(p).alias(f"__{p}") for p in parts]
        inside = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in parts])
        kept = f"{table}__kept"
        self.write(kept, self._files(table).select(*marks, F.col("file_path").alias("__file")).distinct())
        if not open_files:
            new = new.hint("rebalance", *parts).sortWithinPartitions(*parts, *[c for c in sort_by if c not in parts])
        with self._open_files(open_files):
            new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)
        self.spark.catalog.refreshTable(table)
        gone = f"{table}__gone"
        same = self._files(table).join(self.spark.table(kept), inside & (F.col("file_path") == F.col("__file")), "left_semi")
        same = same.select(*parts).distinct()
        if before is not None:
            same = same.join(before.select(*marks).distinct(), inside, "left_semi")
        self.write(gone, same)
        names = []
        for row in self.spark.table(gone).toLocalIterator():
            values = [f"{p} = {'NULL' if row[p] is None else repr(str(row[p]))}" for p in parts]
            names.append(f"PARTITION ({', '.join(values)})")
        for i in range(0, len(names), 1000):
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(names[i : i + 1000])}")
        self.drop(kept)
        self.drop(gone)

    def _files(self, table: str) -> DataFrame:
        """Partition values and the file of every row; no column is read for it."""
        return self.spark.table(table).select(*self.partition_columns(table), "_metadata.file_path")

    def _swap(self, table: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
        """Put ``<table>__next`` in the table's place, where layout or columns change or there are no partitions."""
        if partition_by or self.partition_columns(table):
            # Renaming does not move the locations of partitions in every catalog, so they are copied.
            self.write(table, self.spark.table(f"{table}__next"), partition_by, sort_by, rebalance=False)
            self.drop(f"{table}__next")
            return
        self.drop(f"{table}__old")
        self.spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")
        self.spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}")
        self.drop(f"{table}__old")

    def recover(self, table: str) -> None:
        """Finish a replacement that a lost driver left half done, whatever it left in the table's folder."""
        if not self.exists(table) and self.exists(f"{table}__next"):
            self._clear_folder(table)
            parts = self.partition_columns(f"{table}__next")
            self.write(table, self.spark.table(f"{table}__next"), parts, rebalance=False)
            self.drop(f"{table}__next")
            self.drop(f"{table}__old")

    def _clear_folder(self, table: str) -> None:
        """Remove the folder of a table that the catalog does not know."""
        database, name = table.split(".")
        at = self.spark.catalog.getDatabase(database).locationUri
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{at}/{name.lower()}")
        store = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        store.delete(folder, True)

    def upsert(
        self,
        table: str,
        source: DataFrame,
        key: str,
        *,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        bucket_key: str | None = None,
        on_duplicate_key: str = "error",
        loaded_at: datetime | None = None,
        touch_on_update: bool = True,
        on_schema_change: str = "ignore",
        only_changes: bool = False,
        track: datetime | None = None,
        newer_by: str | None = None,
        stored: bool = False,
    ) -> None:
        """Update rows with known keys and insert the others.

        ``stored`` says that the source only reads tables, other ones than this, so that no copy of it is needed.
        ``newer_by`` names a column by which a row must not be older than the one it updates.
        ``only_changes`` leaves rows alone whose values stay the same. ``track`` keeps the versions that
        get replaced in ``<table>__before``, marked with that time, for later delta runs. ``bucket_key``
        is the column to cut a new table by (see the class); a row's key must determine it.
        """
        with self._writers[table]:
            self.recover(table)
            if not self.exists(table):
                first = single_source_rows(source, key, on_duplicate_key)
                if loaded_at is not None:
                    first = first.withColumn(STAMP, stamp(loaded_at))
                self.replace(table, first, partition_by, sort_by, bucket_key)
                return
            delta, number = f"{table}__delta", self._next_load(table)
            if not stored:
                self.write(delta, source)
                source = self.spark.table(delta)
            rows = single_source_rows(source, key, on_duplicate_key)
            target = self.read(table)
            if only_changes:
                marked = keep_stamps(rows.withColumn(STAMP, F.lit(None).cast("timestamp_ntz")), target, key)
                fresh = marked.where(F.col(STAMP).isNull()).select(F.col(key).alias("__fresh"))
                rows = rows.join(fresh, rows[key].eqNullSafe(fresh["__fresh"]), "left_semi")
            if not rows.isEmpty():
                rows = rows.withColumn(LOAD, F.lit(number).cast("bigint"))

                def merged(old: DataFrame) -> DataFrame:
                    return merge_rows(old, rows, key, loaded_at, touch_on_update, on_schema_change, newer_by=newer_by)

                self._apply(table, rows, rows.select(key), key, merged, on_schema_change, sort_by, track, number)
            self.drop(delta)

    def replace_keys(
        self,
        table: str,
        source: DataFrame,
        keys: DataFrame,
        key: str,
        *,
        on_schema_change: str = "ignore",
        track: datetime | None = None,
    ) -> None:
        """Replace all rows with the given keys by the source rows, however many each key has.

        Where the keys alone say which parts of the table change, the rows are computed once, as they are written.
        Otherwise they are written as a table of their own first.
        """
        with self._writers[table]:
            self.recover(table)
            delta, gone, number = f"{table}__delta", f"{table}__keys", self._next_load(table)
            self.write(gone, keys.select(key))
            cut, stay = self.bucketing(table), f"{table}__stay"
            if not (cut and cut[1] == key):
                self.write(delta, source)
                source = self.spark.table(delta)
            rows = source.withColumn(LOAD, F.lit(number).cast("bigint"))
            keys = self.spark.table(gone)

            def replaced(old: DataFrame) -> DataFrame:
                out = keys.select(F.col(key).alias("__gone"))
                # Old rows are told by the shorter list: the keys that go, or those that stay, which takes reading one column.
                self.write(stay, old.select(F.col(key).alias("__stay")).distinct().join(out, F.col("__stay") == F.col("__gone"), "left_anti"))
                left = self.spark.table(stay)
                old, new = sync_columns(old, rows, on_schema_change)
                if left.count() < keys.count():
                    return old.join(left, F.col(key).eqNullSafe(F.col("__stay")), "left_semi").unionByName(new)
                return old.join(out, F.col(key) == F.col("__gone"), "left_anti").unionByName(new)

            self._apply(table, rows, keys, key, replaced, on_schema_change, (), track, number)
            self.drop(delta)
            self.drop(gone)
            self.drop(stay)

    def _apply(
        self,
        table: str,
        rows: DataFrame,
        keys: DataFrame,
        key: str,
        change: Callable[[DataFrame], DataFrame],
        on_schema_change: str,
        sort_by: Sequence[str],
        track: datetime | None,
        number: int,
    ) -> None:
        """Bring new rows into a table: ``change`` turns old rows into what replaces them.

        Only partitions that hold one of ``keys`` or receive a row are read as old rows and rewritten.
        """
        stored, cut = self.spark.table(table), self.bucketing(table)
        numbered = LOAD in stored.columns
        if not numbered:  # written before loads had numbers
            stored = stored.withColumn(LOAD, F.lit(0).cast("bigint"))
        parts = self.partition_columns(table)
        wanted = keys.select(F.col(key).alias("__key"))
        found = stored.join(wanted, F.col(key) == F.col("__key"), "left_semi")
        same_columns = numbered and (on_schema_change == "ignore" or set(rows.columns) == set(stored.columns) - {BUCKET})
        if not parts or not same_columns:
            if track is not None:
                self._track(table, found, track, number)
            self.replace(table, change(stored.drop(BUCKET)), [] if cut else parts, sort_by)
            return
        if cut:
            # The key's hash says where its rows are; the target need not be searched.
            touched = in_buckets(keys.select(key), *cut) if cut[1] == key else in_buckets(rows, *cut)
            touched = touched.select(BUCKET)
        else:
            touched = found.select(*parts).unionByName(rows.select(*parts))
        scratch = f"{table}__touched"
        self.write(scratch, touched.distinct().select(*[F.col(p).alias(f"__{p}") for p in parts]))
        touched = self.spark.table(scratch)
        inside = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in parts])
        old = stored.join(touched, inside, "left_semi")
        if track is not None:
            self._track(table, old.join(wanted, F.col(key) == F.col("__key"), "left_semi"), track, number)
        new = change(old.drop(BUCKET))
        if cut:
            new = in_buckets(new, *cut)
        before = touched.select(*[F.col(f"__{p}").alias(p) for p in parts])
        self._overwrite(table, new, parts, sort_by, before, self._few(cut, sort_by))
        self.set_properties(table, **{LOADS_PROPERTY: str(number)})
        self.drop(scratch)

    def _track(self, table: str, before: DataFrame, at: datetime, number: int) -> None:
        side = f"{table}{BEFORE_SUFFIX}"
        before = before.drop(BUCKET).withColumns({REPLACED_AT: stamp(at), LOAD: F.lit(number).cast("bigint")})
        if self.exists(side):
            known = self.spark.table(side).drop(BUCKET)
            if set(known.columns) != set(before.columns):
                self.replace(side, known.unionByName(before, allowMissingColumns=True))
                return
            before = before.select(*known.columns)
        before.write.mode("append").format("parquet").option("compression", CODEC).saveAsTable(side)

    def forget(self, table: str, until: datetime | int) -> None:
        """Drop tracked row versions that every reader has taken in: replaced until a time, or by a load up to a number."""
        side = f"{table}{BEFORE_SUFFIX}"
        if self.exists(side):
            old = self.spark.table(side).drop(BUCKET)
            done = F.coalesce(F.col(LOAD), F.lit(0)) <= until if isinstance(until, int) else F.col(REPLACED_AT) <= stamp(until)
            if not old.where(done).isEmpty():
                self.replace(side, old.where(~done))

    def unchanged_since(self, table: str, load: int) -> DataFrame:
        """Rows that no load beyond the given one wrote."""
        now = self.spark.table(table).drop(BUCKET)
        if LOAD not in now.columns:
            return now.where(F.lit(load >= 0))
        return now.where(F.col(LOAD) <= load).drop(LOAD)

    def changed_since(self, table: str, column: str, bound: Column) -> DataFrame:
        """Row versions newer than a bound (a stamp, or the number of a load), with the versions they replaced."""
        now = self.spark.table(table).drop(BUCKET)
        if column == LOAD and LOAD not in now.columns:
            now = now.withColumn(LOAD, F.lit(0).cast("bigint"))
        new = now.where(F.col(column) > bound).drop(LOAD)
        side = f"{table}{BEFORE_SUFFIX}"
        if not self.exists(side):
            return new
        old = self.spark.table(side).drop(BUCKET)
        old = old.where(F.col(LOAD if column == LOAD else REPLACED_AT) > bound)
        return new.unionByName(old.select(*[c for c in old.columns if c in new.columns]), allowMissingColumns=True)


def in_buckets(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


def publish(
    warehouse: Warehouse,
    spec: EntitySpec,
    df: DataFrame,
    database: str = "raw",
    mode: str = "replace",
    loaded_at: datetime | None = None,
    **upsert_options,
) -> str:
    """Write a conformed entity into its partitioned lake table; ``mode`` is replace or upsert.

    Without rows nothing is written.
    """
    table = f"{database}.{spec.name}"
    if df.isEmpty():
        return table
    df = with_partitions(spec, df)
    layout = dict(partition_by=spec.partition_columns, sort_by=spec.sort)
    if mode == "replace":
        if loaded_at is not None:
            df = df.withColumn(STAMP, stamp(loaded_at))
        warehouse.replace(table, df, **layout)
    elif mode == "upsert":
        warehouse.upsert(table, df, spec.key, loaded_at=loaded_at, **layout, **upsert_options)
    else:
        raise ValueError(f"mode must be 'replace' or 'upsert', not {mode!r}")
    return table
