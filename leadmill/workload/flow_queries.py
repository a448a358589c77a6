"""Registered queries of the batch reader, over batches that are written from the given tables first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leadmill.operators.conform import clean, conform
from leadmill.plans.flow import group_reports
from leadmill.session import scratch_dir
from leadmill.sources.batches import (
    added_files,
    by_footer,
    change_summary,
    list_files,
    new_batches,
    read_entity,
    read_groups,
    unread_files,
)
from leadmill.workload.operator_queries import EXTRA, OPP
from leadmill.workload.queries import Tables, register
from leadmill.workload.views import AS_OF, LANDED_SQL, sql_on

# Orders by priority, as batches that differ in types, columns and the case of names. The last is no batch.
FOLDERS = {
    "1-URGENT": "2024-01-01_000000",
    "2-HIGH": "2024-01-02_000000",
    "3-MEDIUM": "2024-01-03_000000",
    "4-NOT SPECIFIED": "2024-01-04_000000",
    "5-LOW": "not_a_batch",
}
_BATCH = " ".join(f"WHEN '{p}' THEN '{b}'" for p, b in FOLDERS.items())


def land_mixed(t: Tables) -> str:
    """Write the batches; returns their root."""
    root = scratch_dir(t.spark, "mixed-batches")
    orders = sql_on(LANDED_SQL, orders=t.base["orders"]).drop("BATCH_ID", "FILE_PATH")
    for priority, folder in FOLDERS.items():
        rows = orders.where(F.col("SOURCE_NOTE") == priority)
        if priority == "2-HIGH":
            created = F.timestamp_micros(F.floor(F.col("CREATED_DATE") / 1000)).cast("timestamp_ntz")
            rows = rows.withColumns({"AMOUNT": F.col("AMOUNT").try_cast("double"), "CREATED_DATE": created})
        elif priority == "3-MEDIUM":
            rows = rows.toDF(*[c.lower() for c in rows.columns]).drop("stage_name")
        elif priority == "4-NOT SPECIFIED":
            rows = rows.withColumn("REGION", F.lit("north"))
        rows.write.parquet(f"{root}/{folder}/opportunity.parquet")
    return root


@register(
    "scan_mixed_batches",
    f"""SELECT opportunity_id, opportunity_name, account_id,
               CASE WHEN source_note <> '3-MEDIUM' THEN stage_name END AS stage_name,
               TRY_CAST(amount AS DECIMAL(15,2)) AS amount, close_date, CAST(NULL AS VARCHAR) AS campaign_id, created_date,
               CASE WHEN source_note = '4-NOT SPECIFIED' THEN 'north' END AS region,
               CASE source_note {_BATCH} END AS batch_id
        FROM cleaned_opportunity WHERE source_note <> '5-LOW'""",
    EXTRA,
)
def scan_mixed_batches(t: Tables) -> DataFrame:
    rows = conform(OPP, clean(OPP, read_entity(t.spark, land_mixed(t), "opportunity")))
    return rows.select(*OPP.fields, "region", "batch_id")


@register(
    "schema_report_per_batch",
    f"""SELECT batch_id, CASE batch_id WHEN '2024-01-03_000000' THEN 'stage_name,campaign_id' ELSE 'campaign_id' END AS missing,
               CASE batch_id WHEN '2024-01-04_000000' THEN 'source_note,region' ELSE 'source_note' END AS extra, COUNT(*) AS "rows"
        FROM (SELECT CASE o_orderpriority {_BATCH} END AS batch_id FROM orders WHERE o_orderpriority <> '5-LOW') GROUP BY ALL""",
)
def schema_report_per_batch(t: Tables) -> DataFrame:
    root = land_mixed(t)
    batches = new_batches(t.spark, root)
    paths = [r[0] for r in list_files(t.spark, root, "opportunity", batches).select("file_path").collect()]
    reports = group_reports(OPP, by_footer(t.spark, paths))
    lines = [(b, ",".join(r.missing), ",".join(r.extra)) for r in reports for b in r.batches]
    rows = read_entity(t.spark, root, "opportunity").groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
    return t.spark.createDataFrame(lines, "batch_id string, missing string, extra string").join(rows, "batch_id")


@register(
    "added_files",
    """SELECT COUNT(DISTINCT o_orderpriority) AS num_batches, MAX('2024-01-04_000000') AS last_batch_id FROM orders
       WHERE o_orderpriority <> '5-LOW'""",
)
def files_since(t: Tables) -> DataFrame:
    files = added_files(t.spark, land_mixed(t), "opportunity").where("batch_id LIKE '2024%'")
    per_batch = files.groupBy("batch_id").agg(F.max("committed_at").alias("committed_at"))
    return change_summary(per_batch).select(F.col("num_files").alias("num_batches"), "last_batch_id")


@register(
    "unread_files",
    f"""SELECT CASE o_orderpriority {_BATCH.replace('not_a_batch', '2024-01-05_000000')} END AS batch_id,
               COUNT(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS "rows",
               CAST(MAX(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS unread
        FROM orders GROUP BY ALL""",
)
def files_not_read(t: Tables) -> DataFrame:
    """Rows of each batch, and files that gave none; the last batch's file is text under a parquet name."""
    root = land_mixed(t)
    notes = t.base["orders"].where("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").cast("string"))
    notes.coalesce(1).write.text(f"{root}/2024-01-05_000000/opportunity.parquet")
    files = list_files(t.spark, root, "opportunity", new_batches(t.spark, root)).select("file_path").collect()
    groups = by_footer(t.spark, [r[0] for r in files])
    rows = read_groups(t.spark, groups, skip_corrupt=True)
    missed = unread_files(t.spark, groups, rows, "opportunity", AS_OF).groupBy("batch_id").agg(F.sum("count").alias("unread"))
    got = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
    return got.join(missed, "batch_id", "full").na.fill(0, ["rows", "unread"])
