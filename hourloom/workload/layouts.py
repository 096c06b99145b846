"""Stored tables after their files were put in order, and details of run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.operators.joins import on_days
from hourloom.operators.layout import compact, interleave
from hourloom.operators.refresh import DatedTable
from hourloom.shared import new_folder
from hourloom.sources.details import typed_details, with_details
from hourloom.workload import adapters
from hourloom.workload.registry import query
from hourloom.workload.sql import over

APPENDS = 6


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.readings(spark, folder).select("event_id", "date", "hour", "site", "actual_power")


@query(over("readings", "SELECT date, COUNT(*) AS rows, SUM(event_id)::BIGINT AS ids, 1::BIGINT AS files FROM readings GROUP BY date"))
def compacted_appends(spark, folder):
    """Each date's rows after several appends were put together: all of them, in one file."""
    table = DatedTable(spark, new_folder(spark, "appended"), cluster_by=["hour"])
    rows = _readings(spark, folder)
    for i in range(APPENDS):
        table.append(rows.where(F.col("event_id") % APPENDS == i))
    compact(table)
    return table.read().withColumn("file", F.input_file_name()).groupBy("date").agg(
        F.count("*").alias("rows"), F.sum("event_id").alias("ids"), F.count_distinct("file").alias("files")
    )


@query(over("readings", "SELECT event_id, date, hour, site, actual_power FROM readings WHERE site = 'view' AND hour BETWEEN 6 AND 9"))
def interleaved_table(spark, folder):
    """Rows of a site and some hours, out of a table ordered by both at once."""
    table = DatedTable(spark, new_folder(spark, "interleaved"))
    table.create(_readings(spark, folder))
    interleave(table, ["site", "hour"])
    return table.read().where((F.col("site") == "view") & F.col("hour").between(6, 9))


@query(
    over(
        "readings calendar",
        """SELECT event_id, date, hour, site, actual_power, day_of_week, is_weekend, is_holiday
        FROM readings JOIN calendar USING (date) WHERE is_holiday OR is_weekend""",
    )
)
def readings_off_work(spark, folder):
    """Weekends and holidays of a stored table: the calendar prunes its partitions."""
    table = DatedTable(spark, new_folder(spark, "readings"))
    table.create(_readings(spark, folder))
    return on_days(table.read(), adapters.calendar(spark, folder), F.col("is_holiday") | F.col("is_weekend"))


_INFO = """SELECT event_id, upper(event_type) AS process_type, CASE
    WHEN event_id % 11 = 0 THEN '{broken' WHEN event_id % 13 = 0 THEN NULL
    WHEN event_type IN ('view', 'click') THEN '{"files": [' || user_id || ', 2], "rows": ' || (event_id % 100) || '}'
    WHEN event_type = 'error' THEN '{"reason": {"code": "E' || (event_id % 9) || '"}, "rows": "many"}'
    ELSE '{"inserted": ' || (event_id % 50) || ', "seconds": ' || CAST(value AS DECIMAL(18,2)) || '}' END AS info FROM events"""


@query(
    over(
        "",
        """SELECT event_id, process_type, TRY_CAST(CASE WHEN process_type IN ('VIEW', 'CLICK') THEN j ->> '$.rows'
            WHEN process_type IN ('SIGNUP', 'PURCHASE') THEN j ->> '$.inserted' END AS BIGINT) AS rows,
          CASE WHEN process_type = 'ERROR' THEN j ->> '$.reason.code' END AS code,
          CASE WHEN process_type = 'VIEW' THEN CAST(j ->> '$.files[0]' AS BIGINT) END AS first_file,
          j IS NULL AS unreadable
        FROM (SELECT *, CASE WHEN json_valid(info) THEN info::JSON END AS j FROM info)""",
        info=_INFO,
    )
)
def run_details(spark, folder):
    """Counts, codes and files out of details whose keys differ by process; bad JSON is NULL."""
    key, kind = F.col("event_id"), F.col("event_type")
    text = (
        F.when(key % 11 == 0, "{broken")
        .when(key % 13 == 0, None)
        .when(
            kind.isin("view", "click"),
            F.concat(F.lit('{"files": ['), "user_id", F.lit(', 2], "rows": '), key % 100, F.lit("}")),
        )
        .when(kind == "error", F.concat(F.lit('{"reason": {"code": "E'), key % 9, F.lit('"}, "rows": "many"}')))
        .otherwise(
            F.concat(F.lit('{"inserted": '), key % 50, F.lit(', "seconds": '), F.col("value").cast("decimal(18,2)"), F.lit("}"))
        )
    )
    log = adapters.events(spark, folder).select("event_id", F.upper("event_type").alias("process_type"), text.alias("additional_info"))
    number = ("$.rows", "bigint")
    inserted = ("$.inserted", "bigint")
    fields = {
        "rows": {"VIEW": number, "CLICK": number, "SIGNUP": inserted, "PURCHASE": inserted},
        "code": {"ERROR": ("$.reason.code", "string")},
        "first_file": {"VIEW": ("$.files[0]", "bigint")},
    }
    typed = typed_details(with_details(log), fields)
    return typed.select("event_id", "process_type", *fields, F.col("details").isNull().alias("unreadable"))
