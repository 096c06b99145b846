"""Sources and sinks, run on files and file contents derived from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions.measures import value_map
from hourloom.operators.refresh import DatedTable, append, write_partitioned
from hourloom.plans.features import power_and_weather
from hourloom.shared import new_folder
from hourloom.sources import hourly_json, sectioned
from hourloom.sources.discovery import in_months, months_for_days
from hourloom.sources.filenames import PREFECTURES, parse_file_name
from hourloom.sources.tables import (
    PREDICTIONS_CSV,
    backfill_predictions,
    export_by_key,
    export_csv,
    export_jsonl,
    scan_range,
)
from hourloom.streaming.files import load_recent_months, stream_files
from hourloom.streaming.ingest import ingest_documents
from hourloom.workload import adapters
from hourloom.workload.registry import query
from hourloom.workload.sql import over

# A site's hours of one day: what one file holds.
_SITE_HOURS = """
SELECT event_type AS site, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INT) AS hour,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS actual_power,
       CAST(COUNT(*) * 60 AS DOUBLE) AS supply_capacity
FROM events GROUP BY 1, 2, 3"""


def _site_hours(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.energy(spark, folder, ["event_type"]).withColumnRenamed("event_type", "site")


def _sectioned_files(spark: SparkSession, folder: str, factor: float = 1.0, hours: DataFrame | None = None) -> DataFrame:
    """A file per site and day, at most 24 lines; some hours are absent, some unreadable."""
    unreadable = (F.col("site") == "error") & (F.dayofmonth("date") % 10 == 3) & (F.col("hour") == 5)
    line = F.concat_ws(
        ",",
        F.date_format("date", "y/M/d"),
        F.concat(F.col("hour").cast("string"), F.lit(":00")),
        F.when(unreadable, "-").otherwise((F.col("actual_power") * factor).cast("string")),
        F.lit("0"),
        F.lit("0"),
        F.col("supply_capacity").cast("string"),
    )
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("hour", line.alias("line")))), lambda x: x["line"]
    )
    before = F.lit("ピーク時供給力(万kW),時間帯\r\n100,18:00\r\n\r\n" + sectioned.MARKER + ",予測値(万kW),使用率(%),供給力(万kW)\r\n")
    text = F.concat(before, F.array_join(lines, "\r\n"), F.lit("\r\n\r\nDATE,TIME,5分間隔値\r\n"))
    texts = (
        (_site_hours(spark, folder) if hours is None else hours)
        .groupBy("site", "date")
        .agg(text.alias("text"))
        .withColumn("path", F.concat_ws("/", "site", F.col("date").cast("string")))
    )
    with sectioned.legacy_charsets(spark):
        return texts.select("path", F.encode("text", sectioned.ENCODING).alias("content"))


_UNREADABLE = "site = 'error' AND day(date) % 10 = 3 AND hour = 5"
_FILES = f"""
SELECT site || '/' || CAST(date AS VARCHAR) AS path, COUNT(*) AS n, bool_or({_UNREADABLE}) AS broken
FROM site_hours GROUP BY site, date"""


@query(
    over(
        "",
        """SELECT path, date, hour, actual_power, supply_capacity FROM site_hours
        JOIN files ON path = site || '/' || CAST(date AS VARCHAR) WHERE n = 24 AND NOT broken""",
        site_hours=_SITE_HOURS,
        files=_FILES,
    )
)
def sectioned_text_strict(spark, folder):
    texts = sectioned.decode_files(_sectioned_files(spark, folder))
    return sectioned.unpack(sectioned.extract_strict(texts))


@query(
    over(
        "",
        f"""SELECT site || '/' || CAST(date AS VARCHAR) AS path, strftime(date, '%Y-%m-%d') AS date,
        lpad(CAST(hour AS VARCHAR), 2, '0') AS hour, actual_power, supply_capacity
        FROM site_hours WHERE NOT ({_UNREADABLE})""",
        site_hours=_SITE_HOURS,
    )
)
def sectioned_text_lenient(spark, folder):
    texts = sectioned.decode_files(_sectioned_files(spark, folder))
    return sectioned.unpack(sectioned.extract_lenient(texts), fail=True)


@query(
    over(
        "",
        """SELECT path, CASE WHEN n = 24 AND NOT broken THEN 'success' ELSE 'failed' END AS status,
        CASE WHEN broken THEN 'unreadable field' WHEN n < 24 THEN 'blank line' END AS error,
        CASE WHEN n = 24 AND NOT broken THEN n ELSE 0 END AS row_count FROM files""",
        site_hours=_SITE_HOURS,
        files=_FILES,
    )
)
def ingest_report(spark, folder):
    texts = sectioned.decode_files(_sectioned_files(spark, folder))
    return sectioned.outcome_per_file(sectioned.extract_strict(texts))


def _documents(spark: SparkSession, folder: str, flawed: bool = True) -> DataFrame:
    """A weather document per site and day, ``flawed`` in three ways on some days."""
    day = F.dayofmonth("date")
    hours = F.array_sort(
        F.collect_list(
            F.struct(
                "hour",
                F.concat(F.col("date").cast("string"), F.lit("T"), F.col("hour"), F.lit(":00")).alias("time"),
                *hourly_json.VARIABLES,
            )
        )
    )
    grouped = (
        adapters.weather(spark, folder)
        .groupBy(F.col("prefecture").alias("site"), "date")
        .agg(hours.alias("h"))
        .withColumn("n", F.size("h"))
    )

    def values(name: str):
        return F.transform("h", lambda x: x[name])

    short, absent, cut = day % 7 == 0, day % 11 == 0, (F.col("site") == "signup") & (day % 13 == 0)
    precipitation, code = values("precipitation"), values("weather_code")
    if flawed:
        precipitation = F.when(short, F.slice(precipitation, 1, F.col("n") - 1)).otherwise(precipitation)
        code = F.when(~absent, code)
    text = F.to_json(
        F.struct(
            F.struct(
                values("time").alias("time"),
                values("temperature_2m").alias("temperature_2m"),
                values("relative_humidity_2m").alias("relative_humidity_2m"),
                precipitation.alias("precipitation"),
                code.alias("weather_code"),
            ).alias("hourly")
        )
    )
    if flawed:
        text = F.when(cut, F.left(text, F.lit(40))).otherwise(text)
    return grouped.select(
        F.concat_ws("/", "site", F.col("date").cast("string")).alias("path"), "site", text.alias("text")
    )


_FLAWS = """
SELECT prefecture AS site, date, prefecture || '/' || CAST(date AS VARCHAR) AS path, COUNT(*) AS n,
       day(date) % 7 = 0 AS short, day(date) % 11 = 0 AS absent,
       prefecture = 'signup' AND day(date) % 13 = 0 AS cut
FROM weather GROUP BY 1, 2"""


@query(
    over(
        "weather",
        """SELECT path, w.date, hour, temperature_2m, relative_humidity_2m, precipitation, weather_code
        FROM weather w JOIN flaws f ON w.prefecture = f.site AND w.date = f.date
        WHERE NOT (short OR absent OR cut)""",
        flaws=_FLAWS,
    )
)
def hourly_json_rows(spark, folder):
    documents = _documents(spark, folder).select("path", "text")
    return sectioned.unpack(hourly_json.extract_hourly(documents))


@query(
    over(
        "weather",
        """SELECT 'chiba' AS prefecture, path, w.date, hour, temperature_2m, relative_humidity_2m, precipitation,
        weather_code FROM weather w JOIN flaws f ON w.prefecture = f.site AND w.date = f.date
        WHERE w.date = DATE '2024-01-15'""",
        flaws=_FLAWS,
    )
)
def hourly_json_on_date(spark, folder):
    documents = _documents(spark, folder).select("path", "text")
    rows = sectioned.unpack(hourly_json.extract_hourly(documents))
    return hourly_json.with_key(hourly_json.on_date(rows, dt.date(2024, 1, 15)), "prefecture", "chiba")


@query(
    over(
        "weather",
        """SELECT path, NOT (cut OR absent OR short) AS valid,
        CASE WHEN cut THEN 'not valid JSON' WHEN absent THEN 'missing variables: weather_code'
          WHEN short THEN 'expected ' || n || ' values, got precipitation: ' || (n - 1) END AS issues,
        CASE WHEN NOT (cut OR absent) THEN n END AS total_hours FROM flaws""",
        flaws=_FLAWS,
    )
)
def payload_validation(spark, folder):
    return hourly_json.validate_documents(_documents(spark, folder).select("path", "text"))


# Sites as prefectures; one of them is not in the list of prefectures.
_SITE_NAMES = {"view": "chiba", "click": "tokyo", "purchase": "gunma", "signup": "saitama", "error": "osaka"}


def _named_documents(spark: SparkSession, folder: str) -> DataFrame:
    day = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"^(\d{4})-(\d{2})-(\d{2})$", "$1_$2$3")
    name = F.concat(value_map(F.col("site"), _SITE_NAMES), F.lit("_"), day, F.lit(".json"))
    return _documents(spark, folder).select(name.alias("path"), "text")


_NAMED = f"""
SELECT *, CASE site {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _SITE_NAMES.items())} END AS prefecture,
  strftime(date, '_%Y_%m%d') AS suffix, site = 'error' OR short OR absent OR cut AS bad FROM flaws"""


@query(
    over(
        "weather",
        """SELECT n.prefecture || suffix AS output, n.prefecture, w.date, hour, temperature_2m, relative_humidity_2m,
          precipitation, weather_code
        FROM named n JOIN weather w ON w.prefecture = n.site AND w.date = n.date WHERE NOT bad""",
        flaws=_FLAWS,
        named=_NAMED,
    )
)
def documents_converted(spark, folder):
    """One CSV folder per converted document, read back."""
    path = new_folder(spark, "converted")
    rows = hourly_json.converted_rows(hourly_json.convert_documents(_named_documents(spark, folder)))
    export_by_key(rows, "output", path)
    return spark.read.schema(rows.schema).option("header", "true").csv(path)


@query(
    over(
        "weather",
        """SELECT prefecture || suffix || '.json' AS path, if(bad, 'failed', 'success') AS status,
          if(bad, NULL, prefecture || suffix) AS output,
          CASE WHEN site = 'error' THEN 'unknown prefecture' WHEN cut THEN 'not valid JSON'
            WHEN absent THEN 'expected ' || n || ' values, got ' || if(short, 'precipitation: ' || (n - 1) || ', ', '')
              || 'weather_code: 0'
            WHEN short THEN 'expected ' || n || ' values, got precipitation: ' || (n - 1) END AS error
        FROM named WHERE bad OR date = DATE '2024-01-15'""",
        flaws=_FLAWS,
        named=_NAMED,
    )
)
def conversion_report(spark, folder):
    """With a date filter: documents of other days are not reported unless they are bad."""
    converted = hourly_json.convert_documents(_named_documents(spark, folder), dt.date(2024, 1, 15))
    return hourly_json.conversion_report(converted)


_NAME_PLACES = [*PREFECTURES, "osaka", ""]


@query(
    """WITH named AS (
      SELECT o_orderkey, list_extract(%s, CAST(o_custkey %% 11 AS INT) + 1)
        || '_' || CAST(CASE WHEN o_orderkey %% 7 = 0 THEN year(o_orderdate) ELSE year(o_orderdate) + 15 END AS VARCHAR)
        || CASE WHEN o_orderkey %% 5 = 0 THEN '' WHEN o_orderkey %% 11 = 0 THEN '_0231'
             WHEN o_orderkey %% 13 = 0 THEN '_13x' ELSE '_' || strftime(o_orderdate, '%%m%%d') END
        || CASE WHEN o_orderkey %% 17 = 0 THEN '_historical' ELSE '' END || '.json' AS path FROM orders),
    parts AS (SELECT *, string_split(replace(path, '.json', ''), '_') AS p FROM named),
    dated AS (SELECT *, CASE WHEN regexp_full_match(p[3], '\\d{4}')
        THEN try_cast(p[2] || '-' || left(p[3], 2) || '-' || right(p[3], 2) AS DATE) END AS d FROM parts),
    graded AS (SELECT *, CASE WHEN NOT list_contains(%s, p[1]) THEN 'unknown prefecture'
        WHEN CAST(p[2] AS INT) NOT BETWEEN 2010 AND 2100 THEN 'bad year' WHEN len(p) > 3 THEN 'too many parts'
        WHEN len(p) = 3 AND NOT regexp_full_match(p[3], '\\d{4}') THEN 'bad month and day'
        WHEN len(p) = 3 AND d IS NULL THEN 'no such day' END AS name_error FROM dated)
    SELECT o_orderkey, path, name_error, CASE WHEN name_error IS NULL THEN p[1] END AS prefecture,
      CASE WHEN name_error IS NULL THEN CAST(p[2] AS INT) END AS year,
      CASE WHEN name_error IS NULL THEN d END AS file_date FROM graded"""
    % (_NAME_PLACES, list(PREFECTURES))
)
def file_name_metadata(spark, folder):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    place = F.get(F.array(*[F.lit(x) for x in _NAME_PLACES]), (F.col("o_custkey") % 11).cast("int"))
    year = F.when(key % 7 == 0, F.year(day)).otherwise(F.year(day) + 15)
    month_day = (
        F.when(key % 5 == 0, "")
        .when(key % 11 == 0, "_0231")
        .when(key % 13 == 0, "_13x")
        .otherwise(F.concat(F.lit("_"), F.date_format(day, "MMdd")))
    )
    more = F.when(key % 17 == 0, "_historical").otherwise("")
    name = F.concat(place, F.lit("_"), year.cast("string"), month_day, more, F.lit(".json"))
    return parse_file_name(adapters.table(spark, folder, "orders").select("o_orderkey", name.alias("path")))


_SCAN_AS_OF = dt.date(2000, 3, 3)


@query(
    """WITH months AS (SELECT DISTINCT strftime(DATE '2000-03-02' - CAST(i AS INT), '%Y%m') AS m
      FROM generate_series(0, 35) g(i))
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders
    WHERE strftime(o_orderdate, '%Y%m') IN (SELECT m FROM months)"""
)
def months_of_recent_days(spark, folder):
    months = months_for_days(_SCAN_AS_OF, 35)
    return in_months(adapters.table(spark, folder, "orders"), "o_orderdate", months).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), "o_totalprice"
    )


@query(
    over(
        "weather",
        """SELECT prefecture, w.date, hour, temperature_2m, relative_humidity_2m, precipitation, weather_code,
          TIMESTAMP '2024-02-01' AS created_at, good, bad, 0::BIGINT AS good_again, 0::BIGINT AS bad_again
        FROM weather w JOIN days USING (prefecture, date) JOIN runs USING (prefecture) WHERE whole""",
        days="""SELECT prefecture, date, day(date) % 7 <> 0 AND day(date) % 11 <> 0
            AND NOT (prefecture = 'signup' AND day(date) % 13 = 0) AS whole FROM weather GROUP BY ALL""",
        runs="""SELECT prefecture, COUNT(*) FILTER (WHERE whole) AS good, COUNT(*) FILTER (WHERE NOT whole) AS bad
          FROM days GROUP BY 1""",
    )
)
def files_loaded_once(spark, folder):
    """Two runs over folders of documents, some bad, one folder per site: the second run finds nothing new."""
    inbox, runs = new_folder(spark, "inbox"), []
    _documents(spark, folder).select("site", "text").write.option("maxRecordsPerFile", 1).partitionBy("site").text(inbox)
    loaded = DatedTable(spark, new_folder(spark, "weather"))
    sites = [r["site"] for r in adapters.weather(spark, folder).select(F.col("prefecture").alias("site")).distinct().collect()]
    for site in sorted(sites):
        record, counts = new_folder(spark, "record"), []
        for _ in range(2):
            at = dt.datetime(2024, 2, 1)
            counts += ingest_documents(
                spark, f"{inbox}/site={site}", loaded, record, ("prefecture", site), at, pattern="*.txt"
            )
        runs.append((site, *counts))
    counted = spark.createDataFrame(runs, "prefecture string, good long, bad long, good_again long, bad_again long")
    return loaded.read().join(F.broadcast(counted), "prefecture")


@query(
    """SELECT event_id, ts, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20' ORDER BY ts, event_id"""
)
def table_scan_range(spark, folder):
    return scan_range(
        adapters.events(spark, folder),
        ["event_id", "ts", "event_type", "value"],
        "ts",
        dt.datetime(2024, 1, 10),
        dt.datetime(2024, 1, 20),
        ["ts", "event_id"],
    )


@query(over("readings", "SELECT date, hour, site, actual_power, supply_capacity, created_at, event_id FROM readings"))
def partitioned_table_copy(spark, folder):
    path = new_folder(spark, "copy")
    write_partitioned(adapters.readings(spark, folder), path, ["date"], cluster_by=["hour", "event_id"])
    return spark.read.parquet(path)


@query(
    over(
        "predictions",
        """SELECT execution_id, CAST(created_at AS DATE) AS prediction_run_date, prediction_date, prediction_hour,
        predicted_power_kwh, created_at FROM predictions""",
    )
)
def append_runs(spark, folder):
    """Three runs, each appended to a table partitioned by run date."""
    path = new_folder(spark, "runs")
    runs = adapters.predictions(spark, folder).withColumn("prediction_run_date", F.col("created_at").cast("date"))
    order = ["execution_id", "prediction_run_date", "prediction_date", "prediction_hour", "predicted_power_kwh", "created_at"]
    for run in ("run-1", "run-3", "run-7"):
        append(runs.where(F.col("execution_id") == run), path, ["prediction_run_date"], order)
    return spark.read.parquet(path)


@query(over("predictions", "SELECT execution_id, prediction_date, prediction_hour, predicted_power_kwh, created_at FROM predictions"))
def csv_export(spark, folder):
    path = new_folder(spark, "csv")
    export_csv(adapters.predictions(spark, folder), path)
    return spark.read.schema(PREDICTIONS_CSV).option("header", "true").csv(path)


@query(
    over(
        "run_log",
        "SELECT execution_id, date, process_type, status, error_message, records_processed FROM run_log",
    )
)
def json_lines_export(spark, folder):
    path = new_folder(spark, "jsonl")
    columns = ["execution_id", "date", "process_type", "status", "error_message", "records_processed"]
    rows = adapters.run_log(spark, folder).select(*columns)
    export_jsonl(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query(
    over(
        "predictions",
        """SELECT execution_id, CASE execution_id WHEN 'run-1' THEN DATE '2024-02-01' WHEN 'run-3' THEN DATE '2024-02-03'
        ELSE DATE '2024-02-07' END AS prediction_run_date, prediction_date, prediction_hour, predicted_power_kwh, created_at
        FROM predictions""",
    )
)
def csv_backfill(spark, folder):
    """All exports, and one that is missing."""
    runs = adapters.predictions(spark, folder)
    files = []
    for run, day in (("run-1", 1), ("run-3", 3), ("run-7", 7)):
        run_date = dt.date(2024, 2, day)
        files.append((new_folder(spark, run), run_date))
        export_csv(runs.where(F.col("execution_id") == run), files[-1][0])
    files.append((new_folder(spark, "absent"), dt.date(2024, 2, 9)))
    path = new_folder(spark, "backfilled")
    backfill_predictions(spark, files, path)
    return spark.read.parquet(path)


@query(
    over(
        "energy weather calendar",
        """SELECT e.date, e.hour, actual_power, supply_capacity, prefecture, temperature_2m, relative_humidity_2m,
        precipitation, weather_code, day_of_week, is_weekend, is_holiday, month(e.date) AS month
        FROM energy e LEFT JOIN weather w ON e.date = w.date AND e.hour = CAST(w.hour AS INT)
        LEFT JOIN calendar c ON e.date = c.date WHERE w.prefecture IS NOT NULL""",
    )
)
def export_per_key(spark, folder):
    path = new_folder(spark, "by-place")
    joined = power_and_weather(
        adapters.energy(spark, folder), adapters.weather(spark, folder), adapters.calendar(spark, folder)
    )
    export_by_key(joined, "prefecture", path)
    return spark.read.schema(joined.schema).option("header", "true").csv(path)


# All hours of a site's days; the last one is absent on some days.
_WHOLE_HOURS = f"""SELECT site, date, CAST(h AS INT) AS hour, coalesce(actual_power, 0.0::DOUBLE) AS actual_power,
    coalesce(supply_capacity, 0.0::DOUBLE) AS supply_capacity
  FROM (SELECT DISTINCT site, date FROM ({_SITE_HOURS})) CROSS JOIN generate_series(0, 23) t(h)
  LEFT JOIN (SELECT *, hour AS h FROM ({_SITE_HOURS})) x USING (site, date, h) WHERE NOT (day(date) % 9 = 4 AND h = 23)"""


def _whole_hours(spark: SparkSession, folder: str) -> DataFrame:
    known = _site_hours(spark, folder).select("site", "date", "hour", "actual_power", "supply_capacity")
    days = known.select("site", "date").distinct().select("site", "date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    days = days.where(~((F.dayofmonth("date") % 9 == 4) & (F.col("hour") == 23)))
    return days.join(known, ["site", "date", "hour"], "left").na.fill(0.0, ["actual_power", "supply_capacity"])


def _write_files(files: DataFrame, path: str) -> None:
    """One text file each, in a folder per site."""
    files.select("site", "text").write.mode("append").option("maxRecordsPerFile", 1).partitionBy("site").text(path)


def _file_texts(spark: SparkSession, folder: str, factor: float = 1.0) -> DataFrame:
    """``(site, date, text)`` of the sectioned files, readings multiplied."""
    with sectioned.legacy_charsets(spark):
        text = F.decode("content", sectioned.ENCODING)
        bits = F.split("path", "/")
        return _sectioned_files(spark, folder, factor, _whole_hours(spark, folder)).select(
            bits[0].alias("site"), bits[1].cast("date").alias("date"), text.alias("text")
        )


_TWICE = "site = 'view' AND day(date) BETWEEN 5 AND 12"
_DELIVERED = f"""SELECT site, date, hour, if({_TWICE}, actual_power * 2, actual_power) AS actual_power, supply_capacity,
    TIMESTAMP '2024-02-01' AS created_at
  FROM site_hours JOIN files ON path = site || '/' || CAST(date AS VARCHAR) WHERE n = 24 AND NOT broken"""


def _twice() -> Column:
    return (F.col("site") == "view") & F.dayofmonth("date").between(5, 12)


def _site_key() -> dict[str, Column]:
    return {"site": F.regexp_extract("path", "site=([^/]+)", 1)}


def _streamed(spark: SparkSession, folder: str) -> tuple[DatedTable, str]:
    """Files in two deliveries, the second with some files of the first again, and a run after each."""
    inbox, record, checkpoint = (new_folder(spark, x) for x in ("inbox", "record", "checkpoint"))
    loaded = DatedTable(spark, new_folder(spark, "power"), cluster_by=["site", "hour"])
    early = F.dayofmonth("date") <= 20
    _write_files(_file_texts(spark, folder).where(early), f"{inbox}/first")
    for delivery in ("first", "second"):
        if delivery == "second":
            _write_files(_file_texts(spark, folder).where(~early), f"{inbox}/second")
            _write_files(_file_texts(spark, folder, 2.0).where(_twice()), f"{inbox}/second")
        run = stream_files(
            spark, inbox, loaded, record, checkpoint, _site_key(), dt.datetime(2024, 2, 1), "*.txt", "UTF-8"
        )
        run.awaitTermination()
    return loaded, record


@query(over("", _DELIVERED, site_hours=_WHOLE_HOURS, files=_FILES))
def files_streamed(spark, folder):
    """Each date of each site once, as the last delivery had it."""
    return _streamed(spark, folder)[0].read()


@query(
    over(
        "",
        f"""SELECT batch, site, status, error, COUNT(*) AS files, CAST(SUM(row_count) AS BIGINT) AS rows FROM (
          SELECT site, if(broken OR n < 24, 'failed', 'success') AS status,
            CASE WHEN broken THEN 'unreadable field' WHEN n < 24 THEN 'blank line' END AS error,
            if(broken OR n < 24, 0, n) AS row_count,
            unnest(if({_TWICE}, [if(day(date) <= 20, 0, 1), 1], [if(day(date) <= 20, 0, 1)])) AS batch
          FROM (SELECT *, split_part(path, '/', 1) AS site, CAST(split_part(path, '/', 2) AS DATE) AS date FROM files))
        GROUP BY ALL""",
        site_hours=_WHOLE_HOURS,
        files=_FILES,
    )
)
def stream_record(spark, folder):
    """What became of the files, run by run: a run read the files new to it and no others."""
    _, record = _streamed(spark, folder)
    outcomes = spark.read.parquet(record).groupBy("batch", "site", "status", "error")
    return outcomes.agg(F.count("*").alias("files"), F.sum("row_count").alias("rows"))


@query(
    over(
        "",
        f"""SELECT d.*, good, bad FROM ({_DELIVERED}) d, (SELECT COUNT(*) FILTER (WHERE n = 24 AND NOT broken) AS good,
          COUNT(*) FILTER (WHERE n < 24 OR broken) AS bad FROM (FROM files UNION ALL (SELECT path, n, broken FROM
            (SELECT *, split_part(path, '/', 1) AS site, CAST(split_part(path, '/', 2) AS DATE) AS date FROM files)
            WHERE {_TWICE})))""",
        site_hours=_WHOLE_HOURS,
        files=_FILES,
    )
)
def month_folders_loaded(spark, folder):
    """All files of the month folders in question; those of the month before are left where they are."""
    root = new_folder(spark, "raw")
    _write_files(_file_texts(spark, folder), f"{root}/202401")
    _write_files(_file_texts(spark, folder, 9.0), f"{root}/202312")
    _write_files(_file_texts(spark, folder, 2.0).where(_twice()), f"{root}/202401")
    loaded = DatedTable(spark, new_folder(spark, "power"), cluster_by=["site", "hour"])
    ran = load_recent_months(
        spark, root, adapters.AS_OF, 5, loaded, new_folder(spark, "record"), _site_key(), dt.datetime(2024, 2, 1),
        "*.txt", "UTF-8",
    )
    return loaded.read().withColumns({"good": F.lit(ran.good).cast("long"), "bad": F.lit(ran.bad).cast("long")})
