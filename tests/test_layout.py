import datetime as dt
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from hourloom.operators.calendar import calendar_frame
from hourloom.operators.joins import on_days
from hourloom.operators.layout import compact, interleave, z_value
from hourloom.operators.refresh import DatedTable
from hourloom.sources.details import shapes, typed_details, with_details

D = dt.date


def _rows(spark, n=2400, days=3):
    return spark.range(n).select(
        F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % days).cast("int")).alias("date"),
        F.concat(F.lit("site"), F.format_string("%02d", F.pmod(F.xxhash64("id"), F.lit(40)))).alias("site"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(24)).cast("int").alias("hour"),
        F.col("id").alias("v"),
    )


def _files(table):
    return {label: len(sizes) for label, sizes in table.file_sizes().items()}


def test_many_appends_become_few_files(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"), cluster_by=["hour"])
    assert compact(table) == []
    rows = _rows(spark)
    for i in range(15):
        table.append(rows.where(F.col("v") % 15 == i))
    table.append(spark.createDataFrame([(None, "s", 1, -1)], rows.schema))
    table.append(spark.createDataFrame([(None, "s", 1, -2), (D(2024, 2, 1), "s", 1, -3)], rows.schema))
    table.take_note("mart", table.changes("mart").upto)
    assert compact(table) == ["2024-01-01", "2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__"]
    assert set(_files(table).values()) == {1} and compact(table) == []
    assert sorted(r["v"] for r in table.read().collect()) == [-3, -2, -1, *range(2400)]
    assert table.changes("mart").dates == []  # the same rows
    hours = [r["hour"] for r in spark.read.parquet(f"{table.path}/date=2024-01-01").coalesce(1).collect()]
    assert hours == sorted(hours)


def test_files_of_a_target_size_and_others_untouched(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"))
    rows = _rows(spark, 60_000, 1)
    for i in range(8):
        table.append(rows.where(F.col("v") % 8 == i))
    table.append(_rows(spark, 10, 3).where("date = '2024-01-03'"))
    other = glob.glob(f"{table.path}/date=2024-01-03/*.parquet")
    size = sum(table.file_sizes()["2024-01-01"])
    assert compact(table, size // 3) == ["2024-01-01"]
    assert 2 <= _files(table)["2024-01-01"] <= 4
    assert glob.glob(f"{table.path}/date=2024-01-03/*.parquet") == other
    assert table.read().where("date = '2024-01-01'").agg(F.sum("v")).first()[0] == 60_000 * 59_999 // 2


def test_bits_in_turn(spark):
    got = spark.range(64).select(z_value([F.col("id") % 8, F.floor(F.col("id") / 8)], 3).alias("z"), "id").collect()

    def plain(a, b):
        return sum((a >> i & 1) << 2 * i + 1 | (b >> i & 1) << 2 * i for i in range(3))

    assert {r["id"]: r["z"] for r in got} == {i: plain(i % 8, i // 8) for i in range(64)}


def _groups_hit(table, column, value):
    """Row groups whose range holds the value, and all row groups."""
    hit = total = 0
    for path in glob.glob(f"{table.path}/date=*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= value <= stats.max
    return hit, total


def test_filters_on_either_column_skip_files(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"))
    rows = _rows(spark, 20_000, 1)
    odd = spark.createDataFrame([(D(2024, 1, 1), None, None, -1), (D(2024, 1, 1), "", 5, -2)], "date date, site string, hour int, v bigint")
    table.create(rows.unionByName(odd))
    interleave(table, ["site", "hour"], files=16)
    for column, value in (("site", "site07"), ("hour", 13)):
        hit, total = _groups_hit(table, column, value)
        assert total >= 12 and hit <= total * 0.6, (column, hit, total)
    assert table.read().count() == 20_002
    found = table.read().where("site = 'site07' AND hour = 13")
    assert found.count() == rows.where("site = 'site07' AND hour = 13").count() > 0


def test_a_calendar_prunes_partitions(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "t"))
    table.create(_rows(spark, 300, 30))
    calendar_frame(spark, D(2024, 1, 1), D(2024, 1, 31), [D(2024, 1, 8)]).write.parquet(str(tmp_path / "cal"))
    cal = spark.read.parquet(str(tmp_path / "cal"))
    got = on_days(table.read(), cal, F.col("is_holiday"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    assert got.count() == 10 and {r["date"] for r in got.collect()} == {D(2024, 1, 8)}


def test_details_of_several_processes(spark):
    log = spark.createDataFrame(
        [("A", '{"rows": 5, "x": {"y": "z"}}'), ("A", '{"rows": "five"}'), ("B", '{"n": 7}'), ("B", "{bad"), ("B", None), ("C", '{"rows": 1}'), (None, '{"rows": 2}')],
        "process_type string, additional_info string",
    )
    log = with_details(log)
    fields = {"rows": {"A": ("$.rows", "bigint"), "B": ("$.n", "bigint")}, "y": {"A": ("$.x.y", "string")}}
    got = [(r["process_type"], r["rows"], r["y"]) for r in typed_details(log, fields).collect()]
    assert got == [("A", 5, "z"), ("A", None, None), ("B", 7, None), ("B", None, None), ("B", None, None), ("C", None, None), (None, None, None)]
    seen = {r["process_type"]: r for r in shapes(log).collect()}
    assert seen["B"]["rows"] == 3 and seen["B"]["unreadable"] == 2 and "n: BIGINT" in seen["B"]["shape"]
