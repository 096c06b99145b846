import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from hourloom.operators.refresh import DatedTable
from hourloom.shared import new_folder
from hourloom.sources.sectioned import MARKER
from hourloom.streaming import files
from hourloom.streaming.files import load_recent_months, stream_files

D = dt.date


def _file(folder, name, day, base, hours=24, modified=None):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f"{day.year}/{day.month}/{day.day},{h}:00,{base + h},0,0,9000" for h in range(hours)]
    (folder / name).write_bytes("\r\n".join([MARKER, *lines]).encode("shift_jis"))
    if modified:
        os.utime(folder / name, (modified, modified))


class Inbox:
    def __init__(self, spark, tmp_path, **more):
        self.spark, self.folder, self.more = spark, tmp_path / "inbox", more
        self.table = DatedTable(spark, str(tmp_path / "table"))
        self.record, self.checkpoint = str(tmp_path / "record"), str(tmp_path / "checkpoint")

    def run(self):
        query = stream_files(self.spark, str(self.folder), self.table, self.record, self.checkpoint, **self.more)
        query.awaitTermination()

    def rows(self):
        return sorted((r["date"].day, r["hour"], r["actual_power"]) for r in self.table.read().collect())

    def outcomes(self):
        got = self.spark.read.parquet(self.record).collect()
        return sorted((r["batch"], os.path.basename(r["path"]), r["status"]) for r in got)


def _day(day, base):
    return [(day, h, float(base + h)) for h in range(24)]


def test_each_run_reads_the_new_files_only(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    _file(box.folder / "d1", "a.csv", D(2024, 1, 1), 100)
    _file(box.folder / "d1", "b.csv", D(2024, 1, 3), 300)
    _file(box.folder / "d1", "bad.csv", D(2024, 1, 2), 200, hours=23)
    box.run()
    assert box.rows() == _day(1, 100) + _day(3, 300)
    box.run()
    _file(box.folder / "d2", "b.csv", D(2024, 1, 3), 500)
    _file(box.folder / "d2", "bad.csv", D(2024, 1, 2), 600)
    box.run()
    # The days between the new files stay as they are.
    assert box.rows() == _day(1, 100) + _day(2, 600) + _day(3, 500)
    assert box.outcomes() == [
        (0, "a.csv", "success"), (0, "b.csv", "success"), (0, "bad.csv", "failed"), (1, "b.csv", "success"), (1, "bad.csv", "success"),
    ]


def test_a_run_stopped_before_the_checkpoint_is_repeated(spark, tmp_path, monkeypatch):
    box = Inbox(spark, tmp_path)
    _file(box.folder, "a.csv", D(2024, 1, 1), 100)
    put = files._put
    with monkeypatch.context() as patch:

        def put_and_stop(*args):
            put(*args)
            raise RuntimeError("stopped after the table")

        patch.setattr(files, "_put", put_and_stop)
        with pytest.raises(Exception, match="stopped after the table"):
            box.run()
    assert box.rows() == _day(1, 100)
    _file(box.folder, "later.csv", D(2024, 1, 2), 200)
    box.run()
    assert box.rows() == _day(1, 100) + _day(2, 200)
    assert box.outcomes() == [(0, "a.csv", "success"), (1, "later.csv", "success")]


def test_few_files_at_a_time_and_the_latest_counts(spark, tmp_path):
    box = Inbox(spark, tmp_path, files_at_once=2, loaded_at=dt.datetime(2024, 2, 1))
    for i, base in enumerate((100, 200, 300, 400, 500)):
        _file(box.folder, f"{9 - i}.csv", D(2024, 1, 1 + i % 2), base, modified=1_700_000_000 + i)
    box.run()
    assert box.rows() == _day(1, 500) + _day(2, 400)
    assert [x[0] for x in box.outcomes()] == [0, 0, 1, 1, 2]
    assert {r["created_at"] for r in box.table.read().collect()} == {dt.datetime(2024, 2, 1)}


def test_sites_do_not_replace_each_other(spark, tmp_path):
    box = Inbox(spark, tmp_path, keys={"site": F.regexp_extract("path", "inbox/([^/]+)/", 1)})
    _file(box.folder / "a", "x.csv", D(2024, 1, 1), 100)
    _file(box.folder / "b", "x.csv", D(2024, 1, 1), 200)
    box.run()
    _file(box.folder / "b", "y.csv", D(2024, 1, 1), 300)
    box.run()
    assert box.rows() == sorted(_day(1, 100) + _day(1, 300))
    assert {(r["site"], r["actual_power"]) for r in box.table.read().where("hour = 2").collect()} == {("a", 102.0), ("b", 302.0)}


def test_only_bad_files_and_none(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.folder.mkdir()
    box.run()
    _file(box.folder, "bad.csv", D(2024, 1, 1), 100, hours=3)
    box.run()
    assert not box.table.exists() and box.outcomes() == [(0, "bad.csv", "failed")]


def test_months_in_question(spark, tmp_path):
    table, record = DatedTable(spark, str(tmp_path / "t")), str(tmp_path / "record")
    for month, name, day, base, hours in (
        ("202401", "1_power_usage.csv", D(2024, 1, 30), 100, 24), ("202402", "2_power_usage.csv", D(2024, 2, 1), 200, 24),
        ("202402", "3_power_usage.csv", D(2024, 2, 2), 300, 20), ("202312", "4_power_usage.csv", D(2023, 12, 30), 400, 24),
        ("202402", "other.csv", D(2024, 2, 3), 500, 24),
    ):
        _file(tmp_path / "raw" / month, name, day, base, hours)
    assert load_recent_months(spark, str(tmp_path / "raw"), D(2024, 2, 4), 5, table, record) == (2, 1)
    assert sorted({str(r["date"]) for r in table.read().collect()}) == ["2024-01-30", "2024-02-01"]
    assert spark.read.parquet(record).where("status = 'failed'").first()["error"] == "section too short"
    _file(tmp_path / "raw" / "202403", "5_power_usage.csv", D(2024, 3, 2), 100, 3)
    with pytest.raises(ValueError, match="none of 1 files"):
        load_recent_months(spark, str(tmp_path / "raw"), D(2024, 3, 20), 2, table, record)


def test_groups_are_replaced_one_by_one(spark, tmp_path):
    schema = "date date, site string, v int"
    table = DatedTable(spark, str(tmp_path / "t"))
    old = [(D(2024, 1, 1), "a", 1), (D(2024, 1, 1), "a", 2), (D(2024, 1, 1), None, 3), (D(2024, 1, 2), "a", 4), (None, "a", 5)]
    table.create(spark.createDataFrame(old, schema))
    new = [(D(2024, 1, 1), "a", 10), (D(2024, 1, 3), "b", 11), (None, "a", 12)]
    assert table.replace_groups(spark.createDataFrame(new, schema), ["site"]) == (2, 3)
    assert sorted(r["v"] for r in table.read().collect()) == [3, 4, 5, 10, 11, 12]
    assert table.replace_groups(spark.createDataFrame([(D(2024, 1, 1), None, 20)], schema), ["site"]) == (1, 1)
    assert sorted(r["v"] for r in table.read().collect()) == [4, 5, 10, 11, 12, 20]
    assert table.replace_groups(spark.createDataFrame([], schema), ["site"]) == (0, 0)


def test_read_files_move_out(spark, tmp_path):
    box = Inbox(spark, tmp_path, archive=str(tmp_path / "done"))
    _file(box.folder, "a.csv", D(2024, 1, 1), 100)
    box.run()
    _file(box.folder, "b.csv", D(2024, 1, 2), 200)
    box.run()
    _file(box.folder, "c.csv", D(2024, 1, 3), 300)
    box.run()
    assert box.rows() == _day(1, 100) + _day(2, 200) + _day(3, 300)
    assert "a.csv" not in os.listdir(box.folder)
