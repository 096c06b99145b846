import datetime as dt
import json
import os
from types import SimpleNamespace

import pytest

from hourloom.operators.refresh import DatedTable
from hourloom.shared import new_folder, shared_root
from hourloom.sources.sectioned import MARKER
from hourloom.streaming.ingest import ingest_documents, ingest_sectioned, read_record

D = dt.date


def _power_file(folder, name, day, base, hours=24):
    lines = [f"{day.year}/{day.month}/{day.day},{h}:00,{base + h},0,0,{9000}" for h in range(hours)]
    (folder / name).write_bytes("\r\n".join([MARKER, *lines]).encode("shift_jis"))


def test_power_files_are_loaded_once_and_late_ones_replace(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    table, checkpoint = DatedTable(spark, new_folder(spark, "power")), new_folder(spark, "progress")
    _power_file(inbox, "a.csv", D(2024, 1, 1), 100)
    _power_file(inbox, "b.csv", D(2024, 1, 3), 300)
    _power_file(inbox, "bad.csv", D(2024, 1, 2), 200, hours=23)
    assert ingest_sectioned(spark, str(inbox), table, checkpoint) == (2, 1)
    assert table.read().count() == 48
    assert ingest_sectioned(spark, str(inbox), table, checkpoint) == (0, 0)
    assert table.read().count() == 48
    _power_file(inbox, "late.csv", D(2024, 1, 3), 500)
    assert ingest_sectioned(spark, str(inbox), table, checkpoint) == (1, 0)
    rows = {(r["date"], r["hour"]): r["actual_power"] for r in table.read().collect()}
    assert len(rows) == 48 and rows[D(2024, 1, 3), 2] == 502.0 and rows[D(2024, 1, 1), 2] == 102.0


def _document(folder, name, days, temperature):
    times = [f"{d}T{h:02d}:00" for d in days for h in range(2)]
    hourly = {v: [temperature] * len(times) for v in ("temperature_2m", "relative_humidity_2m", "precipitation")}
    (folder / name).write_text(json.dumps({"hourly": {"time": times, **hourly, "weather_code": [1] * len(times)}}))


def test_later_documents_win_within_one_run(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    table = DatedTable(spark, new_folder(spark, "weather"))
    table.create(spark.sql("SELECT 'tokyo' AS prefecture, DATE '2024-01-02' AS date, '00' AS hour, 9D AS temperature_2m, "
                           "9D AS relative_humidity_2m, 9D AS precipitation, 9L AS weather_code"))  # fmt: skip
    _document(inbox, "z_first.json", [D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)], 1.0)
    _document(inbox, "a_second.json", [D(2024, 1, 2), D(2024, 1, 4)], 2.0)
    os.utime(inbox / "z_first.json", (1_700_000_000, 1_700_000_000))
    os.utime(inbox / "a_second.json", (1_700_000_900, 1_700_000_900))
    ran = ingest_documents(spark, str(inbox), table, new_folder(spark, "progress"), ("prefecture", "chiba"))
    assert ran == (2, 0)
    got = sorted((r["prefecture"], r["date"].day, r["temperature_2m"]) for r in table.read().collect())
    assert got == [("chiba", 1, 1.0)] * 2 + [("chiba", 2, 2.0)] * 2 + [("chiba", 4, 2.0)] * 2 + [("tokyo", 2, 9.0)]


def test_a_file_delivered_again_is_loaded_again(spark, tmp_path):
    inbox = tmp_path / "inbox" / "202401"
    inbox.mkdir(parents=True)
    table, record = DatedTable(spark, new_folder(spark, "power")), new_folder(spark, "record")
    at = dt.datetime(2024, 1, 9)
    _power_file(inbox, "a.csv", D(2024, 1, 1), 100, hours=23)
    assert ingest_sectioned(spark, str(inbox.parent), table, record, at) == (0, 1)
    assert not os.path.isdir(table.path)
    _power_file(inbox, "a.csv", D(2024, 1, 1), 100)
    os.utime(inbox / "a.csv", (1_800_000_000, 1_800_000_000))
    assert ingest_sectioned(spark, str(inbox.parent), table, record, at, delete=True) == (1, 0)
    rows = table.read().collect()
    assert len(rows) == 24 and {r["created_at"] for r in rows} == {at}
    assert not list(inbox.iterdir())


def test_a_bad_document_is_in_nobodys_way(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    table, record = DatedTable(spark, new_folder(spark, "weather")), new_folder(spark, "record")
    (inbox / "a.json").write_text("{")
    _document(inbox, "b.json", [D(2024, 1, 1), D(2024, 1, 5)], 1.0)
    archive = str(tmp_path / "done")
    assert ingest_documents(spark, str(inbox), table, record, ("prefecture", "x"), archive=archive) == (1, 1)
    assert table.read().count() == 4
    assert os.listdir(inbox) == ["a.json"] and os.listdir(archive) == ["b.json"]
    errors = {os.path.basename(r["path"]): r["error"] for r in read_record(spark, record).collect()}
    assert errors == {"a.json": "not valid JSON", "b.json": None}


class _Session:
    """What ``shared_root`` looks at in a session that names no folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")


def test_a_session_without_a_folder():
    local = _Session("local[2]")
    assert shared_root(local) == shared_root(local) and os.path.isdir(shared_root(local))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Session("yarn"))


def test_folders_come_from_the_session(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
