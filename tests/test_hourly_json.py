import datetime as dt
import json

import pytest

from hourloom.sources import hourly_json, sectioned
from hourloom.sources.filenames import normalize_key, parse_file_name


def _doc(n=2, **changes):
    hourly = {
        "time": [f"2024-10-01T{h:02d}:00" for h in range(n)],
        "temperature_2m": [1.5] * n,
        "relative_humidity_2m": [2] * n,
        "precipitation": [None] * n,
        "weather_code": [3] * n,
    }
    hourly.update(changes)
    return json.dumps({"latitude": 35.6, "hourly": {k: v for k, v in hourly.items() if v is not ...}})


DOCS = {
    "good": _doc(),
    "short": _doc(precipitation=[0.5], weather_code=[]),
    "empty": _doc(0),
    "no_variable": _doc(temperature_2m=...),
    "no_time": _doc(time=...),
    "no_hourly": "{}",
    "broken": '{"hourly": {"time": [',
    "bad_time": _doc(1, time=["yesterday"]),
}


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("docs")
    for name, text in DOCS.items():
        (folder / f"{name}.json").write_text(text)
    return hourly_json.read_documents(spark, str(folder)).cache()


def _named(df, column):
    return {r["path"].rsplit("/", 1)[1][:-5]: r[column] for r in df.collect()}


def test_reasons_name_the_arrays(documents):
    assert _named(hourly_json.extract_hourly(documents), "reason") == {
        "good": None,
        "short": "expected 2 values, got precipitation: 1, weather_code: 0",
        "empty": "no time values",
        "no_variable": "expected 2 values, got temperature_2m: 0",
        "no_time": "no time values",
        "no_hourly": "no time values",
        "broken": "not valid JSON",
        "bad_time": "unreadable time",
    }


def test_rows_of_good_documents(documents):
    rows = sectioned.unpack(hourly_json.extract_hourly(documents)).drop("path")
    rows = hourly_json.with_key(rows, "prefecture", "千葉県")
    got = sorted(map(tuple, rows.collect()))
    day = dt.date(2024, 10, 1)
    assert got == [("千葉県", day, "00", 1.5, 2.0, None, 3), ("千葉県", day, "01", 1.5, 2.0, None, 3)]
    assert hourly_json.on_date(rows, "2024-10-02").count() == 0
    assert hourly_json.on_date(rows).count() == 2


def test_validation(documents):
    checked = hourly_json.validate_documents(documents)
    assert _named(checked, "valid") == {k: k in ("good", "empty", "bad_time") for k in DOCS}
    assert _named(checked, "total_hours") == {
        "good": 2, "short": 2, "empty": 0, "no_variable": None, "no_time": None, "no_hourly": None, "broken": None,
        "bad_time": 1,
    }
    issues = _named(checked, "issues")
    assert issues["no_variable"] == "missing variables: temperature_2m"
    assert issues["no_time"] == "no time data" and issues["no_hourly"] == "no hourly data"


NAMES = {
    "/x/tokyo_2023.json": None,
    "/x/tokyo_2025_0715.json": None,
    "tokyo_2025_0231.json": "no such day",
    "tokyo_2024_0229.json": None,
    "osaka_2023.json": "unknown prefecture",
    "tokyo_1999.json": "bad year",
    "tokyo_20x4.json": "bad year",
    "tokyo_2101.json": "bad year",
    "tokyo.json": "too few parts",
    "tokyo_2025_715.json": "bad month and day",
    "chiba_2025_0801_historical.json": "too many parts",
}


def test_file_names(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "path string")
    got = {r["path"]: r for r in parse_file_name(df).collect()}
    assert {k: r["name_error"] for k, r in got.items()} == NAMES
    assert got["/x/tokyo_2025_0715.json"]["file_date"] == dt.date(2025, 7, 15)
    assert got["/x/tokyo_2023.json"]["file_date"] is None and got["/x/tokyo_2023.json"]["year"] == 2023
    longer = {r["path"]: r for r in parse_file_name(df, max_parts=4).collect()}
    assert longer["chiba_2025_0801_historical.json"]["prefecture"] == "chiba"


def test_keys_are_brought_to_one_spelling(spark):
    df = spark.createDataFrame([("千葉県",), ("chiba",), ("tokyo",)], "k string")
    assert [r[0] for r in df.select(normalize_key(df["k"], {"千葉県": "chiba"})).collect()] == ["chiba", "chiba", "tokyo"]


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_parsed_once(spark, tmp_path):
    (tmp_path / "tokyo_2024.json").write_text(_doc())
    documents = hourly_json.read_documents(spark, str(tmp_path))
    plans = [
        sectioned.unpack(hourly_json.extract_hourly(documents)),
        hourly_json.validate_documents(documents),
        hourly_json.converted_rows(hourly_json.convert_documents(documents, "2024-10-01")),
        hourly_json.conversion_report(hourly_json.convert_documents(documents, "2024-10-01")),
    ]
    assert [_optimized(df).lower().count("from_json") for df in plans] == [1, 1, 1, 1]
    assert [df.count() for df in plans] == [2, 1, 2, 1]


def test_conversion_names_outputs_and_reports(spark, tmp_path):
    (tmp_path / "tokyo_2024_1001.json").write_text(_doc())
    (tmp_path / "osaka_2024.json").write_text(_doc())
    (tmp_path / "chiba_2024.json").write_text(_doc(precipitation=[1.0]))
    documents = hourly_json.read_documents(spark, str(tmp_path))
    converted = hourly_json.convert_documents(documents)
    assert {(r["output"], r["prefecture"], r["hour"]) for r in hourly_json.converted_rows(converted).collect()} == {
        ("tokyo_2024_1001", "tokyo", "00"),
        ("tokyo_2024_1001", "tokyo", "01"),
    }
    report = _named(hourly_json.conversion_report(converted), "error")
    assert report == {
        "tokyo_2024_1001": None,
        "osaka_2024": "unknown prefecture",
        "chiba_2024": "expected 2 values, got precipitation: 1",
    }
    other_day = hourly_json.conversion_report(hourly_json.convert_documents(documents, "2024-10-02"))
    assert set(_named(other_day, "status").values()) == {"failed"}


def test_numbers_as_they_may_be_written(spark):
    texts = [
        ("points", _doc(weather_code=[3.0, 61.0])),
        ("halves", _doc(weather_code=[3.5, 1], temperature_2m=["warm", 1])),
    ]
    found = hourly_json.extract_hourly(spark.createDataFrame(texts, "path string, text string"))
    reasons = {r["path"]: r["reason"] for r in found.collect()}
    assert reasons == {"points": None, "halves": "unreadable value of temperature_2m, weather_code"}
    assert [r["weather_code"] for r in sectioned.unpack(found).collect()] == [3, 61]
