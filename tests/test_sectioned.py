import datetime as dt
import os

import pytest

from hourloom.sources import sectioned
from hourloom.sources.sectioned import MARKER

HEADER = MARKER + ",予測値(万kW),使用率(%),供給力(万kW)"


def _line(h, day="2023/1/1"):
    return f"{day},{h}:00,{3000 + h},0,0,{5000 + h}.5"


def _file(lines, end="\n", after=("", "DATE,TIME,5分", "2023/1/1,0:00,1")):
    return end.join(["ピーク時,時間帯", "1,18:00", "", HEADER, *lines, *after])


DAY = [_line(h) for h in range(24)]
FILES = {
    "valid": _file(DAY),
    "crlf": _file(DAY, "\r\n"),
    "no_end": "\n".join([HEADER, *DAY]),
    "no_marker": "\n".join(DAY),
    "short": "\n".join([HEADER, *DAY[:23]]),
    "short_then_blank": _file(DAY[:23]),
    "blank_inside": _file(DAY[:5] + [""] + DAY[5:]),
    "five_fields": _file(DAY[:5] + ["2023/1/1,5:00,1,0,0"] + DAY[6:]),
    "not_a_number": _file(DAY[:5] + ["2023/1/1,5:00,abc,0,0,1"] + DAY[6:]),
    "java_number": _file(DAY[:5] + ["2023/1/1,5:00,12d,0,0,1"] + DAY[6:]),
    "no_such_day": _file([_line(h, "2023/2/30") for h in range(24)]),
    "not_to_23": _file(DAY[:23] + [_line(22)]),
    "long": _file(DAY + [_line(24)]),
}


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_bytes(text.encode("shift_jis"))
    (folder / "other.txt").write_bytes(b"not read")
    return sectioned.decode_files(sectioned.read_files(spark, str(folder))).cache()


def _by_name(df):
    return {os.path.basename(r["path"])[:-4]: r for r in df.collect()}


def test_strict_outcomes(texts):
    got = {k: r["error"] for k, r in _by_name(sectioned.outcome_per_file(sectioned.extract_strict(texts))).items()}
    assert got == {
        "valid": None,
        "crlf": None,
        "no_end": None,
        "no_marker": "no header line",
        "short": "section too short",
        "short_then_blank": "blank line",
        "blank_inside": "blank line",
        "five_fields": "too few fields",
        "not_a_number": "unreadable field",
        "java_number": "unreadable field",
        "no_such_day": "unreadable field",
        "not_to_23": "last hour missing",
        "long": None,
    }


def test_strict_rows(texts):
    rows = sectioned.unpack(sectioned.extract_strict(texts)).collect()
    assert len(rows) == 4 * 24
    last = max((r for r in rows if r["path"].endswith("crlf.csv")), key=lambda r: r["hour"])
    assert (last["date"], last["hour"], last["actual_power"], last["supply_capacity"]) == (
        dt.date(2023, 1, 1),
        23,
        3023.0,
        5023.5,
    )


def test_lenient_rows(texts):
    good = texts.where("path NOT LIKE '%no_marker%'")
    rows = sectioned.unpack(sectioned.extract_lenient(good), fail=True).collect()
    counts = {}
    for r in rows:
        counts.setdefault(os.path.basename(r["path"])[:-4], []).append(r)
    sizes = {k: len(v) for k, v in counts.items()}
    assert sizes == {
        "valid": 24,
        "crlf": 24,
        "no_end": 24,
        "short": 23,
        "short_then_blank": 23,
        "blank_inside": 23,
        "five_fields": 23,
        "not_a_number": 23,
        "java_number": 23,
        "no_such_day": 24,
        "not_to_23": 24,
        "long": 24,
    }
    first = min(counts["valid"], key=lambda r: r["hour"])
    assert (first["date"], first["hour"]) == ("2023-01-01", "00")


def test_lenient_fails_without_a_header(texts):
    with pytest.raises(Exception, match="no header line"):
        sectioned.unpack(sectioned.extract_lenient(texts), fail=True).collect()


def test_the_session_setting_is_put_back(spark, texts):
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_nothing_is_shuffled(texts):
    plan = sectioned.unpack(sectioned.extract_strict(texts))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_reading_from_a_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(FILES["valid"].encode("shift_jis"))
    for strict in (True, False):
        assert sectioned.unpack(sectioned.read_sectioned(spark, str(tmp_path), strict)).count() == 24
