import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from hourloom.operators.refresh import DatedTable, Refreshed, append, replace_snapshot
from hourloom.shared import new_folder

D = dt.date
SCHEMA = "date date, site string, v int"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _old(spark):
    return _rows(spark, [(D(2024, 1, d), s, d) for d in range(1, 11) for s in ("a", "b")])


def _table(spark, grain="day"):
    table = DatedTable(spark, new_folder(spark, "t"), grain=grain)
    table.create(_old(spark))
    return table


def _content(table):
    return sorted((r["date"].day, r["site"], r["v"]) for r in table.read().collect())


def _want(keep, new):
    return sorted([(d, s, d) for d in range(1, 11) for s in ("a", "b") if keep(d, s)] + new)


@pytest.mark.parametrize("grain", ["day", "month"])
def test_a_gap_inside_the_loaded_range_is_emptied(spark, grain):
    table = _table(spark, grain)
    batch = _rows(spark, [(D(2024, 1, 4), "a", 100), (D(2024, 1, 6), "c", 101)])
    for deleted in (6, 2):
        # The second round finds the batch itself and leaves the same table.
        assert table.replace_loaded_range(batch) == Refreshed(deleted, 2)
        assert _content(table) == _want(lambda d, s: not 4 <= d <= 6, [(4, "a", 100), (6, "c", 101)])


@pytest.mark.parametrize("grain", ["day", "month"])
def test_only_rows_of_the_key_are_replaced(spark, grain):
    table = _table(spark, grain)
    batch = _rows(spark, [(D(2024, 1, 4), "a", 100), (D(2024, 1, 6), "a", 101)])
    assert table.replace_loaded_range(batch, key=("site", "a")) == Refreshed(3, 2)
    assert _content(table) == _want(
        lambda d, s: not (4 <= d <= 6 and s == "a"), [(4, "a", 100), (6, "a", 101)]
    )


def test_rows_without_a_key_are_never_deleted(spark):
    table = DatedTable(spark, new_folder(spark, "t"))
    table.create(_rows(spark, [(D(2024, 1, 1), None, 1), (D(2024, 1, 1), "a", 2)]))
    table.replace_loaded_range(_rows(spark, [(D(2024, 1, 1), "a", 3)]), key=("site", "a"))
    assert sorted(r["v"] for r in table.read().collect()) == [1, 3]


def test_an_empty_batch_changes_nothing(spark):
    table = _table(spark)
    assert table.replace_loaded_range(_old(spark).where("v > 99")) == Refreshed(0, 0)
    assert len(_content(table)) == 20


def test_window_replacement_has_no_upper_end_unless_given(spark):
    table = _table(spark)
    new = _rows(spark, [(D(2024, 1, 8), "n", 1)])
    table.replace_window(new, D(2024, 1, 7))
    assert _content(table) == _want(lambda d, s: d < 7, [(8, "n", 1)])
    table = _table(spark)
    table.replace_window(new, D(2024, 1, 7), D(2024, 1, 8))
    assert _content(table) == _want(lambda d, s: not 7 <= d <= 8, [(8, "n", 1)])


def test_a_window_can_be_emptied(spark):
    table = _table(spark)
    assert table.replace_window(_old(spark).where("v > 99"), D(2024, 1, 7)) == Refreshed(8, 0)
    assert _content(table) == _want(lambda d, s: d < 7, [])


def test_a_table_without_rows_can_be_filled_again(spark):
    table = _table(spark)
    table.replace_window(_old(spark).where("v > 99"), D(2024, 1, 1))
    assert not table.exists()
    assert table.replace_loaded_range(_rows(spark, [(D(2024, 1, 4), "a", 100)])) == Refreshed(0, 1)
    assert _content(table) == [(4, "a", 100)]


def test_a_batch_may_come_from_the_table_itself(spark):
    table = _table(spark)
    table.replace_window(table.read().where("date >= '2024-01-09'").withColumn("v", F.col("v") + 1), D(2024, 1, 9))
    assert _content(table) == _want(lambda d, s: d < 9, [(d, s, d + 1) for d in (9, 10) for s in ("a", "b")])


def test_overwriting_partitions_spares_those_without_new_rows(spark):
    table = _table(spark)
    table.overwrite_partitions(_rows(spark, [(D(2024, 1, 8), "n", 1)]))
    assert _content(table) == _want(lambda d, s: d != 8, [(8, "n", 1)])


def test_retention_by_day_and_by_month(spark):
    table = _table(spark)
    assert table.retain(D(2024, 1, 10), 4) == 5
    assert _content(table) == _want(lambda d, s: d >= 6, [])
    table = _table(spark, "month")
    table.append(_rows(spark, [(D(2023, 11, 30), "a", 30), (D(2024, 2, 1), "a", 99)]))
    assert table.retain(D(2024, 1, 10), 4) == 1
    assert _content(table) == sorted(_want(lambda d, s: d >= 6, [(1, "a", 99)]))


def test_append_orders_columns_and_snapshot_replaces(spark):
    path = new_folder(spark, "log")
    append(_rows(spark, [(D(2024, 1, 1), "a", 1)]), path, ["date"], ["v", "site", "date"])
    append(_rows(spark, [(D(2024, 1, 1), "b", 2)]), path, ["date"], ["v", "site", "date"])
    assert spark.read.parquet(path).columns == ["v", "site", "date"] and spark.read.parquet(path).count() == 2
    path = new_folder(spark, "snapshot")
    for v in (1, 2):
        replace_snapshot(_rows(spark, [(D(2024, 1, 1), "a", v)]), path)
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [2]


def _dated(spark, tmp_path, grain, rows):
    table = DatedTable(spark, str(tmp_path / "t"), grain=grain)
    table.create(_odd(spark, rows))
    return table


def _odd(spark, rows):
    return spark.createDataFrame(rows, "k string, date date, v int")


OLD = [("a", dt.date(2024, 1, 5), 1), ("b", dt.date(2024, 2, 5), 2), ("a", None, 3), ("b", None, 4)]


@pytest.mark.parametrize("grain", ["day", "month"])
@pytest.mark.parametrize("last", [None, dt.date(2024, 12, 31)])
def test_rows_without_a_date_outlive_windows(spark, tmp_path, grain, last):
    table = _dated(spark, tmp_path, grain, OLD)
    new = [("c", dt.date(2024, 2, 6), 5), ("c", None, 6)]
    assert table.replace_window(_odd(spark, new), dt.date(2024, 2, 1), last) == (1, 2)
    assert sorted(r["v"] for r in table.read().collect()) == [1, 3, 4, 5, 6]
    assert table.replace_window(_odd(spark, []), dt.date(2024, 1, 1), last) == (2, 0)
    assert sorted(r["v"] for r in table.read().collect()) == [3, 4, 6]


@pytest.mark.parametrize("grain", ["day", "month"])
@pytest.mark.parametrize("key", [None, ("k", "a")])
def test_rows_without_a_date_outlive_loaded_ranges(spark, tmp_path, grain, key):
    table = _dated(spark, tmp_path, grain, OLD)
    new = [("a", dt.date(2024, 1, 1), 5), ("a", dt.date(2024, 2, 9), 6), ("a", None, 7)]
    deleted = 2 if key is None else 1
    assert table.replace_loaded_range(_odd(spark, new), key) == (deleted, 3)
    want = [3, 4, 5, 6, 7] if key is None else [2, 3, 4, 5, 6, 7]
    assert sorted(r["v"] for r in table.read().collect()) == want
    assert table.replace_loaded_range(_odd(spark, [("a", None, 8)]), key) == (0, 1)
    assert table.replace_loaded_range(_odd(spark, []), key) == (0, 0)
    assert sorted(r["v"] for r in table.read().collect()) == [*want, 8]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_partitions_are_not_replaced_by_rows_without_a_date(spark, tmp_path, grain):
    table = _dated(spark, tmp_path, grain, OLD)
    with pytest.raises(Exception, match="date is NULL"):
        table.overwrite_partitions(_odd(spark, [("c", dt.date(2024, 2, 5), 5), ("c", None, 6)]))
    table.overwrite_partitions(_odd(spark, [("c", dt.date(2024, 2, 5), 5)]))
    assert sorted(r["v"] for r in table.read().collect()) == [1, 3, 4, 5]


def test_a_failed_refresh_leaves_no_staged_batch(spark, tmp_path):
    table = _dated(spark, tmp_path, "day", OLD)
    bad = _odd(spark, OLD).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        table.replace_loaded_range(bad)
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_staged")]
    assert table.read().count() == 4


class Stop(Exception):
    pass


def _stop_after(monkeypatch, steps):
    """Let so many steps on folders and notes happen, then stop for good."""
    left = [steps]

    def counted(name, step):
        def run(self, *args):
            if left[0] == 0:
                raise Stop
            left[0] -= 1
            return step(self, *args)

        monkeypatch.setattr(DatedTable, name, run)

    for name in ("_delete", "_move", "_put", "_make"):
        counted(name, getattr(DatedTable, name))
    return left


CALLS = {
    "range": lambda t, spark: t.replace_loaded_range(_rows(spark, [(D(2024, 1, 4), "a", 100), (D(2024, 1, 6), "c", 101)])),
    "of key": lambda t, spark: t.replace_loaded_range(_rows(spark, [(D(2024, 1, 4), "a", 100), (D(2024, 1, 6), "a", 101)]), ("site", "a")),
    "window": lambda t, spark: t.replace_window(_rows(spark, [(D(2024, 1, 8), "n", 1), (D(2024, 3, 1), "n", 2)]), D(2024, 1, 7), D(2024, 1, 9)),
    "dates": lambda t, spark: t.replace_dates(_rows(spark, [(D(2024, 1, 2), "n", 1)]), [D(2024, 1, 2), D(2024, 1, 9)]),
    "groups": lambda t, spark: t.replace_groups(_rows(spark, [(D(2024, 1, 2), "a", 1), (D(2024, 1, 3), "b", 2)]), ["site"]),
    "append": lambda t, spark: t.append(_rows(spark, [(D(2024, 1, 2), "n", 1), (D(2024, 2, 2), "n", 2), (None, "u", 3)])),
    "partitions": lambda t, spark: t.overwrite_partitions(_rows(spark, [(D(2024, 1, 2), "n", 1), (D(2024, 2, 2), "n", 2)])),
    "rewrite": lambda t, spark: t.rewrite(["2024-01-02", "2024-01-03"], lambda rows: rows.coalesce(1)),
    "retention": lambda t, spark: t.retain(D(2024, 1, 10), 4),
}


@pytest.mark.parametrize("call", CALLS)
def test_a_stopped_call_is_finished_by_the_next(spark, call, monkeypatch):
    """Stopped at each step in turn: either nothing has happened, or the next call makes it whole."""
    before = _table(spark)
    old = sorted(map(tuple, before.read().collect()), key=str)

    def copy():
        table = DatedTable(spark, new_folder(spark, "t"))
        shutil.copytree(before.path, table.path)
        return table

    table = copy()
    CALLS[call](table, spark)
    new = sorted(map(tuple, table.read().collect()), key=str)
    changed = table.changes("none before").dates
    steps = 0
    while True:
        table = copy()
        table.take_note("mart", 0)
        with monkeypatch.context() as patch:
            left = _stop_after(patch, steps)
            try:
                CALLS[call](table, spark)
                done = left[0] > 0
            except Stop:
                done = False
        table = DatedTable(spark, table.path)  # another process
        noted = table.recover()
        found = sorted(map(tuple, table.read().collect()), key=str)
        assert found in ((new,) if noted or done else (old, new)), steps
        assert not [x for x in table._names("") if x.startswith(("_staged", "_pending"))]
        if found == new:
            assert set(table.changes("mart").dates) - set(changed) <= {D(2024, 1, d) for d in range(1, 10)}
        if done:
            break
        steps += 1
    assert steps >= 5


def test_changes_are_told_until_every_reader_has_taken_note(spark):
    table = _table(spark)
    everything = [D(2024, 1, d) for d in range(1, 11)]
    assert table.changes("a") == (everything, 0)  # a reader that never took note
    for reader in ("a", "b"):
        table.take_note(reader, table.changes(reader).upto)
    assert table.changes("a").dates == []
    CALLS["window"](table, spark)
    CALLS["dates"](table, spark)
    want = [D(2024, 1, 2), D(2024, 1, 7), D(2024, 1, 8), D(2024, 1, 9), D(2024, 3, 1)]
    assert table.changes("a") == table.changes("b") == (want, 2)
    table.take_note("a", 1)
    assert table.changes("a").dates == [D(2024, 1, 2), D(2024, 1, 9)] and table.changes("b").dates == want
    table.take_note("a", 2)
    table.take_note("b", 2)
    assert table.changes("b") == ([], 2) and table._changed() == []
    CALLS["append"](table, spark)
    assert table.changes("b") == ([D(2024, 1, 2), D(2024, 2, 2)], 3)


def test_replaced_dates_are_exactly_those_named(spark):
    table = _table(spark)
    assert table.replace_dates(_rows(spark, [(D(2024, 1, 2), "n", 1)]), [D(2024, 1, 2), D(2024, 1, 9), D(2025, 1, 1)]) == (4, 1)
    assert _content(table) == _want(lambda d, s: d not in (2, 9), [(2, "n", 1)])
    with pytest.raises(ValueError, match="not replaced"):
        table.replace_dates(_rows(spark, [(D(2024, 1, 3), "n", 1)]), [D(2024, 1, 2)])
    assert _content(table) == _want(lambda d, s: d not in (2, 9), [(2, "n", 1)])


def test_rows_beyond_the_window_are_added(spark):
    table = _table(spark)
    assert table.replace_window(_rows(spark, [(D(2024, 1, 5), "n", 1)]), D(2024, 1, 9), D(2024, 1, 9)) == (2, 1)
    assert _content(table) == _want(lambda d, s: d != 9, [(5, "n", 1)])


def test_appended_dates_are_one_file_each(spark, tmp_path):
    rows = _odd(spark, [("a", dt.date(2024, 1, 1 + i % 3), i) for i in range(300)]).repartition(4)
    append(rows, str(tmp_path / "t"), ["date"])
    assert len(list((tmp_path / "t").glob("date=*/*.parquet"))) == 3
