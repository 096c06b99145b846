"""Date-partitioned Parquet tables and the ways a batch replaces part of one.

Only the partitions a change touches are read or rewritten. Their new content is written
once, to a folder beside the partitions that readers pass over. Then a note says which
partitions it replaces, which it adds files to and which end up empty, and only then
partition folders are moved. A call that stops before the note leaves the table as it
was; one that stops after it is finished by the next call, which moves what is left.
One writer at a time.

What a finished call changed is kept as a list of dates until every reader that asked for
changes has taken note of it, so what derives from the table can follow by dates.

Rows without a date lie in no range, so a replacement never deletes them; those of a batch
are added to them.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Fixed value: what Spark names the folder of rows without a partition value.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"

# Beside the partitions; readers pass over names that start like this.
_STAGED, _PENDING, _CHANGES, _MARK = "_staged-", "_pending.json", "_changes", ".seen"


class Refreshed(NamedTuple):
    deleted: int
    inserted: int


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", cluster_by: Sequence[str] = ()
) -> None:
    """Write Parquet partitioned by ``by``, rows clustered inside each file.

    The rebalance hint sends a partition's rows to few tasks, and lets adaptive
    execution split a partition that holds far more rows than the others.
    """
    spread = df.hint("rebalance", *by)
    if cluster_by:
        spread = spread.sortWithinPartitions(*by, *cluster_by)
    spread.write.mode(mode).partitionBy(*by).parquet(path)


def append(df: DataFrame, path: str, by: Sequence[str] = (), order: Sequence[str] | None = None) -> None:
    """Append rows; ``order`` fixes the column order of the table first."""
    rows = df.select(*order) if order else df
    if by:
        write_partitioned(rows, path, by, "append")
    else:
        rows.write.mode("append").parquet(path)


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Delete all, insert: a plain overwrite."""
    df.write.mode("overwrite").parquet(path)


def outside_range(target: DataFrame, first: Column, last: Column | None, date: str, key=None) -> DataFrame:
    """Rows a delete of ``first <= date <= last`` (for one key value) leaves alone."""
    return target.where(~_hit(first, last, date, key))


def _hit(first: Column, last: Column | None, date: str, key=None) -> Column:
    hit = F.col(date) >= first
    if last is not None:
        hit = hit & (F.col(date) <= last)
    if key is not None:
        hit = hit & (F.col(key[0]) == F.lit(key[1]))
    return F.coalesce(hit, F.lit(False))


class Changes(NamedTuple):
    """Dates changed since a reader last took note, and the number to take note with."""

    dates: list[dt.date]
    upto: int


class _Batch(NamedTuple):
    """A staged batch: its folder, its partitions, and what was counted while it was written."""

    folder: str
    labels: set[str]
    count: int
    first: dt.date | None
    last: dt.date | None


@dataclass
class DatedTable:
    """A Parquet folder partitioned by day (``date`` itself) or by month of ``date``."""

    spark: SparkSession
    path: str
    date: str = "date"
    grain: str = "day"
    cluster_by: Sequence[str] = field(default_factory=tuple)

    @property
    def partition(self) -> str:
        return self.date if self.grain == "day" else "month"

    def _label(self, day: Column) -> Column:
        return day if self.grain == "day" else F.date_format(day, "yyyy-MM")

    def _label_of(self, day: dt.date):
        return day if self.grain == "day" else day.strftime("%Y-%m")

    def _stored(self, df: DataFrame) -> DataFrame:
        return df if self.grain == "day" else df.withColumn("month", self._label(F.col(self.date)))

    def read(self) -> DataFrame:
        kind = "DATE" if self.grain == "day" else "STRING"
        # The partition's type comes from the folder name, so say which one is meant.
        df = self.spark.read.parquet(self.path).withColumn(self.partition, F.col(self.partition).cast(kind))
        return df if self.grain == "day" else df.drop("month")

    def _read_partitions(self, first: dt.date, last: dt.date | None) -> DataFrame:
        df = self.spark.read.parquet(self.path)
        label = F.col(self.partition)
        wanted = label >= F.lit(self._label_of(first))
        if last is not None:
            wanted = wanted & (label <= F.lit(self._label_of(last)))
        df = df.where(wanted)
        return df if self.grain == "day" else df.drop("month")

    def exists(self) -> bool:
        """Whether any partition is there."""
        return self._exists("") and bool(self._folders())

    def create(self, df: DataFrame) -> None:
        write_partitioned(self._stored(df), self.path, [self.partition], "overwrite", self.cluster_by)

    def append(self, df: DataFrame) -> None:
        """Add rows; files already there stay as they are."""
        with self._staged(df) as staged:
            self._apply(self._note(staged.folder, add=staged.labels))

    def overwrite_partitions(self, df: DataFrame) -> None:
        """Replace exactly the partitions ``df`` has rows for; others stay.

        A row without a date is in no partition to replace, so it is refused.
        """
        missing = F.raise_error(F.lit(f"{self.date} is NULL in rows that replace partitions"))
        dated = F.when(F.col(self.date).isNull(), missing.cast("boolean")).otherwise(True)
        with self._staged(df.where(dated)) as staged:
            self._apply(self._note(staged.folder, install=staged.labels))

    def replace_dates(self, rows: DataFrame, dates: Iterable[dt.date]) -> Refreshed:
        """Replace exactly the partitions of these dates; those without rows are emptied.

        For tables by day. A row of another date is refused.
        """
        wanted = {str(_as_date(d)) for d in dates}
        with self._staged(rows) as staged:
            if stray := staged.labels - wanted:
                raise ValueError(f"rows of dates that are not replaced: {sorted(stray)[:5]}")
            there = [_as_day(label) for label in wanted & set(self._folders())] if self.exists() else []
            before = self.spark.read.parquet(self.path).where(F.col(self.date).isin(there)).count() if there else 0
            self._apply(self._note(staged.folder, install=staged.labels, remove=wanted - staged.labels))
            return Refreshed(before, staged.count)

    def replace_loaded_range(self, batch: DataFrame, key: tuple[str, object] | None = None) -> Refreshed:
        """Delete every row from the batch's first to its last date, then insert it.

        Dates in between that the batch lacks are emptied as well. With ``key`` only
        rows of that key value are deleted.
        """
        with self._staged(batch) as staged:
            return self._replace(staged, batch.columns, staged.first, staged.last, key)

    def replace_window(
        self, rows: DataFrame, first: dt.date, last: dt.date | None = None, key: tuple[str, object] | None = None
    ) -> Refreshed:
        """Delete ``date >= first`` (``<= last`` if given; of one key value if given), then insert ``rows``."""
        with self._staged(rows) as staged:
            return self._replace(staged, rows.columns, first, last, key)

    def replace_groups(self, rows: DataFrame, by: Sequence[str]) -> Refreshed:
        """Delete the rows whose date and ``by`` occur in ``rows``, then insert these.

        A file of one site and day so replaces that site's day alone. Rows without a date replace
        nothing; a NULL in ``by`` is a value like others.
        """
        with self._staged(rows) as staged:
            touched = sorted(staged.labels & set(self._folders()) - {NO_DATE}) if self.exists() else []
            deleted = 0
            if touched:
                grain = [self.date, *by]
                batch = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{staged.folder}")
                batch = batch.withColumn(self.date, F.col(self.date).cast("date")).select(*grain).distinct()
                old = self.spark.read.parquet(self.path).where(F.col(self.partition).isin(touched)).select(*rows.columns)
                same = [old[c].eqNullSafe(batch[c]) for c in grain]
                before, files = old.count(), self._count_files(staged.folder)
                seen = Observation()
                rest = old.join(batch, same, "left_anti").observe(seen, F.count(F.lit(1)).alias("kept"))
                write_partitioned(self._stored(rest), f"{self.path}/{staged.folder}", [self.partition], "append", self.cluster_by)
                kept = seen.get["kept"] if self._count_files(staged.folder) > files else 0
                deleted = before - kept
            dated = staged.labels - {NO_DATE}
            self._apply(self._note(staged.folder, install=dated, add=staged.labels - dated))
            return Refreshed(deleted, staged.count)

    @contextmanager
    def _staged(self, rows: DataFrame):
        """The batch, computed and written once, beside the table's partitions.

        It may derive from the table it will change.
        """
        self.recover()
        folder = f"{_STAGED}{uuid.uuid4().hex}"
        seen = Observation()
        day = F.col(self.date)
        counted = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.min(day).alias("first"), F.max(day).alias("last"))
        try:
            write_partitioned(self._stored(counted), f"{self.path}/{folder}", [self.partition], "overwrite", self.cluster_by)
            labels = set(self._folders(folder))
            got = seen.get if labels else {"n": 0, "first": None, "last": None}
            yield _Batch(folder, labels, got["n"], got["first"], got["last"])
        finally:
            # After a note was written, the next call needs the folder.
            if not self._exists(_PENDING):
                self._delete(folder)

    def _replace(self, batch: _Batch, columns, first, last, key) -> Refreshed:
        if first is None:  # no date at all: nothing to delete
            self._apply(self._note(batch.folder, add=batch.labels))
            return Refreshed(0, batch.count)
        first, last = _as_date(first), _as_date(last)
        low = str(self._label_of(first))
        high = None if last is None else str(self._label_of(last))

        def inside(labels) -> set[str]:
            return {x for x in labels if x != NO_DATE and x >= low and (high is None or x <= high)}

        there = inside(self._folders()) if self.exists() else set()
        touched = self._read_partitions(first, last) if there else None
        before = touched.count() if there else 0  # asks the files' footers only
        kept = 0
        if there and (self.grain != "day" or key is not None):
            stays = ~_hit(F.lit(first), None if last is None else F.lit(last), self.date, key)
            seen, written = Observation(), self._count_files(batch.folder)
            rest = touched.select(*columns).where(stays).observe(seen, F.count(F.lit(1)).alias("kept"))
            write_partitioned(self._stored(rest), f"{self.path}/{batch.folder}", [self.partition], "append", self.cluster_by)
            # Nothing is observed where nothing was written.
            kept = seen.get["kept"] if self._count_files(batch.folder) > written else 0
        labels = set(self._folders(batch.folder))
        install = inside(labels)
        self._apply(self._note(batch.folder, install=install, add=labels - install, remove=there - install))
        return Refreshed(before - kept, batch.count)

    # What follows moves folders. The note names them; every step may be repeated.
    def _note(
        self,
        folder: str,
        install: Iterable[str] = (),
        add: Iterable[str] = (),
        remove: Iterable[str] = (),
        same_rows: bool = False,
    ) -> dict:
        """Write down what is about to happen, before it happens."""
        note = {"stage": folder, "install": sorted(install), "add": sorted(add), "remove": sorted(remove), "same": same_rows}
        note["number"] = 1 + max([0, *self._changed(), *self._marks().values()])
        self._put(_PENDING, note)
        return note

    def _apply(self, note: dict) -> None:
        staged = self._folders(note["stage"]) if self._exists(note["stage"]) else {}
        for label in note["install"]:
            if label in staged:  # else it was moved before
                name = staged[label].getName()
                self._delete(name)
                self._move(f"{note['stage']}/{name}", name)
        for label in note["add"]:
            if label in staged:
                name = staged[label].getName()
                self._make(name)
                for file in self._names(f"{note['stage']}/{name}"):
                    self._move(f"{note['stage']}/{name}/{file}", f"{name}/{file}")
        for label in note["remove"]:
            self._delete(f"{self.partition}={label}")
        changed = sorted({*note["install"], *note["add"], *note["remove"]} - {NO_DATE})
        if not note["same"]:
            self._put(f"{_CHANGES}/{note['number']:012d}.json", changed)
        self._delete(note["stage"])
        self._delete(_PENDING)
        self.spark.catalog.refreshByPath(self.path)

    def recover(self) -> bool:
        """Finish a call that stopped halfway, if there is one; True if there was."""
        if not self._exists(""):
            return False
        stopped = self._exists(_PENDING)
        if stopped:
            self._apply(self._get(_PENDING))
        for name in self._names(""):
            if name.startswith(_STAGED) or name == f"{_PENDING}.new":  # of a call that stopped before its note
                self._delete(name)
        return stopped

    def changes(self, reader: str) -> Changes:
        """Dates changed since ``reader`` last took note; all dates there are if it never did.

        For tables by day.
        """
        self.recover()
        numbers, marks = self._changed(), self._marks()
        upto = max([0, *numbers, *marks.values()])
        if reader not in marks:
            labels = set(self._folders()) - {NO_DATE} if self.exists() else set()
        else:
            labels = {x for n in numbers if n > marks[reader] for x in self._get(f"{_CHANGES}/{n:012d}.json")}
        return Changes(sorted(map(_as_day, labels)), upto)

    def take_note(self, reader: str, upto: int) -> None:
        """``reader`` has followed all changes up to this number. What all readers have seen is forgotten."""
        self._put(f"{_CHANGES}/{reader}{_MARK}", upto)
        seen = min(self._marks().values())
        for n in self._changed():
            if n <= seen:
                self._delete(f"{_CHANGES}/{n:012d}.json")

    def _changed(self) -> list[int]:
        names = self._names(_CHANGES) if self._exists(_CHANGES) else []
        return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json"))

    def _marks(self) -> dict[str, int]:
        names = self._names(_CHANGES) if self._exists(_CHANGES) else []
        return {x.removesuffix(_MARK): self._get(f"{_CHANGES}/{x}") for x in names if x.endswith(_MARK)}

    def file_sizes(self) -> dict[str, list[int]]:
        """Bytes of each file, per partition: names and sizes only."""
        files, root = self._at("")
        if not files.exists(root):
            return {}
        sizes = {}
        for label, folder in self._folders().items():
            found = files.listStatus(folder)
            sizes[label] = [x.getLen() for x in found if not x.getPath().getName().startswith(("_", "."))]
        return sizes

    def rewrite(self, labels: Iterable[str], arranged: Callable[[DataFrame], DataFrame]) -> None:
        """Write some partitions again with the same rows, arranged over tasks and ordered as wanted.

        Readers of changes are not told: no row has changed.
        """
        wanted = sorted(set(labels))
        if not wanted:
            return
        self.recover()
        rows = self.spark.read.parquet(self.path)
        name = F.coalesce(F.col(self.partition).cast("string"), F.lit(NO_DATE))
        folder = f"{_STAGED}{uuid.uuid4().hex}"
        arranged(rows.where(name.isin(wanted))).write.partitionBy(self.partition).parquet(f"{self.path}/{folder}")
        self._apply(self._note(folder, install=wanted, same_rows=True))

    def retain(self, as_of: dt.date, days: int) -> int:
        """Drop partitions that lie wholly before ``as_of - days``; returns how many.

        A month that is only partly too old keeps its later rows.
        """
        limit = as_of - dt.timedelta(days=days)
        label = str(self._label_of(limit))
        self.recover()
        old = [name for name in self._folders() if name < label]
        self._apply(self._note(f"{_STAGED}none", remove=old))
        if self.grain != "day" and limit.day > 1:
            month = self.spark.read.parquet(self.path).where(F.col("month") == label).drop("month")
            month_end = (limit.replace(day=1) + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
            self.replace_window(month.where(F.col(self.date) >= F.lit(limit)), limit.replace(day=1), month_end)
        return len(old)

    # Folder names are metadata: one short text per day or month.
    def _folders(self, inside: str = "") -> dict[str, object]:
        files, at = self._at(inside)
        pattern = re.compile(re.escape(self.partition) + r"=(.+)$")
        found = {}
        for status in files.listStatus(at):
            match = pattern.match(status.getPath().getName())
            if match:
                found[unquote(match.group(1))] = status.getPath()
        return found

    def _count_files(self, inside: str) -> int:
        files, at = self._at(inside)
        return files.getContentSummary(at).getFileCount()

    def _names(self, inside: str) -> list[str]:
        files, at = self._at(inside)
        return sorted(status.getPath().getName() for status in files.listStatus(at))

    def _at(self, inside: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{inside}" if inside else self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _exists(self, inside: str) -> bool:
        files, at = self._at(inside)
        return files.exists(at)

    def _delete(self, inside: str) -> None:
        files, at = self._at(inside)
        files.delete(at, True)

    def _make(self, inside: str) -> None:
        files, at = self._at(inside)
        files.mkdirs(at)

    def _move(self, source: str, target: str) -> None:
        (files, source_at), (_, target_at) = self._at(source), self._at(target)
        if not files.rename(source_at, target_at):
            raise OSError(f"cannot move {source_at} to {target_at}")

    def _put(self, inside: str, value) -> None:
        """A small note as a file, there in full or not at all."""
        self._make(inside.rpartition("/")[0])
        files, at = self._at(f"{inside}.new")
        out = files.create(at, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        self._delete(inside)
        self._move(f"{inside}.new", inside)

    def _get(self, inside: str):
        files, at = self._at(inside)
        source = files.open(at)
        try:
            return json.loads(bytes(source.readAllBytes()))
        finally:
            source.close()


def _as_date(value):
    return value.date() if isinstance(value, dt.datetime) else value


def _as_day(label: str) -> dt.date:
    return dt.date.fromisoformat(label)
