"""Values of earlier dates, found by date and not by row position."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.operators.joins import BROADCAST_ROWS, is_small, small_side
from hourloom.shared import written

#: Days of a chunk of dates; a lag of fewer days reaches at most one other chunk.
CHUNK_DAYS = 128
#: Salts that the rows of a crowded date are dealt to at most.
SALTS = 64


def lag_by_date(
    df: DataFrame,
    mapping: DataFrame,
    value: str,
    lags: Mapping[str, str],
    keys: Sequence[str] = ("hour",),
    date: str = "date",
    unique: bool = False,
    crowded: int | None = None,
) -> DataFrame:
    """Add one column per entry of ``lags`` (new name -> date column of ``mapping``).

    The new column is ``value`` at the mapped date and the same ``keys``; a date that is
    absent gives NULL. ``df`` may hold several rows per (keys, date): they multiply, as
    in a SQL self-join. ``df`` is shuffled once, on (keys, date); each lag brings its values
    along to the date that looks back at them, so it adds a shuffle of narrow rows.
    ``mapping`` has one row per date.

    ``crowded`` is a number of rows: a key's dates with more of them, and the dates that look back at
    these, are joined apart with salts (see ``_crowded``). This counts the rows per key and
    date now.

    ``unique=True`` says (keys, date) is unique and not NULL. Then each row is sent
    forward to the chunks of dates that look back at it, and a single shuffle on (keys, chunk)
    gathers rows with all their lags, however many. A repeated grain fails the query.
    """
    if unique:
        return _send_forward(df, mapping, value, lags, keys, date)
    if crowded is None:
        return _joined(df, df, mapping, value, lags, keys, date)
    grain = [*keys, date]
    counts = df.groupBy(*grain).agg(F.count("*").alias("__n")).where((F.col("__n") > crowded) & _all_there(grain))
    crowds = written(counts, "crowds")  # at most one row per ``crowded`` rows
    if crowds.isEmpty():
        return _joined(df, df, mapping, value, lags, keys, date)
    looking = _links(mapping, lags).join(small_side(crowds), F.col("__from") == F.col(date))
    apart = looking.select(*keys, F.col("target").alias(date)).unionByName(crowds.select(*grain)).distinct()
    apart = written(apart.join(crowds, grain, "left"), "crowded-dates")
    plain = df.join(small_side(apart.select(*grain)), grain, "left_anti")
    past = df.join(small_side(crowds), grain, "left_anti")
    rest = df.join(small_side(apart), grain)  # a crowded date's rows carry their number
    found = _crowded(rest, df, mapping, value, lags, keys, date, crowded).select(*df.columns, *lags)
    return _joined(plain, past, mapping, value, lags, keys, date).unionByName(found)


def _joined(df, earlier, mapping, value, lags, keys, date) -> DataFrame:
    """Rows of ``df`` beside values of ``earlier``, one join per lag."""
    out, small = df, is_small(mapping)
    past = earlier.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col(date).alias("__date"), F.col(value).alias("__value")
    )
    for name, mapped_date in lags.items():
        # A date that maps to nothing, such as a weekend's business lag, has no row here.
        back = mapping.select(F.col("base_date").alias("__target"), F.col(mapped_date).alias("__from"))
        back = back.where("__target IS NOT NULL AND __from IS NOT NULL")
        earlier = past.join(F.broadcast(back) if small else back, F.col("__date") == F.col("__from"))
        match = F.col(date) == F.col("__target")
        for k in keys:
            match = match & (F.col(k) == F.col(f"__{k}"))
        earlier = earlier.select(*[f"__{k}" for k in keys], "__target", F.col("__value").alias(name))
        out = out.join(earlier, match, "left").drop("__target", *[f"__{k}" for k in keys])
    return out.select(*df.columns, *lags)


def _all_there(columns: Sequence[str]) -> Column:
    there = F.lit(True)
    for c in columns:
        there = there & F.col(c).isNotNull()
    return there


def _links(mapping: DataFrame, lags: Mapping[str, str]) -> DataFrame:
    """``(target, slot, __from)``: which dates look back at which, lag by lag from 1."""
    froms = [F.struct(F.lit(i).alias("slot"), F.col(c).alias("__from")) for i, c in enumerate(lags.values(), start=1)]
    links = mapping.select(F.col("base_date").alias("target"), F.inline(F.array(*froms)))
    # A date that maps to nothing, such as a weekend's business lag, has no row here.
    return links.where("__from IS NOT NULL AND target IS NOT NULL")


def _sent(past: DataFrame, mapping: DataFrame, value: str, lags: Mapping[str, str], keys: Sequence[str], date: str) -> DataFrame:
    """``(keys, target, slot, value)``: each value at the dates that look back at it."""
    links = _links(mapping, lags)
    narrow = past.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col(date).alias("__date"), F.col(value).alias("__value")
    )
    if is_small(mapping, BROADCAST_ROWS // len(lags)):
        links = F.broadcast(links)
    sent = narrow.join(links, F.col("__date") == F.col("__from"))
    return sent.select(*[f"__{k}" for k in keys], F.col("target").alias("__target"), "slot", "__value")


def _crowded(df, past, mapping, value, lags, keys, date, crowd: int) -> DataFrame:
    """Rows of crowded dates, and of those that look back at one, joined row by row.

    Equal rows go together as one with a count, and so do equal values; the rows of a crowded date are
    then dealt to several salts by what they hold, and what they look up is repeated for each
    salt. So no task holds a crowded date, on either side.
    """
    own = [c for c in df.columns if c != "__n"]
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("__times"))
    salts = F.least(F.lit(SALTS), F.ceil(F.coalesce("__n", F.lit(1)) / crowd)).cast("int")
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*own), salts).cast("int"))
    spread = df.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(date).alias("__target"), salts.alias("__salts")).distinct()
    grain = [*[f"__{k}" for k in keys], "__target"]
    sent = _sent(past, mapping, value, lags, keys, date).join(small_side(spread), grain)
    sent = sent.groupBy(*grain, "__salts", "slot", "__value").agg(F.count("*").alias("__copies"))
    sent = sent.withColumn("__of", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
    out = rows
    for i, name in enumerate(lags, start=1):
        match = (F.col(date) == F.col("__target")) & (F.col("__salt") == F.col("__of"))
        for k in keys:
            match = match & (F.col(k) == F.col(f"__{k}"))
        found = sent.where(F.col("slot") == i).select(*grain, "__of", F.col("__value").alias(name), F.col("__copies").alias("__more"))
        out = out.join(found, match, "left").withColumn("__times", F.col("__times") * F.coalesce("__more", F.lit(1)))
        out = out.drop(*grain, "__of", "__more")
    # A row for each time it occurs; the counts may be large, so not as one list.
    whole = out.withColumn("__turn", F.explode(F.sequence(F.lit(0), F.floor((F.col("__times") - 1) / crowd))))
    last = F.least(F.lit(crowd), F.col("__times") - F.col("__turn") * crowd).cast("int")
    return whole.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), last)))


def _send_forward(df, mapping, value, lags, keys, date) -> DataFrame:
    """Rows of a unique grain with their lags, from one shuffle into chunks of dates.

    A row goes to its own chunk of ``CHUNK_DAYS`` days and, with its value alone, to the other chunks
    whose dates look back at it. So what is shuffled grows with the chunks that a lag reaches, not with
    the number of lags; a group holds at most the dates of a chunk and those they look back at.
    """
    if dict(df.dtypes)[date] != "date":
        raise TypeError(f"{date} must be a date")
    others = [c for c in df.columns if c not in keys and c != date]
    kind = df.schema[value].dataType
    links = _links(mapping, lags).select("__from", _chunk(F.col("target")).alias("chunk"))
    # One row per date; the list holds the few chunks with dates that look back at it.
    forward = links.groupBy("__from").agg(F.collect_set("chunk").alias("__to"))
    looks = mapping.where("base_date IS NOT NULL")
    if is_small(mapping, BROADCAST_ROWS // len(lags)):
        # Its lists hold at most one entry per mapping row and lag.
        forward, looks = F.broadcast(forward), looks.coalesce(1)
    looks = looks.groupBy(F.col("base_date").alias("__day"))
    looks = looks.agg(F.collect_list(F.array(*[F.col(c) for c in lags.values()])).alias("__backs"))
    if is_small(mapping, BROADCAST_ROWS // len(lags)):
        looks = F.broadcast(looks)
    chunks = F.array_union(F.array(_chunk(F.col(date))), F.coalesce("__to", F.array().cast("array<int>")))
    sent = df.join(forward, F.col(date) == F.col("__from"), "left").select(
        *keys, date, *others, F.posexplode(chunks).alias("slot", "__chunk")
    )
    # What is sent to other chunks is the date and the value alone.
    own_only = [F.when(F.col("slot") == 0, F.col(c)).alias(f"c{i}") for i, c in enumerate(others) if c != value]
    row = F.struct(F.col(date).alias("day"), F.col("slot"), F.col(value).alias("value"), *own_only)
    sent = sent.select(*keys, "__chunk", row.alias("__row")).repartition(*keys, "__chunk")
    # At most a row per date of the chunk, and of dates that these look back at.
    gathered = sent.groupBy(*keys, "__chunk").agg(F.collect_list("__row").alias("__rows")).select(
        *keys,
        "__chunk",
        F.filter("__rows", lambda r: r["slot"] == 0).alias("__own"),
        F.array_sort(F.transform("__rows", lambda r: F.struct(r["day"], r["value"]))).alias("__past"),
    )
    complaint = F.raise_error(F.lit(f"rows are not unique and non-null on ({', '.join([*keys, date])})"))
    broken = F.size(F.array_distinct(F.col("__own.day"))) < F.size("__own")
    for c in [*keys, "__chunk"]:
        broken = broken | F.col(c).isNull()
    gathered = gathered.where(F.when(broken, complaint.cast("boolean")).otherwise(F.lit(True)))

    def after_gap(row: Column, i: Column) -> Column:
        before = F.datediff(row["day"], F.get("__past", i - 1)["day"])
        return F.concat(F.array_repeat(F.lit(None).cast(kind), F.coalesce(before, F.lit(1)) - 1), F.array(row["value"]))

    # Values day by day from the first, so that a date is found by its place.
    daily = gathered.select(
        *keys, "__own", F.get("__past", F.lit(0))["day"].alias("__first"), F.flatten(F.transform("__past", after_gap)).alias("__daily")
    )
    rows = daily.select(*keys, "__first", "__daily", F.explode("__own").alias("__row"))
    rows = rows.join(looks, F.col("__row.day") == F.col("__day"), "left")
    repeated = F.raise_error(F.lit("the mapping's dates are not unique"))
    rows = rows.where(F.when(F.size("__backs") > 1, repeated.cast("boolean")).otherwise(F.lit(True)))
    found = F.transform(F.get("__backs", F.lit(0)), lambda d: F.get("__daily", F.datediff(d, F.col("__first"))))
    rows = rows.select(*keys, "__row", found.alias("__found"))
    own = [F.col("__row.value" if c == value else f"__row.c{i}").alias(c) for i, c in enumerate(others)]
    out = rows.select(
        *keys, F.col("__row.day").alias(date), *own, *[F.get("__found", F.lit(i)).alias(name) for i, name in enumerate(lags)]
    )
    return out.select(*df.columns, *lags)


def _chunk(day: Column) -> Column:
    return F.floor(F.unix_date(day) / CHUNK_DAYS).cast("int")
