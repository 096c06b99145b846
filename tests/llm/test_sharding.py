from collections import Counter

import pytest
from helpers import ODD, table

from hourloom.llm.queries import SHARDS
from hourloom.llm.sharding import SLOTS, assign_shards, lookup_table, write_shards


def test_table_is_full_and_even():
    found = Counter(lookup_table(SHARDS))
    assert sum(found.values()) == SLOTS and len(found) == len(SHARDS)
    assert max(found.values()) - min(found.values()) <= 1


def test_turns_by_preference_order():
    """The same filling, turn by turn, with whole preference lists."""
    from hourloom.llm.sharding import _number

    shards, slots = ["a", "b", "c"], 31
    walks = [
        [(_number("offset", s) % slots + j * (_number("skip", s) % (slots - 1) + 1)) % slots for j in range(slots)]
        for s in shards
    ]
    assert all(sorted(w) == list(range(slots)) for w in walks)
    taken = {}
    while len(taken) < slots:
        for s, walk in zip(shards, walks):
            if len(taken) < slots:
                taken[next(x for x in walk if x not in taken)] = s
    assert lookup_table(shards, slots) == [taken[i] for i in range(slots)]


def test_a_shard_less_moves_little_else():
    before, after = lookup_table(SHARDS), lookup_table(SHARDS[:-1])
    moved = sum(a != b for a, b in zip(before, after) if a != SHARDS[-1])
    assert moved < 0.12 * SLOTS


def test_bad_arguments():
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 9), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            lookup_table(shards, slots)


def test_odd_rows(spark):
    rows = assign_shards(table(spark, clash=True), ["doc_id"], SHARDS).collect()
    assert len(rows) == len(ODD)
    where = lookup_table(SHARDS)
    assert all(r["shard"] == where[r["slot"]] and r["kept"] == r["lang"] for r in rows)
    assert len({r["slot"] for r in rows if r["doc_id"] == 4}) == 1
    assert assign_shards(table(spark).limit(0), ["doc_id"], SHARDS).count() == 0


def test_keys_are_told_apart(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("null", "x"), ("a", "bc"), ("ab", "c")], "p string, q string")
    assert len({r["slot"] for r in assign_shards(df, ["p", "q"], SHARDS).collect()}) == 5


def test_placing_rows_moves_only_the_table(spark):
    plan = assign_shards(table(spark), ["doc_id"], SHARDS)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan


def test_written_shards(spark, tmp_path):
    placed = assign_shards(table(spark), ["doc_id"], ["a", "b"])
    write_shards(placed, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == len(ODD) and {r["shard"] for r in back.select("shard").collect()} <= {"a", "b"}
