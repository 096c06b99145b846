"""Merkle manifest of a table: a tree per group, a tree over the groups, and proofs.

A row is a leaf. Up to 16 consecutive nodes become one node of the next level, until one is
left. Only every second level is stored (checkpoint and recompute): one step of building goes from
a stored level to the next stored one and forgets the level between. Proofs go
from the top down. A stored node and its proof are joined with the 256 stored nodes below
it, the missing level between is made again from these, each node gets its siblings, and
the level is forgotten again. So a subtree is the most that ever comes together, whatever
the size of a group, and the proofs above a subtree are handed down once per subtree, not per row.

Digests are lowercase hex SHA-256, hashed further as hex text.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import stored
from hourloom.llm.ordering import numbered_within

FANOUT = 16
#: Levels from one stored level to the next.
EVERY = 2
#: Fields of a document's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_HEX = "array<struct<before:string,after:string>>"


class Tree(NamedTuple):
    """levels: the stored ones from the leaves up, ``(group, place, total, digest ...)``, where
    ``total`` counts the group's nodes on that level. roots: ``(group, digest)``."""

    levels: list[DataFrame]
    roots: DataFrame


def field(value: Column) -> Column:
    """A value as it is hashed: its bytes with their count before them; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(nodes, "")


def _step(nodes: Column) -> Column:
    """The level above consecutive nodes."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / FANOUT).cast("int") - 1)
    return F.transform(runs, lambda i: F.sha2(_joined(F.slice(nodes, i * FANOUT + 1, FANOUT)).cast("binary"), 256))


def _above(total: Column) -> Column:
    return F.ceil(total / FANOUT).cast("long")


def _subtrees(level: DataFrame, *more: str) -> DataFrame:
    """The nodes below each stored node of the next level, in order, as ``members``, with all
    levels of the subtree: ``nodes0`` (stored), ``nodes1`` ... (made again), and the group's
    count on each, ``total0`` ... Groups that are one node already are left out."""
    size = FANOUT**EVERY
    found = (
        level.where("total > 1")
        .groupBy("group", F.floor(F.col("place") / size).alias("up"), F.col("total").alias("total0"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", *more))).alias("members"))
        .withColumn("nodes0", F.transform("members", lambda m: m["digest"]))
    )
    for i in range(EVERY):
        nodes, total = F.col(f"nodes{i}"), F.col(f"total{i}")
        found = found.withColumns(
            {f"nodes{i + 1}": F.when(total > 1, _step(nodes)).otherwise(nodes), f"total{i + 1}": _above(total)}
        )
    return found


def build(leaves: DataFrame, label: str) -> Tree:
    """The tree of each group of ``(group, place, total, digest)``."""
    levels = [leaves]
    while not (live := levels[-1].where("total > 1")).isEmpty():
        up = _subtrees(live).select(
            "group",
            F.col("up").alias("place"),
            F.col(f"total{EVERY}").alias("total"),
            F.get(f"nodes{EVERY}", F.lit(0)).alias("digest"),
        )
        levels.append(stored(up, f"{label}-level"))
    roots = None
    for level in levels:
        done = level.where("total = 1").select("group", "digest")
        roots = done if roots is None else roots.unionByName(done)
    return Tree(levels, roots)


def proofs(tree: Tree, tops: DataFrame, *more: str) -> DataFrame:
    """``(group, digest, more ..., carried ..., proof)`` for every leaf of the tree.

    tops: ``(group, proof, carried ...)``, one row per group, the proof above its root. A proof
    lists the joined siblings before and after a node, level by level, up to the top.
    """
    carried = [c for c in tops.columns if c not in ("group", "proof")]
    below = None  # proofs of the stored level above the one at hand
    for k in range(len(tree.levels) - 1, -1, -1):
        level, extra = tree.levels[k], (more if k == 0 else ())
        whole = level.where("total = 1").join(tops, "group")
        out = whole.select("group", "place", "digest", *extra, *carried, "proof")
        if below is not None:
            trees = _subtrees(level, *extra).join(
                below.select("group", F.col("place").alias("up"), *carried, "proof"), ["group", "up"]
            )
            kept = [c for c in trees.columns if c.startswith(("nodes", "total"))]
            # Siblings are cut from levels of the subtree that were made once, above.
            each = trees.select("group", *carried, "proof", *kept, F.posexplode("members").alias("i", "m"))
            entries = []
            for s in range(EVERY):
                nodes, j = F.col(f"nodes{s}"), F.floor(F.col("i") / FANOUT**s).cast("int")
                at = j % FANOUT
                pair = F.struct(
                    _joined(F.slice(nodes, j - at + 1, at)).alias("before"),
                    _joined(F.slice(nodes, j + 2, FANOUT - 1 - at)).alias("after"),
                )
                entries.append(F.when(F.col(f"total{s}") > 1, F.array(pair)).otherwise(F.array().cast(_HEX)))
            out = out.unionByName(
                each.select(
                    "group",
                    F.col("m.place").alias("place"),
                    F.col("m.digest").alias("digest"),
                    *[F.col("m")[c].alias(c) for c in extra],
                    *carried,
                    F.concat(*entries, "proof").alias("proof"),
                )
            )
        below = out
    return below.drop("place")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(
        proof, leaf, lambda node, p: F.sha2(F.concat(p["before"], node, p["after"]).cast("binary"), 256)
    )


def siblings(proof: Column) -> Column:
    """All siblings of a proof joined, level by level, left to right."""
    return F.array_join(F.flatten(F.transform(proof, lambda p: F.array(p["before"], p["after"]))), "")


def manifest(
    df: DataFrame,
    fields: Sequence[str] = FIELDS,
    id: str = "doc_id",
    group: str = "source",
    altered: dict[str, Column] | None = None,
    when: Column | None = None,
) -> DataFrame:
    """Per row: id, leaf, subroot (of its group), root, proof, folded_root.

    Leaves ascend by id within their group, null ids first, equal ids by their leaves; groups
    ascend bytewise, null first, and null is a group of its own. ``folded_root`` is
    made from the row's own leaf, or, where ``when`` holds, from that of its ``altered``
    fields; the siblings are those of the rows as they are. A group with one row
    has its leaf as subroot, one group alone its subroot as root. Repeated rows are leaves of their
    own. An empty table gives no rows. Columns beyond the fields are ignored.
    """
    values = [F.col(c) for c in fields]
    changed = [(altered or {}).get(c, F.col(c)) for c in fields]
    # A key that is never null and sorts as groups do: null, then by bytes.
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    hit = F.lit(False) if when is None else F.coalesce(when, F.lit(False))
    rows = df.select(
        key.alias("group"),
        F.col(id).alias("id"),
        leaf_of(values).alias("digest"),
        F.when(hit, leaf_of(changed)).alias("altered"),
    )
    leaves = numbered_within(rows, "group", ["id", "digest"], "place", "total", "merkle-leaves")
    groups = build(leaves, "merkle")
    subroots = groups.roots.select(F.lit("").alias("group"), F.col("group").alias("key"), "digest")
    over = build(numbered_within(subroots, "group", ["key"], "place", "total", "merkle-groups"), "merkle-top")
    top = over.roots.select("group", F.col("digest").alias("root"), F.array().cast(_HEX).alias("proof"))
    tops = proofs(over, top, "key").select(F.col("key").alias("group"), F.col("digest").alias("subroot"), "root", "proof")
    found = proofs(groups, tops, "id", "altered")
    return found.select(
        F.col("id").alias(id),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "proof",
        fold(F.coalesce("altered", "digest"), F.col("proof")).alias("folded_root"),
    )
