"""Merkle manifest of a dataset: one digest for all rows, one per source, a proof for each row.

A row's leaf is the SHA-256 of its fields, each as its byte count and value. A source's leaves stand
in ascending order of id; every 16 in a row become the SHA-256 of their digests, level by level,
until one node, the subroot, remains. The subroots, in order of source, likewise become the root.

Slot pivot: one grouped aggregate per level spreads the children of a parent over 16 columns, one a
slot. The columns side by side are what the parent hashes; side by side without the own slot they
are a child's siblings. On the way up each level's pivot is stored; on the way down a parent's path
meets its pivot in one join and goes to its children with their siblings put in front. A lone
node passes both ways unchanged, so sources of any size and depth run through the same levels.

Nothing grows with a group: levels are grouped by parent, and positions within a source come from
range partitions (``places``), so a source with most of all rows is spread like any others. Texts
are read once and never shuffled; 32 bytes of a leaf in 64 hex digits are what moves.

Defined results: a null field enters a leaf as ``-``, an empty one as ``0:``. Rows without an id come
first in their source, rows without a source first of all. Rows that repeat an id go by their leaf, and equal
rows are leaves of their own in adjacent places. One row alone is its source's subroot, one source
alone gives the root; an empty table gives no rows and a null root. Columns besides ``fields`` are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.llm.places import group_key, positions
from tradewind.operators.scratch import materialize

FANOUT = 16
STEP = "array<struct<left: string, right: string>>"


def leaf(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, a colon and its value."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, from the lowest level up, lead to."""
    step = lambda node, at: F.sha2(F.concat(at["left"], node, at["right"]).cast("binary"), 256)
    return F.aggregate(path, start, step)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, left to right within a level, the lowest level first."""
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), "").cast("binary"), 256)


def _slots() -> list[str]:
    return [f"c{i}" for i in range(FANOUT)]


def _digest(slot: str) -> Column:
    return F.col(slot)["node"]


def _pivoted(nodes: DataFrame, group: str, label: str) -> DataFrame:
    """Stored rows (group, pos, n, c0..c15, node): the parents of ``nodes`` (group, pos, n, item)."""
    slot = F.pmod("pos", F.lit(FANOUT))
    spread = nodes.groupBy(group, F.floor(F.col("pos") / FANOUT).alias("parent")).agg(
        F.min("n").alias("children"),
        *[F.max(F.when(slot == i, F.col("item"))).alias(name) for i, name in enumerate(_slots())],
    )
    joined = F.sha2(F.concat_ws("", *map(_digest, _slots())).cast("binary"), 256)
    lone = F.col("children") == 1
    parents = spread.select(
        group,
        F.col("parent").alias("pos"),
        F.ceil(F.col("children") / FANOUT).cast("long").alias("n"),
        lone.alias("lone"),
        *_slots(),
        F.when(lone, _digest("c0")).otherwise(joined).alias("node"),
    )
    return materialize(parents, label)


@dataclass
class Tree:
    """The stored levels over the items of each group, lowest first, and each group's root."""

    group: str
    levels: list[DataFrame]

    @classmethod
    def over(cls, items: DataFrame, group: str, label: str) -> Tree:
        """``items`` has ``pos`` and ``n`` within ``group``, and a struct ``item`` with the digest as ``node``."""
        levels = [_pivoted(items, group, label)]
        while levels[-1].agg(F.max("n")).first()[0] not in (None, 1):
            nodes = levels[-1].select(group, "pos", "n", F.struct("node").alias("item"))
            levels.append(_pivoted(nodes, group, label))
        return cls(group, levels)

    def roots(self) -> DataFrame:
        return self.levels[-1].select(self.group, "node")

    def paths(self, above: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
        """(group, item, path) of all items; ``above`` has the (group, path) of the roots and columns to hand down."""
        down = above.withColumn("pos", F.lit(0).cast("long"))
        for depth in range(len(self.levels) - 1, -1, -1):
            children = self._children(self.levels[depth].drop("n", "node").join(down, [self.group, "pos"]), carried)
            if depth:
                down = children.drop("item")
        return children.drop("pos")

    def _children(self, parents: DataFrame, carried: Sequence[str]) -> DataFrame:
        names = _slots()

        def side(slots: list[str]) -> Column:
            return F.concat_ws("", *map(_digest, slots)) if slots else F.lit("")

        steps = [
            F.struct(F.lit(i).alias("slot"), F.col(c).alias("item"), side(names[:i]).alias("left"), side(names[i + 1 :]).alias("right"))
            for i, c in enumerate(names)
        ]
        each = parents.select(self.group, "pos", "lone", "path", *carried, F.explode(F.array(*steps)).alias("at"))
        step = F.array(F.struct(F.col("at.left").alias("left"), F.col("at.right").alias("right")))
        return each.filter(F.col("at.item").isNotNull()).select(
            self.group,
            (F.col("pos") * FANOUT + F.col("at.slot")).alias("pos"),
            F.col("at.item").alias("item"),
            F.when(F.col("lone"), F.col("path")).otherwise(F.concat(step, F.col("path"))).alias("path"),
            *carried,
        )


@dataclass
class Manifest:
    """The root, (source, subroot) of each source, and each row with its path."""

    subroots: DataFrame
    root: str | None
    rows: DataFrame


def manifest(docs: DataFrame, fields: Sequence[str], id_col: str = "doc_id", group_col: str = "source", **payload: Column) -> Manifest:
    """The tree over ``docs``; ``payload`` names further values that travel with each leaf.

    ``rows`` has one row per document: source, id, leaf, the payload, subroot and ``path``, the siblings of each
    level as (left, right), the lowest level first.
    """
    items = docs.select(
        group_key(F.col(group_col)).alias("skey"),
        F.col(group_col).alias("source"),
        F.col(id_col).alias("id"),
        leaf([F.col(c) for c in fields]).alias("node"),
        *[value.alias(name) for name, value in payload.items()],
    )
    placed = positions(materialize(items, "leaves"), "skey", ["id", "node"])
    item = F.struct("node", "id", "source", *payload).alias("item")
    lower = Tree.over(placed.select("skey", "pos", "n", item), "skey", "source-level")

    subroots = materialize(lower.roots(), "subroots").withColumn("all", F.lit("all"))
    ordered = positions(subroots, "all", ["skey"])
    upper = Tree.over(ordered.select("all", "pos", "n", F.struct("node", "skey").alias("item")), "all", "root-level")
    top = upper.roots().first()
    start = upper.roots().select("all", F.array().cast(STEP).alias("path"))
    above = upper.paths(start).select(F.col("item.skey").alias("skey"), F.col("item.node").alias("subroot"), "path")
    above = materialize(above, "subroot-paths")
    rows = lower.paths(above, ["subroot"]).select("item.source", "item.id", F.col("item.node").alias("leaf"), *[F.col(f"item.{p}") for p in payload], "subroot", "path")
    names = above.select(F.expr("CASE WHEN skey = '' THEN NULL ELSE substring(skey, 2) END").alias("source"), "subroot")
    return Manifest(names, top and top["node"], rows)


def verified(
    docs: DataFrame,
    fields: Sequence[str],
    altered: dict[str, Column],
    where: Column,
    id_col: str = "doc_id",
    group_col: str = "source",
) -> DataFrame:
    """Checks every row against the root, as if the rows ``where`` now held ``altered`` values.

    Adds nothing to the manifest, which is that of the unaltered rows: each row's leaf, of the altered
    fields where they are altered, is folded with the row's own siblings. Returns id, leaf, subroot, root,
    proof_sha256, folded_root and verified.
    """
    now = leaf([altered.get(c, F.col(c)) for c in fields])
    found = manifest(docs, fields, id_col, group_col, now=F.when(where, now))
    return found.rows.select(
        "id",
        "leaf",
        "subroot",
        F.lit(found.root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("now", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
