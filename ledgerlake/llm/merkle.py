"""A manifest of a dataset: a Merkle tree over the rows of each group, and one over the groups' roots.

Only DataFrame functions. Level by level, lag and lead at fixed offsets bring each node its sibling,
masked by the node's slot and by how long its run is; rows of first children hash the parents.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.ranges import in_order, part_of
from ledgerlake.llm.tables import stored

#: Levels that one window builds: it holds 2 ** LEVELS rows, however large a group is.
LEVELS = 10
#: What a leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (lowercase hex) of values, each as its bytes' number, a colon and itself; null as `-`."""
    texts = [v.cast("string") for v in values]
    framed = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(f, F.lit("-")) for f in framed]), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """The rows with slot (from 0, per group, in ascending order, nulls first) and n (rows of the group).

    Rows are dealt by ranges of group and order, equal ones too, so a large group is many tasks; a
    row's slot is its place in the part of its group that is in its range, and the sizes of the parts
    before it.
    """
    placed = in_order(rows, [group, *order], name).withColumn("_part", part_of())
    parts = placed.groupBy(group, "_part").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        group,
        "_part",
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("n"),
    )
    slot = (F.col("_at") - F.col("_first") + F.col("_before")).alias("slot")
    return placed.join(starts, [group, "_part"]).select(*rows.columns, slot, "n")


def _block(nodes: DataFrame) -> DataFrame:
    """nodes with block, path (of the lowest LEVELS levels) and, on the first row of a block, its
    root in place of its node.

    A row stands for the nodes whose first leaf it is. What a node finds beside it is told by one
    letter and the sibling's digest: L, R, or - alone.
    """
    block = F.shiftright("slot", LEVELS)
    rows = nodes.withColumn("block", block).withColumn("up", F.col("node"))
    run = Window.partitionBy("grp", "block").orderBy("slot")
    slot, n = F.col("slot"), F.col("n")
    for level in range(LEVELS):
        step = 1 << level
        is_node = (slot.bitwiseAND(F.lit(step - 1)) == 0) & (n > step)
        first = slot.bitwiseAND(F.lit(step)) == 0
        paired = slot + step < n
        right = F.when(paired, F.lead("up", step).over(run))
        left = F.lag("up", step).over(run)
        beside = (
            F.when(~first, F.concat(F.lit("L"), "left"))
            .when(paired, F.concat(F.lit("R"), "right"))
            .otherwise(F.lit("-"))
        )
        parent = F.sha2(F.concat("up", F.coalesce("right", F.lit(""))), 256)
        rows = rows.withColumns({"left": left, "right": right}).withColumns(
            {
                f"beside_{level}": F.when(is_node, beside),
                "up": F.when(is_node & first, parent).otherwise(F.col("up")),
            }
        )
    rows = rows.withColumn("path", F.array().cast("array<string>"))
    for level in reversed(range(LEVELS)):
        step = 1 << level
        first = slot.bitwiseAND(F.lit(step)) == 0
        rows = rows.withColumn("left", F.lag("path", step).over(run))
        above = F.when(first, F.col("path")).otherwise(F.col("left"))
        own = F.when(n > step, F.array(f"beside_{level}")).otherwise(F.array().cast("array<string>"))
        is_node = slot.bitwiseAND(F.lit(step - 1)) == 0
        rows = rows.withColumn("path", F.when(is_node, F.concat(own, above)))
    return rows.drop("left", "right", *[f"beside_{level}" for level in range(LEVELS)])


def _climb(nodes: DataFrame, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """nodes (grp, slot, n, node and others) with path up to the end of `finish`, and its `ends`.

    `finish` gets the last node of each group and returns grp, slot, path and ends. What it finds
    comes down block by block, so no join has more than 2 ** LEVELS rows of a key.
    """
    if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
        more = finish(nodes).select("grp", "slot", "path", "ends")
        return nodes.join(more, ["grp", "slot"])
    built = _block(nodes)
    roots = built.where(F.col("slot").bitwiseAND(F.lit((1 << LEVELS) - 1)) == 0).select(
        "grp",
        F.col("block").alias("slot"),
        F.shiftright(F.col("n") + ((1 << LEVELS) - 1), LEVELS).alias("n"),
        F.col("up").alias("node"),
    )
    above = _climb(stored(roots, "merkle-roots"), finish)
    above = above.select("grp", F.col("slot").alias("block"), F.col("path").alias("more"), "ends")
    joined = built.join(above, ["grp", "block"])
    return joined.withColumn("path", F.concat("path", "more")).drop("block", "up", "more")


def _whole_tree(tops: DataFrame) -> DataFrame:
    """grp, slot, path and ends (subroot, root) of the last node of each group."""
    empty = F.array().cast("array<string>")
    runs = tops.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
    found = _climb(
        numbered(runs, "grp", ["name"], "merkle-subroots"),
        lambda top: top.select("grp", "slot", empty.alias("path"), F.col("node").alias("ends")),
    )
    ends = F.struct(F.col("node").alias("subroot"), F.col("ends").alias("root"))
    slot = F.lit(0).cast("long").alias("slot")
    return found.select(F.col("name").alias("grp"), slot, "path", ends.alias("ends"))


def manifest(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """`doc_id`, leaf, subroot, root, path and row (the carried columns as a struct, if any) of every row.

    A group's leaves are in ascending order of `doc_id`, nulls first, equal ids by their digests;
    equal rows are leaves of their own. Every two neighbours become the SHA-256 of their digests
    (text of both), the last one alone of its own, until one is left: the subroot, of a lone leaf the
    leaf. The subroots, in order of the group (null first, by bytes), make the root alike.

    path: for each level up to the root L or R with the sibling on that side, or - without one.
    Null and empty values differ. Other columns, of whatever name, are not read. An empty table has
    no rows, and no root.
    """
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    carried = [F.struct(*carry).alias("row")] if carry else []
    leaves = docs.select(
        F.col(doc_id).alias("key"),
        grp.alias("grp"),
        leaf_digest([F.col(f) for f in fields]).alias("node"),
        *carried,
    )
    found = _climb(numbered(leaves, "grp", ["key", "node"], "merkle-leaves"), _whole_tree)
    return found.select(
        F.col("key").alias(doc_id),
        F.col("node").alias("leaf"),
        "ends.subroot",
        "ends.root",
        "path",
        *(["row"] if carry else []),
    )


def siblings(path: Column) -> Column:
    """The digests of a path in their order, without the sides."""
    return F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives along a path: the manifest's, if and only if the leaf is as it was."""

    def step(node: Column, beside: Column) -> Column:
        side, other = F.left(beside, F.lit(1)), F.substring(beside, 2, 64)
        both = F.when(side == "L", F.concat(other, node)).otherwise(F.concat(node, other))
        return F.sha2(both, 256)

    return F.aggregate(path, leaf, step)
