"""A Merkle manifest of a table: a digest tree per group, one tree over the groups, a proof per row.

Digests are SHA-256; inputs of a digest are concatenated, digests among them as hexadecimal text.
Leaves of a group are numbered along ``order`` and every ``fanout`` consecutive nodes become one
parent, until one node is left: the subroot. Subroots, ordered by group, become the root likewise.

Every level equijoins its nodes with themselves on computed sibling positions: the position XOR 1
for two children, the positions of the run's other slots otherwise. The node in slot zero has then
all digests of its run and emits the parent. Positions are unique in a group, so however large a
group is, a join key holds one row and nothing depends on the number of groups. What reaches the
driver is the largest group's number of leaves, which gives the number of levels. On the way back
each child joins its parent's proof and puts its own siblings in front of it.

Leaves are numbered without a window over a group: rows are range-partitioned and sorted by group
and order, numbered within their partition, and shifted by what earlier partitions hold.

Defined cases: a null field is ``-``; an empty text is ``0:``; texts are hashed whole; a null group is a
group of its own and comes first; null keys come first in their group, rows of equal key follow
their digests, and rows equal in these too are interchangeable; a lone leaf is its group's subroot,
and a lone subroot the root; an empty table gives an empty manifest. Columns other than those
named are not read and can't clash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from evenkeel.session import materialize

NO_STEPS = "CAST(array() AS array<struct<before: binary, after: binary>>)"


def field(value: Column) -> Column:
    """A value as input of a digest: its UTF-8 byte count, a colon, the value; a dash if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def hashed(*parts: Column) -> Column:
    """The digest of concatenated texts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaf_digest(*values: Column) -> Column:
    return hashed(*[field(v) for v in values])


def group_key(value: Column) -> Column:
    """A text without nulls that orders as the group does, null first and then bytewise."""
    return F.coalesce(F.concat(F.lit("+"), value.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (``group``, ...) with ``pos`` from 0 along ``order`` in the group, and ``n``, the group's size."""
    tie = F.monotonically_increasing_id()  # parts rows that are equal otherwise, so they needn't share a task
    keys = ["group", *order, "_tie"]
    spread = rows.withColumn("_tie", tie).repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
    ordered = spread.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys]).drop("_tie")
    placed = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    # As many rows as partitions and groups together, as partitions are ranges.
    parts = placed.groupBy("group", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy("group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "group",
        "_part",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("group")).alias("n"),
    )
    return placed.join(parts, ["group", "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with the joined digests of the run's earlier slots (``before``) and later ones (``after``)."""
    run, slot = F.expr(f"pos div {fanout}"), F.col("pos") % fanout
    level = nodes.withColumn("run", run).withColumn("slot", slot)
    before, after = [F.lit(b"")], [F.lit(b"")]
    for k in range(fanout - 1):
        comes_before = F.lit(k) < F.col("slot")
        if fanout == 2:
            sibling = F.col("pos").bitwiseXOR(F.lit(1))
        else:
            sibling = F.col("run") * fanout + F.when(comes_before, k).otherwise(k + 1)
        other = nodes.select("group", F.col("pos").alias("_sibling"), F.col("digest").alias(f"_digest{k}"))
        level = level.withColumn("_sibling", sibling).join(other, ["group", "_sibling"], "left").drop("_sibling")
        digest = F.coalesce(F.col(f"_digest{k}"), F.lit(b""))
        before.append(F.when(comes_before, digest).otherwise(F.lit(b"")))
        after.append(F.when(comes_before, F.lit(b"")).otherwise(digest))
    level = level.withColumns({"before": F.concat(*before), "after": F.concat(*after)})
    return level.drop(*[f"_digest{k}" for k in range(fanout - 1)])


def build_levels(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The levels from leaves (``group``, ``pos``, ``n``, ``digest``) up; a node with ``n`` = 1 is its group's top."""
    if fanout < 2:
        raise ValueError("a parent needs two children at least")
    size = leaves.agg(F.max("n")).first()[0] or 0
    levels, nodes = [], leaves
    while size > 0:
        level = materialize(with_siblings(nodes, fanout), f"merkle-level-{len(levels)}")
        levels.append(level)
        if size == 1:
            break
        nodes = level.where("slot = 0 AND n > 1").select(
            "group",
            F.col("run").alias("pos"),
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
            hashed(hexed(F.col("digest")), hexed(F.col("after"))).alias("digest"),
        )
        size = -(-size // fanout)
    return levels


def with_proofs(levels: list[DataFrame], tops: DataFrame | None) -> DataFrame:
    """The lowest level with ``steps`` to the root, ``subroot`` and ``root``.

    ``tops`` (``group``, ``above``, ``root``) continues the proof above a group's top; without it the top is the root.
    """
    proved = None
    for level in reversed(levels):
        top = level.where("n = 1").withColumn("subroot", F.col("digest"))
        if tops is None:
            top = top.withColumns({"root": F.col("digest"), "steps": F.expr(NO_STEPS)})
        else:
            top = top.join(tops, "group").withColumnRenamed("above", "steps")
        if proved is None:
            proved = top
            continue
        parents = proved.select(
            "group", F.col("pos").alias("run"), "subroot", "root", F.col("steps").alias("_above")
        )
        inner = level.where("n > 1").join(parents, ["group", "run"])
        own = F.array(F.struct("before", "after"))
        inner = inner.withColumn("steps", F.concat(own, F.col("_above"))).drop("_above")
        proved = inner.unionByName(top)
    return proved


def fold(digest: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        steps, digest, lambda acc, s: hashed(hexed(s["before"]), hexed(acc), hexed(s["after"]))
    )


def proof_digest(steps: Column) -> Column:
    """One digest of all siblings of a proof, level by level and left to right."""
    return hashed(F.array_join(F.transform(steps, lambda s: hexed(F.concat(s["before"], s["after"]))), ""))


def build_manifest(
    docs: DataFrame,
    leaf: Column,
    group: str = "source",
    order: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
    fanout: int = 3,
) -> DataFrame:
    """Per row of ``docs``: ``order``, ``group``, leaf, subroot, root (32 bytes each), steps, and the columns of ``carry``.

    ``steps`` lists, from the leaf up, the digests before and after the node within its run. The
    expressions of ``carry`` are taken in the same scan; their names can't be those of the results.
    """
    carry = dict(carry or {})
    clash = set(carry) & {order, group, "leaf", "subroot", "root", "steps"}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results already")
    values = {f"carry_{i}": c for i, c in enumerate(carry.values())}
    key, named = F.col(order).alias("key"), [c.alias(name) for name, c in values.items()]
    leaves = materialize(
        docs.select(group_key(F.col(group)).alias("group"), F.col(group).alias("name"), key, leaf.alias("digest"), *named),
        "merkle-leaves",
    )
    levels = build_levels(materialize(numbered(leaves, ["key", "digest"]), "merkle-numbered"), fanout)
    if not levels:
        proved = leaves.withColumns({"subroot": F.col("digest"), "root": F.col("digest"), "steps": F.expr(NO_STEPS)})
    else:
        tops = levels[0].where("n = 1").select("group", "digest")
        for level in levels[1:]:
            tops = tops.unionByName(level.where("n = 1").select("group", "digest"))
        subroots = tops.select(F.lit("").alias("group"), F.col("group").alias("of"), "digest")
        upper = build_levels(materialize(numbered(subroots, ["of"]), "merkle-subroots"), fanout)
        above = with_proofs(upper, None).select(F.col("of").alias("group"), F.col("steps").alias("above"), "root")
        proved = with_proofs(levels, materialize(above, "merkle-tops"))
    return proved.select(
        F.col("key").alias(order),
        F.col("name").alias(group),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "steps",
        *[F.col(c).alias(name) for c, name in zip(values, carry)],
    )
