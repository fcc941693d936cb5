"""A Merkle manifest of a table: one digest for all rows, and for each row a proof that it is among them.

The rows of a group, in order, are the leaves of a tree in which up to three consecutive nodes have the digest of
their digests, one after the other, as parent. The groups' roots, in order, are the leaves of a tree on top.

A proof is what a leaf lacks to work out the root: at each level the digests left and right of its own node. Proofs are
made by pointer jumping. Each node starts with the segment from itself to its parent. A self-join then gives every
node the segment of the ancestor that it has reached, so the distance doubles until all
have reached the root: a tree of d levels takes log2(d) joins, whatever the number of leaves.

Leaves are numbered by a range partitioning and counts for each partition, so a group of any size is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepstream.llm.tables import settled

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST_ROWS = 100_000  # of some fifty bytes
_TOP = -1  # number of the tree over the groups, whose own numbers start at 0
_NODE = "struct<tree:bigint,level:int,at:bigint>"
_STEP = "struct<left:binary,right:binary>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(*fields: Column) -> Column:
    """Digest of a row: ``-`` for each NULL, else the value's length in bytes, a colon, and the value."""

    def part(field):
        value = field.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return digest(*map(part, fields))


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def _small(df: DataFrame) -> DataFrame:
    """Marked for a broadcast if it has few rows; joined by a shuffle beyond that."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _numbered(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a running ``_at``; and by group and ``_part`` the first ``_at``, how many rows are there, and ``before`` in the group.

    The place of a row in its group is ``_at - first + before``.
    """
    dealt = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    rows = settled(dealt.withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_at", 33))  # that function's upper bits number the partition
    counts = rows.groupBy(*group, "_part").agg(F.min("_at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return rows, settled(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))


def _node(tree: Column, level: Column, at: Column, nodes: Column) -> Column:
    """The name of a node in a level of ``nodes``; the root of a group's tree is a leaf of the top tree."""
    own = F.struct(tree.alias("tree"), level.cast("int").alias("level"), at.alias("at"))
    as_leaf = F.struct(F.lit(_TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), tree.alias("at"))
    return F.when(nodes == 1, as_leaf).otherwise(own)


def _grow(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """From ``tree, at, n, hash``: for each level the links of its nodes to their parents, and the roots ``tree, hash``."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    links, roots, level, nodes = [], [leaves.where("n = 1")], 0, leaves
    partitions = _partitions(leaves)
    while most > 1:
        run = F.floor(F.col("at") / ARITY).alias("run")
        child = F.struct("at", "hash")
        runs = nodes.where("n > 1").groupBy("tree", "n", run).agg(F.array_sort(F.collect_list(child)).alias("children"))
        partitions = max(1, partitions // ARITY)  # a level has a third of the rows of the one below
        runs = settled(runs.coalesce(partitions))
        fewer = F.ceil(F.col("n") / ARITY)

        def step(child, i):
            left, right = F.slice("children", 1, i), F.slice("children", i + 2, ARITY)
            joined = [F.aggregate(side, F.lit(b""), lambda a, c: F.concat(a, c["hash"])) for side in (left, right)]
            return F.struct(child["at"].alias("at"), joined[0].alias("left"), joined[1].alias("right"))

        steps = runs.select("tree", "n", "run", F.explode(F.transform("children", step)).alias("step"))
        links.append(
            steps.select(
                _node(F.col("tree"), F.lit(level), F.col("step.at"), F.col("n")).alias("node"),
                _node(F.col("tree"), F.lit(level + 1), F.col("run"), fewer).alias("ancestor"),
                F.array(F.struct("step.left", "step.right")).cast(f"array<{_STEP}>").alias("segment"),
            )
        )
        parent = F.unhex(digest(F.array_join(F.transform("children", lambda c: _hex(c["hash"])), "")))
        nodes = runs.select("tree", F.col("run").alias("at"), fewer.alias("n"), parent.alias("hash"))
        roots.append(nodes.where("n = 1"))
        level, most = level + 1, -(-most // ARITY)
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return links, found.select("tree", "hash")


def _to_root(links: list[DataFrame], n_trees: int, spark) -> DataFrame:
    """``node, segment`` from every node to the root, by pointer jumping."""
    if not links:
        return spark.createDataFrame([], f"node {_NODE}, segment array<{_STEP}>")
    paths = links[0]
    for more in links[1:]:
        paths = paths.unionByName(more)
    paths, reach = settled(paths), 1
    root_at = 0 if n_trees == 1 else _TOP  # the root of a lone tree is the one leaf on top
    while reach < len(links):
        # Leaves are nobody's ancestor, but those of the top tree, which are the groups' roots.
        inner = paths.where((F.col("node.level") > 0) | (F.col("node.tree") == _TOP))
        inner = inner.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("further"), F.col("segment").alias("more"))
        at_root = F.col("ancestor.tree").eqNullSafe(_TOP) & F.col("ancestor.at").eqNullSafe(root_at)
        moved = paths.where(~at_root).join(inner, "ancestor")
        moved = moved.select("node", F.col("further").alias("ancestor"), F.concat("segment", "more").alias("segment"))
        paths, reach = settled(moved.unionByName(paths.where(at_root)).coalesce(_partitions(moved))), 2 * reach
    return paths.select("node", "segment")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its way upwards give."""
    return F.aggregate(path, leaf, lambda own, s: digest(_hex(s["left"]), own, _hex(s["right"])))


def proof_digest(path: Column) -> Column:
    """Digest of all digests of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: _hex(F.concat(s["left"], s["right"]))), ""))


def manifest(
    docs: DataFrame, *keep: str, id: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS
) -> DataFrame:
    """``keep``, ``leaf``, ``subroot`` and ``root`` (hex), and ``path``, an array of ``left, right`` (bytes), for every row.

    Leaves ascend by ``id`` in their group, NULL first, then by digest; groups ascend as UTF-8 bytes, NULL first. NULL in a field counts
    as ``-``. Repeated rows are leaves of their own. A lone leaf is its group's root, a lone group's root the root. An empty table gives no
    rows. Columns other than ``keep``, ``id``, ``group`` and ``fields`` are not looked at.
    """
    rows = docs.select(
        F.struct(*keep).alias("_keep"),
        F.col(group).alias("_group"),
        F.col(id).alias("_id"),
        F.unhex(row_digest(*map(F.col, fields))).alias("_leaf"),
    )
    rows, counts = _numbered(rows, ["_group"], ["_id", "_leaf"])
    groups, group_counts = _numbered(counts.groupBy("_group").agg(F.sum("n").alias("leaves")), [], ["_group"])
    trees = groups.join(_small(group_counts.select("_part", "first", "before")), "_part")
    trees = trees.select("_group", "leaves", (F.col("_at") - F.col("first") + F.col("before")).alias("tree"))
    trees = settled(trees)
    n_trees = trees.count()

    other = trees.withColumnRenamed("_group", "_other")
    placed = counts.join(other, F.col("_group").eqNullSafe(F.col("_other"))).drop("_other")
    placed = settled(placed.select(F.col("_group").alias("_other"), F.col("_part").alias("_in"), "first", "before", "tree", "leaves"))
    here = F.col("_group").eqNullSafe(F.col("_other")) & (F.col("_part") == F.col("_in"))
    at = F.col("_at") - F.col("first") + F.col("before")
    leaves = rows.join(_small(placed), here).select("_keep", "_leaf", "tree", at.alias("at"), F.col("leaves").alias("n"))
    leaves = settled(leaves)

    links, subroots = _grow(leaves.select("tree", "at", "n", F.col("_leaf").alias("hash")))
    subroots = settled(subroots)
    top = subroots.select(F.lit(_TOP).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.lit(n_trees).cast("bigint").alias("n"), "hash")
    top_links, root = _grow(top)
    root = root.select(_hex(F.col("hash"))).first()
    paths = _to_root(links + top_links, n_trees, docs.sparkSession)

    own = _node(F.col("tree"), F.lit(0), F.col("at"), F.col("n")).cast(_NODE)
    proven = leaves.withColumn("node", own).join(paths, "node", "left")
    proven = proven.join(_small(subroots), "tree")
    empty = F.array().cast(f"array<{_STEP}>")
    return proven.select(
        "_keep.*",
        _hex(F.col("_leaf")).alias("leaf"),
        _hex(F.col("hash")).alias("subroot"),
        F.lit(root[0] if root else None).cast("string").alias("root"),
        F.coalesce("segment", empty).alias("path"),
    )
