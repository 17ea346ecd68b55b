"""A manifest of a data set as a hash tree, with a proof for every row that leads from its leaf to the root.

The method is pointer jumping.  Every node of the tree holds a pointer to an ancestor and the segment of
siblings that lies between: at first its parent and the nodes beside it.  A self-join of the nodes along the
pointers appends to each node's segment the one of the node it points to, which doubles the distance of all
pointers; after a number of joins that grows with the logarithm of the tree's height every leaf points at
the root, and its segment is its proof.

Leaves are digests of rows.  Within a group (a language, say) they are ordered, and ``RUN`` consecutive nodes
at a time become one of the level above, until one is left, the group's subroot; subroots in the order of
their groups are the leaves of the last tree, whose top is the root.  Places in the order come from a range
partitioning and the counts of its parts, so no group has to fit a task, however many rows it has.

Every join on a pointer is a plain one.  The nodes pointed at become fewer by ``RUN`` to the power of the
distance with each round, so that many leaves share one; Spark broadcasts them where they are small and
splits what is hot where they are not.  Intermediate tables are written to the shared folder.  The driver
learns the size of the largest group, the number of groups and the root.

Null values have a digest of their own kind, apart from empty texts.  A null group is a group, ordered
first; null order keys come first in their group; rows with equal keys are ordered by their leaves, and rows
that are equal altogether by their place in the input, which changes no digest.  No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioscope.llm.shared import Work

#: Nodes that become one of the level above.
RUN = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(*values: Column) -> Column:
    """Digest of a row's values in this order: ``-`` for null, else the length in UTF-8 bytes, ``:`` and the value."""
    texts = [value.cast("string") for value in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]), 256)


def lowered(text: Column) -> Column:
    """A-Z as a-z; what a tampered copy may look like."""
    return F.translate(text, _UPPER, _LOWER)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda all_, one: F.concat(all_, one))


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, start, lambda now, step: F.sha2(F.concat(_hex(step["before"]), now, _hex(step["after"])), 256))


def digest_of(proof: Column) -> Column:
    """Digest of a proof's siblings, level by level, left to right."""
    siblings = F.array_join(F.transform(proof, lambda step: F.concat(_hex(step["before"]), _hex(step["after"]))), "")
    return F.sha2(siblings, 256)


def height(n: int, run: int = RUN) -> int:
    """Levels above ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // run), levels + 1
    return levels


def ranked(work: Work, rows: DataFrame, group: str, *order: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``part`` and ``row_no``, and (group, part, first, before, n): the place of a row in its group is row_no - first + before."""
    keys = [F.asc_nulls_first(c) for c in (group, *order)]
    # Rows that are equal in all keys, of which there may be many, are split over the parts as well.
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*keys, F.asc("_tie")).sortWithinPartitions(*keys, F.asc("_tie")).drop("_tie")
    placed = work.stage(dealt.withColumn("row_no", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftright("row_no", 33))
    parts = placed.groupBy(group, "part").agg(F.min("row_no").alias("first"), F.count("*").alias("n"))
    so_far = Window.partitionBy(group).orderBy("part")  # as many rows as the group has parts
    return placed, parts.select(group, "part", "first", "n", (F.sum("n").over(so_far) - F.col("n")).alias("before"))


def _grouped(nodes: DataFrame, run: int, *others: Column) -> DataFrame:
    """The runs of nodes (g, n, at, digest) that become one node each; n is the number of nodes of the level."""
    digests = F.transform(F.sort_array(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"])
    up = F.floor(F.col("at") / run).alias("up")
    return nodes.where("n > 1").groupBy("g", "n", up).agg(digests.alias("digests"), *others)


def _above(runs: DataFrame, run: int) -> DataFrame:
    """The nodes that runs become."""
    digest = F.unhex(F.sha2(_hex(_joined(F.col("digests"))), 256))
    return runs.select("g", F.ceil(F.col("n") / run).alias("n"), F.col("up").alias("at"), digest.alias("digest"))


def _step(at: Column, run: int) -> Column:
    """What stands before and after a node in its run."""
    place = (at % run).cast("int")
    digests = F.col("digests")
    sides = [F.slice(digests, F.lit(1), place), F.slice(digests, place + 2, F.lit(run))]
    return F.array(F.struct(_joined(sides[0]).alias("before"), _joined(sides[1]).alias("after")))


def _pointer(run: int, level: int, top: bool, subroots: int) -> Column:
    """The parent of a run's nodes: (tree, level, place); null for the root.  A subroot is a leaf of the last tree, -1."""
    last = F.ceil(F.col("n") / run) == 1
    own = F.struct(F.col("g").alias("tree"), F.lit(level + 1).cast("long").alias("level"), F.col("up").alias("place"))
    leaf_of_last = F.struct(F.lit(-1).cast("long").alias("tree"), F.lit(0).cast("long").alias("level"), F.col("g").alias("place"))
    return F.when(~last, own) if top or subroots == 1 else F.when(last, leaf_of_last).otherwise(own)


def _nodes(runs: DataFrame, run: int, level: int, top: bool, subroots: int) -> DataFrame:
    """(tree, level, place, pointer, segment) of the nodes in runs."""
    each = runs.select("*", F.posexplode("digests").alias("pos", "digest"))
    at = F.col("up") * run + F.col("pos")
    tree = (F.lit(-1).cast("long") if top else F.col("g")).alias("tree")
    return each.select(tree, F.lit(level).cast("long").alias("level"), at.cast("long").alias("place"), _pointer(run, level, top, subroots).alias("pointer"), _step(at, run).alias("segment"))


def _tree(work: Work, nodes: DataFrame, levels: int, level: int, run: int, top: bool, subroots: int) -> tuple[DataFrame | None, DataFrame]:
    """All nodes from ``level`` on but the tops, as _nodes, and the tops (g, digest) of the trees."""
    tops, found = nodes.where("n = 1").select("g", "digest"), None
    for k in range(level, levels):
        runs = work.stage(_grouped(nodes, run))
        of_level = _nodes(runs, run, k, top, subroots)
        found = of_level if found is None else found.union(of_level)
        nodes = _above(runs, run)
        tops = tops.union(nodes.where("n = 1").select("g", "digest"))
    return found, tops


def _jumped(rows: DataFrame, nodes: DataFrame, spread: Column) -> DataFrame:
    """Each row's pointer and segment extended by those of the node it points to; rows that point nowhere stay, spread over the tasks."""
    to = nodes.select(F.col("tree").alias("t"), F.col("level").alias("l"), F.col("place").alias("p"), F.col("pointer").alias("further"), F.col("segment").alias("more"))
    rows = rows.withColumns({"t": F.coalesce("pointer.tree", F.lit(-2)), "l": F.coalesce("pointer.level", F.lit(-1)), "p": F.coalesce("pointer.place", spread)})
    jumped = rows.join(to, ["t", "l", "p"], "left").drop("t", "l", "p")
    segment = F.when(F.col("more").isNull(), F.col("segment")).otherwise(F.concat("segment", "more"))
    pointer = F.when(F.col("more").isNull(), F.col("pointer")).otherwise(F.col("further"))
    return jumped.withColumns({"segment": segment, "pointer": pointer}).drop("more", "further")


def proofs(work: Work, rows: DataFrame, leaf: str = "leaf", group: str = "lang", order: str = "doc_id", run: int = RUN) -> DataFrame:
    """``rows`` with subroot, root and proof, replacing columns of these names; ``leaf`` holds hex digests.

    A proof is an array, from the leaf's level to the root's, of the digests ``before`` and ``after`` the path's
    node in its run.  ``rows`` should hold the keys and the leaf only, as all its columns travel.
    """
    added = ["subroot", "root", "proof"]
    kept = [f"`{c}`" for c in rows.columns if c not in added or c in (leaf, group, order)]
    given = rows.select(F.struct(*kept).alias("row"), F.col(group).alias("grp"), F.col(order).alias("key"), F.unhex(f"`{leaf}`").alias("digest"))
    placed, parts = ranked(work, work.stage(given), "grp", "key", "digest")
    groups = parts.groupBy("grp").agg(F.sum("n").alias("size")).withColumn("all", F.lit(0))
    ordered, bounds = ranked(work, work.stage(groups), "all", "grp")
    ordered = ordered.join(bounds.select("part", "first", "before"), "part")
    groups = work.stage(ordered.select("grp", F.col("size").alias("n"), (F.col("row_no") - F.col("first") + F.col("before")).alias("g")))
    largest, subroots = groups.agg(F.max("n"), F.count("*")).first()

    bounds = parts.select(F.col("grp").alias("of"), "part", "first", "before").join(groups.withColumnRenamed("grp", "of_"), F.expr("of <=> of_")).drop("of_")
    leaves = placed.join(bounds.withColumnRenamed("part", "part_"), F.expr("grp <=> of and part = part_"))
    leaves = leaves.select("g", "n", (F.col("row_no") - F.col("first") + F.col("before")).alias("at"), "digest", "row")

    runs = work.stage(_grouped(leaves, run, F.collect_list(F.struct("at", "digest", "row")).alias("leaves")))
    inner, tops = _tree(work, _above(runs, run), height(largest or 0, run), 1, run, False, subroots)
    alone = leaves.where("n = 1")
    tops = work.stage(tops.union(alone.select("g", "digest")))
    last = tops.select(F.lit(-1).cast("long").alias("g"), F.lit(subroots).cast("long").alias("n"), F.col("g").alias("at"), "digest")
    above, root = _tree(work, last, height(subroots, run), 0, run, True, subroots)
    root = root.first()
    root = F.lit(bytes(root["digest"]).hex() if root else None).cast("string")

    # Every leaf with the first step of its way; a leaf alone in its group is its subroot and goes on from there.
    kinds = "array<struct<before: binary, after: binary>>", "struct<tree: bigint, level: bigint, place: bigint>"
    each = runs.join(tops.withColumnRenamed("digest", "top"), "g").select("*", F.explode("leaves").alias("leaf"))
    paths = each.select("leaf.row", "leaf.digest", "top", F.col("leaf.at").alias("at"), _step(F.col("leaf.at"), run).cast(kinds[0]).alias("segment"), _pointer(run, 0, False, subroots).cast(kinds[1]).alias("pointer"))
    own = F.when(F.lit(subroots > 1), F.struct(F.lit(-1).cast("long"), F.lit(0).cast("long"), F.col("g")).cast(kinds[1]))
    paths = paths.union(alone.select("row", "digest", F.col("digest").alias("top"), "at", F.array().cast(kinds[0]), own))

    nodes = above if inner is None else inner if above is None else inner.union(above)
    distance = 1
    while nodes is not None and distance <= height(largest, run) + height(subroots, run):
        nodes = work.stage(nodes)
        paths = _jumped(paths, nodes, F.col("at"))
        distance *= 2
        # Leaves point at levels that the distance divides, or into the last tree.
        nodes = _jumped(nodes.where((F.col("tree") == -1) | (F.col("level") % distance == 0)), nodes, F.xxhash64("tree", "level", "place"))
    return paths.select("row.*", _hex(F.col("top")).alias("subroot"), root.alias("root"), F.col("segment").alias("proof"))
