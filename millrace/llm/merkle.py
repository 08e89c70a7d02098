"""Merkle manifest of a dataset: trees of digests, and proofs by pointer jumping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import kept_apart, let, materialize, restored

#: Levels of a tree that one shuffle builds; a group then holds 2 ** LEVELS nodes at most.
LEVELS = 8
PATH = "array<struct<side:int,digest:binary>>"


def field(value: Column) -> Column:
    """A value inside a digest: ``-`` for null, else its UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def record_digest(values: Sequence[Column]) -> Column:
    """The SHA-256 of a record, in 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def as_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined_digest(digests: Column) -> Column:
    """Lower-case SHA-256 of an array of digests, joined as lower-case hex text."""
    return F.sha2(F.array_join(F.transform(digests, as_text), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its ``path`` of siblings give: side -1 stands left, 1 right, 0 is no sibling."""

    def up(digest: Column, step: Column) -> Column:
        other = F.coalesce(as_text(step["digest"]), F.lit(""))
        pair = F.when(step["side"] < 0, F.concat(other, as_text(digest))).otherwise(F.concat(as_text(digest), other))
        return F.unhex(F.sha2(pair, 256))

    return F.aggregate(path, leaf, up)


def _ranked(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``place`` (from 0) in the order within ``tree``, and ``leaves`` of the tree.

    The order over all trees is cut into ranges, so that no task sees a whole tree. Only counts of
    ranges and trees are summed up, not rows.
    """
    # Equal rows stand in any order; the turn lets a range end between them.
    turned = leaves.withColumn("turn", F.monotonically_increasing_id())
    dealt = turned.repartitionByRange(F.col("tree").asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), "turn").drop("turn")
    ranges = materialize(dealt.withColumn("part", F.spark_partition_id()), "merkle-ranges")
    counts = ranges.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("tree").orderBy("part")) - F.col("rows")
    starts = materialize(
        counts.select(
            F.col("tree").alias("of_tree"), F.col("part").alias("of_part"), before.alias("start"),
            F.sum("rows").over(Window.partitionBy("tree")).alias("leaves"),
        ),
        "merkle-starts",
    )
    inside = Window.partitionBy("part", "tree").orderBy(*(F.col(c).asc_nulls_first() for c in order))
    own = F.col("tree").eqNullSafe(F.col("of_tree")) & (F.col("part") == F.col("of_part"))
    return (
        ranges.withColumn("inside", F.row_number().over(inside) - 1).join(starts, own)
        .withColumn("place", F.col("inside") + F.col("start")).drop("inside", "start", "part", "of_tree", "of_part")
    )


def _height(leaves: Column) -> Column:
    """Levels above the leaves: the digits of the largest place, in binary."""
    return F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(0)


def _levels(nodes: Column, number: Column) -> Column:
    """``nodes`` and the levels above them, as arrays of digests; ``number`` levels are built."""

    def above(level: Column) -> Column:
        places = F.sequence(F.lit(0), F.call_function("div", F.size(level) - 1, F.lit(2)).cast("int"))
        return F.transform(places, lambda k: F.unhex(F.sha2(F.concat(as_text(level[2 * k]), F.coalesce(as_text(F.get(level, 2 * k + 1)), F.lit(""))), 256)))

    none = F.array().cast("array<int>")
    turns = F.when(number > 0, F.sequence(F.lit(1), number)).otherwise(none)
    return F.aggregate(turns, F.array(nodes), lambda built, _: F.concat(built, F.array(above(F.element_at(built, -1)))))


def _nodes(leaves: DataFrame) -> DataFrame:
    """All nodes of all trees: ``tree``, ``level``, ``place``, ``height``, ``digest`` and the ``path`` to its parent, of one step.

    Runs of 256 neighbours, a fixed number, meet in one group and build eight levels at once.
    """
    level = leaves.select("tree", "height", "place", "digest")
    tallest = leaves.agg(F.max("height")).first()[0]
    built, done = [], 0
    while tallest is not None and done <= tallest:
        number = F.least(F.lit(LEVELS), F.col("height") - done)
        runs = level.where(F.col("height") >= done).groupBy("tree", "height", F.shiftright("place", LEVELS).alias("run")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda n: n["digest"]).alias("nodes")
        )
        stacks = materialize(runs.select("tree", "height", "run", _levels(F.col("nodes"), number.cast("int")).alias("levels")), "merkle-levels")
        each = stacks.select("tree", "height", "run", F.posexplode("levels").alias("up", "nodes"))
        # The topmost level built is the lowest of the next round, except for a root.
        top = F.col("height") - done
        each = each.where((F.col("up") < LEVELS) | (F.col("up") == top) & (top < LEVELS))
        sibling = F.get(F.col("nodes"), F.col("at").bitwiseXOR(F.lit(1)))
        here = each.select("*", F.posexplode("nodes").alias("at", "digest")).select(
            "tree", (F.col("up") + done).alias("level"),
            (F.call_function("shiftleft", F.col("run"), F.lit(LEVELS) - F.col("up")) + F.col("at")).alias("place"), "height", "digest",
            F.when(F.col("up") + done == F.col("height"), F.array().cast(PATH)).otherwise(
                F.array(F.struct(F.when(sibling.isNull(), 0).when(F.col("at") % 2 == 1, -1).otherwise(1).alias("side"), sibling.alias("digest"))).cast(PATH)
            ).alias("path"),
        )
        built.append(here)
        level = stacks.where(F.size("levels") == LEVELS + 1).select("tree", "height", F.col("run").alias("place"), F.col("levels")[LEVELS][0].alias("digest"))
        done += LEVELS
    nodes = built[0]
    for more in built[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def _proved(leaves: DataFrame) -> DataFrame:
    """Add ``root`` (of the tree) and ``path`` (all siblings up to it) to ranked leaves with ``height``.

    Pointer jumping: every node starts with the sibling on the way to its parent. Each
    round joins nodes with the ones that they point at and appends their segments, which
    doubles the distance. Only levels that a leaf's pointer can reach are kept: after
    k rounds multiples of 2 ** k, so the table pointed at shrinks with every round.
    """
    tallest = leaves.agg(F.max("height")).first()[0]
    if tallest is None:
        return leaves.withColumns({"root": F.lit(None).cast("binary"), "path": F.array().cast(PATH)})
    nodes = materialize(_nodes(leaves), "merkle-nodes")
    # Written by itself, so that Spark knows its size: one row per tree, whatever the rows of a tree.
    roots = materialize(nodes.where("level = height").select(F.col("tree").alias("at_tree"), F.col("digest").alias("root")), "merkle-roots")
    jump = 1
    while jump < max(tallest, 1):
        targets = nodes.where(f"level % {2 * jump} = {jump} and level < height").select(
            F.col("tree").alias("at_tree"), F.col("level").alias("at_level"), F.col("place").alias("at_place"), F.col("path").alias("rest")
        )
        near = (
            F.col("tree").eqNullSafe(F.col("at_tree")) & (F.col("level") + jump == F.col("at_level"))
            & (F.shiftright("place", jump) == F.col("at_place"))
        )
        longer = nodes.where(f"level % {2 * jump} = 0").join(targets, near, "left")
        path = F.concat("path", F.coalesce("rest", F.array().cast(PATH)))
        nodes = materialize(longer.select("tree", "level", "place", "height", path.alias("path")), "merkle-jump")
        jump *= 2
    proofs = nodes.where("level = 0").select(F.col("tree").alias("of_tree"), F.col("place").alias("of_place"), "path")
    mine = F.col("tree").eqNullSafe(F.col("of_tree")) & (F.col("place") == F.col("of_place"))
    return leaves.join(proofs, mine).join(roots, F.col("tree").eqNullSafe(F.col("at_tree"))).drop("of_tree", "of_place", "at_tree")


def manifest(df: DataFrame, leaf: str = "leaf", tree: str = "lang", order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Add ``place``, ``subroot``, ``root`` (32 bytes each) and ``path`` to every row; ``leaf`` is its digest in 32 bytes.

    Rows of one ``tree`` value form a tree, in ascending ``order``, then by leaf.
    While more than one node remains, each two neighbours become one, the digest of both as hex
    text; the last one alone becomes the digest of itself. A single leaf is its tree's
    subroot. Subroots, ordered by tree (null first, else bytewise), form the last tree in the same way. ``path`` lists
    the siblings of all levels up to the root; see :func:`fold`.

    A null tree is a tree of its own; null order values come first. Repeated rows
    are leaves of their own; equal ones may share their places in any way. A null leaf counts as an empty digest.
    An empty table gives an empty result. Input columns named like an added one are replaced.
    """
    packed = kept_apart(df, tree=tree, digest=leaf, **{f"order{k}": c for k, c in enumerate(order)})
    packed = packed.withColumn("digest", F.coalesce("digest", F.lit("").cast("binary")))
    ranked = _ranked(packed, [*(f"order{k}" for k in range(len(order))), "digest"])
    leaves = materialize(ranked.withColumn("height", _height(F.col("leaves"))).drop("leaves", *(f"order{k}" for k in range(len(order)))), "merkle-leaves")
    proved = materialize(_proved(leaves).withColumnRenamed("root", "subroot"), "merkle-proofs")
    tops = proved.groupBy("tree").agg(F.first("subroot").alias("digest")).select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "digest")
    tops = materialize(_ranked(tops, ["name"]).withColumn("height", _height(F.col("leaves"))).drop("leaves"), "merkle-tops")
    above = materialize(_proved(tops).select(F.col("name").alias("top"), "root", F.col("path").alias("rest")), "merkle-top-proofs")
    whole = proved.join(above, F.col("tree").eqNullSafe(F.col("top")))
    return restored(
        whole.select("row", "place", "subroot", "root", F.concat("path", "rest").alias("path")), df.columns, "place", "subroot", "root", "path"
    )


def siblings(path: Column) -> Column:
    """The digests of a path that exist, from the leaf to the root."""
    return F.transform(F.filter(path, lambda s: s["side"] != 0), lambda s: s["digest"])
