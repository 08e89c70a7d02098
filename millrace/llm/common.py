"""Column helpers, durable intermediate tables and connected components, shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import free_shuffles, keep, materialize, scratch_scope

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"

__all__ = [
    "NOT_SPACES", "SPACES", "ascii_lower", "connected_components", "keep", "kept_apart", "let", "link_groups", "materialize",
    "restored", "scratch_scope", "shared_members", "smallest_rows", "space_words", "text_key", "text_or_empty",
]


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure ASCII texts take the fast built-in."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def space_words(text: Column) -> Column:
    """Words between ASCII white space; an array without empty entries."""
    return F.array_remove(F.split(text, SPACES), "")


def text_key(text: Column) -> Column:
    """Identity of a text: 32 bytes. Results that depend on the text alone are computed once per key."""
    return F.unhex(F.sha2(text, 256))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often and wherever the body reads it."""
    return F.transform(F.array(value), body).getItem(0)


def smallest_rows(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, those of the smallest key. Only keys are sorted, so that no more rows than these move."""
    keyed = df.withColumn("sample_key", key)
    last = keyed.select("sample_key").orderBy("sample_key").limit(rows).agg(F.max("sample_key")).first()[0]
    return keyed.where(F.col("sample_key") <= F.lit(last)).drop("sample_key").limit(rows)


def kept_apart(df: DataFrame, **inputs: str) -> DataFrame:
    """The whole row as one struct ``row`` beside the named inputs, so that no caller's column name can clash."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *(F.col(f"`{c}`").alias(a) for a, c in inputs.items()))


def restored(df: DataFrame, columns: list[str], *added: str) -> DataFrame:
    """The caller's columns again; an added column replaces one of the same name."""
    lower = {a.lower() for a in added}
    return df.select(*(F.col(f"row.`{c}`").alias(c) for c in columns if c.lower() not in lower), *added)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of the undirected graph of ``a``, ``b``: one row ``node``, ``component`` for each node with an edge.

    The component is its smallest node. Large-star and small-star steps alternate
    until nothing changes: every step is an aggregate and a join whose skew
    adaptive execution can split, and its result is a written table, so a lost
    executor repeats one step only. Self loops, repeated and reversed edges are
    allowed; an empty input gives an empty result.
    """
    with scratch_scope(edges.sparkSession):
        star = materialize(
            edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
            "edges",
        )
        before = _fingerprint(star)
        while before[0]:
            star = _star_steps(star)
            after = _fingerprint(star)
            if after == before:
                break
            before = after
        roots = star.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
        return keep(star.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots), "components")


def _star_steps(star: DataFrame) -> DataFrame:
    """A large-star and a small-star step."""
    with scratch_scope(star.sparkSession):
        least = star.groupBy("hi").agg(F.min("lo").alias("least")).withColumnRenamed("hi", "at")
        large = materialize(
            star.join(least, F.col("lo") == F.col("at"), "left").select("hi", F.coalesce("least", "lo").alias("lo")).distinct(),
            "large-star",
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("least"))
        rest = large.join(least, "hi").where(F.col("lo") != F.col("least")).select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        return keep(rest.union(least.select("hi", F.col("least").alias("lo"))).distinct(), "small-star")


BROADCAST_BYTES = 32 << 20
#: Nodes of a bucket that meet at random in a round, and rounds at most.
MEETING = 16
ROUNDS = 8


def _any_size(a: Column, b: Column) -> Column:
    return F.lit(True)


def shared_members(members: DataFrame) -> DataFrame:
    """The members of buckets of several nodes, each with the bucket's smallest node as ``hub``; to be written before any other use."""
    spark = members.sparkSession
    if "home" not in members.columns:
        members = members.withColumn("home", F.lit(True))
    if "size" not in members.columns:
        members = members.withColumn("size", F.lit(0))
    shared = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.max("home").alias("any_home"))
    hubs = materialize(shared.where("hub != last and any_home").select("bucket", "hub"), "shared-buckets")
    del shared
    free_shuffles(spark)
    # Up to a measured size the buckets go to the members; beyond it the members are shuffled once more.
    near = F.broadcast(hubs) if 16 * hubs.count() <= BROADCAST_BYTES else hubs
    return members.join(near, "bucket")


def link_groups(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    known: DataFrame | None = None,
    alike: Callable[[Column, Column], Column] | None = None,
    sizes_alike: Callable[[Column, Column], Column] = _any_size,
) -> DataFrame:
    """Components of all verified pairs that share a bucket, without listing all pairs of a bucket.

    ``members``: ``bucket``, ``node`` and, if present, ``home`` (a pair needs one
    home row) and ``size`` (a pair needs sizes that are ``sizes_alike``); or what :func:`shared_members` made of them.
    ``verify`` takes pairs ``a``, ``b`` and keeps the right ones. ``known`` holds ``node``, ``signature`` (with an array ``buckets``
    of all its buckets) of all nodes that share a bucket; ``alike`` tells whether two signatures are near enough for ``verify`` to look at the pair at all.

    1. Each node of a bucket is compared with the bucket's smallest node.
    2. Components of the links found so far are formed. With ``alike``, nodes of buckets that still hold many components then
       meet in small random groups of their bucket, round by round, as long as that joins components: a crowd whose members are
       like one another, but few of them like the smallest, becomes one component at a cost in proportion to its size.
    3. Only pairs of one bucket that lie in *different* components are compared,
       and of the bucket's largest component only against nodes outside it. A
       crowd whose members are like one another is one component by then; a crowd just too unlike
       stays apart, and its pairs grow with the square. A pair of several common buckets is looked at in the first of them.
       No link between components is lost.
    """
    spark = members.sparkSession
    with scratch_scope(spark):
        placed = members if "hub" in members.columns else materialize(shared_members(members), "members")
        free_shuffles(spark)
        pairs = placed.where(F.col("node") != F.col("hub")).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
        if known is not None:
            x, y = (known.select(F.col("node").alias(n), F.col("signature").alias(f"signature_{n}")) for n in "ab")
            pairs = pairs.join(x, "a").join(y, "b").where(alike(F.col("signature_a"), F.col("signature_b"))).select("a", "b")
            pairs = materialize(pairs, "star-pairs")
        stars = materialize(verify(pairs).select("a", "b"), "star-links")
        parts = connected_components(stars)
        joined = placed.join(parts, "node", "left").select("bucket", "node", "home", "size", F.coalesce("component", "node").alias("component"))
        placed = materialize(joined, "placed")
        free_shuffles(spark)
        links = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        mixed = materialize(_mixed(placed), "mixed-buckets")
        free_shuffles(spark)
        if known is not None:
            mixed = materialize(mixed.join(known, "node"), "mixed-signatures")
            free_shuffles(spark)
            mixed, met = _meet(mixed, verify, alike, sizes_alike)
            links = links.union(met) if met is not None else links
        outside = mixed.where(F.col("component") != F.col("main"))
        x, y = outside.alias("x"), mixed.alias("y")
        apart = (F.col("x.bucket") == F.col("y.bucket")) & _apart(sizes_alike)
        if alike is not None:
            earliest = F.array_min(F.array_intersect("x.signature.buckets", "y.signature.buckets"))
            apart = apart & alike(F.col("x.signature"), F.col("y.signature")) & (F.col("x.bucket") == earliest)
        across = x.join(y, apart).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
        if known is not None:
            across = materialize(across, "across-pairs")
        links = materialize(links.union(verify(across).select("a", "b")), "links")
        free_shuffles(spark)
        return keep(connected_components(links), "linked")


def _apart(sizes_alike: Callable[[Column, Column], Column]) -> Column:
    """Whether a pair of two members can join two components."""
    return (F.col("x.component") != F.col("y.component")) & (F.col("x.home") | F.col("y.home")) & sizes_alike(F.col("x.size"), F.col("y.size"))


def _mixed(placed: DataFrame) -> DataFrame:
    """The members of buckets with several components: with the largest of them (``main``) and the number of members outside it."""
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = F.struct("n", "component")
    main = sizes.groupBy("bucket").agg(F.max(largest).alias("largest"), F.sum("n").alias("members"), F.count("*").alias("parts")).where("parts > 1")
    return placed.join(main.select("bucket", F.col("largest.component").alias("main"), "members", (F.col("members") - F.col("largest.n")).alias("out")), "bucket")


def _meet(
    mixed: DataFrame, verify: Callable[[DataFrame], DataFrame], alike: Callable[[Column, Column], Column], sizes_alike: Callable[[Column, Column], Column]
) -> tuple[DataFrame, DataFrame | None]:
    """Rounds of random groups in buckets with many members outside the largest component: what is mixed after them, and the links found."""
    found = None

    def outside() -> int:
        return mixed.where(F.col("out") > MEETING).where(F.col("component") != F.col("main")).count()

    before = outside()
    for turn in range(ROUNDS):
        if not before:
            break
        seat = F.pmod(F.xxhash64("node", "bucket", F.lit(turn)), F.ceil(F.col("members") / MEETING))
        groups = mixed.where(F.col("out") > MEETING).withColumn("seat", seat)
        x, y = groups.alias("x"), groups.alias("y")
        together = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.seat") == F.col("y.seat")) & (F.col("x.node") < F.col("y.node"))
        pairs = x.join(y, together & _apart(sizes_alike) & alike(F.col("x.signature"), F.col("y.signature")))
        met = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.component").alias("of_a"), F.col("y.component").alias("of_b"))
        met = materialize(met.distinct(), "met")
        linked = materialize(verify(met.select("a", "b")).select("a", "b"), "met-links")
        found = linked if found is None else found.union(linked)
        joined = connected_components(linked.join(met, ["a", "b"]).select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
        joined = joined.select(F.col("node").alias("was"), F.col("component").alias("now"))
        rest = mixed.drop("main", "members", "out").join(joined, F.col("component") == F.col("was"), "left")
        mixed = materialize(_mixed(rest.withColumn("component", F.coalesce("now", "component")).drop("was", "now")), "mixed-again")
        free_shuffles(mixed.sparkSession)
        after = outside()
        if 4 * after > 3 * before:
            break
        before = after
    return mixed, found
