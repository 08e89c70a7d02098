"""Mixing sources to target weights by capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import NOT_SPACES, kept_apart, materialize, restored

DRAW_DIGITS = 15
LEVEL_BITS = 15
LEVELS = 4 * DRAW_DIGITS // LEVEL_BITS


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACES)), F.lit(0)).cast("bigint")


def draw(doc_id: Column, seed: int) -> Column:
    """A seeded number of 60 bits that depends on the id alone, so that reruns agree."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("bigint")


def fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Add ``target`` (words) to ``source``, ``weight`` (whole numbers), ``source_size``.

    All targets share the total size by weight. A source whose share exceeds
    ``max_epochs`` times its size is clamped there and the excess goes to the
    others by weight, until none is above. One aggregate over the sources per
    round; the level only rises, so the clamped set follows from it. Whole
    numbers are compared, never quotients.
    """
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, weights = total, sources.agg(F.sum("weight")).first()[0] or 0
    while weights:
        above = F.col("weight") * F.lit(budget) > cap * F.lit(weights)
        held, free = sources.agg(F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if not free or (total - held, free) == (budget, weights):
            break
        budget, weights = total - held, free
    if not weights:
        return sources.withColumn("target", F.lit(0.0))
    share = (F.col("weight") * F.lit(budget)).cast("double") / F.lit(float(weights))
    return sources.withColumn("target", F.when(F.col("weight") * F.lit(budget) > cap * F.lit(weights), cap.cast("double")).otherwise(share))


def _threshold(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Where the last, partial repetition of each source ends in the order of the draws.

    A radix descent over the 60 bits: each level sums sizes by the next 15 bits
    of the draws below the prefix found so far, and picks the digit in which the
    remaining words run out. No source's rows are ever sorted or gathered; a
    level holds at most 32,768 sums per source.
    """
    at = plan.where("rest > 0").select(F.col("source").alias("at_source"), F.lit(0).cast("bigint").alias("prefix"), F.col("rest").alias("room"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        digits = sized.withColumn("digit", F.shiftright("draw", shift))
        mine = digits.join(at, F.col("source").eqNullSafe(F.col("at_source")) & (F.shiftright("digit", LEVEL_BITS) == F.col("prefix")))
        sums = mine.groupBy("at_source", "digit", "room").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("at_source").orderBy("digit"))
        at = materialize(
            sums.withColumn("upto", upto).where("upto > room and upto - words <= room")
            .select("at_source", F.col("digit").alias("prefix"), (F.col("room") - F.col("upto") + F.col("words")).alias("room"), "words"),
            "mix-level",
        ).drop(*(["words"] if level < LEVELS - 1 else []))
    return at.withColumnRenamed("prefix", "last_draw")


def mix(
    docs: DataFrame, weights: DataFrame, max_epochs: int = 3, seed: int = 42,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``taken`` (words of the mix, repeats counted) to every row.

    ``weights``: ``source``, ``weight`` (whole numbers; null is a source like any
    other, a missing one weighs 0). Every row of a source is taken as many whole
    times as the target holds the source; the remaining words come from rows in
    the order of a seeded draw from the id, the last of them in part. So the words
    taken of a source equal its target rounded to a whole number. Rows of one
    source and one draw (repeated or null ids) share the partial place by size,
    which rounds down. Nothing is taken above ``max_epochs`` times a row's size.

    Null and empty texts have size 0; an empty table gives an empty result.
    Input columns named like an added one are replaced.
    """
    rows = kept_apart(docs, doc_id=doc_id, text=text, source=source)
    sized = materialize(rows.select("source", draw(F.col("doc_id"), seed).alias("draw"), word_count(F.col("text")).alias("size")), "mix-sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = weights.select(F.col("source").alias("wanted"), F.col("weight").cast("bigint").alias("weight"))
    sources = materialize(
        sums.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left").select("source", F.coalesce("weight", F.lit(0)).alias("weight"), "source_size"),
        "mix-sources",
    )
    words = F.floor(F.col("target") + 0.5)
    size = F.greatest("source_size", F.lit(1))
    plan = materialize(
        fill(sources, max_epochs).withColumn("whole", F.floor(words / size)).withColumn("rest", words - F.col("whole") * size), "mix-plan"
    )
    last = _threshold(sized, plan)
    plan = materialize(
        plan.join(last, F.col("source").eqNullSafe(F.col("at_source")), "left")
        .select(F.col("source").alias("plan_source"), "source_size", "target", "whole", "last_draw", "room", "words"),
        "mix-thresholds",
    )
    part = (
        F.when(F.col("draw") < F.col("last_draw"), F.col("size"))
        .when(F.col("draw") == F.col("last_draw"), F.expr("size * room div words"))
        .otherwise(0)
    )
    sized_rows = rows.withColumn("size", word_count(F.col("text"))).withColumn("draw", draw(F.col("doc_id"), seed))
    taken = sized_rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")), "left").select(
        "row", "size", "source_size", "target", (F.col("size") * F.col("whole") + F.coalesce(part, F.lit(0))).cast("bigint").alias("taken")
    )
    return restored(taken, docs.columns, "size", "source_size", "target", "taken")


def turn_weights(docs: DataFrame, turns: tuple[int, ...] = (5, 2, 1), source: str = "source") -> DataFrame:
    """Weights by turns over the sources in code-point order, null last.

    One row per source is ranked in one task: sources are as many as a mixing
    recipe names, not as many as rows.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    names = docs.select(F.col(f"`{source}`").alias("source")).distinct()
    weights = F.array(*(F.lit(t) for t in turns))
    return names.withColumn("place", place).select("source", weights[F.col("place") % len(turns)].alias("weight"))
