"""Renamed columns in a schema difference, by the values that columns share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.names import col
from millrace.operators.baseline import schema_diff

#: Columns whose distinct values are less alike than this are not taken for the same column.
LEAST_SIMILARITY = 0.5
#: Log of the values that a sketch keeps; up to so many distinct values, similarities are exact.
SKETCH_LOG = 12


def _text(kind: str, column: Column) -> Column:
    """One text per value: numbers of different types and scales that are equal have equal texts."""
    if kind.startswith("decimal") or kind in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        return (column.cast("double") + F.lit(0.0)).cast("string")
    return column.cast("string")


def _sketches(df: DataFrame, columns: Sequence[str], log: int) -> DataFrame:
    """One row: a sketch of the distinct values of each column, from partial sketches of the tasks."""
    kinds = dict(df.dtypes)
    return df.agg(*(F.theta_sketch_agg(_text(kinds[c], col(c)), log).alias(f"__{i}") for i, c in enumerate(columns)))


def similarities(actual: DataFrame, baseline: DataFrame, log: int = SKETCH_LOG) -> DataFrame:
    """Each missing column beside each extra one, with the share of their distinct values that both have.

    One scan of each side, of the columns in question only; what is compared are sketches of a fixed size a column.
    NULL is no value; a column without any is like no other.
    """
    missing, extra = schema_diff(actual, baseline)
    if not missing or not extra:
        return actual.sparkSession.createDataFrame([], "missing_column string, extra_column string, similarity double")
    sides = []
    for df, columns, side in ((baseline, missing, "m"), (actual, extra, "e")):
        named = F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"__{i}").alias("sketch")) for i, c in enumerate(columns)))
        sides.append(_sketches(df, columns, log).select(F.lit(1).alias("__one"), named.alias(side)))
    # One row a side; the pairs are of columns.
    pairs = sides[0].join(sides[1], "__one").select(F.explode("m").alias("m"), "e").select("m", F.explode("e").alias("e"))
    both = F.theta_sketch_estimate(F.theta_intersection(F.col("m.sketch"), F.col("e.sketch")))
    either = F.theta_sketch_estimate(F.theta_union(F.col("m.sketch"), F.col("e.sketch"), log))
    share = F.when(either > 0, both / either).otherwise(F.lit(0.0))
    return pairs.select(F.col("m.name").alias("missing_column"), F.col("e.name").alias("extra_column"), share.cast("double").alias("similarity"))


def renamed_columns(actual: DataFrame, baseline: DataFrame, least: float = LEAST_SIMILARITY, log: int = SKETCH_LOG) -> list[tuple[str, str, float]]:
    """Baseline column, its new name, similarity: the pairs, each column once, of the largest total similarity.

    Pairs below ``least`` are never taken; of equal totals the one that comes first by name.
    """
    alike = {(r[0], r[1]): r[2] for r in similarities(actual, baseline, log).collect() if r[2] >= least}  # one a pair of columns
    missing, extra = sorted({m for m, _ in alike}), sorted({e for _, e in alike})
    taken: dict[str, str] = {}
    # Each round adds one pair by the best chain of changes to the pairs so far, found by relaxing it to its end.
    while True:
        gain = {m: (0.0, [m]) for m in missing if m not in taken.values()}
        best: tuple[float, list[str], str] | None = None
        for _ in missing:
            moved = False
            for m, (value, chain) in sorted(gain.items()):
                for e in extra:
                    if (m, e) not in alike or taken.get(e) == m:
                        continue
                    total = value + alike[m, e]
                    if e not in taken:
                        if best is None or total > best[0] + 1e-12:
                            best = (total, chain, e)
                    elif (owner := taken[e]) not in chain and total - alike[owner, e] > gain.get(owner, (float("-inf"), []))[0] + 1e-12:
                        gain[owner] = (total - alike[owner, e], [*chain, e, owner])
                        moved = True
            if not moved:
                break
        if best is None or best[0] <= 0:
            break
        chain = [*best[1], best[2]]
        for m, e in zip(chain[::2], chain[1::2]):
            taken[e] = m
    return sorted((m, e, alike[m, e]) for e, m in taken.items())
