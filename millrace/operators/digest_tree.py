"""Comparison with a baseline by a tree of digests that is stored with it.

Rows are dealt by the hash of their key into leaves, leaves into folders. A
leaf's digest is the sum of its rows' hashes, a folder's the sum of its
leaves'. Equal sums need no further look: of the baseline only the leaves that
differ are read, and of those only keys and hashes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.names import DIFFERENT, EXTRA, IDENTICAL, MISSING, col
from millrace.operators.baseline import row_hashes
from millrace.session import materialize
from millrace.sinks.tables import TableStore

ROWS_PER_LEAF = 50_000
FEWEST_LEAVES, MOST_LEAVES, MOST_FOLDERS = 16, 1 << 20, 1024
#: So many differing leaves are named in a filter that reaches the files; more of them are joined.
NAMED_LEAVES = 1000
FOLDER, LEAF, HASHES = "__folder", "__leaf", ("__h1", "__h2")


def _digested(df: DataFrame, keys: Sequence[str], columns: Sequence[str], leaves: int) -> DataFrame:
    """Keys, hashes of the whole row, leaf and folder."""
    rest = [c for c in columns if c not in set(keys)]
    place = F.pmod(row_hashes(df, keys)[0], F.lit(leaves)).cast("int")
    per_folder = max(1, leaves // MOST_FOLDERS)
    hashed = df.select(*(col(k) for k in keys), *(h.alias(n) for h, n in zip(row_hashes(df, [*keys, *rest]), HASHES)), place.alias(LEAF))
    return hashed.withColumn(FOLDER, F.call_function("div", F.col(LEAF), F.lit(per_folder)).cast("int"))


def _sums(digested: DataFrame, *by: str) -> DataFrame:
    # 64-bit hashes are added as decimals: such a sum does not wrap around.
    return digested.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *(F.sum(F.col(h).cast("decimal(38,0)")).alias(f"sum{h}") for h in HASHES))


def _tables(name: str) -> tuple[str, str]:
    return f"baseline_{name}_digests", f"baseline_{name}_sums"


def save_digests(store: TableStore, df: DataFrame, name: str, keys: Sequence[str], at: datetime, columns: Sequence[str] | None = None) -> int:
    """Store the digest tree of a baseline; returns its number of leaves, which follows from the rows."""
    columns = list(columns or df.columns)
    wanted = max(FEWEST_LEAVES, min(MOST_LEAVES, df.count() // ROWS_PER_LEAF))
    leaves = 1 << (wanted - 1).bit_length()
    rows, sums = _tables(name)
    digested = _digested(df, keys, columns, leaves).sortWithinPartitions(FOLDER, LEAF)
    number = store.replace(rows, digested, at, (FOLDER,))
    written = store.read(rows, number)
    kinds = dict(df.dtypes)
    shape = json.dumps({"leaves": leaves, "keys": list(keys), "columns": [[c, kinds[c]] for c in columns]})
    described = df.sparkSession.createDataFrame([(shape,)], "shape string")
    store.replace(sums, _sums(written, FOLDER, LEAF).unionByName(described, allowMissingColumns=True), at)
    return leaves


def differing_leaves(saved: DataFrame, digested: DataFrame) -> DataFrame:
    """Folder and leaf where the two sides' digests differ: folders are compared first, and only leaves of differing ones after that."""
    now = materialize(_sums(digested, FOLDER, LEAF), "leaf-sums")

    def unequal(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
        names = ["rows", *(f"sum{h}" for h in HASHES)]
        x, y = a.select(*by, *names), b.select(*by, *(F.col(n).alias(f"{n}_b") for n in names))
        differs = [~F.col(n).eqNullSafe(F.col(f"{n}_b")) for n in names]
        return x.join(y, list(by), "full_outer").where(differs[0] | differs[1] | differs[2]).select(*by)

    def folders(sums: DataFrame) -> DataFrame:
        return sums.groupBy(FOLDER).agg(*(F.sum(n).cast("decimal(38,0)").alias(n) for n in ("rows", *(f"sum{h}" for h in HASHES))))

    top = materialize(unequal(folders(now), folders(saved), [FOLDER]), "differing-folders")
    below = [side.join(top, FOLDER, "left_semi") for side in (now, saved)]
    return materialize(unequal(*below, [FOLDER, LEAF]), "differing-leaves")


def _of_leaves(rows: DataFrame, leaves: DataFrame, some: list[tuple[int, int]] | None) -> DataFrame:
    """Rows of the given leaves. A few are named, so that other folders and row groups are not read."""
    if some is None:
        return rows.join(leaves, [FOLDER, LEAF], "left_semi")
    return rows.where(F.col(FOLDER).isin(sorted({f for f, _ in some})) & F.col(LEAF).isin(sorted(n for _, n in some)))


def compare_with_digests(store: TableStore, actual: DataFrame, name: str, only_differences: bool = False) -> DataFrame:
    """Status of every key against the baseline whose digests are stored; the same rows as ``compare_rows`` gives.

    The actual table is read once, into keys and hashes. Keys of equal leaves are
    IDENTICAL without a look at the baseline; ``only_differences`` leaves them out. A column that the
    actual table lacks or has in another type is an error, for its hashes cannot be compared.
    """
    rows, sums = _tables(name)
    saved = store.read(sums)
    shape = json.loads(saved.where("shape is not null").first()["shape"])
    kinds = dict(actual.dtypes)
    changed = [c for c, kind in shape["columns"] if kinds.get(c) != kind]
    if changed:
        raise ValueError(f"columns changed since the baseline: {', '.join(changed)}")
    keys, columns = shape["keys"], [c for c, _ in shape["columns"]]
    now = materialize(_digested(actual, keys, columns, shape["leaves"]), "digested")
    leaves = differing_leaves(saved.where("shape is null").drop("shape"), now)
    count = leaves.count()
    some = [tuple(r) for r in leaves.collect()] if count <= NAMED_LEAVES else None
    before = _of_leaves(store.read(rows), leaves, some)
    changed_now = _of_leaves(now, leaves, some)
    names = [col(k) for k in keys]
    sides = changed_now.select(*names, *HASHES, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        before.select(*names, *HASHES, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    balance = sides.groupBy(*names, *HASHES).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    per_key = balance.groupBy(*names).agg(F.sum("a").alias("actual_rows"), F.sum("b").alias("baseline_rows"), F.max(F.col("a") != F.col("b")).alias("differs"))
    status = F.when(F.col("actual_rows") == 0, MISSING).when(F.col("baseline_rows") == 0, EXTRA).when(F.col("differs"), DIFFERENT).otherwise(IDENTICAL)
    found = per_key.select(*names, "actual_rows", "baseline_rows", status.alias("row_status"))
    if only_differences:
        return found.where(F.col("row_status") != IDENTICAL)
    same = now.join(leaves, [FOLDER, LEAF], "left_anti").groupBy(*names).agg(F.count(F.lit(1)).alias("actual_rows"))
    return found.unionByName(same.select(*names, "actual_rows", F.col("actual_rows").alias("baseline_rows"), F.lit(IDENTICAL).alias("row_status")))

