"""Whitening of embeddings: centred rows to a triangular factor by blocks, then a bidiagonal qd solver."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.bidiagonal import EPS, right_singular
from millrace.llm.common import kept_apart, materialize, restored

#: Whole numbers of an entry c: floor(SCALE * c) + SHIFT, held within +-LARGEST.
SCALE, SHIFT = 1024, 100_000
LARGEST = 1 << 45
#: Entries of a block that one factorisation takes, and factors that one task joins.
BLOCK_ENTRIES = 1 << 20
FAN_IN = 32
#: Squares are summed in two parts of so many bits, exactly.
LIMB = 20


@dataclass(frozen=True)
class Fit:
    """Sums and directions of the fit list: all of the size of one vector, or of a few."""

    rows: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def varies(self) -> np.ndarray:
        """Which components have variance beyond rounding."""
        largest = float(self.values.max(initial=0.0))
        return self.values > largest * (EPS * max(len(self.sums), 1)) ** 2

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part is subtracted exactly."""
        base = np.array([s // self.rows for s in self.sums], dtype=np.int64)
        rest = np.array([(s % self.rows) / self.rows for s in self.sums])
        return (x - base).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n * x - S) squared, exact."""
        base = np.array([s // self.rows for s in self.sums], dtype=np.int64)
        rest = [s - self.rows * (s // self.rows) for s in self.sums]
        far = int(np.abs(x - base).max(initial=0)) + 1
        if far * self.rows < 1 << 45 and x.shape[1] <= 1 << 11:
            y = (x - base) * self.rows - np.array(rest, dtype=np.int64)
            high, low = y >> LIMB, y & ((1 << LIMB) - 1)
            parts = [(high * high).sum(1).tolist(), (high * low).sum(1).tolist(), (low * low).sum(1).tolist()]
            return [(a << 2 * LIMB) + (b << LIMB + 1) + c for a, b, c in zip(*parts)]
        return [sum((self.rows * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x]


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them finite numbers."""
    finite = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def _whole(batch: pa.Array) -> list[np.ndarray]:
    """Whole numbers of the vectors of a batch in blocks of bounded size; all have the same length."""
    if not len(batch):
        return []
    flat = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    step = max(1, min(1 << 16, BLOCK_ENTRIES // flat.shape[1]))
    blocks = (flat[k : k + step] for k in range(0, len(flat), step))
    return [np.clip(np.floor(SCALE * b), -LARGEST, LARGEST).astype(np.int64) + SHIFT for b in blocks]


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in _whole(batch.column("v")):
            yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([x.sum(0).tolist()], pa.list_(pa.int64()))], ["n", "sums"])


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""
    parts = materialize(vectors.mapInArrow(_sum_blocks, "n bigint, sums array<bigint>"), "whitening-sums")
    rows = parts.agg(F.sum("n")).first()[0] or 0
    sums = parts.select(F.posexplode("sums").alias("place", "x")).groupBy("place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    return rows, [int(r["x"]) for r in sums.orderBy("place").collect()]


def _factor(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def _factor_batch(slot: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], ["slot", "r"])


def _triangle(vectors: DataFrame, fit: Fit) -> np.ndarray:
    """The triangular factor of all centred rows: one factor per task, then trees of FAN_IN factors.

    A factor has as many entries as the square of a vector's length at most, however many rows it stands for.
    """
    size = len(fit.sums)

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for x in _whole(batch.column("v")):
                r = _factor([fit.centred(x)] if r is None else [r, fit.centred(x)])
        if r is not None:
            yield _factor_batch(TaskContext.get().partitionId(), r)

    def of_factors(table: pa.Table) -> pa.Table:
        r = None
        for row in table.sort_by("slot").column("r"):
            part = np.array(row.as_py()).reshape(-1, size)
            r = part if r is None else _factor([r, part])
        return pa.Table.from_batches([_factor_batch(table.column("slot")[0].as_py() // FAN_IN, r)])

    factors = materialize(vectors.mapInArrow(of_rows, "slot bigint, r array<double>"), "whitening-factors")
    slots = factors.agg(F.max("slot")).first()[0]
    while slots:
        factors = factors.groupBy(F.expr(f"slot div {FAN_IN}").alias("parent")).applyInArrow(of_factors, "slot bigint, r array<double>")
        slots //= FAN_IN
    r = np.array(factors.first()["r"]).reshape(-1, size)
    return np.vstack([r, np.zeros((size - len(r), size))]) if len(r) < size else r


def fit_whitening(vectors: DataFrame, components: int) -> Fit:
    """Fit on all rows of ``v``, arrays of doubles of one length.

    The covariance is never formed: blockwise QR of the centred rows leaves a
    triangular factor with the same right singular vectors. Householder
    reflections make it bidiagonal, dqds finds its squared singular values, and twisted
    factorisations the directions of the largest ones. Only that factor and
    a vector of sums reach the driver.
    """
    rows, sums = _sums(vectors)
    empty = Fit(rows, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    if not rows:
        return empty
    r = _triangle(vectors, empty)
    squares, directions = right_singular(r, components)
    return Fit(rows, sums, squares[: directions.shape[1]] / rows, directions, float((r * r).sum()) / rows)


def _identity_error(done: DataFrame, fit: Fit) -> float | None:
    """The largest entry of the covariance of the whitened components, which are centred first, minus the identity."""
    places = np.flatnonzero(fit.varies).tolist()
    if not places:
        return None
    w = {k: F.col("whitening.whitened")[k] for k in places}
    means = done.agg(*(F.avg(w[k]) for k in places)).first()
    apart = {k: w[k] - F.lit(m) for k, m in zip(places, means)}
    pairs = [(i, j) for i in places for j in places if i <= j]
    products = done.agg(*(F.avg(apart[i] * apart[j]) for i, j in pairs)).first()
    return max(abs(p - (i == j)) for p, (i, j) in zip(products, pairs))


def whiten(df: DataFrame, vector: str = "embedding", components: int = 8, carry: list[str] | None = None) -> DataFrame:
    """Project each usable vector on the principal components of all of them, scaled to variance one.

    Entries c become whole numbers floor(1024 * c) + 100000, held within 2^45 of zero
    plus that shift. Added, one row per vector and component: ``component`` (from 1, by falling
    variance), ``n`` (vectors of the fit), ``deviation`` (the sum over dimensions of
    the square of n * x - S, exact; null beyond 64 bits, ``deviation_digits`` always has it in decimal digits),
    ``whitened``, ``explained`` (share of the whole variance) and ``identity_error`` (one value:
    how far the covariance of the whitened components is from the identity).
    ``carry`` names the columns to keep, all by default.

    Rows with a null or empty vector, or one with null, infinite or NaN entries, are left
    out; so are those of another length than most usable vectors have (of equally
    frequent lengths the longest counts). Repeated rows stay and count. A vector of k entries has at
    most k components. A component without variance beyond rounding (fewer
    rows than dimensions, equal rows) has a null ``whitened``, and ``explained`` is null
    if nothing varies. Equal variances make directions arbitrary, but the same for all rows. An empty
    table gives an empty result. Input columns named like an added one are replaced.
    """
    kept = list(df.columns if carry is None else carry)
    packed = kept_apart(df, v=vector).select(
        F.struct(F.lit(1).alias("_"), *(F.col(f"row.`{c}`").alias(c) for c in kept)).alias("row"), F.col("v").cast("array<double>").alias("v")
    ).where(usable(F.col("v")))
    lengths = packed.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("rows"))
    common = lengths.agg(F.max_by("length", F.struct("rows", "length"))).first()[0] or 0
    usual = packed.where(F.size("v") == common)
    fit = fit_whitening(usual.select("v"), components)

    values = np.where(fit.varies, fit.values, 1.0)
    project = fit.vectors / np.sqrt(values)
    varies = fit.varies.tolist()
    shape = pa.struct([("deviation", pa.int64()), ("digits", pa.string()), ("whitened", pa.list_(pa.float64()))])

    @F.arrow_udf("deviation bigint, digits string, whitened array<double>")
    def transform(vectors: pa.Array) -> pa.Array:
        found = []
        for x in _whole(vectors):
            whitened = (fit.centred(x) @ project).tolist()
            found += [
                {"deviation": d if d < 1 << 63 else None, "digits": str(d), "whitened": [a if v else None for a, v in zip(w, varies)]}
                for d, w in zip(fit.deviations(x), whitened)
            ]
        return pa.array(found, shape)

    done = materialize(usual.select("row", transform("v").alias("whitening")), "whitened")
    error = _identity_error(done, fit) if fit.rows else None
    share = [float(v) / fit.trace if fit.trace else None for v in fit.values]
    each = done.select("row", "whitening", F.posexplode("whitening.whitened").alias("place", "whitened"))
    added = ["component", "n", "deviation", "deviation_digits", "whitened", "explained", "identity_error"]
    shares = F.array(*(F.lit(s).cast("double") for s in share)).cast("array<double>")
    return restored(
        each.select(
            "row", (F.col("place") + 1).cast("int").alias("component"), F.lit(fit.rows).cast("bigint").alias("n"),
            F.col("whitening.deviation").alias("deviation"), F.col("whitening.digits").alias("deviation_digits"), "whitened",
            shares[F.col("place")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
        ),
        kept, *added,
    )
