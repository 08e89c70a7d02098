"""Document fingerprints by context-triggered piecewise hashing, compared by edit distance."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from millrace.llm.common import kept_apart, restored, text_key, text_or_empty

#: Bytes that the rolling hash sees.
REACH = 7
#: The block size is the least power of two that leaves at most this many expected chunks.
EXPECTED = 40
MOST = 64
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 19
DOCS_PER_BUCKET = 250
MAX_BUCKETS = 50_000


def block_bits(size: int) -> int:
    return max(0, (-(-size // EXPECTED) - 1).bit_length())


def _rolled(padded: np.ndarray) -> np.ndarray:
    """A mixed hash of the last seven bytes at every place; the first six bytes are context only."""
    size = len(padded) - REACH + 1
    value = np.zeros(size, np.uint64)
    for k in range(REACH):
        value *= FACTOR
        value += padded[k : k + size]
    value ^= value >> np.uint64(29)
    value *= FACTOR
    value ^= value >> np.uint64(32)
    return value


def _signature(sums: np.ndarray, ends: np.ndarray, total: np.uint64, size: int) -> str:
    """A character per chunk; what follows the 63rd boundary is one chunk."""
    cut = len(ends) if not len(ends) or ends[-1] != size else len(ends) - 1
    upto = np.append(sums[: min(cut, MOST - 1)], total)
    chunks = np.diff(upto, prepend=np.uint64(0))
    return ALPHABET[((chunks * FACTOR) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(data: bytes) -> str:
    """``block size:signature:signature at the doubled size`` of the whole text.

    A chunk ends where the rolling hash of the last seven bytes is 0 modulo the block size.
    Its character comes from the sum of the rolling hashes in it. Long texts pass
    in blocks with the last six bytes carried along, so memory stays bounded.
    """
    size, bits = len(data), block_bits(len(data))
    if not size:
        return "1::"
    mask, wide = np.uint64((1 << bits) - 1), np.uint64((2 << bits) - 1)
    ends, sums, doubled = [], [], []
    carry, tail = np.uint64(0), np.zeros(REACH - 1, np.uint8)
    for low in range(0, size, BLOCK):
        piece = np.concatenate([tail, np.frombuffer(data, np.uint8, min(BLOCK, size - low), low)])
        tail = piece[-(REACH - 1):]
        value = _rolled(piece)
        upto = np.cumsum(value, dtype=np.uint64) + carry
        at = np.flatnonzero((value & mask) == 0)
        ends.append(at + low + 1)
        sums.append(upto[at])
        doubled.append((value[at] & wide) == 0)
        carry = upto[-1]
    all_ends, all_sums, even = np.concatenate(ends), np.concatenate(sums), np.concatenate(doubled)
    first, second = _signature(all_sums, all_ends, carry, size), _signature(all_sums[even], all_ends[even], carry, size)
    return f"{1 << bits}:{first}:{second}"


@F.arrow_udf(StringType())
def piecewise_hash(texts: pa.Array) -> pa.Array:
    return pa.array([fingerprint(t.encode()) for t in texts.to_pylist()], pa.string())


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from the edit distance of signatures at a common block size; 0 without one, 1 for equal fingerprints."""
    x, y = F.split(a, ":"), F.split(b, ":")

    def near(s: Column, t: Column) -> Column:
        return 1.0 - F.levenshtein(s, t) / F.greatest(F.length(s), F.length(t), F.lit(1))

    wide, other = x[0].cast("bigint"), y[0].cast("bigint")
    return (
        F.when(a == b, 1.0)
        .when(wide == other, F.greatest(near(x[1], y[1]), near(x[2], y[2])))
        .when(wide == 2 * other, near(x[1], y[2]))
        .when(2 * wide == other, near(x[2], y[1]))
        .otherwise(0.0)
    )


def _buckets(ids: DataFrame) -> tuple[list[int], list[int]]:
    """Bounds of id ranges of a few hundred rows, at most 50,000, and the largest id of each range that has rows."""
    rows = ids.agg(F.count("doc_id")).first()[0]
    count = max(1, min(MAX_BUCKETS, rows // DOCS_PER_BUCKET))
    parts = [k / count for k in range(1, count)]
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", parts, 10 * count)).first()[0] or [])) if parts and rows else []
    place = _placer(bounds, [])
    tops = ids.where("doc_id is not null").groupBy(place(F.col("doc_id"))[0].alias("bucket")).agg(F.max("doc_id").alias("top")).orderBy("bucket").collect()
    return bounds, [r["top"] for r in tops]


def _placer(bounds: list[int], tops: list[int]):
    """The bucket of an id, then those where it stands in as the row after the last one."""
    follows = {}
    for low, high in zip(tops, tops[1:]):
        follows.setdefault(low, []).append(bisect.bisect_left(bounds, high))
    if tops:
        follows.setdefault(tops[-1], []).append(bisect.bisect_left(bounds, tops[0]))

    @F.arrow_udf(ArrayType(IntegerType()))
    def place(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in ids:
            yield pa.array([[bisect.bisect_left(bounds, i), *follows.get(i, [])] if i is not None else None for i in batch.to_pylist()], pa.list_(pa.int32()))

    return place


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Fingerprint each text, its edited text and the next document's; ``carry`` names the columns to keep.

    The next document follows in descending doc_id, after the last the first;
    the edited text has its last third replaced by the beginning of the next
    text. Added: ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The order is cut into id ranges of a few hundred rows. The largest id of a
    range also goes to the range above it, as the row after its last one; so one
    shuffle of the texts suffices and no task sees the whole order.

    Null texts are empty. Of repeated ids the row with the smaller text digest comes
    first. Rows with a null id stand outside the order and are their own next
    document. One row alone is its own next document; an empty table gives an
    empty result. Input columns named like an added one are replaced.
    """
    kept = list(docs.columns if carry is None else carry)
    packed = kept_apart(docs, doc_id=doc_id, text=text)
    bounds, tops = _buckets(packed.select(F.col("doc_id").cast("bigint").alias("doc_id")))
    rows = packed.select(
        F.struct(F.lit(1).alias("_"), *(F.col(f"row.`{c}`").alias(c) for c in kept)).alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty(F.col("text")).alias("text"),
    ).withColumn("print", piecewise_hash(F.col("text")))
    dealt = rows.withColumn("places", _placer(bounds, tops)(F.col("doc_id"))).select("*", F.posexplode_outer("places").alias("turn", "bucket")).drop("places")
    # Without a bucket: each row by itself, spread over many buckets below zero.
    dealt = dealt.withColumn("guest", F.coalesce(F.col("turn") > 0, F.lit(False))).withColumn(
        "bucket", F.coalesce("bucket", -1 - F.pmod(F.xxhash64("text"), F.lit(MAX_BUCKETS)))
    )
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc(), text_key(F.col("text")))
    inside = F.col("doc_id").isNotNull()
    led = dealt.select(
        "row", "guest", "text", "print",
        F.when(inside, F.lead("text").over(order)).otherwise(F.col("text")).alias("next_text"),
        F.when(inside, F.lead("print").over(order)).otherwise(F.col("print")).alias("next_print"),
    ).where(~F.col("guest"))
    length = F.length("text")
    edited = F.expr("concat(substring(text, 1, length(text) - length(text) div 3), substring(next_text, 1, int(length(text) div 3)))")
    done = led.select("row", length.cast("bigint").alias("n_chars"), "print", "next_print", edited.alias("edited")).select(
        "row", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.col("print").alias("fingerprint"), "next_print",
        piecewise_hash(F.col("edited")).alias("edited_fingerprint"),
    )
    added = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    judged = done.withColumn("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint"))).withColumn(
        "near_next", likeness(F.col("fingerprint"), F.col("next_print"))
    )
    return restored(judged, kept, *added)
