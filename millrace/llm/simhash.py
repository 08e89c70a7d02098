"""SimHash near-duplicates: segment bit counts, a grid join under Manhattan distance, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.common import ascii_lower, kept_apart, let, link_groups, materialize, restored, space_words, text_key, text_or_empty

SHINGLE = 3
MAX_BITS = 3
#: 01 in each of the 16 two-bit segments of a half.
ONES = 0x55555555
SEGMENTS = 16
BLOCK = 1 << 17


def shingle_hashes(text: Column) -> Column:
    """XXH64 (seed 42) of every run of three words; of the whole sequence if it is shorter."""

    def of(words: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(F.concat_ws(" ", *(words[i + k] for k in range(SHINGLE))))
        )
        short = F.array(F.xxhash64(F.array_join(words, " ")))
        return F.when(F.size(words) >= SHINGLE, runs).when(F.size(words) > 0, short).otherwise(F.array().cast("array<bigint>"))

    return let(space_words(ascii_lower(text_or_empty(text))), of)


def majority_bits(hashes: pa.ListArray) -> pa.Array:
    """A bit is 1 if it is set in over half of the row's hashes; blocks bound the memory of long rows."""
    ends = hashes.offsets.to_numpy()
    values = hashes.values.to_numpy().view(np.uint8).reshape(-1, 8)
    counts = np.zeros((len(hashes), 64), np.int64)
    sizes = np.diff(ends)
    filled = np.flatnonzero(sizes)
    starts = ends[:-1][filled]
    for low in range(int(ends[0]), int(ends[-1]), BLOCK):
        high = min(low + BLOCK, int(ends[-1]))
        first, last = np.searchsorted(starts, low, "right") - 1, np.searchsorted(starts, high, "left")
        cuts = np.maximum(starts[first:last], low) - low
        bits = np.unpackbits(values[low:high], axis=1, bitorder="little")
        counts[filled[first:last]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    packed = np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little")
    return pa.array(packed.view(np.int64).ravel(), pa.int64())


def _add_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = batch.schema.get_field_index("hashes")
        yield batch.set_column(place, "print", majority_bits(batch.column(place)))


def _cells(prints: DataFrame) -> DataFrame:
    """Grid cells of the two halves: ``bucket``, ``node``, ``home``.

    A 32-bit half becomes 16 bit counts of two-bit segments, packed two bits
    each. Fingerprints within three bits have a half within one bit, whose counts
    are then within Manhattan distance one: equal, or neighbours of odd and even
    sum. So each fingerprint is at home in its own cell of each half, and those
    of even sum are guests in all neighbour cells.
    """
    halves = prints.select("node", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    bits = halves.select("node", "half", F.expr("shiftrightunsigned(node, half * 32) & 4294967295L").alias("bits"))
    vectors = bits.select("node", "half", F.expr(f"(bits & {ONES}L) + (shiftrightunsigned(bits, 1) & {ONES}L)").alias("vector"))
    home = vectors.select(F.expr("half * 4294967296L + vector").alias("bucket"), "node", F.lit(True).alias("home"))
    # The sum of the counts is even if an even number of segments holds a one.
    even = vectors.where(F.expr(f"bit_count(vector & {ONES}L) % 2 = 0"))
    steps = even.select("node", "half", "vector", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("segment"), F.expr("shiftrightunsigned(vector, segment * 2) & 3L").alias("count"))
    moved = steps.select("node", "half", "vector", "segment", F.explode(F.expr("filter(array(count - 1, count + 1), c -> c between 0 and 2)")).alias("to"), "count")
    guests = moved.select(F.expr("half * 4294967296L + vector + shiftleft(to - count, segment * 2)").alias("bucket"), "node", F.lit(False).alias("home"))
    occupied = home.select("bucket").distinct()
    return home.union(guests.join(occupied, "bucket"))


def close_bits(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)


def _fingerprinted(docs: DataFrame, kept: list[str], doc_id: str, text: str, *extra: Column) -> DataFrame:
    """A written table of ``row`` (the columns to keep), ``doc_id``, ``print`` and the extra columns."""
    packed = F.struct(F.lit(1).alias("_"), *(F.col(f"row.`{c}`").alias(c) for c in kept)).alias("row")
    rows = kept_apart(docs, doc_id=doc_id, text=text).select(packed, "doc_id", *extra, shingle_hashes(F.col("text")).alias("hashes"))
    # A table function, as Spark 4.1 can't pass an expression with a lambda to a Python column function.
    schema = StructType([*rows.schema.fields[:-1], StructField("print", LongType())])
    return materialize(rows.mapInArrow(_add_bits, schema), "simhash")


def _components(rows: DataFrame) -> DataFrame:
    """``print``, ``least`` (its smallest doc_id), ``rows`` and ``component`` of each distinct fingerprint."""
    prints = materialize(rows.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")), "fingerprints")
    linked = link_groups(_cells(prints.select(F.col("print").alias("node"))), close_bits)
    return prints.join(linked, F.col("print") == F.col("node"), "left").select("print", "least", "rows", F.coalesce("component", "print").alias("component"))


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``fingerprint`` (16 hex digits) and ``component_id`` to every row; ``carry`` names the columns to keep.

    Fingerprints link at three or fewer differing bits; a component's id is its
    smallest doc_id. Equal fingerprints collapse before any pair is formed, the
    grid join yields candidates, their exact Hamming distance decides.

    Null and empty texts have fingerprint zero and link like any other. Null ids
    never become a component's id unless all of its ids are null; repeated rows
    stay. An empty table gives an empty result. Input columns named like an
    added one are replaced.
    """
    kept = list(docs.columns if carry is None else carry)
    rows = _fingerprinted(docs, kept, doc_id, text)
    placed = _components(rows)
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(placed.join(ids, "component").select(F.col("print").alias("of"), "component_id"), "simhash-components")
    found = rows.join(named, F.col("print") == F.col("of")).select("row", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
    return restored(found, kept, "fingerprint", "component_id")


def keep_one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay: of each component that of the smallest doc_id (null last), then of the smaller text digest.

    Only rows of components with several rows are grouped, and tasks reduce them
    before the shuffle. Columns stay as they are; of rows alike in id and text
    any one stays. An empty table gives an empty result.
    """
    rows = _fingerprinted(docs, docs.columns, doc_id, text, text_key(text_or_empty(F.col("text"))).alias("key"))
    placed = materialize(_components(rows), "simhash-components")
    several = placed.groupBy("component").agg(F.sum("rows").alias("rows")).where("rows > 1").select("component")
    crowded = materialize(placed.join(several, "component").select(F.col("print").alias("of"), "component"), "simhash-groups")
    tagged = rows.join(crowded, F.col("print") == F.col("of"), "left")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")
    alone = tagged.where(F.col("component").isNull()).select("row")
    first = tagged.where(F.col("component").isNotNull()).groupBy("component").agg(F.min_by("row", rank).alias("row")).select("row")
    return restored(alone.union(first), docs.columns)
