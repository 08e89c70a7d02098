"""Near-duplicate lines: MinHash sketches of character shingles, banding, exact Jaccard, union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BROADCAST_BYTES, keep, kept_apart, let, link_groups, materialize, scratch_scope, shared_members, text_key, text_or_empty

#: Two lines are near duplicates if their sets of five-character shingles have at least this Jaccard similarity.
SHINGLE = 5
SIMILARITY = 0.8
#: Lines of up to SHORT distinct shingles meet in neighbours of their least hashes, lines of LONG or more in bands of bins.
#: Similar lines differ in size by a fifth at most, so that both have one of the two in common.
SHORT, LONG = 50, 40
LEAST = 12
#: Bands of BAND_BINS bins each; the least hash of every bin is a sample, an empty bin borrows that of another one.
#: A pair of similarity 0.8 shares a band with 0.992, one of 0.85 with 0.9995.
BANDS, BAND_BINS = 16, 6
BINS = BANDS * BAND_BINS
BORROWS = 64
#: Words of 64 bits in a parity bitmap.
WORDS = 8
#: Lines and code points that are sketched at once, and nodes that a task remembers so as to sketch equal lines once.
CHUNK_LINES, CHUNK_POINTS = 1 << 14, 1 << 20
REMEMBERED = 1 << 20
#: Bits of a shingle hash; the place of a line within its chunk stands above them.
HASH_BITS = 50
#: Odd multipliers of the five code points of a shingle and of the mixing steps; powers, so that none is a small multiple of another.
GOLDEN = 0x9E3779B97F4A7C15
MULTIPLIERS = [np.uint64(pow(GOLDEN, k + 1, 1 << 64)) for k in range(SHINGLE + 2)]
SKETCH = pa.schema([("node", pa.int64()), ("size", pa.int32()), *((f"w{k}", pa.int64()) for k in range(WORDS)), ("buckets", pa.list_(pa.int64()))])


def _mixed(x: np.ndarray) -> np.ndarray:
    for k in (SHINGLE, SHINGLE + 1):
        x = (x ^ (x >> np.uint64(31))) * MULTIPLIERS[k]
    return x ^ (x >> np.uint64(29))


def _shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The place of the line and the hash of all distinct shingles of some lines, by line, then hash."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    ends = np.cumsum(lengths)
    width = len(points) - SHINGLE + 1
    hashes = np.zeros(max(width, 0), np.uint64)
    for k in range(SHINGLE):
        hashes += (points[k : k + max(width, 0)] + np.uint64(k)) * MULTIPLIERS[k]
    line = np.repeat(np.arange(len(lines)), lengths)[: max(width, 0)]
    inside = np.arange(max(width, 0)) + SHINGLE <= ends[line]
    # A line shorter than a shingle is one shingle.
    short = np.flatnonzero((lengths < SHINGLE) & (lengths > 0))
    whole = np.array([sum((ord(c) + k) * int(MULTIPLIERS[k]) for k, c in enumerate(lines[i])) % (1 << 64) ^ GOLDEN for i in short], np.uint64)
    line, hashes = np.concatenate([line[inside], short]), np.concatenate([hashes[inside], whole])
    keys = line.astype(np.uint64) << np.uint64(HASH_BITS) | _mixed(hashes) >> np.uint64(64 - HASH_BITS)
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    return (keys >> np.uint64(HASH_BITS)).astype(np.int64), keys & np.uint64((1 << HASH_BITS) - 1)


def _starts(*of: np.ndarray) -> np.ndarray:
    """Where a new group of equal values begins."""
    new = np.zeros(len(of[0]), bool)
    new[:1] = True
    for values in of:
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _buckets(line: np.ndarray, hashes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``line`` and bucket: neighbours of the least hashes for short lines, bands of bins for long ones."""
    first = np.cumsum(size) - size
    rank = np.arange(len(line)) - first[line]
    near = np.flatnonzero((size[line] <= SHORT) & (rank < LEAST) & ((rank + 1 < np.minimum(size[line], LEAST)) | (size[line] == 1)))
    after = np.where(size[line[near]] > 1, hashes[np.minimum(near + 1, len(hashes) - 1)], np.uint64(0))
    short = _mixed(hashes[near] * MULTIPLIERS[0] + _mixed(after + MULTIPLIERS[1]))
    long, keys = _bands(line, hashes, np.flatnonzero(size >= LONG))
    return np.concatenate([line[near], np.repeat(long, BANDS)]), np.concatenate([short, keys.ravel()])


def _bands(line: np.ndarray, hashes: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The long lines and, per line, a key of each band: of the least hashes of its bins."""
    none = np.uint64((1 << 64) - 1)
    row = np.full(int(line[-1]) + 1 if len(line) else 0, -1)
    row[long] = np.arange(len(long))
    bins = (hashes >> np.uint64(HASH_BITS - 32)) * np.uint64(BINS) >> np.uint64(32)
    least = _starts(line, bins) if len(line) else np.zeros(0, np.int64)
    least = least[row[line[least]] >= 0]
    found = np.full((len(long), BINS), none)
    found[row[line[least]], bins[least].astype(np.int64)] = hashes[least]
    filled = found.copy()
    for turn in range(1, BORROWS + 1):
        empty = filled == none
        if not empty.any():
            break
        lender = (_mixed(np.arange(BINS, dtype=np.uint64) + np.uint64(turn * BINS)) % np.uint64(BINS)).astype(np.int64)
        filled = np.where(empty, found[:, lender], filled)
    places = _mixed(np.arange(BINS, dtype=np.uint64))
    keys = _mixed(filled + places).reshape(len(long), BANDS, BAND_BINS).sum(2, dtype=np.uint64)
    return long, _mixed(keys)


def _parity(line: np.ndarray, hashes: np.ndarray, lines: int) -> np.ndarray:
    """Bitmaps in which each hash turns one bit: two of them differ in no more bits than the sets in hashes."""
    words = np.zeros((lines, WORDS), np.uint64)
    if len(line):
        word = hashes >> np.uint64(HASH_BITS - 3)
        group = _starts(line, word)
        words[line[group], word[group].astype(np.int64)] = np.bitwise_xor.reduceat(np.uint64(1) << (hashes & np.uint64(63)), group)
    return words


def sketch(nodes: np.ndarray, lines: list[str]) -> pa.RecordBatch:
    """``buckets`` in which each line meets similar ones, and its distinct shingles (``size``, parity words) for ``may_be_similar``."""
    line, hashes = _shingle_hashes(lines)
    size = np.bincount(line, minlength=len(lines))
    owner, bucket = _buckets(line, hashes, size)
    order = np.argsort(owner, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lines)))]).astype(np.int32)
    words = _parity(line, hashes, len(lines))
    buckets = pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket[order].view(np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes), pa.array(size.astype(np.int32)), *(pa.array(words[:, k].copy().view(np.int64)) for k in range(WORDS)), buckets], schema=SKETCH
    )


def _sketch_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches of ``node``, ``line``; equal lines of a task once as far as it remembers them."""
    seen: set[int] = set()
    held: list[tuple[int, str]] = []
    points = 0
    for batch in batches:
        for node, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node in seen:
                continue
            if len(seen) < REMEMBERED:
                seen.add(node)
            held.append((node, line))
            points += len(line)
            if len(held) == CHUNK_LINES or points >= CHUNK_POINTS:
                yield sketch(np.array([n for n, _ in held], np.int64), [t for _, t in held])
                held, points = [], 0
    if held:
        yield sketch(np.array([n for n, _ in held], np.int64), [t for _, t in held])


def may_be_similar(a: Column, b: Column) -> Column:
    """False only for lines whose similarity is under 0.8.

    Sets of similarity 0.8 or more differ in a ninth of the sum of their sizes at
    most, and their parity bitmaps and sizes in no more than that.
    """
    differing = sum((F.bit_count(a[f"w{k}"].bitwiseXOR(b[f"w{k}"])) for k in range(1, WORDS)), F.bit_count(a["w0"].bitwiseXOR(b["w0"])))
    return 9 * F.greatest(differing, F.abs(a["size"] - b["size"])) <= a["size"] + b["size"]


def _runs(line: Column) -> Column:
    """All five-character shingles; the whole line if it is shorter."""
    runs = F.regexp_extract_all(line, F.lit(rf"(?s)(?=(.{{{SHINGLE}}}))"), 1)
    return F.when(F.length(line) >= SHINGLE, runs).otherwise(F.array(line))


def _shingles(line: Column) -> Column:
    return F.array_distinct(_runs(line))


def similar(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Of pairs ``a``, ``b`` those whose lines (``node``, ``line``) reach the similarity, by exact Jaccard."""
    x = lines.select(F.col("node").alias("a"), F.col("line").alias("left"))
    y = lines.select(F.col("node").alias("b"), F.col("line").alias("right"))

    sets = F.array(_shingles(F.lower("left")), _shingles(F.lower("right")))
    common = lambda s: F.size(F.array_intersect(s[0], s[1]))
    jaccard = let(sets, lambda s: let(common(s), lambda n: n / (F.size(s[0]) + F.size(s[1]) - n)))
    return pairs.join(x, "a").join(y, "b").where(jaccard >= SIMILARITY).select("a", "b")


def _occurrences(docs: DataFrame) -> DataFrame:
    """Each line that is not blank: ``doc_id``, ``text_id``, ``place``, ``line``."""
    split = docs.select(
        F.col("doc_id"), text_key(text_or_empty(F.col("text"))).alias("text_id"),
        F.posexplode(F.split(text_or_empty(F.col("text")), "\n", -1)).alias("place", "line"),
    )
    return split.where(F.trim("line") != "")


def _few(nodes: DataFrame) -> DataFrame:
    """Nodes to be broadcast if they are few enough, else joined."""
    return F.broadcast(nodes) if 16 * nodes.count() <= BROADCAST_BYTES else nodes


def _linked(docs: DataFrame) -> DataFrame:
    """``node``, ``component`` of all lines with a near duplicate."""
    lines = _occurrences(docs).select(F.xxhash64("line").alias("node"), F.lower("line").alias("line"))
    words = [f"w{k}" for k in range(WORDS)]
    # Sketches of all lines go as soon as the few lines that share a bucket are known.
    with scratch_scope(docs.sparkSession):
        schema = f"node bigint, size int, {', '.join(f'{w} bigint' for w in words)}, buckets array<bigint>"
        sketches = materialize(lines.mapInArrow(_sketch_lines, schema), "line-sketches")
        placed = keep(shared_members(sketches.select("node", "size", F.explode("buckets").alias("bucket"))).distinct(), "members")
        wanted = keep(placed.select("node").distinct(), "candidate-lines")
        found = sketches.join(_few(wanted), "node").groupBy("node").agg(F.first(F.struct("size", *words, "buckets")).alias("signature"))
        signatures = keep(found, "signatures")
    texts = _occurrences(docs).select(F.xxhash64("line").alias("node"), "line").join(_few(wanted), "node").groupBy("node").agg(F.min("line").alias("line"))
    texts = materialize(texts, "candidate-texts")
    return link_groups(placed, lambda pairs: similar(pairs, texts), signatures, may_be_similar, lambda a, b: 9 * F.abs(a - b) <= a + b)


def line_decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines to remove: ``doc_id``, ``text_id`` (SHA-256 of the text) and ``removed`` (places from 0).

    Of all lines of a component one stays: that of the smallest doc_id (null
    last), then of the smaller text digest, then the first. Blank lines are never
    removed. Only documents that lose a line have a row.

    Equal lines collapse to one node before any pair is formed. Sketches sample all
    shingles; two lines of similarity 0.8 share a bucket with 0.992, of 0.85 with 0.9995, more similar
    ones nearly always (tests measure it). Of the candidate pairs that can join
    two components, an upper bound of the similarity leaves out dissimilar ones, and
    the exact Jaccard similarity decides the rest. Tables on the way are removed.

    Null and empty texts have no line to remove, long ones are split in lines like any other; rows that repeat id and text are
    one document. An empty table gives an empty result.
    """
    plain = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    with scratch_scope(docs.sparkSession):
        linked = _linked(plain)
        found = _occurrences(plain).select("doc_id", "text_id", "place", F.xxhash64("line").alias("node"), F.substring(text_key(F.col("line")), 1, 16).alias("key"))
        # A line without near duplicates is its own digest of 128 bits; 64-bit nodes only name linked lines.
        group = F.coalesce(F.concat(F.lit("c").cast("binary"), F.col("component").cast("string").cast("binary")), F.col("key"))
        named = materialize(found.join(_few(linked), "node", "left").select("doc_id", "text_id", "place", group.alias("group")), "line-groups")
        several = materialize(named.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group"), "repeated-groups")
        at = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_id", "place").alias("at")
        grouped = materialize(named.join(several, "group").select("doc_id", "text_id", "place", "group", at), "repeated-occurrences")
        repeated = grouped.groupBy("group").agg(F.min("at").alias("kept"), F.max("at").alias("last")).where("kept != last").select("group", "kept")
        repeated = materialize(repeated, "repeated-lines")
        lost = grouped.join(repeated, "group").where(F.col("at") != F.col("kept"))
        return keep(lost.groupBy("doc_id", "text_id").agg(F.sort_array(F.collect_set("place")).alias("removed")), "removed-lines")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its text cut to the lines that stay; rows left without any text go.

    Null and empty texts and texts of blank lines alone stay as they are. Rows that
    repeat both id and text are one document and stay alike. An empty table gives
    an empty result; all other columns stay.
    """
    lost = line_decisions(docs, doc_id, text).select(F.col("doc_id").alias("of_id"), F.col("text_id").alias("of_text"), "removed")
    rows = kept_apart(docs, doc_id=doc_id, text=text)
    mine = F.col("doc_id").cast("bigint").eqNullSafe(F.col("of_id")) & (text_key(text_or_empty(F.col("text"))) == F.col("of_text"))
    lines = F.split("text", "\n", -1)

    def rest(all_lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("removed"))
        return F.array_join(F.transform(places, lambda i: all_lines[i]), "\n")

    cut = rows.join(lost, mine, "left").select("row", "removed", F.when(F.col("removed").isNull(), F.col("text")).otherwise(let(lines, rest)).alias("rest"))
    stays = cut.where(F.col("removed").isNull() | (F.trim(F.regexp_replace("rest", r"\s+", " ")) != ""))
    return stays.select(*(F.col("rest").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def count_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed`` and ``removed`` (places of removed lines from 0) of every row."""
    lost = line_decisions(docs, doc_id, text).select(F.col("doc_id").alias("of_id"), F.col("text_id").alias("of_text"), "removed")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), text_key(text_or_empty(F.col(f"`{text}`"))).alias("text_id"),
        F.size(F.split(text_or_empty(F.col(f"`{text}`")), "\n", -1)).cast("bigint").alias("n_lines"),
    )
    both = rows.join(lost, F.col("doc_id").cast("bigint").eqNullSafe(F.col("of_id")) & (F.col("text_id") == F.col("of_text")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return both.select("doc_id", "n_lines", F.size(removed).cast("bigint").alias("n_removed"), removed.alias("removed"))
