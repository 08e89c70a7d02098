"""Benchmark decontamination by winnowing: shared fingerprints first, whole windows second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, kept_apart, let, materialize, restored, text_key, text_or_empty

#: A shared span of ``GRAM + MINIMA - 1`` words always shares a fingerprint.
GRAM = 5
MINIMA = 6
WINDOW = GRAM + MINIMA - 1
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text_or_empty(text)), NOT_WORD), "")


def _slide(array: Column, width: int, combine) -> Column:
    """``combine`` of each ``width`` neighbours; the array must be that long."""
    starts = F.sequence(F.lit(0), F.size(array) - width)
    return F.transform(starts, lambda i: combine(*(array[i + k] for k in range(width))))


def _minima(hashes: Column) -> Column:
    """For each window of ten words the least hash of its five-word grams."""
    return let(_slide(hashes, GRAM, F.xxhash64), lambda grams: _slide(grams, MINIMA, F.least))


def _grams(hashes: Column, length: int) -> Column:
    """Hash of each run of ``length`` words: the fingerprint of windows too short to be winnowed."""
    return _slide(hashes, length, lambda *h: F.xxhash64(F.lit(length), *h))


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _prints(hashes: Column, length: int) -> Column:
    return F.when(F.size(hashes) >= length, _minima(hashes) if length == WINDOW else _grams(hashes, length)).otherwise(_none("bigint"))


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.xxhash64(w))


def _windows(tokens: Column, length: int) -> Column:
    """Every window of ``length`` words: place, length, fingerprint, digest of the words themselves."""

    def build(prints: Column) -> Column:
        return F.transform(
            prints,
            lambda fingerprint, at: F.struct(
                at.alias("place"), F.lit(length).alias("length"), fingerprint.alias("print"),
                text_key(F.array_join(F.slice(tokens, at + 1, length), " ")).alias("digest"),
            ),
        )

    return let(let(_hashes(tokens), lambda h: _prints(h, length)), build)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` to every row.

    A window is ten consecutive words of a benchmark item, or the whole item if it
    has fewer. A document word in any occurrence of a window is hit. ``n_items``
    counts the items with occurring windows; the digest is of their ids, sorted as
    strings and joined by commas.

    1. Fingerprints: of every window of ten words the least hash of its five-word
       grams (winnowing with six grams), distinct per document, meet those of the
       benchmark. Every shared span of ten words has one. Shorter items meet
       grams of their own length.
    2. The texts with a hit are read again; each window whose fingerprint is hit
       extends to its words, which must have the same SHA-256 digest.
    3. Overlapping windows merge into spans, whose words are counted.

    Equal texts are judged once. Null and empty texts have no words; items without
    words have no windows; null item ids are hit but not listed; repeated rows stay.
    Empty tables give empty results or no hits. Input columns named like an added
    one are replaced.
    """
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), words(F.col(f"`{item_text}`")).alias("tokens"))
    sized = materialize(items.where(F.size("tokens") > 0).withColumn("window", F.least(F.size("tokens"), F.lit(WINDOW))), "benchmark-words")
    lengths = sorted(r[0] for r in sized.select("window").distinct().collect())  # at most ten
    by_length = [
        sized.where(F.col("window") == n).select("item", F.explode(_windows(F.col("tokens"), n)).alias("w")).select("item", "w.length", "w.print", "w.digest")
        for n in lengths or [WINDOW]
    ]
    windows = by_length[0]
    for more in by_length[1:]:
        windows = windows.union(more)
    windows = materialize(windows.distinct(), "benchmark-windows")
    wanted = materialize(windows.select("print").distinct(), "benchmark-prints")

    rows = kept_apart(docs, text=text).withColumn("text", text_or_empty(F.col("text")))
    prints = let(_hashes(words(F.col("text"))), lambda h: F.array_distinct(F.concat(*(_prints(h, n) for n in lengths or [WINDOW]))))
    keyed = rows.select(text_key(F.col("text")).alias("key"), F.explode(prints).alias("print"))
    suspects = materialize(keyed.join(wanted, "print").select("key").distinct(), "suspects")

    again = rows.select(text_key(F.col("text")).alias("key"), "text").join(suspects, "key").groupBy("key").agg(F.first("text").alias("text"))
    occurring = windows.select("print", "length", "digest").distinct()
    tokens = words(F.col("text"))
    places = again.select("key", F.explode(let(tokens, lambda t: F.concat(*(_windows(t, n) for n in lengths or [WINDOW])))).alias("w"))
    hits = materialize(
        places.select("key", "w.place", "w.length", "w.print", "w.digest").join(occurring, ["print", "length", "digest"]), "window-hits"
    )
    ends = F.aggregate(
        F.sort_array(F.collect_set(F.struct(F.col("place"), (F.col("place") + F.col("length")).alias("end")))),
        F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).alias("upto")),
        lambda seen, w: F.struct(
            (seen["words"] + F.greatest(w["end"] - F.greatest(w["place"], seen["upto"]), F.lit(0))).alias("words"),
            F.greatest(w["end"], seen["upto"]).alias("upto"),
        ),
        lambda seen: seen["words"],
    )
    spans = hits.groupBy("key").agg(ends.alias("n_hit"))
    of_items = hits.select("key", "digest").distinct().join(windows.select("digest", "item").distinct(), "digest").groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = materialize(
        spans.join(of_items, "key", "left").select(
            F.col("key").alias("found"), "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ),
        "contamination",
    )
    counted = rows.select("row", text_key(F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    judged = counted.join(found, F.col("key") == F.col("found"), "left").select(
        "row", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
    return restored(judged, docs.columns, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
