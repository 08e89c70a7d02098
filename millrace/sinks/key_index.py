"""Uniqueness against everything loaded before: Bloom words per key block, settled exactly in the touched buckets.

The index of a table keeps each key once, with the load that brought it, in
key-hash buckets, and a filter of 64-bit words. A key sets a few bits of one
word. As the table grows both are written anew with twice the words, so that buckets and words
stay filled alike at every size. A new load is first held against the words; keys whose bits are all set
*may* be known, and only the buckets of those are read and joined. A filter has
no false negatives, so nothing is missed, and the join removes false hits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.names import any_of, col
from millrace.session import materialize
from millrace.sinks.tables import TableStore

#: A word takes this many keys on average; with BITS bits a key, about one new key in a hundred is a false hit.
KEYS_PER_WORD = 4
BITS = 4
#: The smallest filter has 2 to this power words.
FEWEST_WORDS_LOG = 10
#: A bucket, the unit of reading, is filled by the keys of 2 to this power words; there are between these numbers of buckets.
WORDS_PER_BUCKET_LOG = 16
FEWEST_BUCKETS, MOST_BUCKETS = 8, 4096


class KeyIndex:
    """The keys of one table over all its loads.

    ``keys`` name the key columns. A row with a NULL in one of them equals nothing
    and is not judged. What a load adds counts once its run is finished in the
    store, so a failed load is repeated under the same name. The types of the keys
    cannot change, for their hash names bucket and word.
    """

    def __init__(self, store: TableStore, name: str, keys: Sequence[str], words_per_bucket_log: int = WORDS_PER_BUCKET_LOG):
        self.store, self.name, self.keys = store, name, list(keys)
        self.words_per_bucket_log = words_per_bucket_log

    def repeated(self, batch: DataFrame) -> DataFrame:
        """Keys that a batch repeats: their rows in the batch and the load that brought them.

        ``first_load`` is NULL for a key that only the batch itself repeats.
        """
        return self._judge(batch)[0]

    def register(self, batch: DataFrame, load: str) -> DataFrame:
        """:meth:`repeated`, and the batch's new keys become known when run ``load`` is finished."""
        if self.store.is_finished(load):
            raise ValueError(f"load {load} is finished already")
        result, counted, earlier = self._judge(batch)
        fresh = counted if earlier is None else counted.join(earlier.select(*self._key_columns()), self.keys, "left_anti")
        fresh = materialize(fresh.select(*self._key_columns(), F.lit(load).alias("first_load")), "new-keys")
        size = self._size()
        known = self._known(size)
        total = fresh.count() + (known.count() if known is not None else 0)
        needed = _words_log(total)
        if size is not None and needed > size:
            # The smaller index is left as it is: readers take the largest that a finished load wrote.
            fresh = known.select(*self._key_columns(), "first_load").unionByName(fresh)
        size = needed if size is None else max(size, needed)
        hashed = F.xxhash64(*self._key_columns())
        self.store.append(self._keys_table(size), fresh.withColumn("bucket", self._bucket(hashed, size)), ("bucket",), load)
        words = fresh.select(hashed.alias("__hash")).groupBy(_word(size).alias("word")).agg(F.bit_or(_mask()).alias("bits"))
        self.store.append(self._words_table(size), words, (), load)
        return result

    def _key_columns(self) -> list[Column]:
        return [col(k) for k in self.keys]

    def _keys_table(self, size: int) -> str:
        return f"{self.name}_keys_{size}"

    def _words_table(self, size: int) -> str:
        return f"{self.name}_words_{size}"

    def _size(self) -> int | None:
        """Log of the words of the newest index that counts."""
        prefix = f"{self.name}_words_"
        sizes = [int(c[len(prefix) :]) for c in self.store.tables() if c.startswith(prefix) and c[len(prefix) :].isdigit()]
        return max((n for n in sizes if self.store.exists(self._words_table(n))), default=None)

    def _known(self, size: int | None) -> DataFrame | None:
        return None if size is None else self.store.read(self._keys_table(size))

    def _bucket(self, hashed: Column, size: int) -> Column:
        count = min(MOST_BUCKETS, max(FEWEST_BUCKETS, 1 << max(0, size - self.words_per_bucket_log)))
        return F.pmod(hashed, F.lit(count)).cast("int")

    def _judge(self, batch: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        complete = ~any_of([c.isNull() for c in self._key_columns()])
        counted = batch.filter(complete).groupBy(*self._key_columns()).agg(F.count(F.lit(1)).alias("row_count"))
        counted = materialize(counted, "batch-keys")
        size = self._size()
        if size is None:
            first = F.lit(None).cast("string").alias("first_load")
            return counted.filter("row_count > 1").select(*self._key_columns(), "row_count", first), counted, None
        known = self._known(size)
        changed = [k for k in self.keys if known.schema[k].dataType != counted.schema[k].dataType]
        if changed:
            raise ValueError(f"a key cannot change its type: {', '.join(changed)}")
        possible = materialize(self._possible(counted, size), "possible-repeats")
        touched = [r[0] for r in possible.select("bucket").distinct().collect()]  # at most MOST_BUCKETS
        stored = known.filter(F.col("bucket").isin(touched))
        earlier = materialize(possible.join(stored, [*self.keys, "bucket"]).drop("bucket"), "known-keys")
        found = counted.join(earlier, self.keys, "left").filter("row_count > 1 or first_load is not null")
        return found.select(*self._key_columns(), "row_count", "first_load"), counted, earlier

    def _possible(self, counted: DataFrame, size: int) -> DataFrame:
        """Keys whose bits are all set, with their buckets. What several loads set in a word is put together before the join."""
        hashed = counted.withColumn("__hash", F.xxhash64(*self._key_columns()))
        asked = hashed.select(*self._key_columns(), self._bucket(F.col("__hash"), size).alias("bucket"), _word(size).alias("word"), _mask().alias("mask"))
        words = self.store.read(self._words_table(size)).join(asked.select("word"), "word", "left_semi")
        words = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
        set_bits = F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")
        return asked.join(words, "word").filter(set_bits).select(*self._key_columns(), "bucket")


def _words_log(keys: int) -> int:
    """Log of the number of words that so many keys need."""
    return max(FEWEST_WORDS_LOG, (max(keys, 1) // KEYS_PER_WORD).bit_length())


def _word(size: int) -> Column:
    """The word of a key: the high bits of its hash, which do not name its bucket."""
    return F.shiftrightunsigned(F.col("__hash"), 64 - size)


def _mask() -> Column:
    """A key's bits in its word, from a second hash."""
    second = F.xxhash64(F.lit("bits"), F.col("__hash"))
    masks = []
    for n in range(BITS):
        place = F.shiftrightunsigned(second, 6 * n).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        masks.append(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    mask = masks[0]
    for one in masks[1:]:
        mask = mask.bitwiseOR(one)
    return mask
