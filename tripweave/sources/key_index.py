"""Where the rows of a key are stored: an index of keys and months, beside a table that is stored by month.

An upsert has to know which months hold a row of a delivered key. Most delivered keys are new, so a Bloom filter per
bucket of key hashes answers first; it has a few bits a key. Only buckets in which some delivered key may be are read,
and in them only rows of such keys are kept.

Both files are only ever added to, and before the rows themselves are put in place. So the index never misses a stored
row; after a lost run or a move it may name a month that no longer holds the key, which costs reading that month once.
Keys that are missing are not indexed. A key that comes twice with its month may be listed twice.

A batch of many keys meets every bucket, whatever the filters say. So it skips them and meets the stored keys in one join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.upsert import HASH, hashed, shuffled
from tripweave.sources.files import child_names, delete_path, path_exists

BITS_PER_KEY = 12
PROBES = 4  # bits of a word that stand for a key
LEAST_WORDS = 64  # of a bucket's filter, 64 bits each
MOST_ASKED = 100  # keys a bucket up to which filters are asked first; one in fifty new keys passes them, so more meet every bucket


class KeyIndex:
    """Keys under ``path`` in ``buckets`` folders, and their filters."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    @property
    def _keys_path(self) -> str:
        return f"{self.path}/keys"

    def _filter_path(self, words: int) -> str:
        return f"{self.path}/filter-{words}"

    def _words(self) -> int | None:
        """Words of each bucket's filter, which its folder is named after; None without a complete index."""
        sizes = [int(n.split("-")[1]) for n in child_names(self.spark, self.path) if n.startswith("filter-")]
        return max((n for n in sizes if path_exists(self.spark, f"{self._filter_path(n)}/_SUCCESS")), default=None)

    def exists(self) -> bool:
        return self._words() is not None

    def _marked(self, keys: DataFrame, words: int) -> DataFrame:
        """Append the key's bucket, its word there, and its bits of that word."""
        at, one = F.xxhash64(F.lit(2), "key"), F.lit(1).cast("long")
        places = [F.shiftright(at, 6 * k).bitwiseAND(63).cast("int") for k in range(PROBES)]
        bits = [F.call_function("shiftleft", one, place) for place in places]
        return keys.select(
            "*", F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int").alias("bucket"),
            F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(words)).cast("int").alias("word"),
            reduce(lambda a, b: a.bitwiseOR(b), bits).alias("mask"),
        )

    def _filters(self, keys: DataFrame, words: int) -> DataFrame:
        return self._marked(keys.select("key"), words).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))

    def _append_keys(self, pairs: DataFrame, words: int) -> None:
        dealt = self._marked(pairs, words).select("key", "month", "bucket").repartition("bucket")
        dealt.write.mode("append").partitionBy("bucket").parquet(self._keys_path)

    def _append_filters(self, keys: DataFrame, words: int) -> None:
        self._filters(keys, words).write.mode("append").parquet(self._filter_path(words))

    def _keys(self) -> DataFrame:
        return self.spark.read.schema("key string, month string, bucket int").parquet(self._keys_path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)

    def rebuild(self, pairs: DataFrame, rows: int | None = None) -> None:
        """Start anew from ``(key, month)``, of ``rows`` at most; filters get twice the room that these keys need."""
        pairs = pairs.filter("key is not null")
        need = 2 * (pairs.count() if rows is None else rows) * BITS_PER_KEY // (64 * self.buckets)
        words = max(LEAST_WORDS, 1 << need.bit_length())
        self.drop()
        self._append_keys(pairs, words)
        # Filters come last, they make the index complete. What was just stored is read instead of making the pairs again.
        self._append_filters(self._keys(), words)

    def candidates(self, keys: DataFrame) -> DataFrame:
        """``(key, bucket)`` of those different keys that the filters do not rule out."""
        words = self._words()
        filters = self.spark.read.schema("bucket int, word int, bits long").parquet(self._filter_path(words))
        met = self._marked(keys.select("key").distinct(), words).join(shuffled(filters), ["bucket", "word"])
        # A word may have been added to several times.
        whole = met.groupBy("key", "bucket", "mask").agg(F.bit_or("bits").alias("bits"))
        return whole.filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("key", "bucket")

    def months_of(self, keys: DataFrame, asked: int | None = None) -> DataFrame:
        """``(key, month)`` of the stored ones among ``keys``, of which there are ``asked``; a key may have several months."""
        read = self._keys()
        if asked is None or asked <= MOST_ASKED * self.buckets:
            keys = self.candidates(keys)
            # No more numbers than there are buckets.
            buckets = sorted(r["bucket"] for r in keys.select("bucket").distinct().collect())
            read = read.filter(F.col("bucket").isin(buckets))
        met = hashed(read, "key").join(shuffled(hashed(keys.select("key"), "key")), [HASH, "key"], "left_semi")
        # Equal rows meet in one task already.
        return met.select(HASH, "key", "month").distinct().select("key", "month")

    def add(self, pairs: DataFrame, known: DataFrame | None) -> None:
        """Add ``(key, month)`` pairs that are not among the ``known`` ones, if any; filters that got too full grow.

        Filters come first: bits of keys that are not listed yet do no harm, while a key without its bits would be missed.
        Writing keys makes Spark read anew what it persisted of the listed keys, so the new ones would not be new any more.
        """
        words = self._words()
        if known is None:
            # These come from stored rows; reading them twice costs less than keeping them.
            self._append_filters(pairs, words)
            self._append_keys(pairs, words)
        else:
            new = hashed(pairs, "key").join(shuffled(hashed(known, "key")), [HASH, "key", "month"], "left_anti")
            new = new.select("key", "month").persist()
            try:
                if new.isEmpty():
                    return
                self._append_filters(new, words)
                self._append_keys(new, words)
            finally:
                new.unpersist()
        if self._keys().count() * BITS_PER_KEY > 64 * self.buckets * words:
            # The old filters serve until the new ones are complete.
            self._filters(self._keys(), 2 * words).write.mode("overwrite").parquet(self._filter_path(2 * words))
            delete_path(self.spark, self._filter_path(words))
