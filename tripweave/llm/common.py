"""What the operators share: folds, sampling of labelled rows, tables in the shared folder, word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.session import ensure_checkpoint_dir, prepare, shared_root
from tripweave.sources.tables import delete_path

ASCII_SPACE = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{ASCII_SPACE}]+"
BATCH_ROWS = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ready(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; texts may be long, so Arrow batches are kept to few rows."""
    prepare(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables of one run, each of which can be deleted once its last reader is done."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.path = spark, f"{shared_root(spark)}/llm/{what}-{uuid.uuid4().hex}"

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, f"{self.path}/{name}")


def give_back() -> None:
    """Return what freed arrays have left in this process; after a fit the driver has little memory to spare."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % F.lit(folds)


def is_fold(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(remainder(doc_id, folds) == F.lit(fold), F.lit(False))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that would clash with new ones, whatever their case."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def labelled(labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """``(_id, y)`` of the labelled ids outside the held-out fold, each once with its largest value."""
    return (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & ~is_fold(F.col("_id"), folds, fold))
        .groupBy("_id").agg(F.max("y").alias("y"))
    )


def class_weights(labels: DataFrame, label: str, per_class: int, folds: int, fold: int) -> dict[int, float]:
    """For each class, how many labelled ids one of ``labelled_sample`` stands for; 1 without a cut."""
    counts = labelled(labels, label, folds, fold).groupBy("y").count().collect()
    return {r["y"]: max(1.0, r["count"] / per_class) for r in counts}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int, fold: int) -> DataFrame:
    """``(text, y)`` of at most ``per_class`` documents of each class outside the held-out fold.

    The rows are those with the smallest hashes of their ids, so reruns agree. At most ``2 * per_class`` ids are
    broadcast; texts are never shuffled. A label repeated for one id counts once, by its largest value.
    """
    known = labelled(labels, label, folds, fold)
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = known.filter("y = 1").orderBy(*order).limit(per_class).unionByName(
        known.filter("y = 0").orderBy(*order).limit(per_class)
    )
    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "_id").select("text", "y")


HINT_WORDS = 1 << 18  # of 64 bits


def with_hint(df: DataFrame, key: str, ids: DataFrame, name: str = "maybe") -> DataFrame:
    """Append a flag that is true for all rows whose ``key`` is among ``ids`` (one column), and for few others.

    A bitmap of hashed ids is broadcast, of at most ``HINT_WORDS`` rows, whatever the number of ids. It spares most
    rows a shuffle; an exact join has to follow.
    """
    only = ids.columns[0]
    spot = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(HINT_WORDS * 64))
    bits = (
        ids.select(spot(only).alias("s")).groupBy(F.expr("cast(s div 64 as int)").alias("_w"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("_bits"))
    )
    marked = df.withColumn("_s", spot(key)).withColumn("_w", F.expr("cast(_s div 64 as int)")).join(F.broadcast(bits), "_w", "left")
    flag = F.coalesce(F.expr("(_bits & shiftleft(1L, cast(_s % 64 as int))) <> 0"), F.lit(False))
    return marked.withColumn(name, flag).drop("_w", "_s", "_bits")


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, elementwise."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHashes(dict):
    """64-bit hash of a word's bytes, remembered for a bounded number of words."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = xxh3_64_intdigest(word)
        return value


def word_hashes(text: str | bytes, memo: WordHashes) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased; words are split at ASCII white space only."""
    raw = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    h = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        h *= _MIX
        h += words[k : len(words) - width + 1 + k]
    h += np.uint64(width)
    return mix64(h)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, by position; of the whole sequence if it is shorter."""
    return _rolled(words, min(size, len(words))) if len(words) else words


WORDS_AT_ONCE = 400_000


def shingled(texts: pa.Array, size: int, memo: WordHashes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words of each text, and its shingles by position, both hashed; empty for null and empty texts.

    Texts are hashed together, a bounded number of words at a time (or one text that has more), as array operations
    cost the same for few elements.
    """
    get = memo.__getitem__
    none = np.empty(0, np.uint64)

    def together(group: list[list[bytes]], total: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        flat = np.fromiter((get(w) for words in group for w in words), np.uint64, total)
        rolled = _rolled(flat, size) if total >= size else none
        at = 0
        for words in group:
            own = flat[at : at + len(words)]
            yield own, rolled[at : at + len(words) - size + 1] if len(words) >= size else shingle_hashes(own, size)
            at += len(words)

    group: list[list[bytes]] = []
    total = 0
    for raw in texts.cast(pa.binary()).to_pylist():
        words = raw.lower().split() if raw else []
        if group and total + len(words) > WORDS_AT_ONCE:
            yield from together(group, total)
            group, total = [], 0
        group.append(words)
        total += len(words)
    yield from together(group, total)


BYTES_AT_ONCE = 1 << 21
LONG_WORD = 64  # bytes; longer words are hashed one by one
_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _hashed_runs(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of the runs of bytes of ``raw``, eight bytes of all runs at a time."""
    padded = np.zeros((len(raw) // 8 + 3) * 8, np.uint8)
    padded[: len(raw)] = raw
    eights = padded.view("<u8")

    def piece(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        cell, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        upper = (eights[cell + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        return ((eights[cell] >> shift) | upper) & _FIRST_BYTES[np.minimum(left, 8)]

    h = mix64(piece(starts, sizes))
    more, done = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD)), 8
    while len(more):
        h[more] = mix64(h[more] * _MIX + piece(starts[more] + done, sizes[more] - done))
        done += 8
        more = more[sizes[more] > done]
    h = mix64(h + sizes.astype(np.uint64) * _MIX)
    long = np.flatnonzero(sizes > LONG_WORD)
    if len(long):
        from xxhash import xxh3_64_intdigest

        for i in long:
            h[i] = xxh3_64_intdigest(raw[starts[i] : starts[i] + sizes[i]].tobytes())
    return h


def text_shingles(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Hashed shingles of each text by position, of the same words as :func:`shingled` but other hashes.

    Words are found and hashed in the bytes of many texts at once (or of one text that has more than
    ``BYTES_AT_ONCE``), without an object for each word.
    """
    whole = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = whole.buffers()
    offsets = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1] if len(whole) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(whole):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BYTES_AT_ONCE, "right")) - 1)
        raw = _LOWERED[data[offsets[first] : offsets[last]]]
        bounds = offsets[first : last + 1] - offsets[first]
        held = bounds[:-1][np.diff(bounds) > 0], bounds[1:][np.diff(bounds) > 0] - 1
        inside = ~_SPACES[raw]
        # A word begins or ends beside white space and at the ends of its text.
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[held[0]] = inside[held[0]]
        ends[:-1] &= ~inside[1:]
        ends[held[1]] = inside[held[1]]
        starts = np.flatnonzero(begins)
        flat = _hashed_runs(raw, starts, np.flatnonzero(ends) + 1 - starts)
        rolled = _rolled(flat, size) if len(flat) >= size else flat[:0]
        at = np.searchsorted(starts, bounds).tolist()
        for a, b in zip(at, at[1:]):
            yield rolled[a : b - size + 1] if b - a >= size else shingle_hashes(flat[a:b], size)
        first = last
