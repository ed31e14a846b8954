"""Benchmark decontamination by SimHash over item-sized windows.

For every benchmark item of n words, windows of n words of each document are fingerprinted (64-bit SimHash of their
word shingles, weighted by how often they occur) and looked up in a multi-index: fingerprints are cut into blocks, and
an item is filed under every block value within ``RADIUS // BLOCKS`` bits of its own. By the pigeonhole principle each
item within ``RADIUS`` bits of a window shares a block entry with it. Candidates within the radius are then compared
by the exact weighted Jaccard similarity of their shingles (sum of smaller counts over sum of larger ones).

Of all windows of n words, only those are fingerprinted that start at a shingle of some item of n words and hold
enough such shingles for the threshold. This leaves no match out: a window that reaches the threshold can be moved
right to its first shared shingle without losing one. A document shorter than an item is one window. Radius 24 of 64
bits is over four standard deviations beyond what similarity 0.75 gives.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; shingles have five of them; shorter texts are one shingle. Null and
empty texts and items match nothing. Several equal items are all reported, one without an id with a null id; of windows
equally like an item the first is. Repeated rows give repeated results; extra columns pass through and those named like
the output are replaced. An empty benchmark leaves documents without matches. Texts of any length are searched whole. Items are broadcast in chunks of a bounded number of words, one pass over the documents for each chunk.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import WORD_PATTERN, WordHashes, shingle_hashes, shingled, stored, table, without, word_hashes

SIZE = 5
THRESHOLD = 0.75
RADIUS, BLOCKS = 24, 8
CHUNK_WORDS = 2_000_000  # words of the items that are broadcast at a time
MATCHES = "array<struct<item_id:long, start:int, words:int, similarity:double>>"
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("words", pa.int32()), ("similarity", pa.float64())]))


def simhash(shingles: np.ndarray) -> np.uint64:
    """64-bit fingerprint of hashed shingles; one that occurs twice weighs twice."""
    bits = np.unpackbits(np.ascontiguousarray(shingles).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * bits > len(shingles)).view(np.uint64)[0]


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[h]) for h, n in a.items() if h in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def _near_values(radius: int) -> list[int]:
    """Byte masks with at most ``radius`` bits set."""
    return [sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(8), k)]


class ItemIndex:
    """Items by shingle, and by block value of their fingerprints."""

    def __init__(self, items: list[tuple[int, str]]):
        memo = WordHashes()
        self.items = []  # id, words, shingle counts, fingerprint
        self.sizes: dict[int, set[int]] = {}  # shingle -> words of the items that hold it
        self.blocks: dict[tuple[int, int, int], list[int]] = {}  # words, block, value -> items
        masks = _near_values(RADIUS // BLOCKS)
        for item_id, text in items:
            words = word_hashes(text, memo)
            if not len(words):
                continue
            shingles = shingle_hashes(words, SIZE)
            mark = simhash(shingles)
            k = len(self.items)
            self.items.append((item_id, len(words), Counter(shingles.tolist()), mark))
            for h in shingles.tolist():
                self.sizes.setdefault(h, set()).add(len(words))
            for block, value in enumerate(np.array([mark]).view(np.uint8).tolist()):
                for mask in masks:
                    self.blocks.setdefault((len(words), block, value ^ mask), []).append(k)
        self.known = np.sort(np.fromiter(self.sizes, np.uint64, len(self.sizes)))
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.known >> np.uint64(48)).astype(np.int64)] = True
        # Items shorter than a shingle: their one shingle is that of their own size.
        self.widths = sorted({min(SIZE, n) for _, n, _, _ in self.items})

    def windows(self, words: np.ndarray, full: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(first word, last word + 1, item's words)`` of windows that may reach the threshold, by first word.

        ``full`` has the document's shingles by position.
        """
        for width in self.widths:
            if len(words) < width:
                continue
            shingles = full if width == SIZE else shingle_hashes(words, width)
            at = np.flatnonzero(self.filter[(shingles >> np.uint64(48)).astype(np.int64)])
            near = np.searchsorted(self.known, shingles[at])
            at = at[self.known[np.minimum(near, len(self.known) - 1)] == shingles[at]]
            places: dict[int, list[int]] = {}
            for p in at.tolist():
                for size in self.sizes[int(shingles[p])]:
                    if min(SIZE, size) == width:
                        places.setdefault(size, []).append(p)
            for size, found in sorted(places.items()):
                there = np.array(found)
                starts = np.unique(np.minimum(there, max(0, len(words) - size)))
                ends = np.minimum(len(words), starts + size)
                own, held = size - width + 1, ends - starts - width + 1
                shared = np.searchsorted(there, ends - width, side="right") - np.searchsorted(there, starts)
                able = shared * (1 + THRESHOLD) >= THRESHOLD * (own + held)
                yield from zip(starts[able].tolist(), ends[able].tolist(), [size] * int(able.sum()))

    def candidates(self, mark: np.uint64, size: int) -> list[int]:
        """Items of ``size`` words whose fingerprints are within the radius, by the block index."""
        filed = {k for block, value in enumerate(np.array([mark]).view(np.uint8).tolist()) for k in self.blocks.get((size, block, value), ())}
        return [k for k in filed if int(mark ^ self.items[k][3]).bit_count() <= RADIUS]

    def matches(self, words: np.ndarray, full: np.ndarray) -> list[dict]:
        """Each matched item once, at the window most like it."""
        best: dict[int, tuple[float, int, int]] = {}
        for start, end, size in self.windows(words, full):
            shingles = shingle_hashes(words[start:end], SIZE)
            own = None
            for k in self.candidates(simhash(shingles), size):
                own = own or Counter(shingles.tolist())
                similarity = weighted_jaccard(own, self.items[k][2])
                if similarity >= THRESHOLD and similarity > best.get(k, (0.0,))[0]:
                    best[k] = (similarity, start, end - start)
        return [
            {"item_id": self.items[k][0], "start": start, "words": n, "similarity": similarity}
            for k, (similarity, start, n) in sorted(best.items())
        ]


def _matcher(shared: Broadcast):
    @F.arrow_udf(MATCHES)
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, memo = ItemIndex(shared.value), WordHashes()
        for texts in batches:
            yield pa.array([index.matches(*x) if index.items else [] for x in shingled(texts, SIZE, memo)], _ARROW)

    return look


def find_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Append ``matches``: the benchmark items that a document holds, with the window of each in words."""
    docs = without(docs, "matches")
    items = stored(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .withColumn("n", F.regexp_count("text", F.lit(WORD_PATTERN))).filter("n > 0"),
        "benchmark-items",
    )
    total = items.agg(F.sum("n"), F.max("n")).first()
    chunks = max(1, -(-(total[0] or 0) // CHUNK_WORDS))
    found = docs.withColumn("matches", F.lit(None).cast(MATCHES))
    for chunk in range(chunks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == chunk).select("item_id", "text").distinct()
        rows = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        own = _matcher(shared)(F.col(text))
        found = found.withColumn("matches", own if chunk == 0 else F.concat("matches", own))
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark item, with their own columns."""
    return find_matches(docs.select("*"), benchmark).filter(F.size("matches") == 0).select(*docs.columns)


def op4_decontamination(spark, sf_dir):
    """One row per document and benchmark item it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A filter on the matches would be moved below and look for them twice; exploding drops empty lists anyway.
    found = find_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", "m.item_id", F.col("m.start").alias("start_word"), F.col("m.words").alias("n_words"), "m.similarity"
    )
