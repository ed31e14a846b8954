"""Packing of tokenized documents into sequences by cutting-stock column generation.

A document is its token ids and an end id. What it has beyond whole sequences, its rest, is measured in units of 16
tokens, rounded down; the number of rests of each size is a histogram of 255 numbers. A linear program over patterns,
sets of sizes that fill a sequence exactly, packs as many sequences as the histogram allows. Patterns are generated as
they are needed: a knapsack table over the units finds the one that costs least at the prices of the current solution,
and it enters the basis if it costs less than the sequence it fills is worth. The solution is rounded down, and what is
left of the histogram takes further patterns of it, those with the largest fractions first.

Documents are ranked within their size, and the k-th of a size takes the k-th place that the patterns have for it: a
range of ranks per pattern and size, by arithmetic, so no list of places is made. A sequence's documents stand shortest
first; as sizes were rounded down, the end of the last, longest one may reach over the edge and is cut off there. These
ends and the rests that got no place form one line, which is cut at whole sequences; what remains is cut at powers of
two. So all sequences are full or need no padding, and most documents below a sequence's length keep nearly all their
tokens together.

A null text is empty; it has the end id alone. Documents of any length are taken whole, repeated rows are documents of
their own, and a null id stays null. Ties in rank are settled by a row number. An empty table gives no rows. Only the
id and the text are read, so further columns of any name do not matter.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse
from unicodedata import is_normalized
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import stored, table

CAPACITY = 4_096
UNIT = 16
END = 2
VOCABULARY = "word_bpe_49k.json"
REMEMBERED = 1_000_000  # words whose ids a worker keeps
TOGETHER = 4_096  # new words that are tokenized as one text
AT_ONCE = 4 << 20  # bytes of texts, at least, whose words are looked up together
ROUNDS = 3_000  # patterns that are generated at most; every solution on the way is feasible
NEAR_BEST = 0.999  # of the linear program's bound, to stop at
EPSILON = 1e-9


class WordIds:
    """Token ids of texts, put together from those of their words, a bounded number of which is remembered.

    The vocabulary lower-cases, drops white space and ends tokens where letters or digits meet signs. So a text's ids
    are those of its words, one after the other. A text that may hold the name of a special token, in which case
    matters, is one word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.ids: dict[bytes, bytes] = {}
        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode_batch_fast
        # For words that the normaliser and the splitting into letters leave as they are, the same without them.
        letters = Tokenizer(tokenizer.model)
        letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.encode_letters = letters.encode_batch_fast
        tokens = tokenizer.get_vocab()
        self.is_end = np.zeros(max(tokens.values()) + 1, bool)
        self.is_end[[i for t, i in tokens.items() if t.endswith("</w>")]] = True

    def learn(self, words: list[bytes]) -> None:
        """Know all of these words, whatever was known before."""
        new = list(filterfalse(self.ids.__contains__, words))
        if len(self.ids) + len(new) > REMEMBERED:
            self.ids.clear()
            new = words
        plain, other = [], []
        for word in new:
            text = word.decode("utf-8", "replace")
            # Letters alone become tokens of which only the last one is marked as an end, so they can go as one text.
            as_is = text.isalpha() and text == text.lower() and is_normalized("NFC", text)
            (plain if as_is else other).append((word, text))
        for at in range(0, len(plain), TOGETHER):
            part = plain[at : at + TOGETHER]
            ids = np.array(self.encode_letters([" ".join(t for _, t in part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part):
                other += part
                continue
            raw, start = ids.tobytes(), 0
            for (word, _), end in zip(part, (4 * ends).tolist()):
                self.ids[word] = raw[start:end]
                start = end
        for (word, _), found in zip(other, self.encode([t for _, t in other], add_special_tokens=False)):
            self.ids[word] = array("I", found.ids).tobytes()

    def encoded(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; of an empty or null one, none."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring(texts, "<|")
        # Most words with a sign at their end are known without it.
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), "([a-z0-9])([,.])", r"\1 \2")
        words = pc.ascii_split_whitespace(pc.if_else(whole, "", plain))
        met = words.values.dictionary_encode()
        names = met.dictionary.cast(pa.binary()).to_pylist()
        self.learn(names)
        own = list(map(self.ids.__getitem__, names))
        ids = np.frombuffer(b"".join(own), "<u4")
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        starts = np.cumsum(sizes) - sizes
        index, ends = met.indices.to_numpy(), words.offsets.to_numpy()
        for low, high, special, text in zip(ends[:-1].tolist(), ends[1:].tolist(), whole.to_pylist(), texts):
            if special:
                yield array("I", self.encode([text.as_py()], add_special_tokens=False)[0].ids).tobytes()
                continue
            at = index[low:high]
            n = sizes[at]
            # The places of all ids of the words: each word's start, and so many after it.
            places = np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield ids[places].tobytes()


def joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to at least ``size`` bytes, so that repeated words are looked up once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


@lru_cache(1)
def word_ids(vocabulary: str) -> WordIds:
    """What a worker knows of a vocabulary; its tasks share it."""
    return WordIds(vocabulary_path(vocabulary))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenized(docs: DataFrame, id_column: str, text: str, vocabulary: str, end: int, capacity: int) -> DataFrame:
    """``(doc_id, doc_tokens, pieces, rest, row)``: the CRC-32 of each whole sequence, and the ids beyond them.

    A text's ids are put together from those of its words, most of which were met before.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, width = word_ids(vocabulary), np.array([end], "<u4").tobytes(), 4 * capacity
        for batch in joined(batches, AT_ONCE):
            tokens, pieces, rests = [], [], []
            for ids in known.encoded(batch.column(1)):
                ids += last
                full = len(ids) // width
                tokens.append(len(ids) // 4)
                pieces.append([crc32(ids[k * width : (k + 1) * width]) for k in range(full)])
                rests.append(ids[full * width :])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "doc_tokens": pa.array(tokens, pa.int64()),
                "pieces": pa.array(pieces, pa.list_(pa.int64())), "rest": pa.array(rests, pa.binary()),
            })

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string"))
    return rows.mapInArrow(encode, "doc_id long, doc_tokens long, pieces array<long>, rest binary").withColumn(
        "row", F.monotonically_increasing_id()
    )


def cheapest_pattern(sizes: np.ndarray, prices: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """The exactly full pattern that costs least, as numbers of each size, and its cost; infinite if there is none."""
    cost, choice = np.full(units + 1, np.inf), np.full(units + 1, -1)
    cost[0] = 0.0
    for room in range(1, units + 1):
        fit = np.searchsorted(sizes, room, "right")  # sizes ascend
        if fit:
            options = cost[room - sizes[:fit]] + prices[:fit]
            choice[room] = best = int(np.argmin(options))
            cost[room] = options[best]
    pattern = np.zeros(len(sizes))
    if np.isfinite(cost[units]):
        room = units
        while room:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(cost[units]), pattern


def most_sequences(sizes: np.ndarray, counts: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The linear program: patterns as rows, how often each is used, and a bound on the number of sequences."""
    m = len(sizes)
    basis, columns = np.eye(m), np.zeros((m, m))  # the inverse of the basis, and its columns; all slack at first
    worth, amounts, bound = np.zeros(m), counts.astype(float), float(sizes @ counts) / units
    for _ in range(ROUNDS):
        prices = worth @ basis
        slack = int(np.argmin(prices))
        if prices[slack] < -EPSILON:
            enters, gain = np.eye(m)[slack], 0.0
            column = np.zeros(m)
        else:
            cost, column = cheapest_pattern(sizes, np.maximum(prices, 0.0), units)
            if cost > 0:
                # Prices divided by the least cost of a pattern are feasible for the dual program.
                bound = min(bound, float(np.maximum(prices, 0.0) @ counts) / cost)
            if cost >= 1 - EPSILON or worth @ amounts >= NEAR_BEST * bound:
                break
            enters, gain = column, 1.0
        direction = basis @ enters
        ratios = np.full(m, np.inf)
        np.divide(amounts, direction, out=ratios, where=direction > EPSILON)
        leaves = int(np.argmin(ratios))
        if not np.isfinite(ratios[leaves]):
            break
        step = ratios[leaves]
        amounts = np.maximum(amounts - step * direction, 0.0)
        amounts[leaves], worth[leaves], columns[leaves] = step, gain, column
        basis[leaves] /= direction[leaves]
        others = np.arange(m) != leaves
        basis[others] -= np.outer(direction[others], basis[leaves])
    used = worth > 0
    return columns[used].astype(int), amounts[used], bound


def rounded(patterns: np.ndarray, amounts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whole numbers of uses: each amount rounded down, then as many more as what is left allows."""
    times = np.floor(amounts + EPSILON).astype(int)
    left = counts - times @ patterns if len(patterns) else counts
    for k in np.argsort(times - amounts, kind="stable"):
        needs = patterns[k] > 0
        more = max(0, int((left[needs] // patterns[k][needs]).min()))
        times[k] += more
        left = left - more * patterns[k]
    return times


def plan(histogram: dict[int, int], units: int) -> list[tuple[dict[int, int], int]]:
    """Patterns, as how many of each size, and how often each is used."""
    sizes = np.array(sorted(s for s, n in histogram.items() if 0 < s <= units and n > 0), int)
    if not len(sizes):
        return []
    counts = np.array([histogram[s] for s in sizes.tolist()], np.int64)
    patterns, amounts, _ = most_sequences(sizes, counts, units)
    times = rounded(patterns, amounts, counts)
    return [
        ({int(s): int(n) for s, n in zip(sizes, pattern) if n}, int(t)) for pattern, t in zip(patterns, times) if t > 0
    ]


def places(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(size, low, high, each, sequence)``: ranks of a size that a pattern takes, how many go to each of its sequences."""
    taken, sequence, out = {}, 0, []
    for pattern, times in patterns:
        for size, each in pattern.items():
            low = taken.get(size, 0)
            taken[size] = high = low + each * times
            out.append((size, low, high, each, sequence))
        sequence += times
    return out


def with_sums(df: DataFrame, order: list[Column], what: str, **sums: Column) -> DataFrame:
    """Append the sums over all rows that stand before a row in a total order, without one task seeing all rows."""
    dealt = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), what)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    parts = dealt.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    parts = parts.select("_part", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    own = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.select("*", *[F.coalesce(F.sum(c).over(own), F.lit(0)).alias(n) for n, c in sums.items()])
    out = inside.join(F.broadcast(parts), "_part")
    return out.withColumns({n: (F.col(n) + F.col(f"_{n}")).cast("long") for n in sums}).drop("_part", *[f"_{n}" for n in sums])


def powers_of_two(n: int) -> list[int]:
    """``n`` as a sum of different powers of two, the largest first."""
    return [1 << k for k in reversed(range(n.bit_length())) if n >> k & 1]


def cut_line(line: DataFrame, total: int, first: int, capacity: int) -> DataFrame:
    """Pieces of the rows ``(..., start, length, at)`` of one line, cut at whole sequences and then at powers of two."""
    whole = total // capacity
    edges, last = [whole * capacity], []
    for size in powers_of_two(total - whole * capacity):
        last.append((edges[-1], edges[-1] + size, whole + len(last)))
        edges.append(edges[-1] + size)
    kind = "array<struct<low: bigint, high: bigint, nth: bigint>>"
    ends = f"cast(array({', '.join(f'named_struct("low", {a}L, "high", {b}L, "nth", {n}L)' for a, b, n in last)}) as {kind})"
    cuts = f"""flatten(transform(sequence(at div {capacity}, (at + length - 1) div {capacity}), b -> if(b < {whole},
        array(named_struct('low', b * {capacity}, 'high', (b + 1) * {capacity}, 'nth', b)), {ends})))"""
    low, high = F.greatest("at", "c.low"), F.least(F.col("at") + F.col("length"), F.col("c.high"))
    return (
        line.withColumn("c", F.explode(F.expr(cuts))).filter(low < high)
        .withColumn("start", F.col("start") + low - F.col("at"))
        .withColumn("length", high - low)
        .withColumn("sequence_id", F.col("c.nth") + first)
        .withColumn("offset", low - F.col("c.low")).drop("c", "at")
    )


def packed(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end: int = END,
    capacity: int = CAPACITY, unit: int = UNIT,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of every piece."""
    spark = docs.sparkSession
    tokens = stored(tokenized(docs, id_column, text, vocabulary, end, capacity), "tokens")
    full = F.size("pieces").cast("long")
    short = tokens.select(
        "row", "doc_id", "doc_tokens", "pieces", full.alias("full"), (F.col("doc_tokens") - full * capacity).alias("length"),
        F.crc32("rest").alias("crc"),
    ).withColumn("size", F.expr(f"cast(length div {unit} as int)"))
    ranked = with_sums(short, [F.col("size"), F.xxhash64("row"), F.col("row")], "ranked", nth=F.lit(1), before=F.col("full"))
    # At most one number for each size.
    histogram = {r["size"]: r["count"] for r in tokens.select(
        F.expr(f"cast((doc_tokens % {capacity}) div {unit} as int)").alias("size")
    ).groupBy("size").count().collect()}
    patterns = plan(histogram, capacity // unit)
    sequences = sum(times for _, times in patterns)
    starts, so_far = [], 0
    for size in range(capacity // unit):
        starts.append(so_far)
        so_far += histogram.get(size, 0)
    rank = F.col("nth") - F.get(F.lit(starts).cast("array<long>"), F.col("size"))
    # A basis has no more patterns than there are sizes.
    ranges = spark.createDataFrame(places(patterns), "of int, low long, high long, each long, base long")
    found = (F.col("size") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    seats = stored(
        ranked.filter("length > 0").withColumn("rank", rank).join(F.broadcast(ranges), found, "left").select(
            "row", "doc_id", "doc_tokens", (F.col("full") * capacity).alias("start"), "length", "crc",
            F.expr("base + (rank - low) div each").alias("sequence_id"),
        ),
        "seats",
    )
    before = Window.partitionBy("sequence_id").orderBy("length", "row").rowsBetween(Window.unboundedPreceding, -1)
    seated = seats.filter("sequence_id is not null").withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    stay = F.greatest(F.lit(0), F.least(F.col("length"), F.lit(capacity) - F.col("offset")))
    seated = seated.withColumn("stay", stay)
    inside = seated.filter("stay > 0").withColumn("crc", F.when(F.col("stay") == F.col("length"), F.col("crc"))).select(
        "row", "doc_id", "doc_tokens", "start", F.col("stay").alias("length"), "crc", "sequence_id", "offset"
    )
    over = seated.filter("stay < length").select(
        "row", "doc_id", "doc_tokens", (F.col("start") + F.col("stay")).alias("start"), (F.col("length") - F.col("stay")).alias("length"),
        F.when(F.col("stay") == 0, F.col("crc")).alias("crc"),
    )
    rest = over.unionByName(seats.filter("sequence_id is null").drop("sequence_id", "offset"))
    line = with_sums(rest, [F.xxhash64("row"), F.col("row")], "line", at=F.col("length"))
    sums = ranked.agg(F.sum("full").alias("full")).first()["full"] or 0
    total = line.agg(F.sum("length")).first()[0] or 0
    whole_length = line.withColumn("was", F.col("length"))
    cut = cut_line(whole_length, total, sequences + sums, capacity)
    cut = cut.withColumn("crc", F.when(F.col("length") == F.col("was"), F.col("crc"))).drop("was")
    pieces = stored(inside.unionByName(cut), "pieces")
    done = pieces.filter("crc is not null").withColumnRenamed("crc", "ids_crc32")
    at = F.col("start") - F.expr(f"(doc_tokens div {capacity}) * {capacity}")
    own = F.substring("rest", (4 * at + 1).cast("int"), (4 * F.col("length")).cast("int"))
    open_ = pieces.filter("crc is null").drop("crc").join(tokens.select("row", "rest"), "row").withColumn("ids_crc32", F.crc32(own))
    long_ones = ranked.filter("full > 0").select("doc_id", "doc_tokens", "before", F.posexplode("pieces").alias("k", "ids_crc32")).select(
        "doc_id", (F.col("k").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"), "ids_crc32",
        "doc_tokens", (F.col("before") + F.col("k") + sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return done.select(*columns).unionByName(open_.select(*columns)).unionByName(long_ones.select(*columns))


def op11_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"))
