"""Language ID by prediction by partial matching.

Each language has a variable-order tree of byte contexts (up to four bytes). The code length of a byte is
``-log2(c / (n + t))`` in the longest context that has seen it, plus ``-log2(t / (n + t))`` for every longer
context escaped from (n: bytes seen in the context, t: different ones), down to a uniform byte. Statistics are
frozen after fitting, so the code length of a byte depends on five bytes only: the trees are compiled to one hash
table per order that holds the length under every language, and a text costs one gather a byte.

Texts that are null or hold no letter (``str.isalpha``) are ``und`` with score 0. With no labelled text, so in an empty
table too, every document is ``und``. Ties go to the language first in code point order. Repeated rows get equal
results. A long text is coded in segments, so memory does not follow its length. Columns of other names stay; columns
named like the results give way to them. Of more than ``LANGUAGES`` values of ``lang`` those with most documents are
learned, so that a column of dirty values costs bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import give_back, is_fold, stored, table, without

ORDER = 4
PER_LANGUAGE = 1_500  # labelled documents of each language to fit on
LANGUAGES = 200  # that are learned at most
SEGMENT = 1 << 19  # bytes coded at a time, so that memory does not follow the length of a text
OUTPUT = "struct<lang_pred:string, score:double, bits:double>"
_ARROW = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("bits", pa.float64())])
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def encode(text: str) -> bytes:
    """The bytes that are modelled: lower-cased, after as many zeros as the longest context."""
    return b"\0" * ORDER + text.lower().encode("utf-8", "surrogatepass")


def grams(data: np.ndarray) -> np.ndarray:
    """Each byte after the first ``ORDER`` with its context, as one number; the byte itself is lowest."""
    g = np.zeros(len(data) - ORDER, np.uint64)
    for k in range(ORDER, -1, -1):
        g = (g << np.uint64(8)) | data[ORDER - k : len(data) - k].astype(np.uint64)
    return g


class HashTable:
    """Rows of floats by 64-bit key, open addressing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.keys = np.full(1 << self.bits, _FREE)
        self.rows = np.zeros(1 << self.bits, np.int32)
        self.values = values.astype(np.float32)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            open_ = np.flatnonzero(self.keys[at] == _FREE)
            slots, first = np.unique(at[open_], return_index=True)
            took = open_[first]
            self.keys[slots], self.rows[slots] = keys[left[took]], left[took]
            rest = np.ones(len(left), bool)
            rest[took] = False
            left, at = left[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where there is none."""
        out = np.full(len(keys), -1, np.int32)
        at, left = self._home(keys), None
        while True:
            held, wanted = self.keys[at], keys if left is None else keys[left]
            hit = held == wanted
            if left is None:
                out[hit] = self.rows[at[hit]]
            else:
                out[left[hit]] = self.rows[at[hit]]
            on = np.flatnonzero(~hit & (held != _FREE))
            if not len(on):
                return out
            left = on if left is None else left[on]
            at = (at[on] + 1) & ((1 << self.bits) - 1)


@dataclass
class ContextTrees:
    """Languages in code point order; per order k, code lengths by (context of k bytes, byte) and escapes by context."""

    languages: list[str]
    lengths: list[HashTable]
    escapes: list[HashTable]

    def cost(self, g: np.ndarray) -> np.ndarray:
        """Bits of each byte under each language."""
        out = np.zeros((len(g), len(self.languages)), np.float32)
        left = np.arange(len(g))
        for k in range(ORDER, -1, -1):
            own = g[left] & np.uint64((1 << 8 * (k + 1)) - 1)
            row = self.lengths[k].find(own)
            hit = row >= 0
            out[left[hit]] += self.lengths[k].values[row[hit]]
            left, own = left[~hit], own[~hit]
            if not len(left):
                return out
            row = self.escapes[k].find(own >> np.uint64(8))
            seen = row >= 0
            out[left[seen]] += self.escapes[k].values[row[seen]]
        out[left] += 8.0
        return out


def gram_counts(sample: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over the sample, counted per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    parts.setdefault(lang, []).append(grams(np.frombuffer(encode(text), np.uint8)))
            for lang, found in parts.items():
                g, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(g), pa.string()), "gram": pa.array(g.astype(np.int64)), "n": pa.array(n),
                })

    return (
        sample.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


def compile_trees(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> ContextTrees:
    """Trees from each language's counts of five-byte strings; counts of shorter contexts are their sums."""
    languages = sorted(counts)
    size = len(languages)
    seen = []  # per order, per language: keys, counts, context keys, bytes seen in them, different bytes
    for k in range(ORDER + 1):
        per = []
        for lang in languages:
            g, n = counts[lang]
            own = g & np.uint64((1 << 8 * (k + 1)) - 1)
            keys, where = np.unique(own, return_inverse=True)
            c = np.bincount(where, n, minlength=len(keys))
            ctx, where = np.unique(keys >> np.uint64(8), return_inverse=True)
            per.append((keys, c, ctx, np.bincount(where, c), np.bincount(where)))
        seen.append(per)
    lengths, escapes = [], []
    for k in range(ORDER + 1):
        contexts = np.unique(np.concatenate([p[2] for p in seen[k]]))
        escape = np.zeros((len(contexts), size))
        for j, (_, _, ctx, n, t) in enumerate(seen[k]):
            escape[np.searchsorted(contexts, ctx), j] = np.log2((n + t) / t)
        escapes.append(HashTable(contexts, escape))
        keys = np.unique(np.concatenate([p[0] for p in seen[k]]))
        # Not seen in this language: escape from the context, then what the next shorter context gives.
        if k:
            shorter = keys & np.uint64((1 << 8 * k) - 1)
            known = lengths[k - 1].find(shorter)
            value = lengths[k - 1].values[known].astype(float)
        else:
            value = np.full((len(keys), size), 8.0)
        value = value + escape[np.searchsorted(contexts, keys >> np.uint64(8))]
        for j, (own, c, ctx, n, t) in enumerate(seen[k]):
            at = np.searchsorted(ctx, own >> np.uint64(8))
            value[np.searchsorted(keys, own), j] = np.log2((n + t)[at] / c)
        lengths.append(HashTable(keys, value))
    return ContextTrees(languages, lengths, escapes)


def fit(docs: DataFrame, folds: int = 3, held_out: int = 1, per_language: int = PER_LANGUAGE) -> ContextTrees | None:
    """Trees from at most ``per_language`` whole documents of each language outside the held-out fold.

    The ids with the smallest hashes are taken, so reruns agree; they and a count of each language are broadcast, which
    ``LANGUAGES`` bounds. Hashes are even, so a cut at twice the wanted share, before any shuffle, leaves few rows to
    rank, however many a language has.
    """
    from pyspark.sql import Window

    usable = docs.select(F.col("doc_id").alias("_id"), "lang", "text").filter(
        F.col("_id").isNotNull() & F.col("lang").isNotNull() & ~is_fold(F.col("_id"), folds, held_out) & (F.length("text") > 0)
    )
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)), "_id"))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    low = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) * F.col("n") < 2.0 * per_language * (1 << 30)
    few = usable.select("_id", "lang").join(F.broadcast(sizes), "lang").filter(low).select("_id", "lang").distinct()
    picked = few.withColumn("nth", nth).filter(F.col("nth") <= per_language).select("_id", "lang")
    sample = stored(usable.select("_id", "lang", "text").join(F.broadcast(picked), ["_id", "lang"]).select("lang", "text"), "language-sample")
    found = gram_counts(sample).toArrow()
    if not found.num_rows:
        return None
    lang = np.array(found["lang"].to_pylist())
    gram, n = found["gram"].to_numpy().astype(np.uint64), found["n"].to_numpy()
    trees = compile_trees({x: (gram[lang == x], n[lang == x]) for x in sorted(set(lang))})
    del found, lang, gram, n
    give_back()
    return trees


def classify(texts: list[str | None], trees: ContextTrees) -> list[dict]:
    """Best language of each text, its posterior under equal priors, and its bits a byte."""
    out: list[dict] = [{"lang_pred": "und", "score": 0.0, "bits": 0.0} for _ in texts]
    judged = [i for i, x in enumerate(texts) if has_letter(x)]
    totals = np.zeros((len(texts), len(trees.languages)))
    sizes = np.zeros(len(texts), np.int64)
    room: list[tuple[int, np.ndarray]] = []

    def flush():
        if room:
            cost = trees.cost(np.concatenate([g for _, g in room]))
            at = np.cumsum([0, *(len(g) for _, g in room)])[:-1]
            np.add.at(totals, [i for i, _ in room], np.add.reduceat(cost, at, axis=0, dtype=np.float64))
            room.clear()

    held = 0
    for i in judged:
        data = np.frombuffer(encode(texts[i]), np.uint8)
        sizes[i] = len(data) - ORDER
        for start in range(0, int(sizes[i]), SEGMENT):
            room.append((i, grams(data[start : start + SEGMENT + ORDER])))
            held += len(room[-1][1])
            if held >= SEGMENT:
                flush()
                held = 0
    flush()
    for i in judged:
        best = int(np.argmin(totals[i]))
        score = 1.0 / np.exp2(np.clip(totals[i][best] - totals[i], -1000, 0)).sum()
        out[i] = {"lang_pred": trees.languages[best], "score": float(score), "bits": float(totals[i][best] / sizes[i])}
    return out


def predict(docs: DataFrame, trees: ContextTrees | None, text: str = "text") -> DataFrame:
    """Append ``lang_pred``, ``score`` and ``bits`` (code length a byte under that language)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf(OUTPUT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for texts in batches:
            x = texts.to_pylist()
            none = [{"lang_pred": "und", "score": 0.0, "bits": 0.0}] * len(x)
            yield pa.array(classify(x, fitted) if fitted else none, _ARROW)

    new = ("lang_pred", "score", "bits")
    judged = without(docs, *new).withColumn("_judged", judge(F.col(text)))
    return judged.select(*[c for c in docs.columns if c.lower() not in new], *[F.col(f"_judged.{n}").alias(n) for n in new])


def keep_known(docs: DataFrame) -> DataFrame:
    """Documents that hold a letter, so that they have a language, with their own columns.

    However unsure the language of a short text is, it is no reason to drop it, and neither is a lack of labels.
    """

    @F.arrow_udf("boolean")
    def letters(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([has_letter(x) for x in texts.to_pylist()], pa.bool_())

    trees = fit(docs)
    if trees is None:
        return docs.withColumn("_letter", letters("text")).filter("_letter").select(*docs.columns)
    return predict(docs.select("*"), trees).filter(F.col("lang_pred") != "und").select(*docs.columns)


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    judged = predict(docs.select("doc_id", "text"), fit(docs))
    return judged.select("doc_id", is_fold(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score", "bits")
