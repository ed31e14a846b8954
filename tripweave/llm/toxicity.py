"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence is toxic with probability ``sigmoid(b + sum of its words' weights)``;
the document is toxic if any sentence is: ``1 - prod(1 - p)`` (noisy-or). Weights are fitted from document labels
alone, and the fitted sentence probabilities locate the offending sentences.

A word's weight is the sum over its features: the lower-cased word and its prefixes of 3 to 6 letters. A sentence
counts each of its words once. Features are those that differ most between the classes by document counts.

Nulls and empty texts have no sentence, hence score 0. Texts of any length are judged whole, sentence by sentence.
Repeated rows get equal scores. Without labels of both classes every score is 0; an empty table gives no rows. Extra columns pass through; those named like an output are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import is_fold, labelled_sample, stored, table, without

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5, 6)
PER_CLASS = 4_000  # labelled documents of each class to fit on
FEATURES = 5_000  # features kept, by chi-square
LEAST_DOCS = 3
LEAST_CHI = 10.83  # one in a thousand under equal shares
OUTPUT = "struct<score:double, spans:array<struct<start:int, end:int, p:double>>>"
_ARROW = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))])


def features_of(word: str) -> set[str]:
    return {word, *(word[:k] + "~" for k in PREFIXES if len(word) >= k)}


@dataclass
class NoisyOrModel:
    """Feature weights and the bias of a sentence."""

    bias: float = -30.0
    weights: dict[str, float] = field(default_factory=dict)


def words_of(sentence: str) -> list[str]:
    """The different words of a sentence, in order."""
    return list(dict.fromkeys(WORD.findall(sentence.lower())))


class _WordWeights(dict):
    """Weight of a word, remembered for a bounded number of words."""

    LIMIT = 300_000

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        get = self.weights.get
        self[word] = value = sum(get(f, 0.0) for f in features_of(word))
        return value


def _softplus(z: float) -> float:
    return float(np.logaddexp(0.0, z))


def score_text(text: str | None, model: NoisyOrModel, words: _WordWeights, report: float = 0.5) -> dict:
    """Score of one document and the spans, in characters, of sentences at or above ``report``."""
    plain, rest, total, found = 0, [], 0.0, []
    weight = words.__getitem__
    for m in SENTENCE.finditer(text or ""):
        z = sum(map(weight, words_of(m.group())))
        if z == 0.0:
            plain += 1
        else:
            rest.append((z + model.bias, m.start(), m.end()))
    total = plain * _softplus(model.bias)
    for z, start, end in rest:
        total += _softplus(z)
        p = 1.0 / (1.0 + np.exp(-z)) if z > -500 else 0.0
        if p >= report:
            found.append({"start": start, "end": end, "p": float(p)})
    return {"score": float(-np.expm1(-total)), "spans": found}


def feature_counts(sample: DataFrame) -> DataFrame:
    """``(feature, toxic, clean)``: documents of each class holding the feature; summed per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}

        def drain():
            names = list(seen)
            out = pa.RecordBatch.from_pydict({
                "feature": pa.array(names, pa.string()),
                "clean": pa.array([seen[n][0] for n in names], pa.int64()),
                "toxic": pa.array([seen[n][1] for n in names], pa.int64()),
            })
            seen.clear()
            return out

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for f in set().union(*map(features_of, set(WORD.findall(text.lower())))):
                    seen.setdefault(f, [0, 0])[y] += 1
            if len(seen) > 500_000:
                yield drain()
        yield drain()

    return (
        sample.select("text", "y").mapInArrow(count, "feature string, clean long, toxic long")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def select_features(counts: DataFrame, n_toxic: int, n_clean: int, most: int = FEATURES) -> list[str]:
    """The features whose document counts differ most between the classes, by chi-square; at most ``most``."""
    a, b = F.col("toxic"), F.col("clean")
    n = float(n_toxic + n_clean)
    gap = a * F.lit(float(n_clean)) - b * F.lit(float(n_toxic))
    held = (a + b).cast("double")
    chi = gap * gap * n / (held * (F.lit(n) - held + 0.5) * float(n_toxic) * float(n_clean))
    best = (
        counts.filter(held >= LEAST_DOCS).withColumn("chi", chi).filter(F.col("chi") > LEAST_CHI)
        .orderBy(F.desc("chi"), "feature").limit(most)
    )
    return [r["feature"] for r in best.select("feature").collect()]


def bags(sample: DataFrame, names: list[str]) -> pa.Table:
    """Per sampled document: its class, how many sentences hold no chosen feature, and the features of the others."""
    index = sample.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            plain, kept = [], []
            for text in batch.column(0).to_pylist():
                sentences = [
                    [known[f] for w in words_of(m.group()) for f in features_of(w) if f in known]
                    for m in SENTENCE.finditer(text)
                ]
                kept.append([s for s in sentences if s])
                plain.append(len(sentences) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(plain, pa.int64()), pa.array(kept, pa.list_(pa.list_(pa.int32())))],
                names=["y", "plain", "kept"],
            )

    return sample.select("text", "y").mapInArrow(read, "y int, plain long, kept array<array<int>>").toArrow()


def fit_weights(rows: pa.Table, names: list[str], steps: int = 200, rate: float = 0.2, l2: float = 1e-4) -> NoisyOrModel:
    """Maximum likelihood of the noisy-or under an L2 penalty, by Adam over all sampled bags."""
    y = rows["y"].to_numpy().astype(float)
    plain = rows["plain"].to_numpy().astype(float)
    kept = pa.concat_arrays(rows["kept"].chunks)
    sentences = kept.flatten()
    doc = np.repeat(np.arange(len(y)), pc.list_value_length(kept).to_numpy(zero_copy_only=False))
    s = len(sentences)
    sent = np.repeat(np.arange(s), pc.list_value_length(sentences).to_numpy(zero_copy_only=False))
    feat = sentences.flatten().to_numpy(zero_copy_only=False)
    theta = np.zeros(len(names) + 1)
    theta[-1] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    # Both classes weigh alike in the gradient of the weights; this keeps rare toxic bags from being ignored.
    share = np.where(y == 1, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    for t in range(1, steps + 1):
        z = np.bincount(sent, theta[feat], minlength=s) + theta[-1]
        soft, sig = np.logaddexp(0, z), 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        soft0, sig0 = np.logaddexp(0, theta[-1]), 1 / (1 + np.exp(-theta[-1]))
        total = np.bincount(doc, soft, minlength=len(y)) + plain * soft0
        # d loss / d total: 1 for clean bags, -1 / (e^total - 1) for toxic ones.
        slope = share * np.where(y == 1, -1 / np.expm1(np.clip(total, 1e-6, 60)), 1.0)
        per = slope[doc] * sig
        grad = np.zeros_like(theta)
        grad[:-1] = np.bincount(feat, per[sent], minlength=len(names)) + l2 * theta[:-1]
        grad[-1] = per.sum() + (slope * plain).sum() * sig0
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return NoisyOrModel(float(theta[-1]), {f: float(w) for f, w in zip(names, theta) if abs(w) > 1e-3})


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, per_class: int = PER_CLASS) -> NoisyOrModel:
    """Learn from at most ``per_class`` labelled documents of each class outside the held-out fold."""
    sample = stored(labelled_sample(docs, labels, "toxic", per_class, folds, held_out), "toxicity-sample")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return NoisyOrModel()
    names = select_features(feature_counts(sample), sizes[1], sizes[0])
    return fit_weights(bags(sample, names), names) if names else NoisyOrModel()


def score(docs: DataFrame, model: NoisyOrModel, text: str = "text") -> DataFrame:
    """Append ``score`` (0 to 1) and ``spans`` (offending sentences: start, end, probability)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(OUTPUT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        words = _WordWeights(fitted.weights)
        for texts in batches:
            yield pa.array([score_text(x, fitted, words) for x in texts.to_pylist()], _ARROW)

    return without(docs, "score", "spans").withColumn("_judged", judge(F.col(text))).select(
        *[c for c in docs.columns if c.lower() not in ("score", "spans")],
        F.col("_judged.score").alias("score"), F.col("_judged.spans").alias("spans"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Documents scored below ``threshold``, with their own columns."""
    return score(docs.select("*"), fit(docs, labels)).filter(F.col("score") < threshold).select(*docs.columns)


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    judged = score(docs.select("doc_id", "text"), model)
    return judged.select(
        "doc_id", is_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "spans",
    )
