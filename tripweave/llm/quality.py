"""Quality classifier: a sparse ensemble of rules over text statistics.

Small regression trees are boosted on labelled documents, a sample of bounded size in which each row weighs as many labels
as it stands for, so that the shares of the classes don't depend on the size of the table; every path from a root to a node becomes a conjunctive rule
(``statistic <= cut and ...``). A logistic model with an L1 penalty picks few rules and weighs them. The result is
compiled to a Spark column expression over the statistics, so scoring is one generated expression per row.

Statistics cover the whole text; they are gathered in one pass over its bytes and words. A null or empty text has all
statistics 0 and is scored like any other. Without labels of both classes the score is the share of label 1 (0.5
without labels). Repeated rows get equal scores. Extra columns pass through; those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import is_fold, class_weights, labelled_sample, stored, table, without

STATISTICS = (
    "chars", "words", "letters", "capitals", "digits", "spaces", "stops", "commas", "marks", "brackets", "newlines",
    "word_length", "longest_word", "distinct_words", "repeats", "wordless", "distinct_lines", "line_length",
)
PER_CLASS = 10_000  # labelled documents of each class to fit on
TREES, DEPTH, BINS = 24, 3, 16
_STRUCT = "struct<" + ", ".join(f"{n}:double" for n in STATISTICS) + ">"


def _byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack([
    _byte_class(bytes(range(0x80)) + bytes(range(0xC0, 0x100))),  # first bytes of characters
    _byte_class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC3, 0xF5))),  # letters, about
    _byte_class(bytes(range(65, 91))),
    _byte_class(bytes(range(97, 123))),
    _byte_class(b"0123456789"),
    _byte_class(b" \t\r\x0b\x0c"),
    _byte_class(b".?"),
    _byte_class(b",;:"),
    _byte_class(b"!#$%&*@^~+=/\\_|"),
    _byte_class(b"<>{}[]()"),
    _byte_class(b"\n"),
])


def statistics_of(text: str | None) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``; shares are between 0 and 1."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = text.encode("utf-8", "surrogatepass")
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars, letters, upper, lower, digits, spaces, stops, commas, marks, brackets, newlines = (_CLASSES @ hist).tolist()
    words = raw.split()
    n, lines = max(1, len(words)), raw.split(b"\n")
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return [
        float(chars), float(len(words)), letters / chars, upper / max(1, upper + lower), digits / chars, spaces / chars,
        stops / n, commas / n, marks / n, brackets / n, newlines / n,
        float(lengths.mean()) if len(words) else 0.0, float(lengths.max(initial=0)), len(set(words)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n, sum(1 for w in words if len(w) < 4 and not w.isalnum() and w.isascii()) / n,
        len(set(lines)) / len(lines), len(words) / len(lines),
    ]


def with_statistics(df: DataFrame, text: str = "text", name: str = "stats") -> DataFrame:
    """Append a struct of the statistics of ``text``."""
    kinds = pa.struct([(n, pa.float64()) for n in STATISTICS])

    @F.arrow_udf(_STRUCT)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = np.array([statistics_of(x) for x in texts.to_pylist()], float).reshape(-1, len(STATISTICS))
            yield pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], fields=list(kinds))

    return without(df, name).withColumn(name, measure(F.col(text)))


@dataclass(frozen=True)
class Condition:
    """``statistic <= cut``, or ``> cut`` if ``above``."""

    statistic: str
    cut: float
    above: bool

    def column(self, stats: str) -> Column:
        x = F.col(f"{stats}.{self.statistic}")
        return x > F.lit(self.cut) if self.above else x <= F.lit(self.cut)


Rule = frozenset[Condition]


@dataclass
class RuleEnsemble:
    """An intercept and weighted rules; the score is the logistic of their sum."""

    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self, stats: str = "stats") -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for c in sorted(rule, key=lambda c: (c.statistic, c.cut, c.above)):
                holds = holds & c.column(stats)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _grow(x: np.ndarray, bins: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, features: np.ndarray,
          depth: int, path: tuple, out: list, step: np.ndarray, least: int) -> None:
    """One tree on gradients; appends the path of each node to ``out`` and the leaf values to ``step``."""
    if path:
        out.append(frozenset(path))
    best = (1e-6, None, None, None)
    g, h = grad[rows].sum(), hess[rows].sum()
    if depth and len(rows) >= 2 * least:
        for j in features:
            at = np.searchsorted(bins[j], x[rows, j], side="left")
            size = len(bins[j]) + 1
            gs, hs, ns = (np.cumsum(np.bincount(at, w, minlength=size))[:-1] for w in (grad[rows], hess[rows], np.ones(len(rows))))
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < least) | (len(rows) - ns < least)] = 0
            if len(gain) and gain.max() > best[0]:
                k = int(gain.argmax())
                best = (gain[k], j, float(bins[j][k]), x[rows, j] <= bins[j][k])
    if best[1] is None:
        step[rows] = -g / (h + 1)
        return
    _, j, cut, low = best
    for above, side in ((False, rows[low]), (True, rows[~low])):
        _grow(x, bins, grad, hess, side, features, depth - 1, (*path, Condition(STATISTICS[j], cut, above)), out, step, least)


def _quantiles(x: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    if weight.min() == weight.max():
        return np.quantile(x, at)
    return np.quantile(x, at, weights=weight, method="inverted_cdf")


def grow_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, seed: int = 7) -> list[Rule]:
    """Paths of boosted trees, each grown on half of the rows and of the statistics; ``weight`` is 1 on average."""
    weight = np.ones(len(y)) if weight is None else weight
    rng = np.random.default_rng(seed)
    bins = [np.unique(_quantiles(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], weight)) for j in range(x.shape[1])]
    logit, found = np.zeros(len(y)), []
    least = max(3, len(y) // 400)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        rows = np.sort(rng.permutation(len(y))[: max(1, len(y) // 2)])
        features = np.sort(rng.permutation(x.shape[1])[: (x.shape[1] + 1) // 2])
        step = np.zeros(len(y))
        paths: list[Rule] = []
        _grow(x, bins, weight * (p - y), weight * p * (1 - p), rows, features, DEPTH, (), paths, step, least)
        found += paths
        logit += 0.3 * step
    return sorted(set(found), key=lambda r: (len(r), sorted((c.statistic, c.cut, c.above) for c in r)))


def rule_matrix(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    at = {n: j for j, n in enumerate(STATISTICS)}
    out = np.ones((len(x), len(rules)), np.float32)
    for k, rule in enumerate(rules):
        for c in rule:
            v = x[:, at[c.statistic]]
            out[:, k] *= (v > c.cut) if c.above else (v <= c.cut)
    return out


def lasso_logistic(
    a: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 2e-3, steps: int = 400
) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient for the weighted mean of the logistic loss plus ``penalty`` times the L1 norm."""
    n, d = a.shape
    weight = np.ones(n) if weight is None else weight
    heavy = weight.astype(np.float32)
    v = np.ones(d, np.float32)
    for _ in range(20):  # largest eigenvalue of a'a, weighted
        v = a.T @ (heavy * (a @ v))
        v /= np.linalg.norm(v) + 1e-12
    rate = 1.0 / (0.25 * float((a @ v) @ (heavy * (a @ v))) / n + 0.25 + 1e-9)
    share = np.clip((weight * y).mean(), 1e-3, 1 - 1e-3)
    w, b = np.zeros(d), float(np.log(share / (1 - share)))
    zw, zb, t = w.copy(), b, 1.0
    for _ in range(steps):
        r = weight * (1 / (1 + np.exp(-(a @ zw + zb))) - y)
        new = zw - rate * (a.T @ r) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b, nt = zb - rate * r.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        zw, zb = new + (t - 1) / nt * (new - w), new_b + (t - 1) / nt * (new_b - b)
        w, b, t = new, float(new_b), nt
    return b, w


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, per_class: int = PER_CLASS) -> RuleEnsemble:
    """Learn from at most ``per_class`` labelled documents of each class outside the held-out fold, weighted by class."""
    sample = stored(
        with_statistics(labelled_sample(docs, labels, "quality", per_class, folds, held_out)).select("stats.*", "y"),
        "quality-sample",
    ).orderBy("y", *STATISTICS).toArrow()
    y = sample["y"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        return RuleEnsemble(float(np.log(share / (1 - share))))
    stands_for = class_weights(labels, "quality", per_class, folds, held_out)
    weight = np.where(y == 1, stands_for[1], stands_for[0])
    weight /= weight.mean()
    x = np.column_stack([sample[n].to_numpy() for n in STATISTICS])
    rules = grow_rules(x, y, weight)
    if not rules:
        share = float((weight * y).mean())
        return RuleEnsemble(float(np.log(share / (1 - share))))
    b, w = lasso_logistic(rule_matrix(x, rules), y, weight)
    return RuleEnsemble(b, [(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6])


def score(docs: DataFrame, model: RuleEnsemble, text: str = "text") -> DataFrame:
    """Append ``stats`` and ``score`` (0 to 1)."""
    return with_statistics(without(docs, "score"), text).withColumn("score", model.column())


def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", is_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )
