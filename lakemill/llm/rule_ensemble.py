"""Quality classifier as a sparse ensemble of rules.

Small boosted trees are grown on text statistics; every path from a root becomes a conjunctive rule; a logistic
regression with a lasso penalty weighs the rules, most of them with 0; what is left is compiled into one Spark
column expression. Only the fit runs on the driver, on about ``SAMPLE`` labelled rows at most (by hash of the id);
every document is scored by Spark.

Defined cases: null and empty texts have all statistics 0 and are scored like any other; a document labelled twice
counts with its lowest label; missing ids and labels are not learned from; without both labels the score is the
share of label 1 (0.5 without any). Repeated rows are scored alike, and a labelled one counts as often as it stands there; very long texts are
counted whole; equally good splits go to the first statistic and least cutoff. Results stand behind a prefix that no column has.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lakemill.llm.frames import doc_fold, free_prefix
from lakemill.llm.text_stats import with_counts

SAMPLE = 20_000
FOLDS, HELD_OUT = 4, 2
TREES, DEPTH, CUTS, LEAST_LEAF = 40, 3, 24, 15
PENALTY, STEPS = 0.002, 600
CUTOFF = 0.7

Condition = tuple[int, bool, float]  # statistic, above, threshold


@dataclass(frozen=True)
class RuleModel:
    features: tuple[str, ...]
    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self, feature: dict[str, Column]) -> Column:
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for i, above, threshold in conditions:
                value = feature[self.features[i]]
                holds = holds & ((value > threshold) if above else (value <= threshold))
            total = total + F.when(holds, weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def statistics(prefix: str) -> dict[str, Column]:
    """What the rules may look at: counts of the text alone, as shares."""
    n = lambda c: F.col(f"`{prefix}{c}`").cast("double")
    words, chars, lines = (F.greatest(n(c), F.lit(1.0)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "words": n("n_words"), "chars_per_word": n("word_chars") / words, "symbols_per_word": n("n_symbols") / words,
        "repeat_share": n("n_repeat_words") / words, "dup_line_share": n("n_dup_lines") / lines,
        "distinct_share": n("n_distinct") / words, "upper_share": n("n_upper") / chars, "digit_share": n("n_digits") / chars,
        "marks_per_word": n("n_marks") / words, "words_per_line": n("n_words") / lines,
        "short_line_share": n("n_short_lines") / lines, "longest_word": n("max_word"),
    }


def _tree(x: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray, depth: int, path: tuple, paths: list) -> list:
    """Grow a regression tree; returns (rows, value) leaves and collects the path of every node in ``paths``."""
    g, h = gradient[rows].sum(), hessian[rows].sum()
    best = None
    if depth and len(rows) >= 2 * LEAST_LEAF:
        for f in range(x.shape[1]):
            column = x[rows, f]
            for t in cuts[f]:
                low = column <= t
                n = int(low.sum())
                if LEAST_LEAF <= n <= len(rows) - LEAST_LEAF:
                    gl, hl = gradient[rows[low]].sum(), hessian[rows[low]].sum()
                    gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, f, float(t), low)
    if best is None or best[0] < 1e-3:
        return [(rows, -g / (h + 1))]
    _, f, t, low = best
    leaves = []
    for side, above in ((rows[low], False), (rows[~low], True)):
        longer = (*path, (f, above, t))
        paths.append(longer)
        leaves += _tree(x, cuts, gradient, hessian, side, depth - 1, longer, paths)
    return leaves


def tree_rules(x: np.ndarray, y: np.ndarray, seed: int = 11) -> list[tuple[Condition, ...]]:
    """The distinct paths of boosted trees, each tree grown on half of the rows."""
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, CUTS))) for f in range(x.shape[1])]
    margin, paths = np.zeros(len(y)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        rows = np.sort(random.choice(len(y), max(1, len(y) // 2), replace=False))
        found: list = []
        leaves = _tree(x, cuts, p - y, p * (1 - p), rows, DEPTH, (), found)
        paths += found
        step = np.zeros(len(y))
        for conditions, value in _leaf_paths(found, leaves):
            step[_holds(x, conditions)] = value
        margin += 0.3 * step
    return list(dict.fromkeys(paths))


def _holds(x: np.ndarray, conditions: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, t in conditions:
        out &= (x[:, f] > t) if above else (x[:, f] <= t)
    return out


def _leaf_paths(paths: list, leaves: list) -> list:
    """Each leaf's value with the path that leads to it: both come in the order in which the tree grew."""
    ends = [p for p in paths if not any(len(q) > len(p) and q[:len(p)] == p for q in paths)]
    return [(p, value) for p, (_, value) in zip(ends, leaves)]


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic regression, by accelerated proximal steps."""
    n, k = z.shape
    scale = np.sqrt(np.maximum(z.mean(0) * (1 - z.mean(0)), 1e-3))
    a = np.hstack([np.ones((n, 1)), (z - z.mean(0)) / scale])
    w = v = np.zeros(k + 1)
    q = np.random.default_rng(0).standard_normal(k + 1)
    for _ in range(20):
        q = a.T @ (a @ q)
        q /= np.linalg.norm(q)
    rate = 1 / (0.25 * float(q @ (a.T @ (a @ q))) / n * 1.05 + 1e-9)
    t = 1.0
    for _ in range(steps):
        grad = a.T @ (1 / (1 + np.exp(-(a @ v))) - y) / n
        u = v - rate * grad
        u[1:] = np.sign(u[1:]) * np.maximum(np.abs(u[1:]) - rate * penalty, 0)
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        v, w = u + (last - 1) / t * (u - w), u
    weights = w[1:] / scale
    return float(w[0] - weights @ z.mean(0)), weights


def fit(x: np.ndarray, y: np.ndarray, features: tuple[str, ...]) -> RuleModel:
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return RuleModel(features, float(np.log(share / (1 - share))), ())
    rules = tree_rules(x, y)
    if not rules:
        return RuleModel(features, float(np.log(share / (1 - share))), ())
    z = np.stack([_holds(x, r) for r in rules], axis=1).astype(float)
    intercept, weights = lasso_logistic(z, y)
    return RuleModel(features, intercept, tuple((r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6))


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> RuleModel:
    """Fit on labelled documents outside the held-out fold."""
    judged = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (doc_fold("doc_id", FOLDS) != HELD_OUT))
    judged = judged.groupBy(F.col("doc_id").alias("labelled")).agg(F.min(label).alias("y"))
    share = int((1 << 30) * min(1.0, sample / max(1, judged.count())))
    chosen = judged.filter(F.pmod(F.xxhash64("labelled"), F.lit(1 << 30)) < share)
    used = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    stats = with_counts(used.select("doc_id", "y", "text"), "re_")
    columns = statistics("re_")
    table = stats.select("doc_id", "y", *[c.alias(n) for n, c in columns.items()]).toPandas().sort_values(["doc_id", *columns])
    return fit(table[list(columns)].to_numpy(float), table["y"].to_numpy(float), tuple(columns))


def scored(docs: DataFrame, model: RuleModel) -> tuple[DataFrame, str]:
    """``docs`` with score, predicted and held_out behind a free prefix; and that prefix."""
    p = free_prefix(docs, "re_")
    stats = with_counts(docs, p)
    score = model.score(statistics(p))
    return stats.withColumn(f"{p}score", score).withColumns({
        f"{p}predicted": (F.col(f"{p}score") >= CUTOFF).cast("int"),
        f"{p}held_out": doc_fold("doc_id", FOLDS) == HELD_OUT}), p
