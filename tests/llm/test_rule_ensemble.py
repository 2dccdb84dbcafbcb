import math
import zlib

import numpy as np

from lakemill.llm import queries, rule_ensemble as re_
from lakemill.llm.text_stats import COUNTS, counts


def features(text):
    s = dict(zip(COUNTS, counts((text or "").encode())))
    words, chars, lines = (max(s[c], 1) for c in ("n_words", "word_chars", "n_lines"))
    return [s["n_words"], s["word_chars"] / words, s["n_symbols"] / words, s["n_repeat_words"] / words, s["n_dup_lines"] / lines, s["n_distinct"] / words,
            s["n_upper"] / chars, s["n_digits"] / chars, s["n_marks"] / words, s["n_words"] / lines, s["n_short_lines"] / lines, s["max_word"]]


def holds(row, conditions):
    return all(row[f] > t if above else row[f] <= t for f, above, t in conditions)


def test_rules_and_weights_equal_brute_force(spark):
    """Every score from the model by plain loops, and the model's weights against the optimality conditions of the lasso."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 4 for i in texts}
    good = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in texts and fold[r.doc_id] != 2}
    table = sorted([i, *features(texts[i]), y] for i, y in good.items())
    x, y = np.array([r[1:-1] for r in table], float), np.array([r[-1] for r in table], float)
    model = re_.trained(docs, labels)
    rules = re_.tree_rules(x, y)
    z = np.array([[holds(row, r) for r in rules] for row in x], float)
    intercept, weights = re_.lasso_logistic(z, y)
    kept = {r: w for r, w in zip(rules, weights) if abs(w) > 1e-6}
    assert dict(model.rules).keys() == kept.keys() and all(abs(w - kept[r]) < 1e-9 for r, w in model.rules) and 0 < len(kept) < len(rules)
    # At the optimum a kept rule's slope equals the penalty, and no other rule's is above it.
    error = 1 / (1 + np.exp(-(intercept + z @ weights))) - y
    scale = np.sqrt(np.maximum(z.mean(0) * (1 - z.mean(0)), 1e-3))
    slope = ((z - z.mean(0)) / scale).T @ error / len(y)
    assert abs(error.mean()) < 2e-3 and np.abs(slope).max() < re_.PENALTY * 1.5
    strong = np.abs(weights * scale) > 0.05
    assert strong.any() and np.allclose(-slope[strong], re_.PENALTY * np.sign(weights[strong]), atol=re_.PENALTY * 0.5)
    for r in queries.op5_quality_classifier(spark, folder).collect():
        row = features(texts[r.doc_id])
        total = model.intercept + sum(w for conditions, w in model.rules if holds(row, conditions))
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9
        assert (r.held_out, r.predicted) == (fold[r.doc_id] == 2, int(r.score >= 0.7))


def test_the_first_split_is_the_best_of_all():
    rng = np.random.default_rng(8)
    x = rng.random((120, 4)).round(2)
    y = (x[:, 2] + 0.2 * rng.random(120) > 0.6).astype(float)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, re_.CUTS))) for f in range(4)]
    gradient, hessian, paths = 0.5 - y, np.full(120, 0.25), []
    re_._tree(x, cuts, gradient, hessian, np.arange(120), 1, (), paths)
    best = None
    for f in range(4):
        for t in cuts[f]:
            low = [i for i in range(120) if x[i, f] <= t]
            if re_.LEAST_LEAF <= len(low) <= 120 - re_.LEAST_LEAF:
                high = [i for i in range(120) if x[i, f] > t]
                gain = sum(sum(gradient[i] for i in side) ** 2 / (sum(hessian[i] for i in side) + 1) for side in (low, high))
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, f, float(t))
    assert paths == [((best[1], False, best[2]),), ((best[1], True, best[2]),)]
