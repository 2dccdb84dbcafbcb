"""Quality rules whose cutoffs are chosen under a proven bound on false rejections.

Every rule is a statistic with a side ("reject above" or "reject below") and a list of candidate cutoffs.
Labelled documents count, per stratum, rule and cutoff, how many good ones that cutoff would reject. A
cutoff is admissible if the exact binomial tail P(Bin(n, risk) <= rejected) stays under the level after
Holm's step-down correction over all strata, rules and cutoffs; then, with probability 1 - ``level``, no
admissible cutoff falsely rejects more than ``risk`` of a stratum's good documents. As that holds for all
of them at once, the most useful one may be picked afterwards. Each rule gets an equal share of
``total_risk``, so all rules together reject at most ``total_risk``.

Defined cases: a null or empty text has no words and fails the base rules; a missing stratum is a stratum
of its own; a document labelled twice counts with its lowest label; labels without a document, and
documents without a label, do not count; without labels no cutoff is admissible and only the base rules hold. Repeated rows are
judged alike and count as often as they stand there; very long texts are counted whole; of equally useful cutoffs the first listed is taken.
Results stand behind a prefix that no column has. Strata are meant to be few: a row per stratum reaches the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lakemill.llm.frames import free_prefix
from lakemill.llm.text_stats import with_counts

MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


@dataclass(frozen=True)
class Rule:
    name: str
    above: bool
    cutoffs: tuple[float, ...]

    def rejects(self, value: Column, cutoff: float | Column) -> Column:
        return value > cutoff if self.above else value < cutoff


RULES = (
    Rule("symbols_per_word", True, (0.02, 0.05, 0.1, 0.2, 0.4, 0.8)),
    Rule("repeat_share", True, (0.05, 0.1, 0.15)),
    Rule("dup_line_share", True, (0.1, 0.2, 0.3, 0.5)),
    Rule("distinct_share", False, (0.1, 0.2, 0.3, 0.4, 0.5)),
    Rule("upper_share", True, (0.1, 0.2, 0.3, 0.5)),
    Rule("chars_per_word", False, (3.0, 3.5, 4.0)),
    Rule("chars_per_word_high", True, (8.0, 9.0, 12.0)),
    Rule("marks_per_word", True, (0.5, 1.0, 2.0)),
)


def measures(prefix: str) -> dict[str, Column]:
    """The rules' statistics from the counts of ``with_counts``."""
    n = lambda c: F.col(f"`{prefix}{c}`").cast("double")
    words, chars, lines = (F.greatest(n(c), F.lit(1.0)) for c in ("n_words", "word_chars", "n_lines"))
    per_word = n("word_chars") / words
    return {
        "symbols_per_word": n("n_symbols") / words,
        "repeat_share": n("n_repeat_words") / words,
        "dup_line_share": n("n_dup_lines") / lines,
        "distinct_share": n("n_distinct") / words,
        "upper_share": n("n_upper") / chars,
        "chars_per_word": per_word,
        "chars_per_word_high": per_word,
        "marks_per_word": n("n_marks") / words,
    }


def base_failed(prefix: str) -> Column:
    words, repeated = F.col(f"`{prefix}n_words`"), F.col(f"`{prefix}n_repeat_words`")
    return (words < MIN_WORDS) | (repeated * 100 > words * MAX_REPEAT_PERCENT)


def binomial_tail(rejected: int, n: int, risk: float) -> float:
    """P(Bin(n, risk) <= rejected), exactly, summed in logarithms."""
    if n == 0 or rejected >= n:
        return 1.0
    total, odds = 0.0, math.log(risk / (1 - risk))
    term = n * math.log1p(-risk)
    for k in range(rejected + 1):
        total += math.exp(term)
        term += math.log(n - k) - math.log(k + 1) + odds
        if k > n * risk and term < -745:
            break
    return min(1.0, total)


def admissible(cells: list[tuple[int, int]], risk: float, level: float) -> list[bool]:
    """Which (rejected, n) cells are safe at ``level`` together, by Holm's procedure."""
    p = [binomial_tail(k, n, risk) for k, n in cells]
    safe = [False] * len(p)
    for rank, i in enumerate(sorted(range(len(p)), key=p.__getitem__)):
        if p[i] > level / (len(p) - rank):
            break
        safe[i] = True
    return safe


def calibrate(stats: DataFrame, labels: DataFrame, stratum: str, prefix: str, rules=RULES,
              total_risk: float = 0.05, level: float = 0.05, weight: float = 20.0) -> dict[tuple, float]:
    """The chosen cutoff per (stratum, rule); pairs without a safe and useful one are absent.

    Useful: it rejects more than one bad document, and more bad ones than ``weight`` times the share of good
    ones would suggest by chance. One row per stratum reaches the driver, with two counts per rule and cutoff.
    """
    value = measures(prefix)
    judged = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias(f"{prefix}id")).agg(F.min("quality").alias(f"{prefix}good"))
    )
    joined = stats.filter(~base_failed(prefix)).select(
        F.col("doc_id").alias(f"{prefix}doc"), F.col(f"`{stratum}`").alias(f"{prefix}stratum"),
        *[value[r.name].alias(f"{prefix}v{i}") for i, r in enumerate(rules)],
    ).join(judged, F.col(f"{prefix}doc") == F.col(f"{prefix}id"))
    good = F.col(f"{prefix}good") == 1
    sums = [F.count_if(good).alias("good"), F.count_if(~good).alias("bad")]
    for i, r in enumerate(rules):
        for j, c in enumerate(r.cutoffs):
            hit = r.rejects(F.col(f"{prefix}v{i}"), c)
            sums += [F.count_if(good & hit).alias(f"g{i}_{j}"), F.count_if(~good & hit).alias(f"b{i}_{j}")]
    rows = joined.groupBy(f"{prefix}stratum").agg(*sums).collect()
    keys = [(row, i, j) for row in rows for i, r in enumerate(rules) for j in range(len(r.cutoffs))]
    safe = admissible([(row[f"g{i}_{j}"], row["good"]) for row, i, j in keys], total_risk / len(rules), level)
    best: dict[tuple, tuple[float, float]] = {}
    for (row, i, j), ok in zip(keys, safe):
        hit_good, hit_bad = row[f"g{i}_{j}"], row[f"b{i}_{j}"]
        gain = hit_bad - weight * hit_good
        key = (row[f"{prefix}stratum"], rules[i].name)
        if ok and hit_bad > 1 and gain > 0 and gain > best.get(key, (0.0, 0.0))[0]:
            best[key] = (gain, rules[i].cutoffs[j])
    return {key: cutoff for key, (_, cutoff) in best.items()}


def verdict(cutoffs: dict[tuple, float], stratum: str, prefix: str, rules=RULES) -> Column:
    """True for a document that passes the base rules and every rule of its stratum."""
    value, rejected = measures(prefix), base_failed(prefix)
    for r in rules:
        for (of, name), cutoff in sorted(cutoffs.items(), key=repr):
            if name == r.name:
                rejected = rejected | (F.col(f"`{stratum}`").eqNullSafe(F.lit(of)) & r.rejects(value[name], cutoff))
    return ~rejected


def judged_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> tuple[DataFrame, str]:
    """``docs`` with counts, ``base_failed`` and ``kept`` behind a prefix no column has; and that prefix."""
    prefix = free_prefix(docs, "qr_")
    stats = with_counts(docs, prefix)
    cutoffs = calibrate(with_counts(docs.select("doc_id", "text", stratum), prefix, drop_text=True), labels, stratum, prefix, **options)
    return stats.withColumns({
        f"{prefix}base_failed": base_failed(prefix),
        f"{prefix}kept": verdict(cutoffs, stratum, prefix),
    }), prefix
