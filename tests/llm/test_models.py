"""Language model, classifier and quality rules: exact parts against brute force, the rest by held-out accuracy."""

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np

from lakemill.llm import quality_rules, queries, recurrent_lm as lm, rule_ensemble


def test_gradients_equal_differences():
    r = np.random.default_rng(0)
    v = lm.vocabulary(np.arange(10, 60).astype(np.uint64), np.arange(100, 50, -1), 40)
    w = {k: a.astype(np.float64) for k, a in lm.starting_weights(v).items()}
    xs, ys, h = r.integers(0, 51, (4, 3)), r.integers(0, 51, (4, 3)), np.zeros((3, lm.HIDDEN))
    grads = lm.train_window(w, v, xs, ys, np.ones((4, 3), bool), h)[0]
    for k in w:
        at = (xs[0, 0], 2) if k == "embed" else tuple(s // 2 for s in w[k].shape)
        losses = []
        for e in (1e-5, -2e-5):
            w[k][at] += e
            losses.append(lm.train_window(w, v, xs, ys, np.ones((4, 3), bool), h)[2])
        w[k][at] += 1e-5
        assert abs((losses[0] - losses[1]) / 2e-5 - grads[k][at]) < 1e-4


def test_probabilities_sum_to_one():
    v = lm.vocabulary(np.arange(10, 60).astype(np.uint64), np.arange(100, 50, -1), 40)
    w = lm.starting_weights(v)
    h = np.tile(np.random.default_rng(1).standard_normal((1, lm.HIDDEN)).astype(np.float32), (51, 1))
    assert abs(np.exp(lm.output(w, v, h, np.arange(51))[0]).sum() - 1) < 1e-5


def window_of(v, r, steps=6, docs=5):
    n = len(v.counts)
    ys = r.choice(n, (steps, docs), p=v.counts / v.counts.sum())
    xs = np.vstack([np.full((1, docs), n), ys[:-1]])
    return xs, ys, np.arange(steps)[:, None] < r.integers(1, steps + 1, docs)


def test_output_in_small_parts_is_the_same(monkeypatch):
    r = np.random.default_rng(1)
    v = lm.vocabulary(np.arange(10, 310).astype(np.uint64), np.arange(700, 400, -1), 40_000)
    w, (xs, ys, mask), h = lm.starting_weights(v), window_of(v, r, 12, 20), np.zeros((20, lm.HIDDEN), np.float32)
    whole = lm.train_window(w, v, xs, ys, mask, h)
    monkeypatch.setattr(lm, "FLAT", 7)  # cuts classes and their rows
    parts = lm.train_window(w, v, xs, ys, mask, h)
    assert all(np.allclose(a, parts[0][k], atol=1e-5) for k, a in whole[0].items()) and abs(whole[2] - parts[2]) < 1e-3


def test_steps_leave_words_alone_that_a_window_does_not_need():
    r = np.random.default_rng(2)
    v = lm.vocabulary(np.arange(10, 2010).astype(np.uint64), (100_000 / np.arange(1, 2001)).astype(np.int64), 40_000)
    w = lm.starting_weights(v)
    plain = {k: a.astype(np.float64) for k, a in w.items()}
    first, second = ({k: np.zeros_like(a) for k, a in plain.items()} for _ in range(2))
    adam, buffers = lm.Adam(w), {k: np.full_like(a, np.nan) for k, a in w.items()}  # what was left there must not be read
    column = np.concatenate([np.tile(np.arange(a, b), lm.HIDDEN + 1) for a, b in zip(v.bounds, v.bounds[1:])])  # of each number in "word"
    h, untouched = np.zeros((5, lm.HIDDEN), np.float32), 0
    for count in range(1, 5):
        xs, ys, mask = window_of(v, r)
        grads = lm.train_window({k: a.astype(np.float32) for k, a in plain.items()}, v, xs, ys, mask, h)[0]
        _, _, _, n, read = lm.train_window(w, v, xs, ys, mask, h, buffers)
        adam.step(w, buffers, read, lm.blocks_of(v, ys[mask]), n)
        grads = {k: a.astype(np.float64) / n for k, a in grads.items()}
        norm = sum((a * a).sum() for a in grads.values()) ** 0.5
        asked = np.isin(v.classes[v.members[column]], v.classes[ys[mask]])
        untouched += int((~asked).sum())
        for k, a in grads.items():
            at = {"embed": np.unique(xs), "word": np.flatnonzero(asked)}.get(k, slice(None))
            g = a[at] * min(1, lm.CLIP / norm)
            first[k][at] = 0.9 * first[k][at] + 0.1 * g
            second[k][at] = 0.99 * second[k][at] + 0.01 * g * g
            plain[k][at] -= lm.RATE * (first[k][at] / (1 - 0.9**count)) / (np.sqrt(second[k][at] / (1 - 0.99**count)) + 1e-7)
    assert untouched and all(np.allclose(a, plain[k], atol=2e-4) for k, a in w.items())


def test_a_window_makes_no_table_of_the_vocabulary():
    r = np.random.default_rng(3)
    v = lm.vocabulary(np.arange(10, 300_010).astype(np.uint64), (10**8 / np.arange(1, 300_001)).astype(np.int64), 40_000)
    w = lm.starting_weights(v)
    adam, grads, h = lm.Adam(w), {k: np.empty_like(a) for k, a in w.items()}, np.zeros((5, lm.HIDDEN), np.float32)
    xs, ys, mask = window_of(v, r)
    tracemalloc.start()
    _, _, _, n, read = lm.train_window(w, v, xs, ys, mask, h, grads)
    adam.step(w, grads, read, lm.blocks_of(v, ys[mask]), n)
    assert tracemalloc.get_traced_memory()[1] < w["word"].nbytes / 20
    tracemalloc.stop()


def test_words_outside_the_table_are_counted_by_document(spark, docs_of):
    texts = {1: "a b b zz zz zz q", 2: "zz a q q", 3: None, 4: "zz " * 3 + "a"}
    docs = docs_of(sorted(texts.items()) + [(i, "a b " * 20) for i in range(10, 1200)])
    got = {r.doc_id: r for r in lm.scored(spark, docs, head=2).collect()}
    counts = Counter()
    for r in docs.collect():
        if zlib.crc32(str(r.doc_id).encode()) % 5 != 1:
            counts.update((r.text or "").split() + [None])
    total, kinds = sum(counts.values()), len(counts)
    for i, text in texts.items():
        t = (text or "").split() + [None]
        want = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in t)
        assert (got[i].n_tokens, got[i].n_known) == (len(t), sum(x in counts for x in t)) and abs(got[i].base_score - want) < 1e-9 * abs(want)


def test_base_scores_and_held_out_gain(spark):
    folder = "/root/testdata/sf0.001"
    whole = queries.op3_recurrent_lm(spark, folder).collect()
    small = {r.doc_id: r for r in lm.scored(spark, spark.read.parquet(f"{folder}/documents.parquet"), head=500).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    counts = Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(t)
    total, kinds = sum(counts.values()), len(counts)
    for r in whole:
        t = texts[r.doc_id]
        want = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in t)
        for got in (r, small[r.doc_id]):
            assert abs(got.base_score - want) < 1e-6 * max(1, abs(want))
            assert (got.n_tokens, got.n_known, got.train_tokens) == (len(t), sum(x in counts for x in t), total)
    held = [r for r in whole if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_every_training_document_is_learnt_from_once(spark, docs_of):
    docs = docs_of([(i, f"w{i % 50} text {i}") for i in range(600)] + [(None, None), (7, "")])
    shares = [lm.share_of_round(docs, r).select("doc_id", "text").collect() for r in range(lm.ROUNDS)]
    assert Counter(x for share in shares for x in share) == Counter(docs.select("doc_id", "text").collect())
    assert all(150 < len(share) < 250 for share in shares)


def test_the_vocabulary_grows_with_the_counts(spark, docs_of, monkeypatch):
    known = []
    monkeypatch.setattr(lm, "train", lambda spark, docs, v, n_docs: known.append(len(v.hashes)) or lm.starting_weights(v))
    lm.scored(spark, docs_of([(i, " ".join(f"v{(i * 50 + k) % 3000}" for k in range(1500))) for i in range(600)])).count()
    assert known == [3001]  # 3,000 words and the end, each at least 200 times


def test_the_most_frequent_words_are_cut_by_rank(spark):
    r = np.random.default_rng(6)
    n = r.integers(1, 300, 500).tolist() + [128] * 40
    hashes = r.choice(10**9, len(n), replace=False).tolist()
    counts = spark.createDataFrame(list(zip(hashes, n)), "hash bigint, n bigint")
    ranked = sorted(zip(hashes, n), key=lambda x: (-x[1], x[0]))
    for limit in (1, 37, 250, 539, 540, 10_000):
        found, times = lm.frequent(counts, limit)
        assert dict(zip(found.tolist(), times.tolist())) == dict(ranked[:limit]) and (np.diff(found.astype(np.int64)) > 0).all()
    assert len(lm.frequent(counts.limit(0), 5)[0]) == 0


def test_classifier_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.op5_quality_classifier(spark, folder).collect() if r.held_out and r.doc_id in truth]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.95


def test_lasso_drops_noise():
    r = np.random.default_rng(0)
    z = (r.random((800, 12)) < 0.4).astype(float)
    y = (z[:, 0] + z[:, 1] > 0).astype(float)
    _, w = rule_ensemble.lasso_logistic(z, y, penalty=0.02)
    assert min(w[0], w[1]) > 0.5 and np.abs(w[2:]).max() < 0.2


def test_binomial_tail_and_holm():
    want = sum(math.comb(40, k) * 0.1**k * 0.9 ** (40 - k) for k in range(3))
    assert abs(quality_rules.binomial_tail(2, 40, 0.1) - want) < 1e-12
    assert quality_rules.binomial_tail(5, 5, 0.1) == 1.0 and quality_rules.binomial_tail(0, 0, 0.1) == 1.0
    assert quality_rules.admissible([(0, 2000), (0, 10), (30, 2000)], 0.01, 0.05) == [True, False, False]


def test_counts_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.op9_quality_rules(spark, folder).collect():
        t = texts[r.doc_id]
        w = [x for x in __import__("re").split("[\x20\x09-\x0D]+", t) if x]
        runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if x.strip("\x20\x09\x0A\x0B\x0C\x0D")]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r.base_failed and r.kept)
