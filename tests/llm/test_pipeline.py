"""The pipeline's stages, each recomputed by brute force from what the stage before kept."""

import math

import pytest
import sentencepiece
from test_joins_and_spans import brute_components, brute_spans
from test_latent_retrieval import exhaustive

import corpus_pipeline
from lakemill.llm import latent_retrieval, piece_lattice, quality_rules
from lakemill.llm.text_stats import COUNTS, counts

RISK, LEVEL, WEIGHT = 0.05, 0.05, 20.0


def kept_by_rules(docs, labels):
    """Rows that pass: base rules, and cutoffs by exact binomial tails under Holm's correction, from plain loops."""
    stats = {r.doc_id: dict(zip(COUNTS, counts((r.text or "").encode()))) for r in docs}
    failed = {i: s["n_words"] < 10 or 100 * s["n_repeat_words"] > 20 * s["n_words"] for i, s in stats.items()}

    def value(s, name):
        words, chars, lines = (max(s[c], 1) for c in ("n_words", "word_chars", "n_lines"))
        return {"symbols_per_word": s["n_symbols"] / words, "repeat_share": s["n_repeat_words"] / words, "dup_line_share": s["n_dup_lines"] / lines,
                "distinct_share": s["n_distinct"] / words, "upper_share": s["n_upper"] / chars, "chars_per_word": s["word_chars"] / words,
                "chars_per_word_high": s["word_chars"] / words, "marks_per_word": s["n_marks"] / words}[name]

    good = {}
    for r in labels:
        if r.quality is not None:
            good[r.doc_id] = min(r.quality, good.get(r.doc_id, 1))
    beyond = lambda rule, s, c: value(s, rule.name) > c if rule.above else value(s, rule.name) < c
    cells = []
    for lang in {r.lang for r in docs}:
        judged = [r.doc_id for r in docs if r.lang == lang and not failed[r.doc_id] and r.doc_id in good]
        for rule in quality_rules.RULES:
            for c in rule.cutoffs:
                hits = [i for i in judged if beyond(rule, stats[i], c)]
                right = sum(good[i] == 1 for i in judged)
                cells.append((lang, rule, c, sum(good[i] == 1 for i in hits), right, sum(good[i] != 1 for i in hits)))
    risk = RISK / len(quality_rules.RULES)
    tails = [sum(math.comb(n, k) * risk**k * (1 - risk) ** (n - k) for k in range(hit + 1)) for _, _, _, hit, n, _ in cells]
    chosen = {}
    for rank, i in enumerate(sorted(range(len(cells)), key=tails.__getitem__)):
        if tails[i] > LEVEL / (len(cells) - rank):
            break
        lang, rule, c, hit_good, _, hit_bad = cells[i]
        gain = hit_bad - WEIGHT * hit_good
        if hit_bad > 1 and gain > 0:
            chosen.setdefault((lang, rule.name), []).append((gain, c, rule))
    out = []
    for r in docs:
        cuts = [max(v, key=lambda x: x[0]) for (lang, _), v in chosen.items() if lang == r.lang]
        if not failed[r.doc_id] and not any(beyond(rule, stats[r.doc_id], c) for _, c, rule in cuts):
            out.append(r.doc_id)
    return out, bool(chosen)


@pytest.fixture(scope="module")
def stages(spark):
    """Rows that come out of each stage over the smallest table, and what went in."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(spark, stage(spark, docs, folder), "stage")
        found.append((name, docs.collect()))
    return folder, found


def test_quality_rules(spark, stages):
    folder, found = stages
    want, _ = kept_by_rules(found[0][1], spark.read.parquet(f"{folder}/labels.parquet").collect())
    assert sorted(r.doc_id for r in found[1][1]) == sorted(want) and 0 < len(want) < len(found[0][1])


def test_near_duplicates(stages):
    before, after = stages[1][1][1], stages[1][2][1]
    components = brute_components([(r.doc_id, r.text) for r in before], 5, 80)
    want = {i for i, (n, root) in components.items() if root == i}
    assert {r.doc_id for r in after} == want and len(after) == len(want)


def test_substrings(stages):
    before, after = stages[1][2][1], stages[1][3][1]
    left = brute_spans([(r.doc_id, r.text) for r in before], None)
    whole = {r.doc_id: r for r in before}
    assert {r.doc_id: r.text.split() for r in after} == {i: w for i, w in left.items() if w or not whole[i].text.split()}
    for r in after:
        assert r.n_chars == (len(r.text) if r.text != whole[r.doc_id].text else whole[r.doc_id].n_chars)


def test_decontamination(spark, docs_of, stages):
    folder, found = stages
    before, after = found[3][1], found[4][1]
    items = next(latent_retrieval.item_blocks(spark.read.parquet(f"{folder}/benchmark.parquet")))
    frame = spark.createDataFrame(before, spark.read.parquet(f"{folder}/documents.parquet").schema)
    index = latent_retrieval.build_index(spark, frame, items)
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not exhaustive(r.text, index)[0]} and len(after) < len(found[1][1])


def test_pieces(stages):
    import public_tokenizers

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_lattice.PIECE_FILE))
    before, after = stages[1][4][1], stages[1][5][1]
    assert {r.doc_id: r.ids for r in after} == {r.doc_id: model.encode(r.text) for r in before}
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in after)


def test_odd_documents_pass_through(spark, odd):
    """Nulls, repeats and missing ids through every stage; an empty table too."""
    docs, folder = odd, "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(spark, stage(spark, docs, folder), "odd")
        assert docs.count() <= odd.count()
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
