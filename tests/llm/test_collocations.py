import random
import re
from collections import Counter

import numpy as np
import pytest

from lakemill.llm import collocations

SCHEMA = "doc_id long, text string, lang string, source string"


def slow_counts(docs):
    """Counter of (lang, words) and of words per language."""
    found, totals = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    found[lang, tuple(words[i:i + k])] += 1
    return found, totals


def slow_ranks(docs, least, top):
    counts, totals = slow_counts(docs)
    phrases = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), f in phrases.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                inner = (lang, words[i:j])
                if inner != (lang, words) and f >= phrases[inner]:
                    dropped.add(inner)
    rows = {}
    for (lang, words), a in phrases.items():
        if (lang, words) in dropped:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, totals[lang], -s)
                  for lang, found in rows.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def made(seed, n, words=40):
    """Texts of few words with set phrases, uneven sources, copies, odd white space and delimiters."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "naïve", "日本", "A", "b-c"]
    fixed = ["as soon as possible now", "New York City", "w1 w2 w3", " x y"]
    docs = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        docs.append(("".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b"]) for p in parts), rng.choice(["en", "en", "fr", None, "und"])))
    return docs + [docs[3]] * 40 + [(None, "en"), ("", None), (" .,\n", "de")]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, lang, "s") for i, (t, lang) in enumerate(docs)], SCHEMA)


@pytest.mark.parametrize("sample, bits, held", [(8, 27, 1 << 21), (1, 27, 500), (1_000_003, 27, 1 << 21), (3, 6, 1000)])
def test_equals_brute_force(spark, monkeypatch, sample, bits, held):
    """A sample of everything, of next to nothing, so that passes must expand five times, and a table too small for its phrases."""
    monkeypatch.setattr(collocations, "BITS", max(bits, 15))
    monkeypatch.setattr(collocations, "HELD", held)
    monkeypatch.setattr(collocations, "SPELT", min(held, 900))
    monkeypatch.setattr(collocations, "PART", 3000)
    docs = made(sample, 250)
    want = slow_ranks(docs, 6, 40)
    got = sorted(tuple(r) for r in collocations.collocations(spark, frame(spark, docs), least=6, top=40, sample=sample).collect())
    assert got == want and len(want) > 30 and {r[0] for r in want} == {"en", "fr", "und"}


def test_frequent_phrases_are_exact_and_complete(spark):
    docs = made(77, 150)
    counts, totals = slow_counts(docs)
    want = {(lang, " ".join(w), n) for (lang, w), n in counts.items() if n >= 7} | {(lang, "", n) for lang, n in totals.items() if n}
    got = [tuple(r) for r in collocations.frequent_phrases(spark, frame(spark, docs), 7, sample=4).collect()]
    assert len(got) == len(want) and set(got) == want


def test_the_border_finds_what_the_sample_missed(spark, monkeypatch):
    passes = []
    counts = collocations.border_counts
    monkeypatch.setattr(collocations, "border_counts", lambda *a: passes.append(a) or counts(*a))
    docs = [("one two three four five six", "en")] * 30
    got = {r.phrase: r.n for r in collocations.frequent_phrases(spark, frame(spark, docs), 30, sample=1 << 40).collect()}
    assert got["one two three four five"] == got["two three four five six"] == 30 and got[""] == 180 and len(got) == 1 + 6 + 5 + 4 + 3 + 2
    assert len(passes) == 1 + 6  # one over the empty sample, then one per length and one to see that nothing is missed


def test_phrases_that_share_a_first_hash_are_told_apart(spark, monkeypatch):
    hashed = collocations._hashed

    def few(block, names, hasher, longest, which=0):
        for k, inside, h in hashed(block, names, hasher, longest, which):
            yield k, inside, h % np.uint64(50) if which == 0 else h

    monkeypatch.setattr(collocations, "_hashed", few)
    docs = made(5, 60, words=15)
    counts, totals = slow_counts(docs)
    want = {(lang, " ".join(w), n) for (lang, w), n in counts.items() if n >= 9} | {(lang, "", n) for lang, n in totals.items() if n}
    assert {tuple(r) for r in collocations.frequent_phrases(spark, frame(spark, docs), 9, sample=2).collect()} == want


def test_odd_tables(spark):
    assert collocations.collocations(spark, frame(spark, []), 2).collect() == []
    assert collocations.collocations(spark, frame(spark, [(None, None), ("", "en"), ("a b a b a b", "en")]), 50).collect() == []
    docs = [("a b", None), ("A  b", "und"), ("a\tb.", None)]
    clash = frame(spark, docs).withColumnsRenamed({"source": "phrase"}).withColumn("h1", collocations.F.lit(1)).withColumn("n", collocations.F.lit(2))
    assert [tuple(r) for r in collocations.collocations(spark, clash, 3).collect()] == [("und", 1, "a b", 3, 3, 3, 6, 2000)]


def test_long_texts_are_cut_behind_delimiters(monkeypatch):
    monkeypatch.setattr(collocations, "PART", 10)
    data = b"aaaa bbbb cccc dddd. e f g h i j, kkkkkkkkkkkkkkkkkkkkkkkkkkkkkkkk"
    cut = collocations.parts(data)
    assert b"".join(cut) == data and len(cut) > 1 and all(c[-1:] in b".,;:!?\n" for c in cut[:-1])
