"""What an operator sends between tasks, keeps on disk or gathers stays in proportion to its input."""

import random

import numpy as np
import pyarrow as pa

from lakemill.llm import collocations, combination_join as cj, latent_retrieval as lr, piece_lattice as pl
from test_collocations import slow_counts


def test_merges_need_no_shuffle_and_no_work_table(spark, docs_of, monkeypatch):
    monkeypatch.setattr(pl.Scratch, "staged", lambda *a: (_ for _ in ()).throw(AssertionError("staged")))
    docs = docs_of([(i, f"word{i % 7} and some more words") for i in range(50)])
    out, p = pl.encoded(spark, docs, pl.load_pieces())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert {r.text == r[f"{p}decoded"] for r in out.collect()} == {True}


def test_merges_of_a_matrix_equal_those_of_the_heap():
    r = random.Random(3)
    pieces = sorted({"".join(r.choice("abcé") for _ in range(r.randrange(1, 6))) for _ in range(150)} | set("ab"))
    table = pl.Pieces("bpe", [(p, 300 + i, -float(r.randrange(40))) for i, p in enumerate(pieces)], 0, 299)  # ties between ranks
    ids, rank = {p: i for p, i, _ in table.pieces}, {p: s for p, _, s in table.pieces}
    words = ["".join(r.choice("abcéX🙂") for _ in range(r.randrange(1, 90))) for _ in range(400)]
    data = [w.encode() for w in words]
    ends = np.cumsum([len(d) for d in data])
    offsets, flat = pl.Merges.of(vars(pl.Merges(table))).encoded(b"".join(data), ends - [len(d) for d in data], ends)
    for i, word in enumerate(words):
        want = [k for s in pl.merged(word, rank) for k in ([ids[s]] if s in ids else s.encode())]
        assert flat[offsets[i]:offsets[i + 1]].tolist() == want


def test_space_is_fitted_from_one_reading_of_the_texts(spark, docs_of, monkeypatch):
    """Frequencies and passages come from the same pass; terms that a text repeats, and a text of several passages, count once."""
    read, used = [], lr.text_bytes
    monkeypatch.setattr(lr, "text_bytes", lambda *a: read.append(1) or used(*a))
    monkeypatch.setattr(lr, "latent_basis", lambda rows, n_terms: np.eye(n_terms))
    texts = ["a b " * 100, "b", None, "c"]
    index = lr.build_index(spark, docs_of(list(enumerate(texts))), [lr.Item(1, [b"a", b"b", b"x"])])
    assert len(read) == 1
    assert np.allclose(np.diag(index.project), [np.log(5 / (1 + n)) + 0.05 for n in (1, 2, 0)])


def phrase_texts():
    rng = random.Random(11)
    return [(" ".join(f"w{int(rng.paretovariate(0.9)) % 40}" for _ in range(60)), rng.choice(["en", "fr"])) for _ in range(300)]


def test_tasks_send_their_phrases_by_bucket(spark, monkeypatch):
    """However many phrases are frequent, a task sends a row per bucket at most, and one of its totals."""
    monkeypatch.setattr(collocations, "BUCKETS", 4)
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(phrase_texts())], "doc_id long, text string, lang string").repartition(3)
    sent: list = []
    grouped = type(docs).groupBy
    monkeypatch.setattr(type(docs), "groupBy", lambda df, *c: (sent.append(df) if repr(c) == repr(("bucket",)) else None) or grouped(df, *c))
    texts = collocations._texts(docs)
    words = spark.createDataFrame([(i,) for i in range(1 << 12)], "h1 long")
    every = collocations.Table(spark, words)
    every.shared = spark.sparkContext.broadcast(collocations.zlib.compress(np.full((1 << collocations.BITS) >> 3, 255, np.uint8), 1))
    found = collocations.spelt_counts(texts, 5, every, 3)
    got = {tuple(r) for r in found.collect()}
    counts, totals = slow_counts(phrase_texts())
    assert got == {(lang, " ".join(w), n) for (lang, w), n in counts.items() if n >= 3} | {(lang, "", n) for lang, n in totals.items()}
    assert len(got) > 100 and len(sent) == 1 and sent[0].count() <= 3 * (4 + 1)


def test_few_missed_phrases_take_one_more_pass(spark, monkeypatch):
    """A sample that proposes all but one phrase of two words, and so nothing that holds it: all longer ones are counted in the next pass."""
    texts = phrase_texts() + [("rare phrase of five words", "en")] * 12
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string")
    all_texts, work = collocations._texts(docs), collocations.Scratch(spark)
    every = collocations._grown(spark, work, all_texts, spark.createDataFrame([], "h1 long"), 10, 5).distinct()
    block, hasher = collocations._Block([b"rare phrase of five words"], [0]), collocations._Hasher()
    holding = [int(h[0].view(np.int64)) for k, _, h in collocations._hashed(block, ["en"], hasher, 5) if k > 1]
    known = work.staged(every.filter(~every.h1.isin(holding)), "some")
    passes, counts = [], collocations.border_counts
    monkeypatch.setattr(collocations, "border_counts", lambda *a: passes.append(a) or counts(*a))
    found = collocations._grown(spark, work, all_texts, known, 10, 5)
    assert sorted(r.h1 for r in found.distinct().collect()) == sorted(r.h1 for r in every.collect())
    assert len(passes) == 2


def test_documents_that_share_scattered_shingles_are_no_candidates(spark, docs_of, monkeypatch):
    """Few words, so that every shingle stands in several documents, no near copies but one pair."""
    r, seen, used = random.Random(5), {}, cj.Scratch.staged

    def staged(self, df, label):
        seen[label] = used(self, df, label)
        if label == "pairs":
            seen["count"] = seen[label].count()
        return seen[label]

    monkeypatch.setattr(cj.Scratch, "staged", staged)
    texts = [" ".join(f"w{r.randrange(25)}" for _ in range(200)) for _ in range(300)]
    got = cj.near_duplicates(spark, docs_of(list(enumerate([*texts, texts[0] + " w1"]))))
    assert {x.doc_id: x.component_id for x in got.collect()} == {**{i: i for i in range(300)}, 300: 0}
    assert 1 <= seen["count"] <= 10


def test_linked_sets_share_a_signature_of_a_part_or_a_prefix():
    r = np.random.default_rng(8)
    for percent in (80, 90):
        for n in (4, 9, 10, 17, 30, 31, 64, 200, 700, 5000):
            for rare in (0.0, 0.1, 0.95):
                x = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
                gone = int(r.integers(0, n - -(-n * percent // 100) + 1))
                y = np.sort(r.permutation(x)[gone:])
                more = r.integers(0, 2**64, 20 * n, dtype=np.uint64)
                new = 0
                while 100 * len(y) >= percent * (len(x) + new + 1):
                    new += 1
                y = np.sort(np.concatenate([y, more[:new]]))  # as far apart as linked sets may be
                both = len(np.intersect1d(x, y))
                assert 100 * both >= percent * (len(x) + len(y) - both)
                load = lambda s: np.where(s % np.uint64(1000) < np.uint64(1000 * rare), 1, 100 + (s % np.uint64(7)).astype(int))  # noqa: E731,B023
                one, two = (cj.signatures(s, load(s), 50, percent) for s in (x, y))
                assert len(np.intersect1d(one, two)), (percent, n, rare)


def test_groups_of_a_signature_across_batches():
    r = random.Random(6)
    rows = sorted({(r.randrange(40) if r.random() < 0.7 else 99, r.randrange(1000)) for _ in range(400)})
    for size in (1, 3, 7, 400):
        parts = [pa.RecordBatch.from_pydict({"sig": [s for s, _ in rows[i:i + size]], "id": [k for _, k in rows[i:i + size]]}) for i in range(0, len(rows), size)]
        got = [tuple(x.values()) for b in cj.met(iter(parts)) for x in b.to_pylist()]
        want = []
        for sig in {s for s, _ in rows}:
            ids = [k for s, k in rows if s == sig]
            want += [(k, ids[0], True) for k in ids[1:]] if len(ids) > cj.SMALL else [(a, b, False) for a in ids for b in ids if a < b]
        assert sorted(got) == sorted(want)
    assert list(cj.met(iter([]))) == []
