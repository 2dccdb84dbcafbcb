import random

import numpy as np

from lakemill.llm import latent_retrieval as lr


def test_basis_equals_an_exact_decomposition(spark):
    """A matrix of falling singular values: the subspace of the leading ones, and what the rows keep of their length in it."""
    rng = np.random.default_rng(4)
    u, v = (np.linalg.qr(rng.standard_normal((n, 60)))[0] for n in (90, 60))
    a = (u * 0.7 ** np.arange(60)) @ v.T
    rows = spark.createDataFrame([(list(range(60)), r.tolist()) for r in a], "terms array<bigint>, weights array<double>").repartition(5)
    found = lr.latent_basis(rows, 60, rank=12)
    exact = np.linalg.svd(a)[2][:12].T
    assert found.shape == (60, 12) and np.allclose(found.T @ found, np.eye(12), atol=1e-9)
    angles = np.linalg.svd(exact.T @ found)[1]
    assert angles.min() > 1 - 1e-6
    assert np.allclose(np.linalg.norm(a @ found, axis=0), np.linalg.svd(a)[1][:12], rtol=1e-5)


def test_sparse_product_equals_the_matrix(spark):
    rng = np.random.default_rng(5)
    a = rng.standard_normal((40, 700)) * (rng.random((40, 700)) < 0.05)
    rows = [(np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for r in a]
    basis = rng.standard_normal((700, 6))
    found = lr._times_gram(spark.createDataFrame(rows, "terms array<bigint>, weights array<double>"), basis)
    assert np.allclose(found, a.T @ (a @ basis))


def test_space_is_fitted_on_every_passage(spark, docs_of, monkeypatch):
    """The matrix has the block's passages and all of all documents, with the weights that a loop over them gives."""
    rng = random.Random(3)
    items = [lr.Item(i, [b"w%d" % rng.randrange(50) for _ in range(30)]) for i in range(4)]
    texts = [" ".join(f"w{rng.randrange(90)}" for _ in range(rng.choice([0, 5, 64, 65, 200]))) for _ in range(2500)]
    seen = {}

    def fitted(rows, n_terms):
        seen["rows"] = rows.collect()
        return np.eye(n_terms)

    monkeypatch.setattr(lr, "latent_basis", fitted)
    index = lr.build_index(spark, docs_of(list(enumerate(texts))), items)
    sets = [set(t.encode().split()) for t in texts]
    idf = {w: np.log(2501 / (1 + sum(w in s for s in sets))) + 0.05 for w in index.terms}

    def row(words):
        tf = {w: words.count(w) for w in words if w in idf}
        norm = sum((n * idf[w]) ** 2 for w, n in tf.items()) ** 0.5
        return tuple(sorted((index.terms[w], round(n * idf[w] / norm, 4)) for w, n in tf.items()))

    passages = [t.encode().split()[at:at + 64] for t in texts for at in range(0, len(t.split()), 64)]
    got = lambda scaled: sorted(tuple((t, round(w, 4)) for t, w in zip(r.terms, r.weights)) for r in seen["rows"] if (r.scale < 1) == scaled)
    close = lambda a, b: len(a) == len(b) and all(
        [t for t, _ in x] == [t for t, _ in y] and all(abs(v - w) < 2e-4 for (_, v), (_, w) in zip(x, y)) for x, y in zip(a, b))
    by_terms = lambda rows: sorted(rows, key=lambda r: ([t for t, _ in r], [w for _, w in r]))
    assert close(by_terms(got(False)), by_terms(row(i.words) for i in items))
    assert close(by_terms(got(True)), by_terms(filter(None, map(row, passages))))


def exhaustive(text, index):
    """Every passage against every item, nothing left out beforehand: (hits, best item, best share)."""
    words = (text or "").encode().lower().split()
    hits, best, share_of = 0, None, 0.0
    for j in range(max(1, -(-len(words) // lr.STEP) - 1)):
        ids = [index.terms[w] for w in words[j * lr.STEP:(j + 2) * lr.STEP] if w in index.terms]
        vector = index.project[ids].sum(axis=0)
        for i, item in enumerate(index.items):
            cosine = vector @ index.points[i] / max(float(np.linalg.norm(vector)), 1e-9)
            if cosine >= lr.LEAST_COSINE:
                share, hit = lr.leaked(item, index.answers[i], words[max(0, (j - 1) * lr.STEP):(j + 3) * lr.STEP])
                hits += hit
                if hit and share > share_of:
                    best, share_of = item.item_id, share
    return hits, best, share_of


def test_search_equals_an_exhaustive_one(spark, docs_of):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 6, 12, 40, 150])))) for i in range(40)]
    texts = []
    for k in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 31, 33, 64, 200, 700]))]
        for _ in range(rng.randint(0, 2)):  # an item, some of its words lost or changed, somewhere in the text
            part = [w for w in items[rng.randrange(40)][1].split() if rng.random() < 0.85]
            at = rng.randint(0, len(words))
            words[at:at] = part
        texts.append(" ".join(words))
    docs = docs_of(list(enumerate(texts)) + [(500, None), (501, "")])
    benchmark = spark.createDataFrame(items + [(99, None), (98, " ")], "item_id long, text string")
    found, p = lr.searched(spark, docs, benchmark)
    got = {r.doc_id: (r[f"{p}hits"], r[f"{p}item_id"], r[f"{p}ordered_share"]) for r in found.collect()}
    blocks = list(lr.item_blocks(benchmark))
    index = lr.build_index(spark, docs, blocks[0])
    want = {i: exhaustive(t, index) for i, t in [*enumerate(texts), (500, None), (501, "")]}
    assert len(blocks) == 1 and {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in want.items()}
    assert all(abs(got[i][2] - want[i][2]) < 1e-12 for i in want)
    assert 40 < sum(v[0] > 0 for v in want.values()) < 118
