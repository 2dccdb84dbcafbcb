"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into passages of ``2 * STEP`` words that overlap by half. Terms are the
lower-cased words of a block of at most ``BLOCK`` benchmark passages, weighted by their document frequency over
*all* documents. A randomised singular value decomposition, with every product of the TF-IDF matrix and its
transpose computed by Spark, gives the latent space; its rows are the block's passages and all passages of *all*
documents (there without overlap), scaled down so that they add word associations without outweighing the
benchmark. The items are the stated query set, blocks follow one another in the same pass. A hit must hold, with the passage on either
side, at least half of the item's rarest words (its answer), so passages are first looked through for these, which loses no hit; those
left are compared with the item by cosine, and candidates must then hold, in order, most of the item's words (longest
common subsequence).

Defined cases: null and empty texts have no passage and are clean; items without words are ignored; repeated
documents or items are judged each on its own; an empty benchmark leaves every document clean. Very long texts are searched whole, passage by
passage; of hits with equal shares the first passage and item is named. Results stand behind a prefix that no column has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm.frames import Scratch, free_prefix, in_parts, text_bytes

STEP = 32
BLOCK = 1024
RANK, OVERSAMPLING, ROUNDS = 128, 16, 2
CORPUS_WEIGHT = 0.25
LEAST_COSINE = 0.35
LEAST_ORDERED = 0.6
CHUNK = 16  # terms whose sums meet in one group: every task sends its own
ROWS = 128  # passages multiplied at once: more hold more terms, and few of all of them


@dataclass
class Item:
    item_id: int | None
    words: list[bytes]


@dataclass
class Index:
    """One block of benchmark passages in its latent space."""

    terms: dict[bytes, int]
    project: np.ndarray
    items: list[Item]
    points: np.ndarray
    answers: list[frozenset]


def item_blocks(benchmark: DataFrame) -> Iterator[list[Item]]:
    """Passages of the items, ``BLOCK`` at a time; long items are cut so that each part is searched."""
    block: list[Item] = []
    rows = benchmark.select(F.col("item_id").cast("long"), text_bytes()).orderBy("item_id")
    for item_id, data in rows.toLocalIterator():
        words = data.lower().split()
        for at in range(0, len(words), 2 * STEP):
            part = words[at:at + 2 * STEP]
            if at and len(part) < STEP:
                part = words[-2 * STEP:]
            block.append(Item(item_id, part))
            if len(block) == BLOCK:
                yield block
                block = []
    if block:
        yield block


def weighted(ids: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and unit-length TF-IDF weights of one passage."""
    at, tf = np.unique(ids[ids >= 0], return_counts=True)
    w = tf * idf[at]
    return at, w / max(float(np.linalg.norm(w)), 1e-12)


def _lists(first: np.ndarray, terms: np.ndarray, values: np.ndarray, kind: pa.DataType) -> list[pa.Array]:
    """Lists of terms and their values that begin at ``first``."""
    offsets = pa.array(np.append(first, len(terms)), pa.int32())
    return [pa.ListArray.from_arrays(offsets, v) for v in (pa.array(terms, pa.int32()), pa.array(values, kind))]


def passage_counts(batch: pa.RecordBatch, terms: dict[bytes, int], documents: np.ndarray) -> pa.RecordBatch:
    """(terms, counts, false) of every passage, without overlap, that holds a known word; adds to ``documents`` in how many texts each term occurs."""
    get, n, known, owner, at = terms.get, len(terms), [], [], 0
    for v in batch.column(0):
        words = v.as_py().lower().split()
        ids = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        place = np.flatnonzero(ids >= 0)
        known.append((at + place // (2 * STEP)) * n + ids[place])
        owner.append(at)
        at += len(ids) // (2 * STEP) + 1
    keys, tf = np.unique(np.concatenate([np.zeros(0, np.int64), *known]), return_counts=True)
    passage, term = keys // n, keys % n
    text = np.searchsorted(owner, passage, side="right")
    documents += np.bincount(np.unique(text * n + term) % n, minlength=n)
    first = np.flatnonzero(np.diff(passage, prepend=-1))
    return pa.RecordBatch.from_arrays(
        [*_lists(first, term, tf, pa.int32()), pa.array(np.zeros(len(first), bool))], names=["terms", "counts", "documents"])


def passage_weights(batch: pa.RecordBatch, idf: np.ndarray) -> pa.RecordBatch:
    """(terms, weights) from (terms, counts): as :func:`weighted`, for a whole batch at once."""
    sizes, terms, tf = batch.column(0).value_lengths().to_numpy(), batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()
    w, first = tf * idf[terms], np.cumsum(sizes) - sizes
    if len(first):
        w = w / np.repeat(np.maximum(np.sqrt(np.add.reduceat(w * w, first)), 1e-12), sizes)
    return pa.RecordBatch.from_arrays(_lists(first, terms, w, pa.float32()), names=["terms", "weights"])


def counted_passages(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(terms, counts, documents) of all passages; where ``documents`` is true, of a task's texts: how many hold each term, and at -1 how many there are."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        found, n = np.zeros(len(shared.value), np.int64), 0
        for batch in in_parts(batches):
            yield passage_counts(batch, shared.value, found)
            n += batch.num_rows
        at = np.flatnonzero(found)
        lists = _lists(np.zeros(1, np.int64), np.append(at, -1), np.append(found[at], n), pa.int32())
        yield pa.RecordBatch.from_arrays([*lists, pa.array([True])], names=["terms", "counts", "documents"])

    return docs.select(text_bytes()).mapInArrow(run, "terms array<int>, counts array<int>, documents boolean")


def document_frequencies(counted: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and the number of documents; over all of them."""
    df, total = np.zeros(n_terms, np.int64), 0
    pairs = counted.filter("documents").select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    for term, n in pairs.groupBy("x.terms").agg(F.sum(F.col("x.counts").cast("long"))).collect():
        if term < 0:
            total = n
        else:
            df[term] = n
    return df, total


def _add_gram(at: np.ndarray, w: np.ndarray, sizes: np.ndarray, q: np.ndarray, total: np.ndarray) -> None:
    """Adds A^T A ``q`` to ``total``, for a few sparse rows of A that lie one behind the other: dense over the terms they hold."""
    held = np.zeros(len(q), bool)
    held[at] = True
    terms, place = np.flatnonzero(held), np.cumsum(held)
    a = np.zeros((len(sizes), len(terms)), q.dtype)
    a[np.repeat(np.arange(len(sizes)), sizes), place[at] - 1] = w
    total[terms] += a.T @ (a @ q[terms])


def _times_gram(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A^T A ``basis`` for the sparse rows (terms, weights) of A, times their ``scale`` if they have one; partial products are summed by Spark.

    A few rows at a time are multiplied in the precision of their weights, and added up in double.
    """
    shared = rows.sparkSession.sparkContext.broadcast(basis)
    n_terms, width = basis.shape

    def run(batches):
        q, total = shared.value, np.zeros((n_terms, width))
        for batch in in_parts(batches, ROWS):
            sizes, at, w = batch.column(0).value_lengths().to_numpy(), batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()
            if q.dtype != w.dtype:
                q = q.astype(w.dtype)
            if batch.num_columns > 2:
                w = w * np.repeat(batch.column(2).to_numpy().astype(w.dtype), sizes)
            _add_gram(at, w, sizes, q, total)
        for c in range(0, n_terms, CHUNK):
            if total[c:c + CHUNK].any():
                yield pa.RecordBatch.from_arrays([pa.array([c]), pa.array([total[c:c + CHUNK].tobytes()])], names=["c", "part"])

    def summed(key, table):
        whole = sum(np.frombuffer(v.as_py()) for v in table.column("part"))
        return pa.table({"c": [key[0].as_py()], "part": [whole.tobytes()]})

    out = np.zeros((n_terms, width))
    parts = rows.mapInArrow(run, "c bigint, part binary").groupBy("c").applyInArrow(summed, "c bigint, part binary")
    for c, part in parts.toLocalIterator():
        out[c:c + CHUNK] = np.frombuffer(part).reshape(-1, width)
    shared.destroy()
    return out


def latent_basis(rows: DataFrame, n_terms: int, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors of the rows' matrix (terms x rank), by randomised subspace iteration."""
    width = min(n_terms, rank + OVERSAMPLING)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0]
    for _ in range(ROUNDS):
        basis = np.linalg.qr(_times_gram(rows, basis))[0]
    values, vectors = np.linalg.eigh(basis.T @ _times_gram(rows, basis))
    order = np.argsort(values)[::-1][:rank]
    order = order[values[order] > 1e-9]
    return basis @ vectors[:, order]


def build_index(spark: SparkSession, docs: DataFrame, items: list[Item]) -> Index:
    terms = {t: i for i, t in enumerate(sorted({w for item in items for w in item.words}))}
    read, work = Scratch(spark), Scratch(spark)
    counted = read.staged(counted_passages(docs, terms), "counted")
    df, total = document_frequencies(counted, len(terms))
    idf = np.log((total + 1) / (df + 1)) + 0.05
    own = [weighted(np.array([terms[w] for w in item.words], np.int64), idf) for item in items]

    def run(batches):
        for batch in batches:
            yield passage_weights(batch, idf)

    schema = "terms array<int>, weights array<float>"
    corpus = work.staged(counted.filter("NOT documents").select("terms", "counts").mapInArrow(run, schema), "passages")
    read.clear()
    scale = (CORPUS_WEIGHT * len(items) / max(1, corpus.count())) ** 0.5
    bench = spark.createDataFrame([(t.tolist(), w.tolist()) for t, w in own], schema)
    matrix = bench.withColumn("scale", F.lit(1.0)).unionAll(corpus.withColumn("scale", F.lit(scale)))
    project = (latent_basis(matrix, len(terms)) * idf[:, None]).astype(np.float32)
    work.clear()
    points = np.stack([project[[terms[w] for w in item.words]].sum(0) for item in items])
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    answers = []
    for item in items:
        distinct = sorted(set(item.words), key=lambda w: (df[terms[w]], w))
        answers.append(frozenset(distinct[:max(2, len(distinct) // 4)]))
    return Index(terms, project, items, points, answers)


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, all of ``a``'s positions in one integer."""
    at: dict[bytes, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        if (m := at.get(w)) is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def leaked(item: Item, answer: frozenset, region: list[bytes]) -> tuple[float, bool]:
    """Share of the item's words found in order, and whether the region holds the item."""
    there = set(region)
    if 2 * len(answer & there) < len(answer):
        return 0.0, False
    n = len(item.words)
    share = common_subsequence(item.words, region) / n
    return share, share >= (LEAST_ORDERED if n >= 10 else 0.9)


def passages_with_answers(words: list[bytes], found: frozenset, asked: dict[bytes, list[int]], half: list[int]) -> list[tuple[int, int]]:
    """(passage, item) where the passage and its surroundings hold half of the item's answer: no other can be a hit.

    ``found`` are the answer words among ``words``, ``asked`` tells whose answer each is part of.
    """
    counts: dict[int, int] = {}
    for w in found:
        for i in asked[w]:
            counts[i] = counts.get(i, 0) + 1
    items = {i for i, n in counts.items() if n >= half[i]}
    if not items:
        return []
    wanted = {w: [i for i in asked[w] if i in items] for w in found}
    last = max(1, -(-len(words) // STEP) - 1) - 1
    held: dict[tuple[int, int], set[bytes]] = {}
    for at, w in enumerate(words):
        for i in wanted.get(w, ()):
            for j in range(max(0, at // STEP - 2), min(last, at // STEP + 1) + 1):
                held.setdefault((j, i), set()).add(w)
    return sorted(p for p, there in held.items() if len(there) >= half[p[1]])


def _searched(docs: DataFrame, index: Index) -> DataFrame:
    """``docs`` with the running results of one more block of items."""
    plain = vars(index) | {"items": [(i.item_id, i.words) for i in index.items]}  # workers may not have this module
    shared = docs.sparkSession.sparkContext.broadcast(plain)
    keep = len(docs.columns) - 6
    names = docs.columns

    def run(batches):
        ix = Index(**shared.value)
        ix.items = [Item(*i) for i in ix.items]
        asked = {}
        for i, answer in enumerate(ix.answers):
            for w in answer:
                asked.setdefault(w, []).append(i)
        known, half = frozenset(asked), [-(-len(answer) // 2) for answer in ix.answers]
        for batch in batches:
            data = [v.as_py() for v in batch.column(keep)]
            state = [list(r) for r in zip(*(batch.column(keep + 1 + i).to_pylist() for i in range(5)))]
            for row, d in zip(state, data):
                words = d.lower().split()
                for j, i in passages_with_answers(words, known.intersection(words), asked, half):
                    vector = ix.project[[t for t in map(ix.terms.get, words[j * STEP:(j + 2) * STEP]) if t is not None]].sum(axis=0)
                    cosine = float(vector @ ix.points[i] / max(float(np.linalg.norm(vector)), 1e-9))
                    if cosine < LEAST_COSINE:
                        continue
                    share, hit = leaked(ix.items[i], ix.answers[i], words[max(0, (j - 1) * STEP):(j + 3) * STEP])
                    row[0] += 1
                    if hit:
                        row[1] += 1
                        if share > row[4]:
                            row[2:] = [ix.items[i].item_id, cosine, share]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            columns = list(zip(*state)) if state else [()] * 5
            arrays = [batch.column(i) for i in range(keep + 1)] + [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(run, docs.schema)


def searched(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with, behind a free prefix: candidates (passage and item that hold half an answer and are near), hits, item_id, cosine, ordered_share (of the best hit), contaminated."""
    p = free_prefix(docs, "lr_")
    result = docs.withColumn(f"{p}bytes", text_bytes()).withColumns({
        f"{p}candidates": F.lit(0).cast("long"), f"{p}hits": F.lit(0).cast("long"), f"{p}item_id": F.lit(None).cast("long"),
        f"{p}cosine": F.lit(0.0), f"{p}ordered_share": F.lit(0.0)})
    for items in item_blocks(benchmark):
        result = _searched(result, build_index(spark, docs, items))
    return result.drop(f"{p}bytes").withColumn(f"{p}contaminated", F.col(f"{p}hits") > 0), p
