import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakemill.llm import simhash_grid
from lakemill.llm.frames import documents
from lakemill.session import fresh_dir


def slow_fingerprint(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    k = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, distance=4):
    """Least position reachable, by comparing every pair."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def test_query_equals_brute_force(spark, small):
    texts = documents(spark, small).collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_grid.near_duplicates(spark, documents(spark, small)).collect()}
    texts = sorted(texts, key=lambda r: r.doc_id)
    values = [slow_fingerprint(r.text) for r in texts]
    want = {r.doc_id: (f"{v:016x}", texts[c].doc_id) for r, v, c in zip(texts, values, slow_components(values))}
    assert got == want
    assert len({c for _, c in got.values()}) < len(got)


def test_linked_fingerprints_share_a_cell():
    rng = random.Random(5)
    for distance in (0, 2, 3, 4, 7, 12):
        a = [rng.getrandbits(64) for _ in range(300)]
        b = [v ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, distance))) for v in a]
        both = np.array(a + b, np.uint64)
        index, cells = simhash_grid.cells_of(both, distance)
        held = [set() for _ in both]
        for i, c in zip(index.tolist(), cells.tolist()):
            held[i].add(c)
        assert all(held[i] & held[i + 300] for i in range(300))


def test_manhattan_distance_is_a_lower_bound():
    rng = random.Random(6)
    for _ in range(2000):
        a, b = rng.getrandbits(64), rng.getrandbits(64)
        p, q = (int(v) for v in simhash_grid.points(np.array([a, b], np.uint64)))
        apart = sum(abs((p >> 2 * i & 3) - (q >> 2 * i & 3)) for i in range(32))
        assert apart <= (a ^ b).bit_count()


@pytest.mark.parametrize("spread", [3, 5])
def test_large_cells_are_worked_off_in_blocks(spark, monkeypatch, spread):
    """One dense cloud, so that cells overflow, and clouds of their own beside it."""
    monkeypatch.setattr(simhash_grid, "CELL", 20)
    monkeypatch.setattr(simhash_grid, "BLOCK", 16)
    rng = random.Random(spread)
    values = []
    for size in (700, 5, 5):
        centre = rng.getrandbits(64)
        values += {centre ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, spread))) for _ in range(size)}
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    classes = spark.createDataFrame([(v, 1 + i % 3) for i, v in enumerate(signed)], "fp long, n long")
    found = simhash_grid.links(spark, classes, 4).collect()
    assert all(((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 4 for r in found)
    at = {v: i for i, v in enumerate(signed)}
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in found:
        a, b = sorted((find(at[r.u]), find(at[r.v])))
        root[b] = a
    assert [find(i) for i in range(len(values))] == slow_components(values)


def test_cells_are_not_broadcast(spark):
    """A class becomes a hundred rows that no estimate of Spark's knows of."""
    path = fresh_dir(spark, "few-classes")
    spark.range(200).select(F.xxhash64("id").alias("fp"), F.lit(1).cast("long").alias("n")).write.parquet(path)
    met = simhash_grid.met_in_cells(spark.read.parquet(path), 4)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_odd_documents(spark, docs_of, odd):
    got = sorted(((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in simhash_grid.near_duplicates(spark, odd).collect()), key=repr)
    zero = "0" * 16
    assert [g[1:] for g in got if g[1] in (1, 2, 3)] == [(i, zero, 1) for i in (1, 2, 3)]
    assert [g[3] for g in got if g[1] in (4, 5)] == [4, 4, 4]
    assert [g[3] for g in got if g[0]] == [None]
    long = next(r.text for r in odd.collect() if r.doc_id == 6)
    assert next(g[2] for g in got if g[1] == 6) == f"{slow_fingerprint(long):016x}"
    assert simhash_grid.near_duplicates(spark, docs_of([])).collect() == []
    clash = docs_of([(1, "a b"), (2, "A  b")]).toDF("doc_id", "text", "fp", "cell", "n").withColumnRenamed("n", "component_id")
    assert {r.component_id for r in simhash_grid.near_duplicates(spark, clash).collect()} == {1}
