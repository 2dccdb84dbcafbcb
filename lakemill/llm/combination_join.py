"""Exact n-gram Jaccard self-join with signatures of parts and of prefixes, and the link components it gives.

A document is its set of word shingles. Equal sets are one class.

*Parts.* Sets are cut into parts by ranges of their hashes, as many as two linked sets of a size class may differ in shingles, one
more, and some spare ones. Of two linked sets all parts but those that hold a difference are equal, so one more than the spare ones are.
The content of a part is a signature; it has several shingles, which unlinked sets do not share by chance, however often
each occurs. *Weak* parts, with less than three shingles and no rare one, do not sign. If a set has no more weak parts than spare ones, one
of its parts that equals the linked set's is not weak. A size class is that of the larger set, so a set signs for all classes a partner may have.

*Prefixes.* A set with more weak parts than that also signs by its prefix, which finds the links among such sets. Shingles are put in
one global order, rare ones first; how often a shingle occurs comes from a table of ``BUCKETS`` counters over all
documents, which only steers the order and which parts are weak: results do not depend on it. Shingles in well-filled counters are
*frequent*, the others rare. A set of n shingles can miss at most ``e = n - ceil(t n)`` of its shingles in a linked set. A rare
shingle of the prefix is a signature by itself and worth one credit. Frequent ones fall into groups by hash;
every pair within a group is a signature, and g of them are worth g - 1 credits, as all but one must be missing
before no pair is left. The prefix is extended until its credits exceed e. Of two linked sets, the one whose
prefix ends first then shares a signature with the other. Groups depend on the size band, so a set signs for
the bands of all sizes a partner may have.

*Meeting.* Signatures with class ids are shuffled once, without text or key, and sorted: rows of one signature follow each other, and a task
holds ``SMALL`` of them at most. As a class has many signatures, one signature has a small share of all rows.

*Large groups.* A signature with more than ``SMALL`` classes emits no pairs. Its most typical class, the one with the fewest rare shingles, is the
pivot and is compared with each member. Two members linked with the pivot need no comparison. The others are compared
among each other, ``BLOCK`` by ``BLOCK``, by vectors of bucket counts whose distance is never above the sets' difference: first
each with its ``NEAREST``, which connects groups of near copies, then all pairs that may be linked and are not connected yet. Such a
comparison emits only pairs that pass the bound. No pair is dropped, nothing is capped; the comparisons in a group grow with its members
times those its pivot does not connect.

*Verification* compares the whole sets, computed from the texts, after an exact lower bound on their difference from bucket
histograms. Texts travel compressed; a pivot's goes out once per ``CHUNK`` members, which a task walks through in order.

Class ids with one in ``HOT`` of all pairs or more, ``HOT`` at most, are looked up in a broadcast table, so no task holds all pairs of one.

Defined cases: null and empty texts have no shingle and link with nothing, fewer words than a shingle are
one shingle, repeated rows are one class, a null id takes part but never names a component (null if the
component has no other id). Very long texts are hashed a part at a time. Equal sets are found by 128-bit digests of 64-bit hashes, and
pairs are verified by 64-bit hashes of their shingles. Columns other than the id and the text are not read by the join.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm.components import connected
from lakemill.llm.frames import Batches, Scratch, free_prefix, in_parts, staged, text_bytes
from lakemill.llm.shingles import WordHasher, digest, mixed, shingle_set

BUCKETS = 1 << 18
HISTOGRAM = 128
SMALL = 4
SLOTS = 1 << 20
CHUNK = 64
HOT = 1000
FIRST_BAND = 5  # below 32 shingles every shingle counts as rare
GROUP_SPREAD = 80
VECTOR = 4096
BLOCK = 512
NEAREST = 6
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bucket(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - 18)).astype(np.int64)


def allowed_missing(n: int, percent: int) -> int:
    """Shingles a set of ``n`` can lack in a set it is linked with."""
    return n - -(-n * percent // 100)


def bands(n: int, percent: int) -> range:
    least, most = -(-n * percent // 100), n * 100 // percent
    return range(least.bit_length(), most.bit_length() + 1)


def prefix_signatures(ranked: np.ndarray, heavy: np.ndarray, groups: int, need: int, salt: np.uint64) -> tuple[np.ndarray, bool]:
    """Signatures of the shortest prefix worth ``need`` credits, and whether there is one; else of all of ``ranked``.

    A light element is worth one credit; of the heavy ones of a group, all but the first are.
    """
    group = np.where(heavy, (ranked % np.uint64(groups)).astype(np.int64), -1)
    first = np.zeros(len(ranked), bool)
    at = np.flatnonzero(heavy)
    first[at[np.unique(group[at], return_index=True)[1]]] = True
    end = int(np.searchsorted(np.cumsum(~first), need)) + 1
    ranked, heavy, group = ranked[:end], heavy[:end], group[:end]
    out = [mixed(ranked[~heavy] ^ salt)]
    for g in np.unique(group[heavy]):
        members = np.sort(ranked[group == g])
        i, j = np.triu_indices(len(members), 1)
        out.append(mixed((members[i] * _GOLD + mixed(members[j])) ^ ~salt))
    return np.concatenate(out), end <= len(first)


@lru_cache
def parts_of(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per size class its greatest size, number of parts, and how many of them are spare."""
    limits = [1]
    while limits[-1] < 1 << 31:
        limits.append(max(limits[-1] + 1, limits[-1] * 3 // 2))
    parts, spares = [], []
    for below, limit in zip([0, *limits], limits):
        most = 2 * limit * (100 - percent) // (100 + percent)  # shingles that only one of two linked sets has
        spares.append(1 + math.ceil(2.5 * most * math.exp(-(below + 1) / (most + 1))))
        parts.append(most + 1 + spares[-1])
    return np.array(limits), np.array(parts), np.array(spares)


def part_signatures(values: np.ndarray, sizes: np.ndarray, light: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the parts that are not weak, the number of the set of each, and per set whether it has more weak parts than spare ones.

    The sets lie one behind the other, ``sizes`` long, and are sorted; a part is a range of hashes.
    """
    limits, parts, spares = parts_of(percent)
    least = np.searchsorted(limits, sizes)
    last = np.searchsorted(limits, sizes * 100 // percent)
    found, owners, scarce = [], [], np.zeros(len(sizes), bool)
    for step in range(int((last - least).max(initial=-1)) + 1):
        sets = np.flatnonzero(last - least >= step)
        inside = np.repeat(last - least >= step, sizes)
        kept, n, at = values[inside], sizes[sets], least[sets] + step
        first = np.cumsum(parts[at]) - parts[at]
        place = (kept >> np.uint64(32)) * np.repeat(parts[at], n).astype(np.uint64) >> np.uint64(32)
        cut = np.append(0, np.cumsum(np.bincount(np.repeat(first, n) + place.astype(np.int64), minlength=parts[at].sum())))
        sums = np.append(np.uint64(0), np.cumsum(mixed(kept)))
        lights = np.append(0, np.cumsum(light[inside]))
        weak = (np.diff(lights[cut]) == 0) & (np.diff(cut) < 3)
        number = (np.arange(cut.size - 1) - np.repeat(first, parts[at])).astype(np.uint64)
        salt = np.repeat(mixed((at + (1 << 32)).astype(np.uint64)), parts[at])
        owner = np.repeat(sets, parts[at])
        found.append(mixed(mixed(np.diff(sums[cut]) + number * _GOLD) ^ salt)[~weak])
        owners.append(owner[~weak])
        scarce[sets] |= np.bincount(owner[weak], minlength=len(sizes))[sets] > spares[at]
    return np.concatenate(found), np.concatenate(owners), scarce


def prefixes(values: np.ndarray, load: np.ndarray, frequent: int, percent: int) -> np.ndarray:
    """Signature hashes of the prefixes of one set; ``load`` has the counter of each shingle."""
    n = len(values)
    order = np.lexsort((values, load))
    ranked, heavy = values[order], load[order] > frequent
    need = allowed_missing(n, percent) + 1
    out = []
    for band in bands(n, percent):
        salt = mixed(np.array([band], np.uint64))[0]
        if band <= FIRST_BAND or not heavy.any():
            out.append(mixed(ranked[:need] ^ salt))
        else:
            out.append(prefix_signatures(ranked, heavy, max(1, (1 << band) // GROUP_SPREAD), need, salt)[0])
    return np.unique(np.concatenate(out))


def signatures_of_sets(values: np.ndarray, sizes: np.ndarray, load: np.ndarray, frequent: int, percent: int) -> list[np.ndarray]:
    """Signature hashes of each of the sorted sets that lie one behind the other."""
    found, owner, scarce = part_signatures(values, sizes, load <= frequent, percent)
    found = found[np.argsort(owner, kind="stable")]
    out = np.split(found, np.cumsum(np.bincount(owner, minlength=len(sizes)))[:-1])
    end = np.cumsum(sizes)
    for i in np.flatnonzero(scarce):
        own = slice(end[i] - sizes[i], end[i])
        out[i] = np.concatenate([out[i], prefixes(values[own], load[own], frequent, percent)])
    return out


def signatures(values: np.ndarray, load: np.ndarray, frequent: int, percent: int) -> np.ndarray:
    """Signature hashes of one sorted set; ``load`` has the counter of each shingle."""
    return signatures_of_sets(values, np.array([len(values)]), load, frequent, percent)[0]


def _counters(docs: DataFrame, width: int) -> np.ndarray:
    """How often the shingles of each counter occur; ``BUCKETS`` numbers whatever the input."""

    def run(batches):
        hasher, total = WordHasher(), np.zeros(BUCKETS, np.int64)
        for batch in in_parts(batches):
            found = [shingle_set(v.as_py(), width, hasher) for v in batch.column(0)]
            if found:
                total += np.bincount(bucket(np.concatenate(found)), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["b", "n"])

    rows = docs.select(text_bytes().alias("t")).mapInArrow(run, "b bigint, n bigint").groupBy("b").agg(F.sum("n").alias("n"))
    load = np.zeros(BUCKETS, np.int64)
    for row in rows.toLocalIterator():
        load[row["b"]] = row["n"]
    return load


def _histogram(values: np.ndarray) -> bytes:
    """Bucket sizes, 255 for more: cutting them off only brings two histograms closer, so the bound below still holds."""
    return np.minimum(np.bincount((values & np.uint64(HISTOGRAM - 1)).astype(np.int64), minlength=HISTOGRAM), 255).astype(np.uint8).tobytes()


def shingled(work: Scratch, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: doc_id, xxh (hash of the text), n, key, typical, hist and sigs (null key without shingles); staged."""
    load = _counters(docs, width)
    used = load[load > 0]
    mean = float(used.mean()) if len(used) else 0.0
    frequent = int(mean + 6 * mean ** 0.5 + 16)
    shared = docs.sparkSession.sparkContext.broadcast(load)

    def run(batches):
        hasher, counters = WordHasher(), shared.value
        for batch in in_parts(batches):
            columns = [[] for _ in range(7)]
            sets = [shingle_set(data.as_py(), width, hasher) for data in batch.column(2)]
            sizes = np.array([len(values) for values in sets])
            every = np.concatenate(sets)
            seen = counters[bucket(every)]
            signed = iter(signatures_of_sets(every, sizes[sizes > 0], seen, frequent, percent) if len(every) else ())
            lights = np.append(0, np.cumsum(seen <= frequent))[np.append(0, np.cumsum(sizes))]
            for doc_id, xxh, values, light in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sets, np.diff(lights)):
                row = (doc_id, xxh, 0, None, None, None, None)
                if len(values):
                    row = (doc_id, xxh, len(values), digest(values), int(255 * light / len(values)), _histogram(values), next(signed).view(np.int64))
                for column, value in zip(columns, row):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int16(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["doc_id", "xxh", "n", "key", "typical", "hist", "sigs"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("xxh"), text_bytes().alias("t"))
    return work.staged(rows.mapInArrow(
        run, "doc_id bigint, xxh bigint, n bigint, key binary, typical smallint, hist binary, sigs array<bigint>"), "shingled")


def _classes(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per distinct set; equal sets have equal columns, so any of their values will do."""
    return rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct("doc_id", "xxh")).alias("rep"), *[F.first(c).alias(c) for c in columns])


def _grouped(signed: DataFrame, key: str, *aggregates, least: int = 2) -> DataFrame:
    """``signed`` with aggregates per ``key`` for keys with ``least`` rows or more; common keys are looked up in a small broadcast table."""
    counted = signed.groupBy(key).agg(F.count("*").alias("size"), *aggregates).filter(F.col("size") >= least)
    common = F.broadcast(counted.filter(F.col("size") * HOT > signed.agg(F.count("*")).scalar()))
    return signed.join(common, key).unionByName(signed.join(common.select(key), key, "left_anti").join(counted, key))


def met(batches: Batches) -> Batches:
    """Pairs (a, b, star) of the ids that share a signature; rows (sig, id) are sorted.

    A group of more than ``SMALL`` is a star about its first id. Of a group that goes on in the next batch only that id, or
    up to ``SMALL``, are held.
    """
    sig, ids, large = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for batch in chain(batches, [None]):
        if batch is not None:
            sig, ids = (np.concatenate([held, batch.column(c).to_numpy()]) for held, c in ((sig, "sig"), (ids, "id")))
        if not len(sig):
            continue
        begin = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        size = np.diff(np.append(begin, len(sig)))
        star = size > SMALL
        star[0] |= large
        of_star = np.repeat(star, size)
        of_star[begin] = False
        found = [(ids[of_star], np.repeat(ids[begin], size)[of_star])]
        closed = ~star
        closed[-1] &= batch is None
        for k in range(2, SMALL + 1):
            first = begin[closed & (size == k)]
            for i, j in combinations(range(k), 2):
                one, two = ids[first + i], ids[first + j]
                found.append((np.minimum(one, two), np.maximum(one, two)))
        one, two = (np.concatenate(side) for side in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(np.arange(len(one)) < len(found[0][0]))], names=["a", "b", "star"])
        large = bool(star[-1])
        rest = slice(begin[-1], begin[-1] + 1 if large else None)
        sig, ids = sig[rest], ids[rest]


def _candidates(signed: DataFrame) -> DataFrame:
    """Pairs of class ids to verify: (a, b, star); ``star`` marks the pivot ``b`` of a large group. ``signed`` has sig, id."""
    dealt = signed.repartition("sig").sortWithinPartitions("sig", "id")
    return dealt.mapInArrow(met, "a bigint, b bigint, star boolean").groupBy("a", "b").agg(F.max("star").alias("star"))


def _within_bound(percent: int):
    """Keeps pairs whose histograms allow a link, and all star pairs."""

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            ha, hb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, HISTOGRAM).astype(np.int64) for i in (4, 5))
            fits = np.abs(ha - hb).sum(1) <= (na + nb) * (100 - percent) // (100 + percent)
            star = batch.column(6).to_numpy(zero_copy_only=False)
            mask = pa.array(fits | star)
            kept = batch.filter(mask)
            yield pa.RecordBatch.from_arrays([kept.column(i) for i in (0, 1, 6)], names=["a", "b", "star"])

    return run


def _texts(work: Scratch, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text) of the wanted classes: their representatives' texts, compressed.

    Only texts whose hash shares one of ``SLOTS`` slots with a wanted one are shuffled; the slots are at most that many.
    """
    slot = lambda i, x: F.pmod(F.xxhash64(i, x), F.lit(SLOTS))
    slots = F.broadcast(wanted.select(slot("rep.doc_id", "rep.xxh").alias("slot")).distinct())
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("xxh"), F.col("text"))
    rows = rows.withColumn("slot", slot("doc_id", "xxh")).join(slots, "slot", "left_semi")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            packed = [zlib.compress(v.as_py(), 1) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "xxh", "text"])

    small = rows.select("doc_id", "xxh", text_bytes().alias("text")).mapInArrow(run, "doc_id bigint, xxh bigint, text binary")
    found = small.join(
        wanted.select(F.col("rep.doc_id").alias("i"), F.col("rep.xxh").alias("x"), "id"),
        (F.col("xxh") == F.col("x")) & F.col("doc_id").eqNullSafe(F.col("i")))
    once = found.select("xxh", "id", "text").dropDuplicates(["xxh", "id"])  # lies as the join has dealt it
    return work.staged(once.select("id", "text"), "texts")


Compared = Callable[[tuple, np.ndarray, np.ndarray], tuple | None]


def _walked(pairs: DataFrame, texts: DataFrame, width: int, each: Compared, schema: str, types: list[pa.DataType]) -> DataFrame:
    """``each(pair, set of a, set of b)`` as a row per pair (a, b, ...), or none.

    Pairs are dealt by ``b`` and, within, into chunks of about ``CHUNK``; the text of ``b`` goes out once per chunk and comes first there.
    """
    more = [c for c in pairs.columns if c not in ("a", "b")]
    sized = _grouped(pairs, "b", least=1)
    chunk = F.pmod(F.xxhash64("a"), F.ceil(F.col("size") / CHUNK)).cast("int").alias("chunk")
    dealt = sized.select("b", chunk, "a", *more)
    heads = dealt.select("b", "chunk").distinct().join(texts.withColumnRenamed("id", "b"), "b")
    dealt = dealt.join(texts.withColumnRenamed("id", "a"), "a")
    both = dealt.select("b", "chunk", "a", "text", *more).unionByName(
        heads.select("b", "chunk", F.lit(None).cast("bigint").alias("a"), "text"), allowMissingColumns=True)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Batches) -> Batches:
        hasher, head, other = WordHasher(), None, None
        for batch in batches:
            rows = []
            values = batch.select(["b", "a", *more]).to_pylist()
            texts_ = batch.column(3)
            for i, row in enumerate(values):
                found = shingle_set(zlib.decompress(texts_[i].as_py()), width, hasher)
                if row["a"] is None:
                    head, other = row["b"], found
                elif head == row["b"] and (result := each(tuple(row.values()), found, other)) is not None:
                    rows.append(result)
            columns = list(zip(*rows)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return both.repartition("b", "chunk").sortWithinPartitions("b", "chunk", F.col("a").asc_nulls_first()).mapInArrow(run, schema)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, star, linked) of the pairs (a, b, star), by their whole sets."""

    def each(pair: tuple, x: np.ndarray, y: np.ndarray) -> tuple:
        b, a, star = pair
        both = len(np.intersect1d(x, y, assume_unique=True))
        return a, b, star, 100 * both >= percent * (len(x) + len(y) - both)

    return _walked(pairs.select("a", "b", "star"), texts, width, each, "a bigint, b bigint, star boolean, linked boolean",
                   [pa.int64(), pa.int64(), pa.bool_(), pa.bool_()])


def _vectors(work: Scratch, texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(a, vector): how many shingles of a set fall into each of ``VECTOR`` buckets, compressed; 255 stands for more."""

    def run(batches: Batches) -> Batches:
        hasher = WordHasher()
        for batch in batches:
            found = []
            for v in batch.column(1):
                values = shingle_set(zlib.decompress(v.as_py()), width, hasher)
                counts = np.bincount((values >> np.uint64(20)).astype(np.int64) & (VECTOR - 1), minlength=VECTOR)
                found.append(zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["a", "vector"])

    rows = texts.join(wanted.select(F.col("a").alias("id")).distinct(), "id")
    return work.staged(rows.select("id", "text").mapInArrow(run, "a bigint, vector binary"), "vectors")


def near_pairs(ids: np.ndarray, roots: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, side: np.ndarray, percent: int, every: bool):
    """Pairs of unconnected members whose vectors allow a link: all of them, or of each member with its ``NEAREST``.

    Cutting counts off at 255 only brings vectors closer, so no linked pair is missed. Members of two blocks (``side``) are compared across.
    """
    cross, places, out = side.min() != side.max(), np.arange(len(ids)), []
    for i in range(len(ids)):
        others = np.flatnonzero((roots != roots[i]) & ((side != side[i]) if cross else places != i))
        if every:
            others = others[others > i]
        apart = np.abs(vectors[others] - vectors[i]).sum(axis=1)
        fits = apart <= (sizes[others] + sizes[i]) * (100 - percent) // (100 + percent)
        near, apart = others[fits], apart[fits]
        if not every and len(near) > NEAREST:
            near = near[np.argsort(apart, kind="stable")[:NEAREST]]
        out.append(np.stack([np.minimum(ids[near], ids[i]), np.maximum(ids[near], ids[i])]))
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)


def _group_pairs(work: Scratch, members: DataFrame, vectors: DataFrame, percent: int, every: bool) -> DataFrame:
    """Pairs (a, b) to verify among the members (b, a, root, n) of each pivot, ``BLOCK`` by ``BLOCK``."""
    sized = _grouped(members, "b", least=1)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("a"), blocks).cast("int")
    meets = F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi"))))
    dealt = sized.select("b", "a", "root", "n", own.alias("own"), meets.alias("m")).select("b", "m.lo", "m.hi", "a", "root", "n", "own").join(vectors, "a")

    def pairs(group):
        ids, roots, sizes, side = (group.column(c).to_numpy() for c in ("a", "root", "n", "own"))
        lists = [np.frombuffer(zlib.decompress(v.as_py()), np.uint8) for v in group.column("vector")]
        one, two = near_pairs(ids, roots, sizes, np.stack(lists).astype(np.int16), side, percent, every)
        return pa.table({"a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64())})

    found = dealt.groupBy("b", "lo", "hi").applyInArrow(pairs, "a bigint, b bigint")
    return work.staged(found.distinct().withColumn("star", F.lit(False)), "near-pairs")


def _member_links(spark: SparkSession, work: Scratch, stars: DataFrame, direct: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Linked pairs (u, v) among the members of large groups that links with the pivots do not connect.

    First each member with its nearest, which settles groups of near copies, then every pair that may be linked and is not
    connected yet.
    """
    sizes = classes.select(F.col("id").alias("a"), "n")
    links_, vectors = direct, None
    for every in (False, True):
        roots = connected(spark, links_)
        root_of = lambda node, name: roots.select(F.col("node").alias(node), F.col("root").alias(name))
        placed = stars.join(root_of("a", "root"), "a", "left").join(root_of("b", "pivot_root"), "b", "left").select(
            "a", "b", F.coalesce("root", "a").alias("root"), (F.coalesce("root", "a") != F.coalesce("pivot_root", "b")).alias("far"))
        placed = work.staged(placed, "placed")
        members = work.staged(placed.join(placed.filter("far").select("b").distinct(), "b", "left_semi").join(sizes, "a").select(
            "b", "a", "root", "n"), "group-members")
        vectors = _vectors(work, texts, members, width) if vectors is None else vectors
        pairs = _group_pairs(work, members, vectors, percent, every)
        more = _verified(pairs, texts, width, percent).filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        links_ = work.staged(links_.unionAll(more).distinct(), "member-links")
    return links_


def links(spark: SparkSession, docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links between classes, enough of them to connect every component, as (u, v) of class ids; the classes (id, key); and
    (doc_id, xxh, n, key) of every row. Staged tables go as soon as their last reader is done."""
    wide, narrow, work = Scratch(spark), Scratch(spark), Scratch(spark)
    rows = shingled(wide, docs, width, percent)
    slim = staged(spark, rows.select("doc_id", "xxh", "n", "key"), "document-classes")
    signing = work.staged(_classes(rows, "n", "typical", "hist", "sigs").withColumn(
        "id", F.shiftleft(F.col("typical").cast("long"), 55) + F.monotonically_increasing_id()), "signing-classes")  # ids are in order of ``typical``
    wide.clear()
    classes = narrow.staged(signing.drop("typical", "sigs"), "classes")
    pairs = narrow.staged(_candidates(signing.select(F.explode("sigs").alias("sig"), "id")), "pairs")
    work.clear()
    side = lambda of: classes.select(F.col("id").alias(of), F.col("n").alias(f"n{of}"), F.col("hist").alias(f"h{of}"))
    sizes = lambda of: classes.select(F.col("id").alias(of), F.col("n").alias(f"n{of}"))
    near = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) | F.col("star")
    fitting = pairs.join(sizes("a"), "a").join(sizes("b"), "b").filter(near).select("a", "b", "star")
    open_pairs = narrow.staged(fitting.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ha", "hb", "star").mapInArrow(
        _within_bound(percent), "a bigint, b bigint, star boolean"), "open")
    wanted = open_pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = _texts(narrow, docs, classes.select("id", "rep").join(wanted, "id", "left_semi"))
    verified = narrow.staged(_verified(open_pairs, texts, width, percent), "verified")
    direct = staged(spark, verified.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v")), "direct-links")
    stars = verified.filter("star").select("a", "b")
    found = staged(spark, _member_links(spark, narrow, stars, direct, classes, texts, width, percent), "class-links")
    names = staged(spark, classes.select("id", "key"), "class-names")
    narrow.clear()
    work.clear()
    return found, names, slim


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs``: doc_id, xxh (hash of the text), n_shingles, class_key, n_links, component_id.

    ``n_links`` counts the links found for the class; inside a large group they are the pivot's, so they connect
    the component but are not all of its pairs. A document without shingles is its own component.
    """
    edges, names, rows = links(spark, docs, width, percent)
    roots = connected(spark, edges)
    classes = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    classes = classes.join(names, "key").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    degree = edges.select(F.explode(F.array("u", "v")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    classes = classes.join(degree, "id", "left")
    components = classes.groupBy("root").agg(F.min("least").alias("component"))
    placed = staged(spark, classes.join(components, "root").select("key", "copies", "component", "n_links"), "placed-classes")
    # Classes with a large share of all rows, HOT at most, need not meet their copies in one task.
    common = F.broadcast(placed.filter(F.col("copies") * HOT > rows.agg(F.count("*")).scalar()))
    found = rows.join(common, "key").unionByName(rows.join(common.select("key"), "key", "left_anti").join(placed, "key", "left"))
    return found.select(
        "doc_id", "xxh", F.col("n").alias("n_shingles"), F.col("key").alias("class_key"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def one_per_group(spark: SparkSession, docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """Rows of ``docs`` that stay: of each component the row with its least id, repeated rows once.

    A component without any id keeps its least text. Documents without shingles all stay.
    """
    found = near_duplicates(spark, docs, width, percent)
    prefix = free_prefix(docs, "nd_")
    first = found.filter("class_key IS NOT NULL").groupBy(F.coalesce(F.col("component_id").cast("string"), F.hex("class_key"))).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "xxh")).alias("first"))
    first = first.select(F.col("first.doc_id").alias(f"{prefix}id"), F.col("first.xxh").alias(f"{prefix}xxh"))
    empty = found.filter("class_key IS NULL").select(F.col("doc_id").alias(f"{prefix}id"), F.col("xxh").alias(f"{prefix}xxh")).distinct()
    marked = docs.withColumn(f"{prefix}hash", F.xxhash64("text"))
    match = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{prefix}id")) & (F.col(f"{prefix}hash") == F.col(f"{prefix}xxh"))
    blank = marked.join(empty, match, "left_semi")
    kept = marked.join(first, match, "left_semi").dropDuplicates(["doc_id", f"{prefix}hash"])
    return kept.unionAll(blank).drop(f"{prefix}hash")
