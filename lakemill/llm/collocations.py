"""Phrase collocations by Toivonen's sampling: frequent phrases proposed by a sample, counted exactly on everything.

A phrase is frequent in a language if it stands at least ``least`` times there, and then so are all phrases inside it. So a phrase
must be counted only if the two phrases that lack its last and its first word are known; phrases that
are known, and those that are not though both of these are (the negative border), are counted together.

1. A sample of documents, by hash of the id, proposes the phrases that reach a lowered count in it, mined length by length.
2. One full pass counts the proposed phrases and their negative border, words always.
3. A frequent phrase of the border is one the sample missed, and phrases that contain it may not have been counted. The
   next pass adds those to the known phrases and counts what they add to the border. Passes go on until none brings a
   frequent phrase that was not known: by induction over the length every frequent phrase is counted then, whatever
   the sample held. If few were missed, one pass is enough: it takes what it counts for the first time as known, and so counts all
   longer phrases that the missed ones may bring.
4. A last pass spells the frequent phrases and counts each by itself; what tasks have found meets by bucket of the first hash.

Up to then phrases are 64-bit hashes of language and words: two that share one can only be counted too high, so no frequent phrase is
lost, and the last pass tells them apart by 128 bits. A pass adds up its own counts ``HELD`` places at a time before anything is
shuffled. Workers look phrases up in a bit table of fixed size (2^``BITS`` bits, sent to each worker): a wrongly set bit only makes
them count a phrase more, so results do not depend on it, and with more phrases than bits the passes count more and stay exact.
Frequent phrases are never gathered: cuts, scores, containment and ranks are joins on the phrase.

Null texts and texts without words add nothing; a null language is ``und``. Pieces (text between delimiters) of any length are kept
whole, very long texts are worked off ``PART`` bytes at a time, cut behind a delimiter. Repeated rows count again, ties
end as documented in :func:`ranked`, an empty table gives no rows. Columns other than the id, the text and the language are not read, so
their names cannot clash. Scores are exact while 1000 * a * n is below 10^38; beyond that Spark raises an error.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakemill.llm.frames import Batches, Scratch, staged, text_bytes
from lakemill.llm.shingles import Powers, mixed

LONGEST = 5
SAMPLE = 8  # the sample is every document whose hash is divisible by this
FEW = 8  # missed phrases are few if this many times more were known
BITS = 27
BUCKETS = 1 << 10  # of first hashes, which the last pass sends together
PART = 1 << 19
HELD = 1 << 18
ROWS = 1 << 15  # rows handed to Spark at once
SPELT = 1 << 20  # phrases a worker counts before it sends them on, half as many as it can remember as spelt

_DELIMITER = np.zeros(256, bool)
_DELIMITER[list(b".,;:!?\n\x0b\x0c\r")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t")] = True
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_SECOND = np.uint64(0xA0761D6478BD642F)


class _Hasher(Powers):
    """Two independent 64-bit hashes of byte ranges."""

    def __init__(self) -> None:
        super().__init__()
        rng = np.random.default_rng(20_011)
        self.tables = [rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]

    def words(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        return self.ranges(self.tables[which][raw], begin, end)


def lang_number(lang: str) -> tuple[np.uint64, np.uint64]:
    data = lang.encode()
    return np.uint64(zlib.crc32(data) << 32 | zlib.adler32(data)), np.uint64(zlib.crc32(data[::-1]) << 32 | zlib.crc32(data + b"#"))


def parts(data: bytes) -> list[bytes]:
    """``data`` in parts of about ``PART`` bytes, each but the last ending with a delimiter."""
    found, at = [], 0
    while len(data) - at > PART:
        stop = at + PART
        while stop < len(data):
            window = np.frombuffer(data[stop:stop + PART], np.uint8)
            hits = np.flatnonzero(_DELIMITER[window])
            if len(hits):
                stop += int(hits[0]) + 1
                break
            stop += len(window)
        found.append(data[at:stop])
        at = stop
    return found + [data[at:]] if at < len(data) or not found else found


class _Block:
    """Texts of a batch as one run of bytes: words, the piece each lies in, and its language."""

    def __init__(self, texts: list[bytes], langs: list[int]) -> None:
        self.data = b"\n".join(texts).lower() + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        stops = _DELIMITER[raw]
        outside = np.ones(len(raw) + 2, bool)
        outside[1:-1] = stops | _SPACE[raw]
        edge = np.flatnonzero(outside[1:] != outside[:-1])
        self.begin, self.end = edge[::2], edge[1::2]
        self.piece = np.cumsum(stops, dtype=np.int32)[self.begin] if len(self.begin) else np.zeros(0, np.int32)
        self.raw = raw
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.lang = np.array(langs, np.int32)[np.searchsorted(ends, self.begin, side="right")] if len(self.begin) else np.zeros(0, np.int32)

    def spelt(self, first: int, k: int) -> bytes:
        return b" ".join(self.data[self.begin[first]:self.end[first + k - 1]].split())


def _blocks(batches: Batches):
    """Blocks of about ``PART`` bytes, with the names of their languages."""
    texts, numbers, names, size = [], [], {}, 0
    for batch in batches:
        for value, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            text = value.as_py()  # one at a time: a batch holds thousands
            for part in parts(text) if len(text) > PART else [text]:
                texts.append(part)
                numbers.append(names.setdefault(lang, len(names)))
                size += len(part) + 1
                if size >= PART:
                    yield _Block(texts, numbers), list(names)
                    texts, numbers, size = [], [], 0
    if texts:
        yield _Block(texts, numbers), list(names)


def _hashed(block: _Block, names: list[str], hasher: _Hasher, longest: int, which: int = 0):
    """Per length k: which places hold a phrase (inside one piece), and a hash of each."""
    word = hasher.words(block.raw, block.begin, block.end, which)
    mark = np.array([lang_number(n)[which] for n in names], np.uint64)[block.lang]
    total = np.zeros(len(word), np.uint64)
    for k in range(1, longest + 1):
        m = len(word) - k + 1
        if m <= 0:
            return
        total = total[:m] + word[k - 1:] * _ODD[k - 1]
        yield k, block.piece[k - 1:] == block.piece[:m], mixed(total + mark[:m] * _SECOND + np.uint64(k))


class _Counter:
    """Places collected and added up ``HELD`` at a time."""

    def __init__(self) -> None:
        self.kept, self.size = [], 0

    def add(self, *hashes: np.ndarray) -> None:
        self.kept.append(hashes)
        self.size += len(hashes[0])

    def taken(self) -> Iterator[pa.RecordBatch]:
        found, n = np.unique(np.concatenate([h for h, in self.kept]), return_counts=True)
        self.kept, self.size = [], 0
        yield from _sliced([found, n], ["h1", "n"])


class _Totals(_Counter):
    """The same for pairs of hashes, kept over a whole task as far as they are ``SPELT`` at most, in parts of falling size."""

    def __init__(self) -> None:
        super().__init__()
        self.parts: list[list[np.ndarray]] = []

    def settle(self) -> None:
        if not self.size:
            return
        self.parts.append(_added_up(*(np.concatenate(h) for h in zip(*self.kept)), np.ones(self.size, np.int64)))
        self.kept, self.size = [], 0
        while len(self.parts) > 1 and 2 * len(self.parts[-1][0]) >= len(self.parts[-2][0]):
            one, two = self.parts.pop(), self.parts.pop()
            self.parts.append(_added_up(*(np.concatenate(h) for h in zip(one, two))))

    def held(self) -> int:
        return sum(len(h1) for h1, _, _ in self.parts)

    def taken(self) -> list[np.ndarray]:
        self.settle()
        found, self.parts = self.parts, []
        return [np.concatenate([np.zeros(0, t), *c]) for t, c in zip((np.uint64, np.uint64, np.int64), zip(*found) if found else ((), (), ()))]


def _added_up(h1: np.ndarray, h2: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Sums of ``n`` per pair of hashes, in their order."""
    order = np.argsort(h1, kind="stable")
    if np.any((h1[order][1:] == h1[order][:-1]) & (h2[order][1:] != h2[order][:-1])):
        order = np.lexsort((h2, h1))
    h1, h2, n = h1[order], h2[order], n[order]
    first = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])][:len(h1)])
    return [h1[first], h2[first], np.add.reduceat(n, first) if len(first) else n]


class _Spelt:
    """Phrases a task has spelt, by their second hash, each in one of two slots; one that is put out is spelt again."""

    def __init__(self) -> None:
        self.slots = np.zeros(1 << (2 * SPELT - 1).bit_length(), np.uint64)

    def missing(self, h2: np.ndarray) -> np.ndarray:
        """Places of phrases that are not held, one of each; they are held from now on."""
        one, two = ((h2 >> np.uint64(k)) & np.uint64(len(self.slots) - 1) for k in (0, 32))
        new = np.flatnonzero(((self.slots[one] != h2) & (self.slots[two] != h2)) | (h2 == 0))
        new = new[np.unique(h2[new], return_index=True)[1]]
        self.slots[np.where(self.slots[one[new]] == 0, one[new], two[new])] = h2[new]
        return new


def _bucketed(counts: list[np.ndarray], rows: list[tuple]) -> pa.RecordBatch:
    """A row per bucket of first hashes that has any: its counts, and its phrases as spelt."""
    s1, s2, langs, phrases = zip(*rows) if rows else ((), (), (), ())
    values = [*counts, np.array(s1, np.uint64), np.array(s2, np.uint64)]
    bucket, cut, orders = np.arange(BUCKETS + 1), [], []
    for h1 in (values[0], values[3]):
        at = (h1 >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        orders.append(np.argsort(at, kind="stable"))
        cut.append(np.searchsorted(at[orders[-1]], bucket))
    used = np.flatnonzero(sum(np.diff(c) for c in cut))
    lists = lambda k, x: pa.ListArray.from_arrays(pa.array(np.append(cut[k][used], cut[k][-1]), pa.int32()), x)
    whole = lambda k, x: lists(k, pa.array(x[orders[k]].view(np.int64)))
    named = lambda x: lists(1, pa.array(x, pa.string()).take(pa.array(orders[1])))
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), *(whole(0, x) for x in values[:3]), *(whole(1, x) for x in values[3:]), named(langs), named(phrases)],
        names=["bucket", "h1", "h2", "n", "s1", "s2", "lang", "phrase"])


def _sliced(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[i:i + ROWS].view(np.int64)) for c in columns], names=names)


class Table:
    """The bit table of a set of phrases; it travels compressed, so a few phrases are a few bytes."""

    def __init__(self, spark: SparkSession, phrases: DataFrame) -> None:
        at = (F.col("h1").bitwiseAND((1 << BITS) - 1) + 1).alias("at")
        filled = phrases.select(at).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
        table = np.zeros((1 << BITS) >> 3, np.uint8)
        for bucket, bits in filled:
            table[(bucket - 1) * 4096:(bucket - 1) * 4096 + len(bits)] = np.frombuffer(bits, np.uint8)
        self.shared = spark.sparkContext.broadcast(zlib.compress(table, 1))

    def worker(self):
        table = np.frombuffer(zlib.decompress(self.shared.value), np.uint8)
        low = np.uint64((1 << BITS) - 1)

        def holds(h1: np.ndarray) -> np.ndarray:
            at = h1 & low
            return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0

        return holds


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_bytes().alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))


def border_counts(texts: DataFrame, longest: int, known: Table, before: Table | None, closed: bool = False) -> DataFrame:
    """(h1, n): counts of known phrases and their negative border, without those counted when ``before`` was known.

    If ``closed``, what is counted for the first time is taken as known, so that all longer phrases it may bring are counted too.
    """

    def run(batches: Batches) -> Batches:
        hasher, counter, holds = _Hasher(), _Counter(), known.worker()
        held = before.worker() if before else None
        for block, names in _blocks(batches):
            now = then = None  # per place, whether the phrase of k - 1 words that begins there is, and was, known
            for k, inside, h1 in _hashed(block, names, hasher, longest):
                m = len(h1)
                at = np.flatnonzero(inside if k == 1 else inside & now[:m] & now[1:m + 1])
                if held is None:
                    counter.add(h1[at])
                else:
                    done = np.ones(len(at), bool) if k == 1 else then[at] & then[at + 1]
                    counter.add(h1[at[~done]])
                    then = np.zeros(m, bool)
                    then[at] = done & held(h1[at])
                now = np.zeros(m, bool)
                now[at] = holds(h1[at]) | ~done if closed else holds(h1[at])
            if counter.size >= HELD:
                yield from counter.taken()
        if counter.size:
            yield from counter.taken()

    return texts.mapInArrow(run, "h1 long, n long")


def spelt_counts(texts: DataFrame, longest: int, wanted: Table, least: int) -> DataFrame:
    """(lang, phrase, n) of the wanted phrases that stand ``least`` times or more, by both hashes.

    A task sends its counts, and a spelling of each phrase, as lists by bucket of the first hash; all of a phrase meets in its bucket. The
    empty phrase has the number of words of its language and stands in a bucket of its own.
    """

    def run(batches: Batches) -> Batches:
        hasher, counter, holds, spelt = _Hasher(), _Totals(), wanted.worker(), _Spelt()
        totals, rows = {}, []
        for block, names in _blocks(batches):
            for number, n in zip(*np.unique(block.lang, return_counts=True)):
                totals[names[number]] = totals.get(names[number], 0) + int(n)
            for (k, inside, h1), (_, _, h2) in zip(_hashed(block, names, hasher, longest), _hashed(block, names, hasher, longest, 1)):
                at = np.flatnonzero(inside)
                at = at[holds(h1[at])]
                counter.add(h1[at], h2[at])
                # Phrases that share their first hash are told apart by the second, so that is what is remembered.
                rows += [(h1[i], h2[i], names[block.lang[i]], block.spelt(i, k).decode("utf-8", "replace")) for i in at[spelt.missing(h2[at])].tolist()]
            if counter.size >= HELD:
                counter.settle()
            if counter.held() >= SPELT or 4 * len(rows) >= SPELT:
                yield _bucketed(counter.taken(), rows)
                rows = []
        if counter.size or counter.parts or rows:
            yield _bucketed(counter.taken(), rows)
        if totals:
            nothing = pa.array([[]], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32()), nothing, nothing, pa.array([list(totals.values())], pa.list_(pa.int64())), nothing, nothing,
                 pa.array([list(totals)], pa.list_(pa.string())), pa.array([[""] * len(totals)], pa.list_(pa.string()))],
                names=["bucket", "h1", "h2", "n", "s1", "s2", "lang", "phrase"])

    def met(key, group):
        flat = lambda name: group.column(name).combine_chunks().flatten()
        lang, phrase, n = flat("lang"), flat("phrase"), flat("n").to_numpy()
        if key[0].as_py() < 0:
            names, which = np.unique(np.array(lang.to_pylist(), object), return_inverse=True)
            sums = np.zeros(len(names), np.int64)
            np.add.at(sums, which, n)
            return pa.table({"lang": pa.array(names.tolist(), pa.string()), "phrase": pa.array([""] * len(names)), "n": sums})
        hashes = lambda *c: [flat(x).to_numpy().view(np.uint64) for x in c]
        n = _added_up(*hashes("h1", "h2"), n)[2]
        s1, s2 = hashes("s1", "s2")
        order = np.lexsort((s2, s1))
        s1, s2 = s1[order], s2[order]
        first = order[np.r_[True, (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])]]  # every phrase counted is spelt, and no other: the same order
        kept = np.flatnonzero(n >= least)
        return pa.table({"lang": lang.take(pa.array(first[kept])), "phrase": phrase.take(pa.array(first[kept])), "n": n[kept]})

    sent = texts.mapInArrow(run, "bucket int, h1 array<bigint>, h2 array<bigint>, n array<bigint>, "
                                 "s1 array<bigint>, s2 array<bigint>, lang array<string>, phrase array<string>")
    return sent.groupBy("bucket").applyInArrow(met, "lang string, phrase string, n bigint")


def lowered(least: int, share: float) -> int:
    """A count that a phrase of ``least`` places reaches in the sample nearly always: two deviations below the mean."""
    mean = least * share
    return max(1, math.floor(mean - 2 * math.sqrt(mean)))


def frequent_phrases(
    spark: SparkSession, docs: DataFrame, least: int = 100, longest: int = LONGEST, sample: int = SAMPLE,
) -> DataFrame:
    """(lang, phrase, n) of every phrase of 1 to ``longest`` words that stands ``least`` times or more.

    The empty phrase stands for all words of a language.
    """
    work = Scratch(spark)
    texts = _texts(docs)
    drawn = _texts(docs.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(sample)) == 0))
    nothing = spark.createDataFrame([], "h1 long")
    proposed = _grown(spark, work, drawn, nothing, lowered(least, 1 / sample), longest, rounds=longest)
    frequent = _grown(spark, work, texts, proposed, least, longest)
    table = Table(spark, frequent)
    found = staged(spark, spelt_counts(texts, longest, table, least), "phrases")
    table.shared.destroy()
    work.clear()
    return found


def _grown(spark: SparkSession, work: Scratch, texts: DataFrame, known: DataFrame, least: int, longest: int, rounds: int | None = None) -> DataFrame:
    """First hashes of all phrases with ``least`` places, and of no other, up to chance: passes go on until none brings a phrase that was not known.

    With ``rounds`` passes end there: from nothing known each finds the phrases of one more word.
    """
    found, before, closed = spark.createDataFrame([], "h1 long"), None, False
    while rounds is None or rounds > 0:
        table = Table(spark, known)
        counts = border_counts(texts, longest, table, before, closed).groupBy("h1").agg(F.sum("n").alias("n"))
        more = work.staged(counts.filter(F.col("n") >= least).select("h1"), "counted")
        if before:
            before.shared.destroy()
        before, found = table, found.unionAll(more)
        missed = more.join(known, "h1", "left_anti")
        if closed or not (n_missed := missed.count()):
            break
        closed = rounds is None and n_missed * FEW <= known.count()
        known = work.staged(known.unionAll(missed), "known")
        rounds = rounds and rounds - 1
    before.shared.destroy()
    return found


def ranked(phrases: DataFrame, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each language by association.

    A phrase of a places is cut into a first part of l and a rest of r; with n words in its language the cut's score is
    floor(1000 a n / (l r)), and the lowest cut counts, on equal scores the shortest first part. Phrases that stand in a
    longer one as often as at all are left out. Ties go to the more frequent, then by the phrase's bytes.
    """
    words = F.split("phrase", " ")
    total = phrases.filter("phrase = ''").select("lang", F.col("n").alias("total"))
    known = phrases.filter("phrase != ''")
    candidates = known.withColumn("words", words).filter(F.size("words") > 1)
    # A phrase lies in a longer one of as many places only if it lies in one of a single word more.
    shorter = candidates.filter(F.size("words") > 2).select("lang", "n", F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.size("words") - 1), " "),
        F.array_join(F.slice("words", F.lit(2), F.size("words") - 1), " "))).alias("phrase"))
    within = shorter.groupBy("lang", "phrase").agg(F.max("n").alias("within"))
    open_ = candidates.join(within, ["lang", "phrase"], "left").filter("within is null or 100 * within < 100 * n").drop("within")
    cuts = open_.select("lang", "phrase", F.col("n").alias("a"), F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda i: F.struct(F.array_join(F.slice("words", F.lit(1), i), " ").alias("first"),
                           F.array_join(F.slice("words", i + 1, F.size("words") - i), " ").alias("rest")))).alias("k", "cut"))
    part = lambda name, n: known.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    scored = (
        cuts.select("lang", "phrase", "a", "k", "cut.first", "cut.rest")
        .join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(F.broadcast(total), "lang")
        .withColumn("score", F.expr("(cast(1000 * a as decimal(19,0)) * cast(total as decimal(19,0))) "
                                    "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")))
    best = scored.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("a").desc(), "phrase")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")


def collocations(spark: SparkSession, docs: DataFrame, least: int = 100, top: int = 2000, sample: int = SAMPLE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest collocations of 2 to ``LONGEST`` words per language."""
    return ranked(frequent_phrases(spark, docs, least, sample=sample), top)
