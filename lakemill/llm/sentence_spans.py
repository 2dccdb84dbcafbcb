"""Removes sentences that repeat: every run of several consecutive sentences is hashed and joined globally.

A sentence ends with a word that ends in ``.``, ``!`` or ``?``, or at a line break. A sentence of more than
``LONG`` words is cut further after each word whose hash is the least of some ``NEAR`` consecutive words of the sentence
(of equal ones the last), so that cuts are at most ``NEAR`` words apart and a passage pasted into other text is cut in
the same places everywhere but for ``NEAR - 1`` words at its ends. A span starts at every sentence or piece. Of whole
sentences it takes ``least_sentences``, and more until it has ``least_words`` words. With a piece of a cut sentence in it, it
takes as many as make ``piece_words`` words, which a single sentence of ordinary length does not have.

So every passage of 50 words holds a whole span, wherever it stands: its first certain cut, the same in every text, lies behind its
first 12 words at most, its last one before its last 12, and the 26 words or more between them are three whole
sentences, or hold a piece. Of the places where a span occurs, the one with the smallest (id, text hash, position) is first;
sentences covered by any other place are removed.

How it runs: a first pass marks in a bit table of fixed size which spans may occur twice; a second
sends the places of these alone, dealt by span, and each task walks through its sorted places once. A span with a
share of all places of 1 in ``HOT`` or more (found in a sample of documents, ``HOT`` of them at most; it steers the dealing alone) is dealt
over ``SALTS`` tasks, whose first places are compared in a second round. A full table lets more places through and loses
none. Documents from which nothing goes are not shuffled.

Defined cases: null and empty texts have no sentence and stay as they are; a null id sorts last; repeated rows
(same id, same text) are one document, and each keeps the same text; a document has its own later repeats
removed too; texts shorter than a span stay whole; a very long text is one value of its row and is worked off in memory linear in it.
Ties are broken as said above. Spans are compared by two independent 64-bit hashes of their words. Other columns pass through,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm.bit_tables import Repeated
from lakemill.llm.frames import Batches, extended, free_prefix, staged, text_bytes
from lakemill.llm.shingles import Powers, WordHasher, mixed

LONG, NEAR = 12, 7
PIECE_WORDS = 24
HOT, SALTS = 1000, 32
SAMPLE = 64
SLOTS = 1 << 20
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord("!"), ord("?")]] = True
_OTHER = np.uint64(0xA0761D6478BD642F)


def least_nearby(hashes: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """Whether each word's hash is the least, and the last such, of some ``NEAR`` consecutive words of its sentence."""
    out = np.zeros(len(hashes), bool)
    if len(hashes) >= NEAR:
        windows = np.lib.stride_tricks.sliding_window_view(hashes, NEAR)[sentence[NEAR - 1:] == sentence[:len(sentence) - NEAR + 1]]
        starts = np.flatnonzero(sentence[NEAR - 1:] == sentence[:len(sentence) - NEAR + 1])
        out[starts + NEAR - 1 - windows[:, ::-1].argmin(1)] = True
    return out


class Cut:
    """A text cut into sentences and pieces of long ones."""

    def __init__(self, data: bytes, hasher: WordHasher) -> None:
        begin, end, self.hashes = hasher.words(data)
        n = len(self.hashes)
        self.data, self.word_begin, self.word_end = data, begin, end
        self.first = self.of = np.zeros(0, np.int64)
        self.piece = np.zeros(0, bool)
        if not n:
            return
        raw = np.frombuffer(data, np.uint8)
        last = _STOP[raw[end - 1]]
        before = np.searchsorted(begin, np.flatnonzero(raw == 10)) - 1
        last[before[before >= 0]] = True
        last[-1] = True
        ends = np.flatnonzero(last)
        length = np.diff(ends, prepend=-1)
        long = np.repeat(length > LONG, length)
        sentence = np.repeat(np.arange(len(ends)), length)
        cut = last.copy()
        if long.any():
            cut[long] |= least_nearby(self.hashes[long], sentence[long])
        #: First word, sentence, and whether it is a piece of a cut sentence, of each part.
        self.first = np.concatenate([[0], np.flatnonzero(cut)[:-1] + 1])
        self.of, self.piece = sentence[self.first], long[self.first]

    def spans(self, least_sentences: int, least_words: int, piece_words: int = PIECE_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """The parts that start a span, and the part behind the end of each."""
        n, k = len(self.hashes), len(self.first)
        if not k or n < least_words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bounds = np.append(self.first, n)
        at = np.flatnonzero(self.piece)
        piece = np.append(at, k)[np.searchsorted(at, np.arange(k))]  # the first piece at or behind each part
        whole = np.maximum(np.searchsorted(bounds, self.first + least_words), np.arange(k) + least_sentences)
        with_piece = np.maximum(np.searchsorted(bounds, self.first + max(piece_words, least_words)), piece + 1)
        stop = np.where(whole <= piece, whole, with_piece)
        starts = np.flatnonzero(stop <= k)
        return starts, stop[starts]

    def first_hashes(self, hasher: "Hasher", starts: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """A hash of the words of each span."""
        return hasher.ranges(self.hashes, self.first[starts], np.append(self.first, len(self.hashes))[stop])

    def second_hashes(self, hasher: "Hasher", starts: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """An independent one: its words' hashes come from their bytes through another table."""
        other = hasher.other(self.data, self.word_begin, self.word_end)
        return hasher.ranges(other, self.first[starts], np.append(self.first, len(self.hashes))[stop])


class Hasher(WordHasher):
    """Word hashes, and a second one that no collision of the first is likely to share."""

    def __init__(self) -> None:
        super().__init__()
        self.table = mixed(np.arange(256, dtype=np.uint64) + _OTHER)

    def other(self, data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.hashes(self.table[np.frombuffer(data, np.uint8)], begin, end)


def _spans_of(batch: pa.RecordBatch, hasher: Hasher, rules: tuple[int, int]) -> Iterator[tuple[int, Cut, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, cut text, starts, ends, first hashes) of every text with a span; the text is the batch's last column."""
    for row, v in enumerate(batch.column(batch.num_columns - 1)):
        cut = Cut(v.as_py(), hasher)
        starts, stop = cut.spans(*rules)
        if len(starts):
            yield row, cut, starts, stop, cut.first_hashes(hasher, starts, stop)


def _repeated(docs: DataFrame, rules: tuple[int, int]) -> Repeated:
    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        hasher = Hasher()
        for *_, h1 in _spans_of(batch, hasher, rules):
            yield h1

    return Repeated(_rows(docs), hashes)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("xxh"), text_bytes().alias("t"))


def _hot_spans(docs: DataFrame, rules: tuple[int, int]) -> list[int]:
    """First hashes of spans with a large share of the places of a sample of documents, ``HOT`` at most."""

    def run(batches: Batches) -> Batches:
        hasher = Hasher()
        for batch in batches:
            found = [h1 for *_, h1 in _spans_of(batch, hasher, rules)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["h1"])

    drawn = _rows(docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE)) == 0))
    counts = staged(docs.sparkSession, drawn.mapInArrow(run, "h1 long").groupBy("h1").agg(F.count("*").alias("n")), "sampled-spans")
    everything = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [r.h1 for r in counts.filter((F.col("n") > 1) & (F.col("n") * HOT >= everything)).limit(HOT).collect()]


def _places(docs: DataFrame, rules: tuple[int, int], repeated: Repeated, hot: list[int]) -> DataFrame:
    """(h1, h2, salt, no_id, doc_id, xxh, pos): where spans start that may occur twice."""
    names = ["h1", "h2", "salt", "no_id", "doc_id", "xxh", "pos"]

    def run(batches: Batches) -> Batches:
        hasher, may_repeat, common = Hasher(), repeated.worker(), np.array(hot, np.int64)
        for batch in batches:
            columns = [[] for _ in names]
            for row, cut, starts, stop, h1 in _spans_of(batch, hasher, rules):
                found = np.flatnonzero(may_repeat(h1))
                if len(found):
                    h2 = cut.second_hashes(hasher, starts[found], stop[found])
                    one, pos, doc, xxh = h1[found].view(np.int64), starts[found], batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                    salt = np.full(len(pos), -1)
                    if len(common):
                        seed = np.uint64(hash((doc or 0, xxh)) & (1 << 63) - 1)
                        salt = np.where(np.isin(one, common), mixed(pos.astype(np.uint64) + seed) % np.uint64(SALTS), salt)
                    values = (one, h2.view(np.int64), salt, np.full(len(pos), doc is None), np.full(len(pos), doc or 0), np.full(len(pos), xxh), pos)
                    for column, value in zip(columns, values):
                        column.append(value)
            if columns[0]:
                types = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(columns, types)], names=names)

    return _rows(docs).mapInArrow(
        run, "h1 long, h2 long, salt int, no_id boolean, doc_id long, xxh long, pos long")


def _walked(places: DataFrame) -> DataFrame:
    """(no_id, doc_id, xxh, pos, h1, h2) of places that are not first of their span and salt, and of the first ones of salted
    spans; hashes only for the latter."""
    names = ["no_id", "doc_id", "xxh", "pos", "h1", "h2"]

    def run(batches: Batches) -> Batches:
        before = place = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, salt, no_id, doc, xxh, pos = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            changed = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (salt[1:] != salt[:-1])
            first = np.r_[(h1[0], h2[0], salt[0]) != before, changed]
            same = (no_id[1:] == no_id[:-1]) & (doc[1:] == doc[:-1]) & (xxh[1:] == xxh[:-1]) & (pos[1:] == pos[:-1])
            # A repeated row's place is the same place.
            again = np.r_[place == (no_id[0], doc[0], xxh[0], pos[0]) and not first[0], same & ~first[1:]]
            before, place = (h1[-1], h2[-1], salt[-1]), (no_id[-1], doc[-1], xxh[-1], pos[-1])
            salted = first & (salt >= 0)
            kept = pa.array((~first & ~again) | salted)
            hashes = [pa.array(h, pa.int64(), mask=~salted) for h in (h1, h2)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i).filter(kept) for i in range(3, 7)), *(h.filter(kept) for h in hashes)], names=names)

    dealt = places.repartition("h1", "h2", "salt").sortWithinPartitions("h1", "h2", "salt", "no_id", "doc_id", "xxh", "pos")
    return dealt.mapInArrow(run, "no_id boolean, doc_id long, xxh long, pos long, h1 long, h2 long")


def repeats(spark: SparkSession, docs: DataFrame, least_sentences: int = 3, least_words: int = 12) -> DataFrame:
    """(doc_id, xxh, starts): the sentences at which a non-first repeated span starts, per document."""
    rules = (least_sentences, least_words)
    repeated = _repeated(docs, rules)
    walked = staged(spark, _walked(_places(docs, rules, repeated, _hot_spans(docs, rules))), "later-places")
    repeated.destroy()
    place = ["no_id", "doc_id", "xxh", "pos"]
    salted = walked.filter("h1 is not null")
    # One row per salt of a common span: SALTS times HOT at most.
    firsts = salted.groupBy("h1", "h2").agg(F.min(F.struct(*place)).alias("first"))
    second = salted.join(F.broadcast(firsts), ["h1", "h2"]).filter(F.struct(*place) != F.col("first"))
    later = walked.filter("h1 is null").select(*place).unionAll(second.select(*place))
    return later.groupBy(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "xxh").agg(F.collect_set("pos").alias("starts"))


def without_repeats(spark: SparkSession, docs: DataFrame, least_sentences: int = 3, least_words: int = 12) -> tuple[DataFrame, str]:
    """``docs`` with their text cut, and behind a free prefix how many sentences it had, of how many something went, and
    how many words went; and that prefix."""
    p = free_prefix(docs, "sd_")
    rules = (least_sentences, least_words)
    found = staged(spark, repeats(spark, docs, *rules).select(
        F.col("doc_id").alias(f"{p}id"), F.col("xxh").alias(f"{p}xxh"), F.col("starts").alias(f"{p}starts")), "repeats")
    slot = lambda i, x: F.pmod(F.xxhash64(i, x), F.lit(SLOTS))
    slots = F.broadcast(found.select(slot(f"{p}id", f"{p}xxh").alias(f"{p}slot")).distinct())  # SLOTS rows at most
    marked = docs.withColumn(f"{p}hash", F.xxhash64("text")).withColumn(f"{p}slot", slot(F.col("doc_id").cast("long"), F.col(f"{p}hash")))
    match = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{p}id")) & (F.col(f"{p}hash") == F.col(f"{p}xxh"))
    plain = [F.col(f"`{c}`") for c in docs.columns]
    touched = marked.join(slots, f"{p}slot", "left_semi").join(found, match, "left").select(*plain, f"{p}starts")
    joined = marked.join(slots, f"{p}slot", "left_anti").select(*plain, F.lit(None).cast("array<bigint>").alias(f"{p}starts")).unionAll(touched)
    at, keep = docs.columns.index("text"), len(docs.columns)
    schema = extended(docs, f"`{p}sentences` bigint, `{p}removed` bigint, `{p}words` bigint")

    def run(batches: Batches) -> Batches:
        hasher = Hasher()
        for batch in batches:
            texts, counts = [], []
            for text, starts in zip(batch.column(at).to_pylist(), batch.column(keep).to_pylist()):
                data = (text or "").encode()
                cut = Cut(data, hasher)
                covered = np.zeros(len(cut.first), bool)
                if starts:
                    edges = np.zeros(len(cut.first) + 1, np.int64)
                    at_start, stop = cut.spans(*rules)
                    np.add.at(edges, np.array(starts), 1)
                    np.add.at(edges, stop[np.searchsorted(at_start, np.array(starts))], -1)
                    covered = np.cumsum(edges)[:-1] > 0
                words = np.diff(np.append(cut.first, len(cut.hashes)))
                whole = int(cut.of[-1]) + 1 if len(cut.of) else 0
                counts.append((whole, len(np.unique(cut.of[covered])), int(words[covered].sum())))
                if covered.any():
                    bounds = np.append(cut.word_begin[cut.first], len(data))
                    data = data[:bounds[0]] + b"".join(data[bounds[i]:bounds[i + 1]] for i in np.flatnonzero(~covered))
                    text = data.decode()
                texts.append(text)
            rows = np.array(counts, np.int64).reshape(-1, 3)
            arrays = [batch.column(i) for i in range(keep)] + [pa.array(rows[:, i]) for i in range(3)]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return joined.mapInArrow(run, schema), p
