"""SentencePiece encoding and decoding: merges of a BPE model, a relational lattice for a unigram model.

Texts are cut into *segments* where no piece can reach across: between two ASCII bytes that stand next to each
other in no piece (so before every space that follows a word, around line breaks, mostly between a word and
its full stop). Equal segments have equal ids, so each is encoded once among the texts it is met in.

A BPE model's scores are merge ranks. A task takes the distinct segments of some hundred texts, those of equal length as
one matrix of symbols, and applies to every row its best merge until none is left, which gives the public library's ids.
Nothing is shuffled, gathered or looked up elsewhere.

For a unigram model the substrings of each distinct segment of all texts are exploded and equi-joined with the piece table; the
matches, grouped by segment, are the edges of its lattice; Viterbi over the sum of scores is a fold with Spark's
``aggregate``. Segments are then looked up in the texts by hash: the most frequent ones (at most ``HEAD``, a fixed bound) in a
table every task holds, all others by a join on the documents that have them.

Decoding concatenates the pieces' bytes. Space and U+2581 are the same character to the model, and text that is not valid UTF-8
becomes U+FFFD; other texts come back exactly.

Defined cases: null stays null with null ids; an empty text has no ids; characters outside the table become byte
pieces; segments of more than ``WIDE`` characters (a row of a matrix costs its width per merge) take the same merges from a heap;
repeated rows and null ids are encoded like any other; of merges of equal rank the leftmost goes first; a very long text is cut into
segments as one value. Results stand behind a prefix that no column has.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemill.llm.frames import Scratch, extended, free_prefix, in_parts
from lakemill.llm.shingles import WordHasher

HEAD = 1 << 22
PER_TASK = 20_000
WIDE = 60
TOGETHER = 1000  # texts whose segments are encoded together: more repeat more, and hold more at once
BROADCAST_PIECES = 1 << 18
PIECE_FILE = "piece_bpe_32k.model"
_MARK = "▁"


@dataclass
class Pieces:
    """A piece table: ``pieces`` holds (text with plain spaces, id, score); ids of the 256 bytes follow ``first_byte``."""

    kind: str
    pieces: list[tuple[str, int, float]]
    first_byte: int
    unknown: int

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)

    def cuts(self) -> np.ndarray:
        """256 x 256: whether a text may be cut between two bytes."""
        seen = np.zeros((256, 256), bool)
        seen[128:] = seen[:, 128:] = True
        for piece, _, _ in self.pieces:
            raw = piece.encode()
            for pair in zip(raw, raw[1:]):
                seen[pair] = True
        return ~seen

    def table(self) -> list[bytes]:
        """The bytes of every id; control pieces have none."""
        out = [b""] * (1 + max([self.first_byte + 255, self.unknown, *(i for _, i, _ in self.pieces)]))
        for b in range(256):
            out[self.first_byte + b] = bytes([b])
        for piece, i, _ in self.pieces:
            out[i] = piece.encode()
        return out


def load_pieces(path: str | None = None, kind: str = "bpe") -> Pieces:
    """Read a model file on the driver; workers get the table, never the file."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(PIECE_FILE)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
    ids = range(model.get_piece_size())
    pieces = [(model.id_to_piece(i).replace(_MARK, " "), i, model.get_score(i)) for i in ids if not special(i)]
    return Pieces(kind, pieces, next(i for i in ids if model.is_byte(i)), model.unk_id())


def prepared(text: str) -> bytes:
    """The bytes that are cut and encoded: a space in front, the model's space mark as a space."""
    return b" " + text.encode(errors="replace").replace(_MARK.encode(), b" ") if text else b""


def segments(data: bytes, cuts: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and hash of each segment."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    begin = np.append(0, np.flatnonzero(cuts[raw[:-1], raw[1:]]) + 1)
    end = np.append(begin[1:], len(raw))
    return begin, end, hasher.hashes(raw, begin, end)


def merged(segment: str, rank: dict[str, float]) -> list[str]:
    """The symbols of a segment after all merges, by a heap: for segments too long for the fold."""
    n = len(segment)
    left, right, stop, alive = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1)), [True] * n
    heap: list[tuple[float, int, int, int]] = []

    def offer(i: int) -> None:
        j = right[i]
        if j < n and (score := rank.get(segment[i:stop[j]])) is not None:
            heapq.heappush(heap, (-score, i, stop[i], stop[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, middle, end = heapq.heappop(heap)
        if not alive[i] or stop[i] != middle or middle >= n or not alive[middle] or stop[middle] != end:
            continue
        alive[middle], stop[i], right[i] = False, end, right[middle]
        if right[middle] < n:
            left[right[middle]] = i
        if left[i] >= 0:
            offer(left[i])
        offer(i)
    return [segment[i:stop[i]] for i in range(n) if alive[i]]


class Merges:
    """The merges of a BPE table over symbols: a piece by its place in the table, then other characters of pieces, then code points."""

    def __init__(self, pieces: Pieces) -> None:
        names = [p for p, _, _ in pieces.pieces]
        self.others = sorted({c for p in names for c in p} - set(names))
        number = {s: k for k, s in enumerate(names + self.others)}
        rank = {cost: k for k, cost in enumerate(sorted({-score for _, _, score in pieces.pieces}))}
        self.base, self.none, self.first_byte = len(number), len(rank), pieces.first_byte
        self.ids = np.array([i for _, i, _ in pieces.pieces], np.int32)
        self.score = {p: score for p, _, score in pieces.pieces}
        found = {}
        for piece, _, score in pieces.pieces:
            for cut in range(1, len(piece)):
                if (a := number.get(piece[:cut])) is not None and (b := number.get(piece[cut:])) is not None:
                    found[a << 32 | b] = rank[-score], number[piece]
        keys = sorted(found)
        self.keys = np.array([*keys, np.iinfo(np.int64).max], np.int64)  # one more, which no pair has
        self.ranks = np.array([*(found[k][0] for k in keys), self.none], np.int32)
        self.into = np.array([*(found[k][1] for k in keys), 0], np.int32)
        self.number = number

    @classmethod
    def of(cls, tables: dict) -> Merges:
        """From ``vars`` of another: workers may not have this module, so only these are sent."""
        self = cls.__new__(cls)
        vars(self).update(tables)
        self.character = np.arange(self.base, self.base + 0x110000, dtype=np.int32)
        for s, k in self.number.items():
            if len(s) == 1:
                self.character[ord(s)] = k
        return self

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of two symbols (``none`` without one) and the symbol it gives."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], np.int32(self.none)), self.into[at]

    def merged(self, s: np.ndarray):
        """(rows, symbols) of the rows of a matrix after all merges: each step takes the best of every row, the leftmost of equals."""
        rows = np.arange(len(s))
        rank, into = self.pairs(s[:, :-1], s[:, 1:])
        while s.shape[1] > 1 and len(rows):
            at, i = rank.argmin(1), np.arange(len(rows))
            more = rank[i, at] < self.none
            if not more.all():
                yield rows[~more], s[~more]
                rows, s, rank, into, at = (x[more] for x in (rows, s, rank, into, at))
                i = np.arange(len(rows))
            s[i, at] = into[i, at]
            s, rank, into = (_without(x, gone) for x, gone in ((s, at + 1), (rank, at), (into, at)))
            for j, k in ((np.flatnonzero(at > 0), -1), (np.flatnonzero(at < s.shape[1] - 1), 0)):
                place = at[j] + k
                rank[j, place], into[j, place] = self.pairs(s[j, place], s[j, place + 1])
        yield rows, s

    def encoded(self, data: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of the segments ``data[begin:end]``, one list after the other."""
        raw = np.frombuffer(data, np.uint8)[spread(np.append(begin, 0), np.arange(len(begin)), end - begin)]
        starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[np.concatenate([[0], np.cumsum(end - begin)])]
        text = raw.tobytes().decode()
        symbols, size = self.character[np.frombuffer(text.encode("utf-32-le"), np.uint32)], np.diff(starts)
        done, order = [], np.argsort(size, kind="stable")
        lengths, first = np.unique(size[order], return_index=True)
        for length, mine in zip(lengths.tolist(), np.split(order, first[1:]) if len(order) else []):
            if length <= WIDE:
                done += [(mine[rows], s) for rows, s in self.merged(symbols[starts[mine][:, None] + np.arange(length)])]
                continue
            for m in mine.tolist():
                path = merged(text[starts[m]:starts[m + 1]], self.score)
                done.append((np.array([m]), np.array([[self.number[x] if x in self.number else self.base + ord(x) for x in path]])))
        size = np.zeros(len(begin), np.int64)
        for mine, s in done:
            size[mine] = s.shape[1]
        offsets = np.concatenate([[0], np.cumsum(size)])
        flat = np.zeros(offsets[-1], np.int64)
        for mine, s in done:
            flat[offsets[mine][:, None] + np.arange(s.shape[1])] = s
        return self._with_bytes(offsets, flat)

    def _with_bytes(self, offsets: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols to ids; a character that is no piece becomes its bytes."""
        odd = np.flatnonzero(flat >= len(self.ids))
        if not len(odd):
            return offsets, self.ids[flat]
        kinds, which = np.unique(flat[odd], return_inverse=True)
        raw = [(self.others[k - len(self.ids)] if k < self.base else chr(k - self.base)).encode() for k in kinds.tolist()]
        width, size = np.array([len(x) for x in raw])[which], np.ones(len(flat), np.int64)
        size[odd] = width
        place = np.concatenate([[0], np.cumsum(size)])
        out = np.zeros(place[-1], np.int32)
        out[place[:-1]] = self.ids[np.minimum(flat, len(self.ids) - 1)]
        table = np.array([[*x, 0, 0, 0][:4] for x in raw], np.int32)[which] + self.first_byte
        for t in range(4):
            here = width > t
            out[place[odd[here]] + t] = table[here, t]
        return place[offsets], out


def _without(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A matrix without one entry of each row."""
    keep = np.ones(x.shape, bool)
    keep[np.arange(len(x)), at] = False
    return x[keep].reshape(len(x), x.shape[1] - 1)


def _substrings(distinct: DataFrame, pieces: Pieces) -> DataFrame:
    """(hash, segment, s, e, id, score) of every substring that is a piece; id is null for characters outside the table."""
    table = distinct.sparkSession.createDataFrame(pieces.pieces, "sub string, id int, score double")
    table = F.broadcast(table) if len(pieces.pieces) <= BROADCAST_PIECES else table
    size = F.length("segment")
    spans = F.flatten(F.transform(F.sequence(F.lit(0), size - 1), lambda s: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(pieces.longest), size - s)),
        lambda k: F.struct(s.alias("s"), (s + k).alias("e"), F.substring(F.col("segment"), s + 1, k).alias("sub")))))
    subs = distinct.select("hash", "segment", F.explode(spans).alias("x")).select("hash", "segment", "x.s", "x.e", "x.sub")
    return subs.join(table, "sub", "left").filter("id IS NOT NULL OR e = s + 1").drop("sub")


def _byte_ids(character: Column, pieces: Pieces) -> Column:
    code = F.hex(character)
    return F.transform(F.sequence(F.lit(0), F.octet_length(character) - 1), lambda k: (
        F.conv(F.substring(code, k * 2 + 1, F.lit(2)), 16, 10).cast("int") + pieces.first_byte))


def lattice(distinct: DataFrame, pieces: Pieces) -> DataFrame:
    """(hash, segment, edges): each edge has s, e, cost and ids (those of its bytes for a character outside the table).

    Substrings stay in their segment's task; the grouping reuses the partitioning that made segments distinct.
    """
    ids = F.when(F.col("id").isNull(), _byte_ids(F.substring("segment", F.col("s") + 1, F.lit(1)), pieces)).otherwise(F.array("id"))
    edge = F.struct(F.coalesce(-F.col("score"), F.lit(float("inf"))).alias("cost"), "s", "e", ids.alias("ids"))
    return _substrings(distinct, pieces).groupBy("hash", "segment").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def viterbi_fold(edges: Column, size: Column) -> Column:
    """Ids of the path with the greatest sum of scores; equal sums go to the later start. Unknown characters cost 10 more than any piece."""
    known = lambda x: x["cost"] < float("inf")
    empty = F.array().cast("array<int>")
    start = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(0).alias("s"), empty.alias("ids")))
    worst = F.array_max(F.transform(edges, lambda x: F.when(known(x), x["cost"]).otherwise(0.0))) + 10.0

    def forward(unknown: Column) -> Column:
        def step(best: Column, end: Column) -> Column:
            into = F.transform(F.filter(edges, lambda x: x["e"] == end), lambda x: F.struct(
                (F.get(best, x["s"])["cost"] + F.when(known(x), x["cost"]).otherwise(unknown)).alias("cost"),
                (-x["s"]).alias("s"), x["ids"].alias("ids")))
            return F.concat(best, F.array(F.array_min(into)))

        return F.aggregate(F.sequence(F.lit(1), size), start, step)

    def backward(best: Column) -> Column:
        first = F.struct(size.cast("int").alias("at"), empty.alias("ids"))
        return F.aggregate(F.sequence(F.lit(1), size), first, lambda path, _: F.when(path["at"] <= 0, path).otherwise(F.struct(
            (-F.get(best, path["at"])["s"]).alias("at"), F.concat(F.get(best, path["at"])["ids"], path["ids"]).alias("ids"))))["ids"]

    return _let(_let(worst, forward), backward)


def encode_segments(distinct: DataFrame, pieces: Pieces) -> DataFrame:
    """(hash, ids) for distinct (hash, segment) rows."""
    if pieces.kind != "bpe":
        return lattice(distinct, pieces).select("hash", viterbi_fold(F.col("edges"), F.length("segment")).alias("ids"))
    shared = distinct.sparkSession.sparkContext.broadcast(vars(Merges(pieces)))

    def run(batches):
        merges = Merges.of(shared.value)
        for batch in batches:
            data = [s.encode() for s in batch.column(1).to_pylist()]
            ends = np.cumsum([len(x) for x in data], dtype=np.int64)
            offsets, ids = merges.encoded(b"".join(data), np.concatenate([[0], ends])[:-1].astype(np.int64), ends)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["hash", "ids"])

    return distinct.select("hash", "segment").mapInArrow(run, "hash bigint, ids array<int>")


def distinct_segments(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """(hash, segment, n): every distinct segment of all texts with its number of places."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces.cuts())

    def run(batches):
        cuts, hasher = shared.value, WordHasher()
        for batch in in_parts(batches, 1000):  # larger parts hold fewer repeats, smaller ones less at once
            data = [prepared(t) for t in batch.column(0).to_pylist()]
            parts = [segments(d, cuts, hasher) for d in data]
            if not parts:
                continue
            offset = np.concatenate([[0], np.cumsum([len(d) for d in data])])
            begin, end = (np.concatenate([p[k] + o for p, o in zip(parts, offset)]) for k in (0, 1))
            hashes, first, n = np.unique(np.concatenate([p[2] for p in parts]), return_index=True, return_counts=True)
            whole = b"".join(data)
            found = [whole[b:e].decode() for b, e in zip(begin[first].tolist(), end[first].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(found, pa.string()), pa.array(n.astype(np.int64))], names=["hash", "segment", "n"])

    rows = docs.select("text").mapInArrow(run, "hash bigint, segment string, n bigint")
    return rows.groupBy("hash", "segment").agg(F.sum("n").alias("n"))


def _head(dictionary: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes, offsets and ids of the most frequent segments, at most ``limit``.

    One more entry behind them, the single id -1, stands for all others.
    """
    level = F.floor(F.log2("n")).cast("int")
    sizes = {r[0]: r[1] for r in dictionary.groupBy(level.alias("level")).agg(F.count("*")).collect()}
    least, total = 64, 0
    for at in sorted(sizes, reverse=True):
        if total + sizes[at] > limit:
            break
        least, total = at, total + sizes[at]
    table = dictionary.filter(F.col("n") >= (1 << min(least, 62))).select("hash", "ids").toArrow().combine_chunks()
    hashes = table.column("hash").to_numpy().view(np.uint64)
    lists = table.column("ids").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    order = np.argsort(hashes)
    sizes_of = np.diff(lists.offsets.to_numpy())[order] if len(order) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.append(sizes_of, 1))]).astype(np.int64)
    ids = lists.take(pa.array(order)).flatten().to_numpy() if len(order) else np.zeros(0, np.int32)
    return hashes[order], offsets, np.append(ids, -1).astype(np.int32)


def spread(offsets: np.ndarray, which: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
    """Positions of the elements of the lists ``which``, one list after the other; ``sizes`` if they do not follow one another."""
    sizes = offsets[which + 1] - offsets[which] if sizes is None else sizes
    ends = np.cumsum(sizes)
    return np.repeat(offsets[which] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _merged_texts(spark: SparkSession, docs: DataFrame, pieces: Pieces, p: str) -> DataFrame:
    """``docs`` with the ids a BPE model gives its texts, and these decoded: each task merges the distinct segments it meets."""
    shared = spark.sparkContext.broadcast((pieces.cuts(), pieces.table(), vars(Merges(pieces))))
    at, schema = docs.columns.index("text"), extended(docs, f"`{p}ids` array<int>, `{p}decoded` string")

    def run(batches):
        cuts, table, tables = shared.value
        hasher, merges = WordHasher(), Merges.of(tables)
        raw, places = np.frombuffer(b"".join(table), np.uint8), np.cumsum([0, *map(len, table)])
        for batch in in_parts(batches, TOGETHER):
            texts = batch.column(at).to_pylist()
            data = [prepared(t or "") for t in texts]
            parts = [segments(d, cuts, hasher) for d in data]
            offset = np.cumsum([0, *map(len, data)])
            begin, end = (np.concatenate([x[k] + o for x, o in zip(parts, offset)]) for k in (0, 1))
            _, first, which = np.unique(np.concatenate([x[2] for x in parts]), return_index=True, return_inverse=True)
            starts, flat = merges.encoded(b"".join(data), begin[first], end[first])
            ids, decoded, done = [], [], 0
            for text, (own, _, _) in zip(texts, parts):
                found = flat[spread(starts, which[done:done + len(own)])]
                done += len(own)
                ids.append(None if text is None else found)
                decoded.append(None if text is None else raw[spread(places, found)][1:].tobytes().decode(errors="replace"))
            arrays = [*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(run, schema)


def encoded(spark: SparkSession, docs: DataFrame, pieces: Pieces, head: int = HEAD) -> tuple[DataFrame, str]:
    """``docs`` with ``ids`` and ``text`` decoded again, behind a free prefix; and that prefix. ``head`` bounds a unigram model's table."""
    p, work = free_prefix(docs, "sp_"), Scratch(spark)
    if pieces.kind == "bpe":
        return _merged_texts(spark, docs, pieces, p), p
    distinct = distinct_segments(docs, pieces)
    counts = work.staged(distinct, "segments")
    spread_out = counts.repartition(1 + counts.count() // PER_TASK, "hash", "segment")  # a task's edges are grouped in memory
    dictionary = work.staged(encode_segments(spread_out, pieces).join(counts.select("hash", "n"), "hash"), "segment-ids")
    shared = spark.sparkContext.broadcast((pieces.cuts(), pieces.table(), *_head(dictionary, head)))
    at, keep = docs.columns.index("text"), len(docs.columns)
    schema = extended(docs, f"`{p}ids` array<int>, `{p}decoded` string, `{p}holes` array<bigint>")

    def run(batches):
        cuts, table, known, starts, flat = shared.value
        hasher, padded = WordHasher(), np.append(known, np.uint64(0))
        for batch in in_parts(batches):
            ids, decoded, holes = [], [], []
            for text in batch.column(at).to_pylist():
                found = back = missing = None
                if text is not None:
                    seen = segments(prepared(text), cuts, hasher)[2]
                    place = np.searchsorted(known, seen)
                    hit = padded[place] == seen
                    hit &= place < len(known)
                    found = flat[spread(starts, np.where(hit, place, len(known)))]
                    if hit.all():
                        back = decode_ids(found.tolist(), table)
                    else:
                        missing = seen[~hit].view(np.int64)
                ids.append(found), decoded.append(back), holes.append(missing)
            arrays = [batch.column(i) for i in range(keep)] + [
                pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string()), pa.array(holes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    found = docs.mapInArrow(run, schema)
    if dictionary.count() <= len(shared.value[2]):  # every segment is in the table: no text can miss one
        return found.drop(f"{p}holes"), p
    row = f"{p}row"
    found = work.staged(found.withColumn(row, F.monotonically_increasing_id()), "encoded")
    asked = found.select(row, F.posexplode(f"{p}holes").alias("pos", "hash"))
    answers = asked.join(dictionary, "hash").groupBy(row).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "ids"))), lambda x: x["ids"]).alias(f"{p}answers"))
    holding = found.filter(f"`{p}holes` IS NOT NULL").drop(f"{p}holes").join(answers, row).drop(row)
    filled_schema = holding.drop(f"{p}answers").schema

    def fill(batches):
        table = shared.value[1]
        for batch in in_parts(batches):
            ids, decoded = [], []
            for some, answer in zip(batch.column(keep).to_pylist(), batch.column(keep + 2).to_pylist()):
                rest, whole = iter(answer), []
                for i in some:
                    whole += [i] if i >= 0 else next(rest)
                ids.append(whole), decoded.append(decode_ids(whole, table))
            arrays = [batch.column(i) for i in range(keep)] + [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=filled_schema.names)

    complete = found.filter(f"`{p}holes` IS NULL").drop(f"{p}holes", row)
    return complete.unionAll(holding.mapInArrow(fill, filled_schema)), p


def decode_ids(ids: list[int], table: list[bytes]) -> str:
    """The text of a list of ids, without the space that encoding puts in front."""
    return b"".join(map(table.__getitem__, ids))[1:].decode(errors="replace")


def decoded(docs: DataFrame, pieces: Pieces, ids: str = "ids", into: str = "text") -> DataFrame:
    """``docs`` with the text of its id lists; null ids give null text."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces.table())
    schema, at = extended(docs, f"`{into}` string"), docs.columns.index(ids)

    def run(batches):
        table = shared.value
        for batch in batches:
            texts = [None if v is None else decode_ids(v, table) for v in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)
