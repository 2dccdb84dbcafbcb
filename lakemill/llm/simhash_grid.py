"""SimHash near duplicates: fingerprints as points of bit counts, joined on a grid under Manhattan distance.

A fingerprint's 64 bits are cut into segments of two, and each segment keeps only how many of its bits are set. Between
two such points the Manhattan distance is never above the Hamming distance of the fingerprints. The segments are dealt to a few
parts, and a grid is laid over some of the parts, over every choice of so many (:func:`grids`): with 4 bits, over every two of
three parts. If two fingerprints differ in 4 bits at most, the two parts of least difference have a Manhattan
distance of 2 or less, and a grid point lies within one step of both. So every point is dealt to its own cell and the
cells one step away, about 100 over all grids, and linked points always meet in a cell. There the
fingerprints themselves are compared, so links are exact; unrelated ones meet at a rate of 1.4 in a million.

* Equal fingerprints are one class before anything is joined, so copies cost no comparison.
* A cell of up to ``CELL`` classes is a join on the cell. In a larger one, classes near the cell's pivot (that of most
  documents) are linked with it alone; the others are compared with all classes of the cell, ``BLOCK`` by
  ``BLOCK``, each pair of blocks a group of its own that returns a spanning forest of its links and not all of them. The
  work in such a cell grows with its classes outside the pivot's reach times all its classes; nothing is left out.
* Components come from alternating star contractions over the links.

Null, empty and wordless texts have the fingerprint zero and link like any other. Texts of fewer words than a shingle are
one shingle. Very long texts are hashed ``PART`` shingles at a time. Repeated rows and rows with equal ids stay, one
result row per input row; a missing id never becomes a component id, and a component without any id has a null one. Columns other than
the id and the text are not read, so their names cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm.components import connected
from lakemill.llm.frames import map_arrow, staged, text_bytes

SEED = 42
PART = 1 << 16  # shingles hashed at once
CELL = 256  # classes a cell may hold before it is worked off in blocks
BLOCK = 2048
HOT = 1000  # a fingerprint with more than one in HOT of all rows is looked up in a broadcast table, of HOT rows at most

_ODD_BITS = np.uint64(0x5555555555555555)


def fingerprint(text: bytes, width: int) -> int:
    """64 bits, each set if it is set in more than half of the hashes of the text's shingles."""
    words = text.lower().split()  # bytes: A-Z alone, and ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    size = min(width, len(words))
    begin, end = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(begin), PART):
        hashes = np.array([xxhash.xxh64_intdigest(line[b:e], SEED) for b, e in zip(begin[at:at + PART], end[at:at + PART])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(begin), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, fingerprint as a long) of every row."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t, width) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    rows = docs.select("doc_id", text_bytes().alias("text"))
    return map_arrow(rows, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long", each)


def points(values: np.ndarray) -> np.ndarray:
    """Set bits of each of the 32 two-bit segments, as 32 two-bit numbers (0 to 2) in one word."""
    shifted = values >> np.uint64(1)
    return ((values & shifted & _ODD_BITS) << np.uint64(1)) | ((values ^ shifted) & _ODD_BITS)


def grids(distance: int) -> list[np.ndarray]:
    """The segments of each grid: all choices of ``kept`` of ``parts`` parts.

    Of ``distance`` steps spread over the parts the ``kept`` least hold most when they are spread evenly; that must be 2 at
    most. Taken is what keeps the greatest share of the segments with ten choices at most.
    """
    def most(parts: int, kept: int) -> int:
        each, more = divmod(distance, parts)
        return kept * each + max(0, kept - (parts - more))

    options = [(parts, kept) for parts in range(1, 33) for kept in range(1, parts + 1)
               if most(parts, kept) <= 2 and (math.comb(parts, kept) <= 10 or kept == 1)]
    parts, kept = max(options, key=lambda o: (o[1] / o[0], -o[0]))
    dealt = np.array_split(np.arange(32), parts)
    return [np.concatenate(choice) for choice in combinations(dealt, kept)]


def cells_of(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Per fingerprint and grid, its own cell and those one step away: (index of the fingerprint, cell).

    A cell is the counts of the grid's segments; those outside the grid read 3, which no count does, and tell grids apart.
    """
    point, every = points(values), np.arange(len(values))
    index, cells = [], []
    for segments in grids(distance):
        inside = np.uint64(sum(3 << 2 * int(j) for j in segments))
        own = (point & inside) | ~inside
        index.append(every), cells.append(own)
        for j in segments:
            step = np.uint64(1 << 2 * int(j))
            count = (point >> np.uint64(2 * j)) & np.uint64(3)
            for fits, moved in ((count < 2, own + step), (count > 0, own - step)):
                index.append(every[fits]), cells.append(moved[fits])
    return np.concatenate(index), np.concatenate(cells)


def in_cells(classes: DataFrame, distance: int) -> DataFrame:
    """(cell, fp, n): every class in every cell it may meet a linked one in."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(0).to_numpy().view(np.uint64)
        index, cells = cells_of(values, distance)
        taken = batch.take(pa.array(index))
        return pa.RecordBatch.from_arrays([pa.array(cells.view(np.int64)), *taken.columns], names=["cell", "fp", "n"])

    # A class becomes a hundred rows: few tasks read the classes, many deal them.
    spread = classes.select("fp", "n").repartition(4 * classes.sparkSession.sparkContext.defaultParallelism)
    return map_arrow(spread, "cell long, fp long, n long", each)


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of a spanning forest of the links of a Boolean matrix."""
    free_rows, free_columns = linked.any(axis=1), np.ones(linked.shape[1], bool)
    left, right = [], []
    for start in np.flatnonzero(free_rows):
        if not free_rows[start]:
            continue
        free_rows[start] = False
        waiting = [start]
        while waiting:
            row = waiting.pop()
            columns = np.flatnonzero(linked[row] & free_columns)
            free_columns[columns] = False
            left.append(np.full(len(columns), row)), right.append(columns)
            if len(columns):
                rows = np.flatnonzero(free_rows)
                meets = linked[np.ix_(rows, columns)]
                rows, meets = rows[meets.any(axis=1)], meets[meets.any(axis=1)]
                free_rows[rows] = False
                left.append(rows), right.append(columns[meets.argmax(axis=1)])
                waiting.extend(rows.tolist())
    if not left:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(left), np.concatenate(right)


def _differ(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _block_links(rows: DataFrame, distance: int) -> DataFrame:
    """Links of the classes of large cells that their pivots do not settle."""
    near = _differ("fp", "pivot") <= distance
    far = rows.groupBy("cell").agg(F.count_if(~near).alias("far"), F.count_if(near).alias("close")).filter("far > 0")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    dealt = rows.withColumn("near", near).join(far, "cell").withColumns({"fars": blocks("far"), "closes": blocks("close")})
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("near"), F.col("closes")).otherwise(F.col("fars"))).cast("int")
    # Blocks of classes near the pivot are numbered behind those of the others.
    dealt = dealt.withColumn("own", F.when(F.col("near"), F.col("fars") + own).otherwise(own))
    meet = lambda a, b: F.struct(a.alias("probe"), b.alias("base"))
    as_base = F.transform(F.sequence(F.lit(0), F.when(F.col("near"), F.col("fars") - 1).otherwise(F.col("own"))), lambda j: meet(j, F.col("own")))
    as_probe = F.transform(F.sequence(F.col("own"), F.col("fars") + F.col("closes") - 1), lambda i: meet(F.col("own"), i))
    sent = dealt.select("cell", "fp", F.explode(as_base).alias("m"), F.lit(False).alias("probes")).unionAll(
        dealt.filter("not near").select("cell", "fp", F.explode(as_probe).alias("m"), F.lit(True).alias("probes")))

    def links(group):
        values, probes = group.column("fp").to_numpy(), group.column("probes").to_numpy()
        a, b = np.sort(values[probes]), np.sort(values[~probes])
        linked = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= distance
        rows, columns = forest(linked)
        return pa.table({"u": a[rows], "v": b[columns]}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return sent.select("cell", F.col("m.probe").alias("probe"), F.col("m.base").alias("base"), "fp", "probes").groupBy(
        "cell", "probe", "base").applyInArrow(links, "u long, v long").filter("u != v")


def met_in_cells(classes: DataFrame, distance: int) -> DataFrame:
    """(cell, fp, held, pivot): the classes of every cell that holds several, how many those are, and its pivot."""
    cells = in_cells(classes, distance)
    held = cells.groupBy("cell").agg(F.count("*").alias("held"), F.max_by("fp", F.struct("n", "fp")).alias("pivot"))
    # Spark takes the cells to be as few as the classes they are made of, a hundredth, and would broadcast them.
    return cells.select("cell", "fp").hint("merge").join(held.filter("held > 1"), "cell")


def links(spark: SparkSession, classes: DataFrame, distance: int = 4) -> DataFrame:
    """Links (u, v) between fingerprints; in cells above ``CELL`` classes enough of them to join what is connected."""
    met = staged(spark, met_in_cells(classes, distance), "cells")
    few, many = met.filter(F.col("held") <= CELL).select("cell", "fp"), met.filter(F.col("held") > CELL).select("cell", "fp", "pivot")
    small = few.select("cell", F.col("fp").alias("u")).join(
        few.select("cell", F.col("fp").alias("v")), "cell").filter((F.col("u") < F.col("v")) & (_differ("u", "v") <= distance))
    star = many.filter((F.col("fp") != F.col("pivot")) & (_differ("fp", "pivot") <= distance))
    return small.select("u", "v").unionAll(star.select(F.col("fp").alias("u"), F.col("pivot").alias("v"))).unionAll(_block_links(many, distance))


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``: the least id reachable over links, its own included."""
    if not 0 <= distance <= 32:
        raise ValueError("a distance of 0 to 32 bits")
    rows = staged(spark, fingerprints(docs, width), "fingerprints")
    classes = staged(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "classes")
    reached = connected(spark, links(spark, classes, distance))
    rooted = classes.join(reached.select(F.col("node").alias("fp"), "root").distinct(), "fp", "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(spark, rooted.join(least, "root").select("fp", "n", "component_id"), "named")
    common = F.broadcast(named.filter(F.col("n") * HOT > rows.agg(F.count("*")).scalar()).select("fp", "component_id"))
    known = rows.join(common, "fp").unionByName(
        rows.join(common, "fp", "left_anti").join(named.select("fp", "component_id"), "fp"))
    return known.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
