"""Bit tables of fixed size over 64-bit hashes: which may occur twice, looked up by every worker.

They only ever let something through that need not be: a slot that two different hashes share reads as repeated. What is
kept by them is therefore complete at any size of the input, and a full table merely keeps everything.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakemill.llm.frames import Batches

BITS = 27
GROUP = 1 << 15  # bits that travel together
HELD = 1 << 20

Hashes = Callable[[pa.RecordBatch], Iterator[np.ndarray]]


def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit of each hash's slot."""
    slot = hashes & np.uint64((1 << BITS) - 1)
    return (slot >> np.uint64(3)).astype(np.int64), (slot & np.uint64(7)).astype(np.uint8)


class Seen:
    """The slots seen once, and those seen twice."""

    def __init__(self) -> None:
        self.once, self.twice = (np.zeros((1 << BITS) >> 3, np.uint8) for _ in range(2))
        self.held, self.size = [], 0

    def add(self, hashes: np.ndarray) -> None:
        self.held.append(hashes)
        self.size += len(hashes)
        if self.size >= HELD:
            self.settle()

    def settle(self) -> None:
        if not self.held:
            return
        slots, n = np.unique(np.concatenate(self.held) & np.uint64((1 << BITS) - 1), return_counts=True)
        self.held, self.size = [], 0
        byte, shift = places(slots)
        bit = np.left_shift(np.uint8(1), shift)
        again = (n > 1) | (self.once[byte] & bit != 0)
        for table, wanted in ((self.twice, again), (self.once, np.ones(len(slots), bool))):
            at, bits = byte[wanted], bit[wanted]
            if len(at):
                first = np.flatnonzero(np.diff(at, prepend=-1))
                table[at[first]] |= np.bitwise_or.reduceat(bits, first)


class Repeated:
    """The slots of ``rows`` that hold two hashes or more; ``hashes`` yields those of a batch."""

    def __init__(self, rows: DataFrame, hashes: Hashes) -> None:
        width = GROUP >> 3

        def run(batches: Batches) -> Batches:
            seen = Seen()
            for batch in batches:
                for found in hashes(batch):
                    seen.add(found)
            seen.settle()
            for i in range(0, len(seen.once), width):
                once, twice = seen.once[i:i + width], seen.twice[i:i + width]
                if once.any():
                    bits = zlib.compress(once.tobytes() + twice.tobytes(), 1)
                    yield pa.RecordBatch.from_arrays([pa.array([i // width], pa.int32()), pa.array([bits])], names=["part", "bits"])

        def merged(key, group):
            once, twice = np.zeros(width, np.uint8), np.zeros(width, np.uint8)
            for v in group.column("bits"):
                one, two = np.frombuffer(zlib.decompress(v.as_py()), np.uint8).reshape(2, -1)
                twice |= two | (once & one)
                once |= one
            return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([zlib.compress(twice.tobytes(), 1)])})

        table = np.zeros((1 << BITS) >> 3, np.uint8)
        parts = rows.mapInArrow(run, "part int, bits binary").groupBy("part").applyInArrow(merged, "part int, bits binary")
        for part, bits in parts.toLocalIterator():
            table[part * width:(part + 1) * width] = np.frombuffer(zlib.decompress(bits), np.uint8)
        self.shared = rows.sparkSession.sparkContext.broadcast(zlib.compress(table, 1))

    def worker(self) -> Callable[[np.ndarray], np.ndarray]:
        """For a task: which of some hashes may occur twice."""
        table = np.frombuffer(zlib.decompress(self.shared.value), np.uint8)

        def may(hashes: np.ndarray) -> np.ndarray:
            byte, shift = places(hashes)
            return (table[byte] >> shift) & 1 != 0

        return may

    def destroy(self) -> None:
        self.shared.destroy()
