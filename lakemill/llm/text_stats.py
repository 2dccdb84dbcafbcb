"""Per-document statistics, computed in one pass over the bytes of each text."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakemill.llm.frames import extended, in_parts

SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
WINDOW = 5

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
    "n_upper", "n_digits", "n_marks", "n_short_lines", "max_word",
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a ``window``-word run found at least twice in the text."""
    if len(words) <= window:
        return 0
    runs = list(zip(*(words[i:] for i in range(window))))
    if len(set(runs)) == len(runs):
        return 0
    seen = Counter(runs)
    hit = np.fromiter((seen[r] > 1 for r in runs), bool, len(runs))
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def counts(data: bytes) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one text; all 0 for an empty one."""
    words = data.split()
    seen: set[bytes] = set()
    n_lines = n_dup = n_short = 0
    for line in data.split(b"\n"):
        kept = line.strip()
        if not kept:
            continue
        n_lines += 1
        n_short += len(kept) < 12
        if line in seen:
            n_dup += 1
        seen.add(line)
    codes = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    points = int(codes[:128].sum() + codes[192:].sum())
    return (
        len(words),
        points - int(sum(codes[s[0]] for s in SPACES)),
        int(sum(codes[s[0]] for s in SYMBOLS)),
        n_dup,
        repeated_words(words),
        n_lines,
        len(set(words)),
        int(codes[65:91].sum()),
        int(codes[48:58].sum()),
        int(codes[33] + codes[44] + codes[46] + codes[58] + codes[59] + codes[63]),
        n_short,
        max(map(len, words), default=0),
    )


def with_counts(docs: DataFrame, prefix: str, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with a long column per count behind its own columns; with ``drop_text`` without the text, which then does not come back from Python.

    A null text counts as empty; rows, order of columns and values of ``docs`` stay as they are.
    """
    at = docs.columns.index(text)
    kept = [i for i in range(len(docs.columns)) if not (drop_text and i == at)]
    own = docs.select(*[F.col(f"`{docs.columns[i]}`") for i in kept])
    schema = extended(own, ", ".join(f"`{prefix}{c}` bigint" for c in COUNTS))

    def run(batches):
        for batch in in_parts(batches):
            data = batch.column(at).cast(pa.binary())
            rows = np.array([counts(v.as_py() or b"") for v in data], np.int64).reshape(-1, len(COUNTS))
            arrays = [batch.column(i) for i in kept] + [pa.array(rows[:, i]) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(run, schema)
