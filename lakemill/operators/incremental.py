"""Choosing the source rows a load has not seen yet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Watermark:
    """What marks a row as new.

    ``ts``        one timestamp column
    ``greatest``  the greater of several timestamp columns; a row is new if any of them is
    ``id``        an integer id that may be stored as text
    """

    kind: str
    columns: tuple[str, ...]

    def __post_init__(self):
        if self.kind not in ("ts", "greatest", "id"):
            raise ValueError(f"unknown watermark kind {self.kind!r}")
        if not self.columns or (self.kind != "greatest" and len(self.columns) != 1):
            raise ValueError(f"watermark {self.kind} got columns {self.columns}")

    def values(self) -> list[Column]:
        if self.kind == "id":
            return [F.col(self.columns[0]).try_cast("bigint")]
        return [F.col(c) for c in self.columns]

    def is_new(self, high: Column, inclusive: bool = False) -> Column:
        tests = [(v >= high) if inclusive else (v > high) for v in self.values()]
        new = tests[0]
        for test in tests[1:]:
            new = new | test
        return new


def high_water(target: DataFrame, mark: Watermark) -> DataFrame:
    """One row, one column ``high``: the greatest mark stored so far, NULL for an empty target."""
    values = mark.values()
    value = F.greatest(*values) if len(values) > 1 else values[0]
    return target.agg(F.max(value).alias("high"))


def incremental(source: DataFrame, target: DataFrame, mark: Watermark, inclusive: bool = False) -> DataFrame:
    """Source rows above the target's high-water; the whole source when the target is empty.

    Lazy: the high-water is a scalar subquery of the same plan. With ``inclusive`` rows equal to the
    high-water come again, for loads that remove repeats by key afterwards.
    """
    high = high_water(target, mark).scalar()
    return source.filter(high.isNull() | mark.is_new(high, inclusive))


def incremental_from(source: DataFrame, target: DataFrame, mark: Watermark, compared: list[str]) -> DataFrame:
    """Rows from the high-water on, itself included, less those of the target that carry it already.

    A row that was committed late with the same mark as the stored high-water is taken, and so is a stored row that changed
    without a new mark; what is stored alike in all ``compared`` columns does not come twice. Only the target's
    rows at the high-water are compared, by a digest, and both sides are filtered by a literal.
    """
    high = high_water(target, mark).first()["high"]
    if high is None:
        return source
    fresh = source.filter(mark.is_new(_literal(high, source, mark), inclusive=True))
    values = mark.values()
    at = F.greatest(*values) if len(values) > 1 else values[0]
    edge = target.filter(at == _literal(high, target, mark))
    compared = [c for c in compared if c in target.columns]
    # Each side as text of the target's types, so that a narrower source column compares alike.
    kinds = dict(target.dtypes)
    # A mark that is compared itself differs above the high-water: those rows need no comparison.
    edge_only = all(c in compared and dict(source.dtypes)[c] == kinds[c] for c in mark.columns)
    above = None
    if edge_only:
        level = _literal(high, source, mark)
        above, fresh = fresh.filter(at > level), fresh.filter(at == level)
    digest = F.sha2(F.to_json(F.struct(*[F.col(c).cast(kinds[c]).cast("string").alias(f"c{i}") for i, c in enumerate(compared)])), 256)
    stored = edge.select(digest.alias("_stored")).distinct()
    unseen = fresh.withColumn("_digest", digest).join(stored, F.col("_digest") == F.col("_stored"), "left_anti").drop("_digest")
    return unseen if above is None else above.unionByName(unseen)


def _literal(high, df: DataFrame, mark: Watermark) -> Column:
    return F.lit(high) if mark.kind == "id" else F.lit(high).cast(dict(df.dtypes)[mark.columns[0]])


def incremental_pushed(source: DataFrame, target: DataFrame, mark: Watermark, inclusive: bool = False) -> DataFrame:
    """Same rows as :func:`incremental`, with the high-water fetched first (an action, one value).

    The filter then holds a literal, which a JDBC source evaluates remotely and a parquet source
    uses to skip row groups.
    """
    high = high_water(target, mark).first()["high"]
    if high is None:
        return source
    return source.filter(mark.is_new(_literal(high, source, mark), inclusive))
