"""Operators along an integer id: prefix sums, pairs in a distance band, best-average run.

Ids are cut into ranges of ``width`` ids. A range holds at most ``width`` distinct ids, so no task
receives more, however the rows are spread; repeated ids are summed before the exchange.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from lakemill.operators.radix import totals_before
from lakemill.session import stages

WIDTH = 1 << 18  # prefix sums
BAND_WIDTH = 1 << 14  # bands: many small ranges, each overlapping the next by the band only


def per_id(df: DataFrame, id_col: str, amount: str) -> DataFrame:
    return df.groupBy(id_col).agg(F.sum(amount).alias(amount))


def _range_of(id_col: Column, width: int) -> Column:
    return F.floor(id_col / F.lit(width)).cast("bigint")


def prefix_sum(df: DataFrame, id_col: str, amount: str, out: str = "sum", width: int = WIDTH) -> DataFrame:
    """Running total in id order over the whole table.

    Each range of ids runs its own window and adds the total of the ranges before it, which comes from a tree over the ranges:
    no task orders more than ``width`` ids or 2^18 ranges, also where ids are scattered over 64 bits.
    """
    ranges = (
        df.groupBy(_range_of(F.col(id_col), width).alias("_range"))
        .agg(F.sum(amount).cast("decimal(38,2)").alias("_total"))
    )
    offsets = totals_before(ranges, "_range", "_total", "_before")
    inside = Window.partitionBy("_range").orderBy(id_col).rowsBetween(Window.unboundedPreceding, 0)
    rows = per_id(df, id_col, amount).withColumn("_range", _range_of(F.col(id_col), width))
    running = rows.withColumn("_inside", F.sum(amount).over(inside))
    total = F.col("_inside") + F.col("_before")
    return running.join(offsets, "_range").select(id_col, amount, total.cast("decimal(38,2)").alias(out))


def _with_halo(df: DataFrame, id_col: str, reach: int, width: int) -> DataFrame:
    """Give each row to its own id range, and to the next one if it lies within ``reach`` of it."""
    if reach > width:
        raise ValueError("the band must fit into one id range")
    home = _range_of(F.col(id_col), width)
    last = (home + 1) * width - 1
    targets = F.when(F.col(id_col) > last - reach, F.array(home, home + 1)).otherwise(F.array(home))
    return df.withColumn("_range", F.explode(targets))


def banded_pairs(
    df: DataFrame, id_col: str, columns: list[str], nearest: int, farthest: int, width: int = BAND_WIDTH
) -> DataFrame:
    """Pairs (left, right) of rows with ``nearest <= right id - left id <= farthest``.

    ``id_col`` must be unique. A range frame per right row collects at most
    ``farthest - nearest + 1`` left rows, so the output is linear in the input; there is one exchange
    and no join.
    """
    rows = _with_halo(df.select(id_col, *columns), id_col, farthest, width)
    frame = Window.partitionBy("_range").orderBy(id_col).rangeBetween(-farthest, -nearest)
    right = rows.withColumn("_left", F.collect_list(F.struct(id_col, *columns)).over(frame))
    native = right.filter(F.col("_range") == _range_of(F.col(id_col), width))
    pairs = native.withColumn("_left", F.explode("_left"))
    names = [id_col, *columns]
    return pairs.select(
        *[F.col(f"_left.{c}").alias(f"left_{c}") for c in names],
        *[F.col(c).alias(f"right_{c}") for c in names],
    )


def _fill_near_gaps(rows: DataFrame, id_col: str, amount: str, reach: int) -> DataFrame:
    """Add absent ids as zero amounts up to ``reach`` before and after every present id."""
    order = Window.partitionBy("_range").orderBy(id_col)
    i, before, after = F.col(id_col), F.lag(id_col).over(order), F.lead(id_col).over(order)
    marked = rows.withColumns({"_before": before, "_after": after})
    start = F.greatest(i - reach, F.coalesce(F.col("_before") + reach + 1, F.col("_bounds.low")), F.col("_bounds.low"))
    stop = F.least(i + reach, F.coalesce(F.col("_after") - 1, F.col("_bounds.high")))
    return marked.withColumn("_id", F.explode(F.sequence(F.least(start, i), stop))).select(
        "_range",
        F.col("_id").alias(id_col),
        F.when(F.col("_id") == i, F.col(amount)).otherwise(F.lit(0)).alias(amount),
    )


def id_bounds(df: DataFrame, id_col: str) -> DataFrame:
    """One row: the smallest and the greatest id."""
    return df.agg(F.struct(F.min(id_col).alias("low"), F.max(id_col).alias("high")).alias("bounds"))


def _long_ties(tied: DataFrame, totals: DataFrame, best: Row, id_col: str, k: int, reach: int, width: int) -> int:
    """How many runs of ``2k`` or more ids have the best average s/n, that of the run ``best``.

    Such a run splits after its first ``k`` ids, and before its last ``k``, into runs of the best average, so it begins
    and ends with tied runs of ``k`` ids. With P the running total, a run from ``first`` to ``last`` is tied if
    n P(first - 1) - s (first - 1) = n P(last) - s last: starts and ends are grouped by this number, and each end counts
    the starts at least ``2k - 1`` ids before it, first inside id ranges, then over the ranges of a number.
    """
    span = F.col("_span")
    n, s = best._span.last - best._span.first + 1, best._span.cents
    short = tied.filter((span["last"] - span["first"] == k - 1) & (F.col("_best") == F.lit(best._best)))
    if short.limit(2).count() < 2:
        return 0
    # Running totals inside a range begin with the halo, the last ids of the range before.
    last = (_range_of(F.col(id_col), width) + 1) * width - 1
    sums = totals.groupBy(_range_of(F.col(id_col), width).alias("_range")).agg(
        F.sum("_cents").alias("_total"), F.sum(F.when(F.col(id_col) > last - reach, F.col("_cents")).otherwise(0)).alias("_tail"))
    halo = sums.select((F.col("_range") + 1).alias("_range"), (-F.col("_tail")).alias("_less"), F.lit(0).cast("bigint").alias("_more"))
    every = sums.select("_range", F.lit(0).cast("bigint").alias("_less"), F.col("_total").alias("_more")).unionAll(halo)
    ranges = every.groupBy("_range").agg(F.sum("_less").alias("_less"), F.sum("_more").cast("decimal(38,0)").alias("_more"))
    offsets = totals_before(ranges, "_range", "_more", "_ahead").join(ranges, "_range").select(
        "_range", (F.col("_ahead") + F.col("_less")).alias("_before"))
    placed = short.join(offsets, "_range")
    number = lambda running, at: (
        F.lit(n).cast("decimal(18,0)") * (F.col("_before") + running).cast("decimal(20,0)")
        - F.lit(s).cast("decimal(19,0)") * at.cast("decimal(19,0)")).cast("decimal(38,0)")
    events = placed.select(F.explode(F.array(
        F.struct(number(F.col("_upto") - span["cents"], span["first"] - 1).alias("value"), (span["first"] + 2 * k - 1).alias("at"), F.lit(1).alias("start")),
        F.struct(number(F.col("_upto"), span["last"]).alias("value"), span["last"].alias("at"), F.lit(0).alias("start")))).alias("e")).select("e.*")
    events = events.withColumn("part", _range_of(F.col("at"), WIDTH))
    inside = Window.partitionBy("value", "part").orderBy("at", F.col("start").desc()).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("value").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    near = events.withColumn("seen", F.sum("start").over(inside)).groupBy("value", "part").agg(
        F.sum(F.when(F.col("start") == 0, F.coalesce("seen", F.lit(0))).otherwise(0)).alias("near"),
        F.sum("start").alias("starts"), F.sum(1 - F.col("start")).alias("ends"))
    far = F.col("ends") * F.coalesce(F.sum("starts").over(across), F.lit(0))
    return near.select((F.col("near") + far).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).first()[0]


def best_average_run(
    df: DataFrame,
    id_col: str,
    amount: str,
    min_distance: int = 20,
    width: int = BAND_WIDTH,
    bounds: DataFrame | None = None,
    every_length: bool = False,
) -> DataFrame:
    """The run of consecutive ids with the greatest average amount.

    A run spans at least ``min_distance + 1 = k`` ids between the smallest and the greatest id; an
    absent id counts as zero, amounts are not negative. A run of ``2k`` or more ids splits into two
    runs of at least ``k`` ids, one with no smaller average, so lengths ``k .. 2k-1`` hold a best run
    and each right end meets ``k`` candidates.

    One row: ``seq_index`` 1, the average, ``id_range`` ``first-last`` of the first best run (lowest
    start, then shortest) and ``matchnum``, how many runs of those lengths tie with it; with ``every_length``
    how many of any length from ``k`` on.

    ``bounds`` may bring the result of :func:`id_bounds` from a cheaper frame with the same ids, for
    instance the rows before a dedupe by id. The amounts per id and the tied runs are written down once, so ``df`` is read
    once (and ``bounds`` once); the result, one row or none, is computed here.
    """
    k = min_distance + 1
    common = math.lcm(*range(k, 2 * k))
    if common * (1 << 63) >= 10**38:
        raise ValueError(f"averages over {k} to {2 * k - 1} ids cannot be compared exactly")
    spark = df.sparkSession
    # Whole cents in 64 bits: exact like decimals, and a range never sums more than its own ids.
    cents = (F.col("_amount").cast("decimal(18,2)") * 100).cast("bigint")
    with stages(spark) as staged:
        totals = staged(df.groupBy(id_col).agg(F.sum(amount).alias("_amount")).select(id_col, cents.alias("_cents")), "run-totals")
        low, high = (id_bounds(totals, id_col) if bounds is None else bounds).first()[0]
        found = []
        if low is not None:
            tied = staged(_best_per_range(totals, low, high, id_col, k, width, common), "run-ties")
            per_range = tied.groupBy("_range", "_best").agg(F.count("*").alias("_ties"), F.min("_span").alias("_span"))
            # One row per range and best of a range; the greatest best of all, with its ties and its first run.
            found = per_range.groupBy("_best").agg(F.sum("_ties").alias("matchnum"), F.min("_span").alias("_span")).orderBy(
                F.col("_best").desc()).limit(1).collect()
        results = []
        for best in found:
            ties = best.matchnum
            if every_length and best._best == 0:
                # All runs tie; elsewhere zeros at either end make a run longer than k no best one.
                ties = (high - low + 2 - k) * (high - low + 3 - k) // 2
            elif every_length:
                ties += _long_ties(tied, totals, best, id_col, k, 2 * k - 2, width)
            n = best._span.last - best._span.first + 1
            results.append((1, best._span.cents / 100 / n, f"{best._span.first}-{best._span.last}", ties))
    return spark.createDataFrame(results, "seq_index int, avg_order_price double, id_range string, matchnum bigint")


def _best_per_range(totals: DataFrame, low: int, high: int, id_col: str, k: int, width: int, common: int) -> DataFrame:
    """The runs of ``k`` to ``2k - 1`` ids that have the best average of the id range they end in.

    One row per run: its range, the average as a whole number (``_best``), the running total at its end, and ``_span`` (first id,
    last id, cents).
    """
    reach, min_distance = 2 * k - 2, k - 1
    rows = _with_halo(totals, id_col, reach, width).withColumn("_bounds", F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")))
    dense = _fill_near_gaps(rows, id_col, "_cents", reach)

    order = Window.partitionBy("_range").orderBy(id_col)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col(id_col)
    new_island = F.when(F.coalesce(F.lag(id_col).over(order) + 1 != end, F.lit(True)), end)
    summed = dense.withColumns({"_new": new_island, "_sum": F.sum("_cents").over(so_far)})
    # A frame of rows over one number is cheap to collect. Rows are consecutive ids inside an island,
    # so the last entry belongs to the start min_distance ids back and each earlier one to one id more.
    band = order.rowsBetween(-reach, -min_distance)
    starts = summed.withColumns({
        "_island": F.max("_new").over(so_far),
        "_priors": F.collect_list(F.col("_sum") - F.col("_cents")).over(band),
    })
    native = starts.filter(F.col("_range") == _range_of(end, width)).withColumn("_last", F.size("_priors") - 1)

    # An average s/n is compared as the whole number s * (common / n), with no rounding.
    whole = [F.lit(Decimal(common // (k + j))).cast("decimal(18,0)") for j in range(k)]

    def average(prior: Column, j: int) -> Column:
        mean = ((F.col("_sum") - prior).cast("decimal(19,0)") * whole[j]).cast("decimal(38,0)")
        return F.when(end - (min_distance + j) >= F.col("_island"), mean)

    # Plain expressions over array positions stay in generated code, a lambda over the array would not.
    averages = [average(F.get("_priors", F.col("_last") - j), j) for j in range(k)]
    best = native.withColumn("_best", F.greatest(*averages))
    # Only right ends that reach their range's best go on to the comparison of single runs.
    top = F.max("_best").over(Window.partitionBy("_range"))
    ends = best.withColumn("_top", top).filter(F.col("_best") == F.col("_top"))
    hits = F.array(*[F.when(a == F.col("_best"), F.struct(
        (end - (min_distance + j)).alias("first"), end.alias("last"),
        (F.col("_sum") - F.get("_priors", F.col("_last") - j)).alias("cents"))) for j, a in enumerate(averages)])
    return ends.select("_range", "_best", F.col("_sum").alias("_upto"), F.explode(F.array_compact(hits)).alias("_span"))
