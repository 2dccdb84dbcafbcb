"""Totals before a place in a long order, added up over a tree of fixed fan-out, so that no task orders the whole list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

FAN_BITS = 18
LEVELS = 3  # above the places themselves: 64 bits are 18 + 18 + 18 + 10


def totals_before(totals: DataFrame, place: str, total: str, out: str, descending: bool = False) -> DataFrame:
    """``totals`` (one row per 64-bit integer ``place``) with the sum of ``total`` over all smaller places, or all greater ones.

    Places are grouped by all but their last 18 bits, these groups by all but the next 18, and so on. Each level
    is a window inside its parent, of 2^18 rows at most, however the places are spread; the few children of the root
    (2^10 at most) are the only list ordered in one task.
    """
    upper = [f"_r{k}" for k in range(1, LEVELS + 1)]
    names = [place, *upper]
    level = totals.select(place, F.col(total).alias("_t0"), F.shiftright(place, FAN_BITS).alias(upper[0]))
    tables = []
    for k, name in enumerate(names):
        order = F.col(name).desc() if descending else F.col(name).asc()
        inside = Window.partitionBy(names[k + 1]) if k < LEVELS else Window.partitionBy()
        before = F.sum(f"_t{k}").over(inside.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
        tables.append(level.withColumn(f"_b{k}", before).drop(f"_t{k}"))
        if k < LEVELS:
            keys = names[k + 1:k + 3]
            level = level.groupBy(names[k + 1]).agg(F.sum(f"_t{k}").alias(f"_t{k + 1}"))
            if len(keys) == 2:
                level = level.withColumn(keys[1], F.shiftright(keys[0], FAN_BITS))
    found = tables[-1]
    for k in range(LEVELS - 1, -1, -1):
        found = tables[k].join(found, names[k + 1])
    zero = F.lit(0).cast(totals.schema[total].dataType)
    ahead = sum((F.coalesce(f"_b{k}", zero) for k in range(1, LEVELS + 1)), F.coalesce("_b0", zero))
    return found.select(place, ahead.alias(out))


def decimal_code(value: Column, scale: int) -> Column:
    """A decimal as the integer number of its last places, which orders like the value; an error beyond 64 bits."""
    return (value.cast(f"decimal(38,{scale})") * F.lit(10**scale).cast("decimal(20,0)")).cast("bigint")


def double_code(value: Column) -> Column:
    """The bit pattern of a double as an integer that orders like the value: 52 bits of fraction below the exponent.

    Powers of two are exact in doubles, so every step is; the logarithm is only a first guess of the exponent. Both
    zeros are one value; NaN comes last, behind infinity.
    """
    x = F.abs(value)
    guess = F.greatest(F.floor(F.log2(x)), F.lit(-1022)).cast("double")
    power = lambda p: F.pow(F.lit(2.0), p)
    guess = F.when(power(guess) > x, guess - 1).otherwise(guess)
    exponent = F.when(x / 2 >= power(guess), guess + 1).otherwise(guess)
    normal = (exponent + 1023).cast("bigint") * F.lit(1 << 52) + ((x / power(exponent) - 1) * F.lit(float(1 << 52))).cast("bigint")
    small = (x / power(F.lit(-1074.0))).cast("bigint")
    size = F.when(x == 0, F.lit(0).cast("bigint")).when(x < power(F.lit(-1022.0)), small).otherwise(normal)
    infinite = F.lit(2047 << 52)
    return (
        F.when(F.isnan(value), infinite + 1).when(value == float("inf"), infinite).when(value == float("-inf"), -infinite)
        .when(value < 0, -size).otherwise(size)
    )
