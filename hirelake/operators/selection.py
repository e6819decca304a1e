"""Exact quantiles by narrowing (G10): the element of a rank, found without sorting,
without a sketch and without a map of a group's values.

A double's bit pattern, read as a whole number (negative values turned round), is in
the order of the values. Equal values of a group are counted first; then every pass
cuts each group's range of patterns into ``BINS`` equal intervals, counts the rows of
each, and keeps the interval that holds the wanted rank, trimmed to the patterns that
are there, until it holds ``FINISH`` different values or fewer, which are sorted. A pass shrinks a range by ``BINS`` at least, so
any data end after eight passes; salaries take one, small groups none.

A pass is one aggregate with map-side counts: a group that holds a third of all rows is
``BINS`` rows a task before the shuffle. The result depends on the values alone, not on
partitions or retries. The counted values and each pass's ranges, a row a group, are
written to the shared checkpoint folder, so a lost executor costs its tasks only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.session import stored

BINS = 1 << 10
FINISH = 1 << 12              # different values of a group that are sorted at the end
_MANTISSA = 1 << 52
_ABOVE = (1 << 63) - 1        # NaN, the largest value in Spark's order
_INFINITE = _ABOVE - 1


def ordered_bits(value: Column) -> Column:
    """A double's IEEE pattern as a long in the order of the values.

    |x| = (1 + m) 2^e has the pattern (e + 1023) 2^52 + m 2^52; below 2^-1022 the
    pattern is x in units of 2^-1074. log2 may round across a power of two, so e is put
    right by one. Both zeros are 0; infinities and NaN come after the finite values.
    """
    size = F.abs(value)

    def scaled(e: Column) -> Column:       # in two steps: 2^-e alone may pass a double
        half = F.floor(e / 2)
        return size / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), e - half)

    e = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    e = F.when(scaled(e) >= 2, e + 1).when((scaled(e) < 1) & (e > -1022), e - 1).otherwise(e)
    bits = (e + 1022) * F.lit(_MANTISSA) + (scaled(e) * F.lit(float(_MANTISSA))).cast("long")
    bits = F.when(value == 0, F.lit(0)).when(size == float("inf"), F.lit(_INFINITE)).otherwise(bits)
    signed = F.when(value < 0, -bits).otherwise(bits)
    return F.when(F.isnan(value), F.lit(_ABOVE)).otherwise(signed).cast("long")


def exact_quantiles(df: DataFrame, keys: list[str], value: str, q: float = 0.5,
                    weight: str | None = None) -> DataFrame:
    """``keys`` and ``value``: of each group the smallest value that at least a part
    ``q`` of its non-NULL values does not exceed (``percentile_disc``).

    Groups without a value are left out; NULL keys are a group. ``q`` is from 0 to 1.
    A row counts ``weight`` times, if given (whole numbers above 0).
    """
    names = [f"k{i}" for i in range(len(keys))]
    one = [F.col(k).alias(n) for k, n in zip(keys, names)]
    times = F.col(weight) if weight else F.lit(1)
    counted = stored(df.select(*one, F.col(value).cast("double").alias("v"),
                               times.cast("long").alias("w")).where("v IS NOT NULL")
                     .groupBy(*names, "v").agg(F.sum("w").alias("n"))
                     .withColumn("b", ordered_bits(F.col("v"))), "selection-values")
    total = F.sum("n")
    state = counted.groupBy(*names).agg(
        F.min("b").alias("lo"), F.max("b").alias("hi"), F.count(F.lit(1)).alias("d"),
        F.greatest(F.ceil(total * F.lit(q)), F.lit(1)).cast("long").alias("rank"))
    state = stored(state, "selection-ranges")
    wide = (F.col("lo") < F.col("hi")) & (F.col("d") > FINISH)

    def inside(ranges: DataFrame) -> DataFrame:
        named = ranges.select(*[F.col(n).alias(f"_{n}") for n in names], "lo", "hi", "rank")
        same = F.lit(True)
        for n in names:
            same = same & F.col(n).eqNullSafe(F.col(f"_{n}"))
        return counted.join(named, same).where("b BETWEEN lo AND hi")

    while not state.where(wide).isEmpty():
        # signs are parted first: a range over both may be too wide for a long
        place = F.when(F.expr("lo < 0 AND hi >= 0"), F.when(F.col("b") < 0, 0).otherwise(1)).otherwise(
            F.expr(f"(b - lo) div ((hi - lo) div {BINS} + 1)"))
        bins = inside(state.where(wide)).groupBy(*names, "rank", place.alias("bin")).agg(
            F.sum("n").alias("n"), F.min("b").alias("lo"), F.max("b").alias("hi"),
            F.count(F.lit(1)).alias("d"))
        upto = Window.partitionBy(*names).orderBy("bin").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        met = bins.withColumn("end", F.sum("n").over(upto)).where(
            "end >= rank AND end - n < rank").select(
            *names, "lo", "hi", "d", (F.col("rank") - (F.col("end") - F.col("n"))).alias("rank"))
        state = stored(state.where(~wide).unionByName(met), "selection-ranges")
    upto = Window.partitionBy(*names).orderBy("b").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return inside(state).withColumn("end", F.sum("n").over(upto)).where(
        "end >= rank AND end - n < rank").select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)], F.col("v").alias(value))
