"""Exact quantiles by narrowing, against sorted values."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from hirelake.operators import selection

ODD = [0.0, -0.0, 1.0, 2.0, 3.0, 0.1, 1e-310, 5e-324, -5e-324, 1e308, -1e308, math.inf, -math.inf,
       2.0 ** 52 - 0.5, 2.0 ** 53, 1 - 2 ** -53, 1 + 2 ** -52, 2.2250738585072014e-308,
       8.98846567431158e+307, 4.450147717014403e-308, 1.7976931348623157e308]


def _bits(x):
    if x == 0:
        return 0
    n = struct.unpack(">q", struct.pack(">d", abs(x)))[0]
    return -n if x < 0 else n


def test_bits_are_the_pattern_s(spark):
    dice = random.Random(4)
    values = ODD + [dice.choice([-1, 1]) * dice.random() * 10.0 ** dice.randrange(-320, 309)
                    for _ in range(3000)]
    values += [math.ldexp(1 - 2 ** -53 * dice.randrange(3), e) for e in range(-1074, 1024)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", selection.ordered_bits(F.col("v")).alias("b")).collect()
    for r in rows:
        if not math.isinf(r.v):
            assert r.b == _bits(r.v), r.v
    most = max(r.b for r in rows)
    assert all((r.b == most) == (r.v == math.inf) for r in rows)


@pytest.mark.parametrize("bins", [2, 1 << 10])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_equal_to_sorted_values(spark, monkeypatch, bins, q):
    monkeypatch.setattr(selection, "BINS", bins)
    monkeypatch.setattr(selection, "FINISH", 1 if bins == 2 else 20)     # narrow down to values
    dice = random.Random(bins)
    rows = [(dice.choice(["a", "a", "a", "b", None]), dice.randrange(3),
             dice.choice([None, float(dice.randrange(40)), -float(dice.randrange(9)), 7.0]))
            for _ in range(900)]
    rows += [("odd", 0, v) for v in ODD] + [("none", 0, None), ("one", 1, 4.5)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(5)
    groups = {}
    for g, h, v in rows:
        if v is not None:
            groups.setdefault((g, h), []).append(v)
    want = {k: sorted(vs)[max(math.ceil(q * len(vs)), 1) - 1] for k, vs in groups.items()}
    got = selection.exact_quantiles(df, ["g", "h"], "v", q).collect()
    assert {(r.g, r.h): r.v for r in got} == want and len(got) == len(want)


def test_partitioning_does_not_matter(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"),
                                    F.pow(F.lit(1.001), F.col("id")).alias("v"))
    one, many = (rows_of(selection.exact_quantiles(d, ["g"], "v"))
                 for d in (df.coalesce(1), df.repartition(13)))
    assert one == many
    disc = df.groupBy("g").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("v"))
    assert one == rows_of(disc)


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert selection.exact_quantiles(df, ["g"], "v").collect() == []
