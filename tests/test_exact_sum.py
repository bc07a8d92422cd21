from __future__ import annotations

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kerbside.functions.exact_sum import digits_of, scale_of, total

RND = random.Random(21)
LISTS = {
    "tiny": [1e-10] * 10 + [3e-10],
    "huge": [1e20, 1.5e20, 0.1],
    "mixed": [1e20, 1e-10, -1e20, 0.1, 0.2, 0.3, 1e308, -1e308, 5e-324],
    "far apart": [1e300, 1e-300, 1.0, -1e300],
    "cancelling": [0.1, -0.1, 1e16, 1.0, -1e16],
    "zero": [0.0, -0.0],
    "negative": [-0.1] * 7 + [-1e-17],
    "half way": [1.0, 2.0**-53, 2.0**-106],
    "half way to even": [1.0, 2.0**-53],
    "just below a power": [math.nextafter(2.0**k, 0) for k in (-48, -24, 0, 24, 48)],
    "subnormal": [5e-324] * 3 + [2.5e-310],
    "trips": [RND.randrange(1, 3000) / 100 for _ in range(2000)],
    "any": [RND.choice([-1, 1]) * RND.random() * 10.0 ** RND.randrange(-30, 30) for _ in range(500)],
}


def exact_totals(frame):
    """{name: total} of (name, x) by states of each scale."""
    digits = [d.alias(f"d{3 - n}") for n, d in enumerate(digits_of(F.col("x")))]
    cut = frame.select("name", scale_of(F.col("x")).alias("scale"), *digits)
    states = cut.groupBy("name", "scale").agg(*[F.sum(f"d{n}").alias(f"d{n}") for n in (3, 2, 1, 0)])
    parts = F.struct("scale", "d3", "d2", "d1", "d0")
    return dict(rows(states.groupBy("name").agg(total(F.collect_list(parts)))))


@pytest.mark.parametrize("partitions", [1, 5])
def test_sums_are_those_of_fsum(spark, partitions):
    data = [(name, x) for name, xs in LISTS.items() for x in xs]
    RND.shuffle(data)
    frame = spark.createDataFrame(data, "name STRING, x DOUBLE").repartition(partitions)
    assert exact_totals(frame) == {name: math.fsum(xs) for name, xs in LISTS.items()}


def test_random_sums_are_those_of_fsum(spark):
    lists = {}
    for n in range(300):
        spread = RND.choice([1, 5, 40, 250])
        lists[str(n)] = [RND.choice([-1, 1, 1]) * RND.random() * 2.0 ** RND.randrange(-spread, spread + 1) for _ in range(RND.randrange(1, 30))]
    frame = spark.createDataFrame([(n, x) for n, xs in lists.items() for x in xs], "name STRING, x DOUBLE")
    assert exact_totals(frame) == {n: math.fsum(xs) for n, xs in lists.items()}
