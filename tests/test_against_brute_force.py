"""The whole pipeline against plain Python loops, on random trips that sit close to every limit."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import rows

from kerbside.operators import cleaning, demand, quality
from kerbside.schemas import BRONZE_TRIPS

BOROUGHS = {1: "Queens", 2: "Bronx", 3: "Unknown", 4: "N/A", 5: "EWR", 6: "Queens", 7: None}


def random_trips(seed: int, n: int = 400) -> list[tuple]:
    pick = random.Random(seed)
    starts = ["2024-12-31 23:59:58.5", "2025-01-01 00:00:00", "2025-03-09 01:59:59.9", "2025-12-31 23:59:59.999999"]
    gaps = [-61, -60, -59, -1, -0.4, 0, 0.6, 59, 59.5, 60, 61, 3000, 7199, 7199.9, 7200, 7201]
    miles = [None, float("nan"), -1.0, 0.0, 0.001, 2.5, 2.501, 29.999, 30.0, 31.0]
    trips = []
    for _ in range(n):
        start = datetime.fromisoformat(pick.choice(starts)) + timedelta(seconds=pick.choice([0, 0, 0.3, 1, 86400 * 40]))
        trips.append(
            (
                None if pick.random() < 0.03 else start,
                None if pick.random() < 0.03 else start + timedelta(seconds=pick.choice(gaps)),
                pick.choice([None, 0, 1, 2, 3]),
                pick.choice(miles),
                pick.choice([None, 1, 2, 3, 4, 5, 6, 7, 8]),
                pick.choice([1, 2, 6, 8]),
            )
        )
    return trips + trips[:40]


def whole(moment: datetime) -> int:
    return int((moment.replace(microsecond=0) - datetime(1970, 1, 1)).total_seconds())


def brute_silver(trips: list[tuple]) -> list[tuple]:
    best: dict[tuple, tuple] = {}
    for start, end, people, miles, pu, do in trips:
        if start is None or not datetime(2025, 1, 1) <= start < datetime(2026, 1, 1):
            continue
        if end is not None and 0 < whole(start) - whole(end) < 60:
            end = start
        if end is None or miles is None or miles != miles:
            continue
        seconds = whole(end) - whole(start)
        if not (60 <= seconds < 7200 and 0 < miles < 30):
            continue
        key, rank = (start, end, pu, do), (miles, people or 0)
        best[key] = min(best.get(key, rank), rank)
    return [
        (start, end, people, miles, pu, do, whole(end) - whole(start))
        for (start, end, pu, do), (miles, people) in best.items()
    ]


@pytest.mark.parametrize("seed", range(6))
def test_pipeline(spark, seed):
    trips = random_trips(seed)
    bronze = spark.createDataFrame(trips, BRONZE_TRIPS).repartition(1 + seed)
    silver = cleaning.clean_trips(bronze).cache()
    expected = brute_silver(trips)
    assert sorted(rows(silver), key=repr) == sorted(expected, key=repr) and expected

    lookup = spark.createDataFrame(list(BOROUGHS.items()), "zone_LocationID INT, Borough STRING")
    gold = demand.gold_from_rollup(demand.activity_rollup(silver).cache(), lookup)
    assert sorted(rows(gold["hourly_demand"])) == sorted(Counter(t[0].hour for t in expected).items())

    def known(place):
        name = BOROUGHS.get(place)
        return name if name not in (None, "Unknown", "N/A", "EWR") else None

    per_borough = Counter(known(t[4]) for t in expected if known(t[4]))
    assert sorted(rows(gold["demand_by_borough"])) == sorted(per_borough.items())
    per_route = Counter((known(t[4]), known(t[5])) for t in expected if known(t[4]) and known(t[5]))
    assert sorted(rows(gold["popular_routes"])) == sorted((*route, n) for route, n in per_route.items())
    by_month = defaultdict(list)
    for trip in expected:
        by_month[trip[0].month].append(trip)
    for name, of, keep in (
        ("avg_duration", lambda t: t[6] / 60, lambda t: True),
        ("avg_distance", lambda t: t[3], lambda t: True),
        ("avg_passengers", lambda t: t[2], lambda t: t[2] > 0),
    ):
        wanted = {m: [of(t) for t in ts if keep(t)] for m, ts in sorted(by_month.items())}
        wanted = {m: sum(v) / len(v) for m, v in wanted.items() if v}
        assert dict(rows(gold[name])) == pytest.approx(wanted, rel=1e-12), name

    funnel = {step: n for _, step, n in rows(cleaning.cleaning_funnel(bronze))}
    assert funnel["bronze"] == len(trips) and funnel["silver"] == len(expected)
    metrics = quality.silver_metrics(silver).first()
    assert metrics.zero_passengers == sum(t[2] == 0 for t in expected)
    spark.catalog.clearCache()
