"""The six gold tables, straight from silver trips or from one shared rollup of them.

Groupings by hour, month or place combine on the map side, so a hot hour or place costs one row per
input task. Boroughs are looked up after counting by place: the lookup then joins at most (places x places)
rows instead of every trip.

Monthly tables group by the month number. A period of several years adds the year, or months would mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import known_borough, mean_of_parts, month_start
from kerbside.functions.exact_sum import digits_of, is_finite, scale_of, total

BY_HOUR, BY_MONTH, BY_ROUTE = "hour", "month", "route"
PLACES = ["pickup_location_id", "dropoff_location_id"]
SCALE = "distance_scale"


def _with_calendar(trips: DataFrame, by_year: bool) -> DataFrame:
    pickup = F.col("pickup_datetime")
    dated = trips.withColumn("month", F.month(pickup))
    return dated.withColumn("year", F.year(pickup)) if by_year else dated


def _calendar(by_year: bool) -> list[str]:
    return ["year", "month"] if by_year else ["month"]


def _has_passengers() -> Column:
    return F.col("passenger_count") > 0


# Straight from silver -------------------------------------------------------------------------------------------


def hourly_demand(trips: DataFrame) -> DataFrame:
    """Trips per hour of day."""
    return (
        trips.filter(F.col("pickup_datetime").isNotNull())
        .groupBy(F.hour("pickup_datetime").alias("hour"))
        .agg(F.count("*").alias("ride_count"))
    )


def rides_per_place(trips: DataFrame, *places: str) -> DataFrame:
    return trips.groupBy(*places).agg(F.count("*").alias("ride_count"))


def demand_by_borough(trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Trips per known pickup borough."""
    return borough_totals(rides_per_place(trips, "pickup_location_id"), lookup)


def popular_routes(trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Trips per pair of known boroughs; the whole table, the cut to the top is made when serving."""
    return route_totals(rides_per_place(trips, "pickup_location_id", "dropoff_location_id"), lookup)


def borough_totals(rides: DataFrame, lookup: DataFrame) -> DataFrame:
    known = lookup.filter(known_borough(F.col("Borough")))
    return (
        rides.join(known, F.col("pickup_location_id") == F.col("zone_LocationID"))
        .groupBy("Borough")
        .agg(F.sum("ride_count").alias("ride_count"))
    )


def route_totals(rides: DataFrame, lookup: DataFrame) -> DataFrame:
    known = lookup.filter(known_borough(F.col("Borough")))
    pickup = known.select(F.col("zone_LocationID").alias("PU_zone_id"), F.col("Borough"))
    dropoff = known.select(F.col("zone_LocationID").alias("DO_zone_id"), F.col("Borough").alias("DO_Borough"))
    return (
        rides.join(pickup, F.col("pickup_location_id") == F.col("PU_zone_id"))
        .join(dropoff, F.col("dropoff_location_id") == F.col("DO_zone_id"))
        .groupBy("Borough", "DO_Borough")
        .agg(F.sum("ride_count").alias("ride_count"))
    )


def avg_duration(trips: DataFrame, by_year: bool = False) -> DataFrame:
    """Minutes per trip, by month."""
    seconds = F.col("duration_sec")
    return (
        _with_calendar(trips, by_year)
        .groupBy(*_calendar(by_year))
        .agg((mean_of_parts(F.sum(seconds), F.count(seconds)) / 60).alias("avg_duration_min"))
    )


def _digits(miles: Column) -> dict[str, Column]:
    return {f"distance_d{3 - nth}": digit for nth, digit in enumerate(digits_of(miles))}


def _distance_sums(miles: Column) -> dict[str, Column]:
    """What adds up over the distances of one scale, as sums and counts."""
    return {
        **{name: F.sum(name) for name in _digits(miles)},
        "distance_rides": F.count(miles),
        "distance_nan_rides": F.count_if(F.isnan(miles)),
        "distance_inf_rides": F.count_if(~is_finite(miles) & (miles > 0) & ~F.isnan(miles)),
        "distance_minus_inf_rides": F.count_if(~is_finite(miles) & (miles < 0)),
    }


def _parts() -> Column:
    return F.struct(F.col(SCALE).alias("scale"), *[F.col(f"distance_d{n}").alias(f"d{n}") for n in (3, 2, 1, 0)])


def _mean_distance() -> Column:
    """Aggregate over the states of all scales: the exact sum, rounded once, by the number of distances.

    Like a mean of doubles it is NaN or infinite where a distance is, and null without any.
    """
    high, low = F.sum("distance_inf_rides"), F.sum("distance_minus_inf_rides")
    odd = (F.sum("distance_nan_rides") > 0) | ((high > 0) & (low > 0))
    mean = mean_of_parts(total(F.collect_list(_parts())), F.sum("distance_rides"))
    return (
        F.when(odd, F.lit(float("nan"))).when(high > 0, F.lit(float("inf"))).when(low > 0, F.lit(float("-inf"))).otherwise(mean)
    )


def avg_distance(trips: DataFrame, by_year: bool = False) -> DataFrame:
    """Miles per trip, by month: the average of the exact sum, whatever the order and partitioning of the rows.

    Distances of about one size add up as whole numbers, one row per month and size; a month has a handful of sizes.
    """
    miles, calendar = F.col("trip_distance"), _calendar(by_year)
    keyed = _with_calendar(trips, by_year).withColumn(SCALE, scale_of(miles)).withColumns(_digits(miles))
    states = keyed.groupBy(*calendar, SCALE).agg(*[c.alias(n) for n, c in _distance_sums(miles).items()])
    return states.groupBy(*calendar).agg(_mean_distance().alias("avg_distance"))


def avg_passengers(trips: DataFrame, by_year: bool = False) -> DataFrame:
    """Passengers per trip that has any, by month."""
    people = F.col("passenger_count")
    return (
        _with_calendar(trips.filter(_has_passengers()), by_year)
        .groupBy(*_calendar(by_year))
        .agg(mean_of_parts(F.sum(people), F.count(people)).alias("avg_passenger_count"))
    )


# From one shared pass -------------------------------------------------------------------------------------------


def _states(trips: DataFrame, hours: list[str], months: list[str], places: list[str]) -> DataFrame:
    """Partial states by the three grouping sets of an aggregate, one scan of ``trips``. ``grain`` names the set of a row.

    All measures are sums and counts, so states of disjoint trips merge by addition. Distances add up within a scale, which
    the set of months has as a further key.
    """
    miles, people = F.col("trip_distance"), F.when(_has_passengers(), F.col("passenger_count"))
    measures = trips.withColumn("hour", F.hour("pickup_datetime")).withColumn("people", people)
    measures = measures.withColumn(SCALE, scale_of(miles)).withColumns(_digits(miles))
    grain = (
        F.when(F.grouping("hour") == 0, F.lit(BY_HOUR))
        .when(F.grouping(SCALE) == 0, F.lit(BY_MONTH))
        .otherwise(F.lit(BY_ROUTE))
    )
    keys = list(dict.fromkeys([*hours, *months, *places]))
    sums = {
        "ride_count": F.count("*"),
        "duration_sec_sum": F.sum("duration_sec"),
        "duration_rides": F.count("duration_sec"),
        **_distance_sums(miles),
        "passenger_rides": F.count("people"),
        "passenger_sum": F.sum("people"),
    }
    rolled = measures.groupingSets([hours, [*months, SCALE], places], *keys, SCALE).agg(
        grain.alias("grain"), *[c.alias(n) for n, c in sums.items()]
    )
    of_month = {
        n: F.when(F.col("grain") == BY_MONTH, F.col(n)).alias(n) for n in sums if n.startswith("distance")
    }
    return rolled.select("grain", *keys, SCALE, *[of_month.get(n, F.col(n)) for n in sums])


def activity_rollup(trips: DataFrame, by_year: bool = False) -> DataFrame:
    """Everything that the six tables need, from a single scan of silver.

    Three grouping sets (hour, month and size of distance, pair of places) in one aggregate. The result has at most
    24 + months x sizes + places x places rows, whatever the number of trips.
    """
    return _states(_with_calendar(trips, by_year), ["hour"], _calendar(by_year), PLACES)


def month_states(trips: DataFrame) -> DataFrame:
    """The rollup of each pickup month by itself (``pickup_month``): what a changed month replaces and gold merges."""
    month = F.col("pickup_month") if "pickup_month" in trips.columns else month_start(F.col("pickup_datetime"))
    dated = trips.withColumn("pickup_month", month)
    return _states(dated, ["pickup_month", "hour"], ["pickup_month"], ["pickup_month", *PLACES])


def rollup_of_states(states: DataFrame, by_year: bool = False) -> DataFrame:
    """The rollup of all months out of the states of each: sums of a few rows per month."""
    of_month = F.col("grain") == BY_MONTH
    dated = states.withColumn("month", F.when(of_month, F.month("pickup_month")))
    if by_year:
        dated = dated.withColumn("year", F.when(of_month, F.year("pickup_month")))
    keys = ["grain", "hour", *_calendar(by_year), *PLACES, SCALE]
    measures = [c for c in states.columns if c not in {*keys, "pickup_month"}]
    return dated.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def month_rows(rollup: DataFrame) -> DataFrame:
    """(calendar, ride_count, the three averages, passenger_rides) of each month of a rollup."""
    months = rollup.filter(F.col("grain") == BY_MONTH)
    return months.groupBy(*_calendar("year" in rollup.columns)).agg(
        F.sum("ride_count").alias("ride_count"),
        (mean_of_parts(F.sum("duration_sec_sum"), F.sum("duration_rides")) / 60).alias("avg_duration_min"),
        _mean_distance().alias("avg_distance"),
        mean_of_parts(F.sum("passenger_sum"), F.sum("passenger_rides")).alias("avg_passenger_count"),
        F.sum("passenger_rides").alias("passenger_rides"),
    )


def readable_rollup(rollup: DataFrame) -> DataFrame:
    """The rollup with the sums of all sizes of distance joined: one row per hour, month and pair of places."""
    keys = ["grain", "hour", *_calendar("year" in rollup.columns), *PLACES]
    of_month = F.col("grain") == BY_MONTH
    joined = rollup.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in ("ride_count", "duration_sec_sum", "duration_rides")],
        total(F.collect_list(_parts())).alias("distance_sum"),
        *[F.sum(n).alias(n) for n in ("distance_rides", "passenger_rides", "passenger_sum")],
    )
    return joined.withColumn("distance_sum", F.when(of_month, F.col("distance_sum")))


def gold_from_rollup(rollup: DataFrame, lookup: DataFrame) -> dict[str, DataFrame]:
    """The six gold tables out of a stored rollup. Equal to the direct forms on any silver table."""
    calendar = _calendar("year" in rollup.columns)
    hours = rollup.filter((F.col("grain") == BY_HOUR) & F.col("hour").isNotNull())
    months = month_rows(rollup)
    routes = rollup.filter(F.col("grain") == BY_ROUTE)
    per_pickup = routes.groupBy("pickup_location_id").agg(F.sum("ride_count").alias("ride_count"))
    return {
        "hourly_demand": hours.select("hour", "ride_count"),
        "demand_by_borough": borough_totals(per_pickup, lookup),
        "popular_routes": route_totals(
            routes.select("pickup_location_id", "dropoff_location_id", "ride_count"), lookup
        ),
        "avg_duration": months.select(*calendar, "avg_duration_min"),
        "avg_distance": months.select(*calendar, "avg_distance"),
        "avg_passengers": months.filter("passenger_rides > 0").select(*calendar, "avg_passenger_count"),
    }


def monthly_averages(rollup: DataFrame) -> DataFrame:
    """The three averages of each month side by side, out of the rollup's month rows: no join."""
    averages = ["avg_duration_min", "avg_distance", "avg_passenger_count"]
    return month_rows(rollup).select(*_calendar("year" in rollup.columns), *averages)
