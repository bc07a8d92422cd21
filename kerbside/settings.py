"""Parameters of the jobs. The defaults are the fixed values that decide results."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Fixed values.
SKEW_TOLERANCE_SEC = 60
MIN_DURATION_SEC = 60
MAX_DURATION_SEC = 7200
MAX_DISTANCE_MILES = 30.0
EXCLUDED_BOROUGHS = ("Unknown", "N/A", "EWR")
RECHECK_EXCLUDED_BOROUGHS = ("Unknown", "N/A")
TOP_ROUTES = 20
SAMPLE_ROWS = 5
MONTH_FILE = "yellow_tripdata_{month}.parquet"
GOLD_TABLES = (
    "hourly_demand",
    "demand_by_borough",
    "popular_routes",
    "avg_duration",
    "avg_distance",
    "avg_passengers",
)
CRITICAL_CHECKS = ("negative_duration", "invalid_distance", "null_duration", "null_distance")


@dataclass(frozen=True)
class Period:
    """Half-open range of whole months, ``start`` inclusive and ``end`` exclusive."""

    start: date = date(2025, 1, 1)
    end: date = date(2026, 1, 1)

    def __post_init__(self) -> None:
        if self.start.day != 1 or self.end.day != 1 or self.start >= self.end:
            raise ValueError(f"a period runs from one first of month to a later one, got {self.start}..{self.end}")

    @property
    def month_count(self) -> int:
        return (self.end.year - self.start.year) * 12 + self.end.month - self.start.month

    @property
    def months(self) -> list[str]:
        first = self.start.year * 12 + self.start.month - 1
        return [f"{n // 12:04d}-{n % 12 + 1:02d}" for n in range(first, first + self.month_count)]

    def each_month(self) -> list[Period]:
        """The period split into its single months."""
        firsts = [date.fromisoformat(f"{m}-01") for m in self.months] + [self.end]
        return [Period(first, following) for first, following in zip(firsts, firsts[1:])]

    @property
    def several_years(self) -> bool:
        """True when a month number alone would mix two years."""
        return self.month_count > 12 or self.months[0][:4] != self.months[-1][:4]


@dataclass(frozen=True)
class CleaningRules:
    skew_tolerance_sec: int = SKEW_TOLERANCE_SEC
    min_duration_sec: int = MIN_DURATION_SEC
    max_duration_sec: int = MAX_DURATION_SEC
    max_distance_miles: float = MAX_DISTANCE_MILES


@dataclass(frozen=True)
class LakeLayout:
    """Where each layer lives, below one root that any Hadoop file system can serve."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def zones(self) -> str:
        return f"{self.root}/raw/taxi_zone_lookup.csv"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/trips"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/clean_trips"

    @property
    def marked(self) -> str:
        return f"{self.root}/silver/marked_trips"

    @property
    def rollup(self) -> str:
        return f"{self.root}/gold/activity_rollup"

    @property
    def states(self) -> str:
        return f"{self.root}/gold/month_states"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"
