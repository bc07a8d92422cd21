"""Column expressions: built-in functions only, so every caller stays in whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.settings import EXCLUDED_BOROUGHS


def ntz(day: date) -> Column:
    """Midnight of ``day`` as a zone-free literal. Parquet scans do not skip row groups by such times: partitions do."""
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def month_start(when: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(when.cast("date"), "month")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two times, each cut to its second first (00:00:00.9 to 00:01:00.1 is 60)."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def epoch_micros(when: Column) -> Column:
    """Microseconds since 1970 of a zone-free time, whatever the session's zone."""
    fraction = F.pmod((F.extract(F.lit("SECOND"), when) * 1_000_000).cast("bigint"), F.lit(1_000_000))
    return F.unix_timestamp(when) * 1_000_000 + fraction


def known_borough(borough: Column, excluded: Sequence[str] = EXCLUDED_BOROUGHS) -> Column:
    """Present and not one of the placeholder names; the comparison is case-sensitive."""
    return borough.isNotNull() & ~borough.isin(*excluded)


def mean_of_parts(total: Column, rows: Column) -> Column:
    """Average from a total and a row count; null where there are no rows."""
    return F.try_divide(total.cast("double"), rows.cast("double"))


def round_half_even(value: Column, pattern: str = "0.00") -> Column:
    """Two decimals, rounded from the exact binary value with ties to even.

    This is the rounding that Python's ``round(x, 2)`` does (2.675 gives 2.67, 0.125 gives 0.12); Spark's
    ``round`` gives 2.68 and 0.13. The served results were rounded in Python, so the views follow it.
    """
    return F.call_function("format_number", value, F.lit(pattern)).cast("double")
