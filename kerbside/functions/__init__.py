"""Column expressions shared by the operators; all of them stay inside the JVM."""

from kerbside.functions.columns import (
    elapsed_seconds,
    epoch_micros,
    known_borough,
    mean_of_parts,
    month_start,
    ntz,
    round_half_even,
)

__all__ = [
    "elapsed_seconds",
    "epoch_micros",
    "known_borough",
    "mean_of_parts",
    "month_start",
    "ntz",
    "round_half_even",
]
