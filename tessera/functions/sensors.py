"""Sensor reading column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def temp_diff(target: Column | str = "TargetTemp", actual: Column | str = "ActualTemp") -> Column:
    t = F.col(target) if isinstance(target, str) else target
    a = F.col(actual) if isinstance(actual, str) else actual
    return t - a


def temperature_band(diff: Column, tolerance: float = 5) -> Column:
    """COLD when the target exceeds the reading by more than ``tolerance``,
    HOT when it is below by more, else NORMAL (also for a null reading)."""
    return F.when(diff > tolerance, "COLD").when(diff < -tolerance, "HOT").otherwise("NORMAL")


def extreme_flag(diff: Column, tolerance: float = 5) -> Column:
    """1 if the reading is off its target by more than ``tolerance`` (a null reading is not)."""
    return F.coalesce(F.abs(diff) > tolerance, F.lit(False)).cast("int")
