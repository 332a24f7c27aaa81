"""K4 — sensor readings banded against their set point and enriched with
building attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.sensors import extreme_flag, temp_diff, temperature_band
from tessera.operators.joins import left_join

READING_COLUMNS = ("TargetTemp", "ActualTemp", "System", "SystemAge")
BUILDING_COLUMNS = ("Country", "HVACproduct", "BuildingMgr")


def band_readings(hvac: DataFrame, tolerance: float = 5) -> DataFrame:
    diff = temp_diff("TargetTemp", "ActualTemp")
    return hvac.withColumns({
        "temp_diff": diff,
        "temprange": temperature_band(diff, tolerance),
        "extremetemp": extreme_flag(diff, tolerance),
    })


def hvac_building(hvac: DataFrame, building: DataFrame, tolerance: float = 5) -> DataFrame:
    """Banded readings left-joined to their building (unknown building ->
    null attributes; a duplicated building id fans out)."""
    banded = band_readings(hvac, tolerance)
    dims = building.select("BuildingID", *BUILDING_COLUMNS)
    joined = left_join(banded, dims, "BuildingID")
    return joined.select(*READING_COLUMNS, "temp_diff", "temprange", "extremetemp", *BUILDING_COLUMNS)


def hvac_reliability(hvac: DataFrame, building: DataFrame, tolerance: float = 5) -> DataFrame:
    """Share of extreme readings per (country, HVAC product)."""
    enriched = hvac_building(hvac, building, tolerance)
    return enriched.groupBy("Country", "HVACproduct").agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum("extremetemp").alias("extreme_readings"),
        F.avg("extremetemp").alias("extreme_share"))
