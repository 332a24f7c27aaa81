"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite",
              sep: str = ",") -> None:
    """CSV with a header line per part file.  Each task writes its own part
    file, so nothing funnels through one writer."""
    df.write.mode(mode).option("header", str(header).lower()).option("sep", sep).csv(path)
