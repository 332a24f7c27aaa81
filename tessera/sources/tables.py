"""Logs as tables: one folder a day, read back under a name for SQL text.

A query that asks for some days reads only their folders, also when the days
come out of a join (dynamic partition pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

DAY = "day"


def _by_day(logs: DataFrame, date_col: str) -> DataFrame:
    """The rows with their day, dealt so that a day is a few files and a busy
    one is shared by many tasks (AQE sizes the pieces of a rebalance)."""
    return logs.withColumn(DAY, F.col(date_col).try_cast("date")).hint("rebalance", F.col(DAY))


def write_log_table(logs: DataFrame, path: str, *, date_col: str = "date") -> str:
    """Write ``logs`` as a new table.  Rows whose date is no date keep its
    text and share one folder, whose day is null."""
    _by_day(logs, date_col).write.partitionBy(DAY).parquet(path)
    return path


def refresh_days(logs: DataFrame, path: str, *, date_col: str = "date") -> str:
    """Replace the days that ``logs`` has rows of and leave all others alone,
    so that bringing a day again does not double it."""
    (_by_day(logs, date_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY).parquet(path))
    return path


def open_log_table(spark: SparkSession, path: str, schema: StructType, *, view: str | None = None) -> DataFrame:
    """The table as a DataFrame and, with ``view``, as a name for SQL text.
    ``schema`` is that of the logs; no file is opened to find it out."""
    table = spark.read.schema(StructType([*schema.fields, StructField(DAY, DateType())])).parquet(path)
    if view:
        table.createOrReplaceTempView(view)
    return table


def calendar(days: DataFrame, day_col: str = DAY) -> DataFrame:
    """(day, year, month, weekday) of every day that occurs; weekday 1 is Sunday.  One row a day."""
    day = F.col(day_col).cast("date")
    return (days.select(day.alias(DAY)).filter(F.col(DAY).isNotNull()).distinct()
            .select(DAY, F.year(DAY).alias("year"), F.month(DAY).alias("month"), F.dayofweek(DAY).alias("weekday")))
