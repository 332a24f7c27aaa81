import datetime as dt

import pytest

from pyspark.sql import functions as F

from tessera.registry import WEEKEND_SQL
from tessera.session import shared_path
from tessera.sources.schemas import WEBLOG_SCHEMA
from tessera.sources.tables import calendar, open_log_table, refresh_days, write_log_table


def logs(spark, rows):
    names = [f.name for f in WEBLOG_SCHEMA.fields]
    data = [tuple({"date": d, "c_ip": ip, "sc_status": status, "sc_bytes": 10}.get(n) for n in names) for d, ip, status in rows]
    return spark.createDataFrame(data, WEBLOG_SCHEMA)


@pytest.fixture(scope="module")
def month(spark):
    rows = [(f"2024-01-{d:02d}", f"10.0.0.{i}", 200 + 100 * (i % 4)) for d in range(1, 31) for i in range(d)] + [("bad", "1", 200), (None, "2", 404)]
    return logs(spark, rows)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_are_folders_and_bad_dates_stay(spark, month):
    path = write_log_table(month, shared_path(spark, "t-logs"))
    table = open_log_table(spark, path, WEBLOG_SCHEMA, view="t_logs")
    assert table.count() == month.count()
    assert {r.date for r in table.filter("day IS NULL").collect()} == {"bad", None}
    day = spark.sql("SELECT count(*) AS n FROM t_logs WHERE day = DATE'2024-01-07'")
    assert day.first().n == 7
    one = spark.sql("SELECT * FROM t_logs WHERE day = DATE'2024-01-07'")
    assert "PartitionFilters: [isnotnull(day" in plan_of(one)
    assert {f.rsplit("/", 2)[1] for f, in one.select(F.input_file_name()).distinct().collect()} == {"day=2024-01-07"}
    spark.catalog.dropTempView("t_logs")


def test_a_join_prunes_days(spark, month):
    path = write_log_table(month, shared_path(spark, "t-logs"))
    table = open_log_table(spark, path, WEBLOG_SCHEMA)
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 31)], "day date")
    path = shared_path(spark, "t-calendar")
    days.write.parquet(path)
    result = spark.sql(WEEKEND_SQL, logs=table, calendar=calendar(spark.read.parquet(path)))
    assert "dynamicpruning" in plan_of(result)
    weekend = [d for d in range(1, 31) if dt.date(2024, 1, d).weekday() >= 5]
    got = {r.day.day: (r.requests, r.client_errors, r.ips, r.bytes) for r in result.collect()}
    assert got == {d: (d, sum(i % 4 == 2 for i in range(d)), d, 10 * d) for d in weekend}


def test_refreshing_a_day_replaces_it_alone(spark, month):
    path = write_log_table(month, shared_path(spark, "t-logs"))
    again = logs(spark, [("2024-01-05", "9.9.9.9", 500)] * 3 + [("2024-02-01", "9.9.9.9", 200)])
    for _ in range(2):  # a second time changes nothing
        refresh_days(again, path)
        table = open_log_table(spark, path, WEBLOG_SCHEMA)
        n = {str(r.day): r.n for r in table.groupBy("day").agg(F.count("*").alias("n")).collect()}
        assert n["2024-01-05"] == 3 and n["2024-02-01"] == 1 and n["2024-01-06"] == 6 and n["None"] == 2
        assert table.count() == month.count() - 5 + 4


def test_calendar_has_a_row_a_day(spark):
    days = spark.createDataFrame([("2024-01-06",), ("2024-01-06",), (None,), ("2024-02-29",)], "day string")
    assert sorted(tuple(r) for r in calendar(days).collect()) == [(dt.date(2024, 1, 6), 2024, 1, 7), (dt.date(2024, 2, 29), 2024, 2, 5)]
