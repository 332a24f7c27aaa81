import pytest

from tessera.session import shared_path
from tessera.sources import rejects

GOOD = [f"{i} name{i} {i * 1.5}" for i in range(50)]


@pytest.fixture()
def folder(spark, tmp_path):
    """Two files: good lines, short, long and mistyped ones, a directive."""
    (tmp_path / "a.txt").write_text("\n".join(["#Version", *GOOD[:30], "1 short", "x y 2.0", "3 z"]) + "\n")
    (tmp_path / "b.txt").write_text("\n".join([*GOOD[30:], "4 n 1.0 more", "5 n 1.0.0", '6 "a b" 2.5']) + "\n")
    return str(tmp_path)


SCHEMA = "id int, name string, size double"


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_both_sides_add_up_with_file_and_reason(spark, folder):
    scan = rejects.scan_delimited(spark, folder, schema(spark), sep=" ", comment="#")
    good, bad = rejects.quarantine(scan, shared_path(spark, "t-quarantine"))
    assert good.columns == ["id", "name", "size"] and good.count() == 51
    assert ("a b", 2.5) in {(r.name, r.size) for r in good.collect()}
    got = sorted((r[rejects.FILE].rsplit("/", 1)[1], r[rejects.REASON], r[rejects.RAW]) for r in bad.collect())
    assert got == [("a.txt", "bad value: id", "x y 2.0"), ("a.txt", "too few fields", "1 short"), ("a.txt", "too few fields", "3 z"),
                   ("b.txt", "bad value: size", "5 n 1.0.0"), ("b.txt", "too many fields", "4 n 1.0 more")]
    assert {(r.reason, r.n) for r in rejects.reject_counts(bad).collect()} == {
        ("bad value: id", 1), ("too few fields", 2), ("bad value: size", 1), ("too many fields", 1)}


def test_quarantine_scans_the_files_once(spark, folder):
    scan = rejects.scan_delimited(spark, folder, schema(spark), sep=" ", comment="#")
    good, bad = rejects.quarantine(scan, shared_path(spark, "t-quarantine"))
    for side in (good, bad):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert folder not in plan and "PartitionFilters: [isnotnull(_status" in plan


def test_separators_in_quotes_are_no_fields(spark, tmp_path):
    (tmp_path / "q.csv").write_text('1,"a, b",2.5\n2,"c, d",x\n3,"e ""f"", g",1.0,9\n')
    scan = rejects.scan_delimited(spark, str(tmp_path), schema(spark))
    good, bad = rejects.quarantine(scan, shared_path(spark, "t-quarantine"))
    assert [tuple(r) for r in good.collect()] == [(1, "a, b", 2.5)]
    assert {r[rejects.REASON] for r in bad.collect()} == {"bad value: size", "too many fields"}


def test_json_lines(spark):
    lines = ['{"id": 1, "name": "a", "size": 1.0}', "{broken", "", '{"id": "x", "name": "b", "size": 2.0}', '{"name": "only"}', None, "[1]"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    parsed = rejects.parsed_json(df, schema(spark))
    got = {r.n: (r.id, r.name, r[rejects.REASON]) for r in parsed.collect()}
    assert got[0] == (1, "a", None) and got[4] == (None, "only", None)
    assert got[1][2] == rejects.NO_JSON and got[2][2] == rejects.NO_JSON and got[5][2] == rejects.NO_JSON
    assert got[3][2] == "bad value"
    good, bad = rejects.quarantine(parsed, shared_path(spark, "t-quarantine"))
    assert good.count() + bad.count() == len(lines)


def test_empty_input(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    good, bad = rejects.quarantine(rejects.scan_delimited(spark, str(tmp_path), schema(spark)), shared_path(spark, "t-quarantine"))
    assert good.count() == 0 and bad.count() == 0
