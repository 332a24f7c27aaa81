from tessera.functions.weblog import page_key
from tessera.plans.weblog import client_errors, referrers_per_day
from tessera.session import shared_path, local_path
from tessera.sources import read_lines, read_w3c_log, skip_lines
from tessera.sources.schemas import WEBLOG_SCHEMA

GUID = "0f8fad5b-d9cb-469f-a165-70867728950e"


def test_page_key(spark):
    df = spark.createDataFrame([("/p", None), ("/p", ""), ("/p", f"a=1&X-ARR-LOGID={GUID}"),
                                ("/p", f"X-ARR-LOGID={GUID.upper()}")], "s string, q string")
    got = [r.k for r in df.select(page_key("s", "q").alias("k")).collect()]
    assert got == ["/p", "/p?", "/p?a=1&", f"/p?X-ARR-LOGID={GUID.upper()}"]


def _log(spark, rows):
    base = {f.name: None for f in WEBLOG_SCHEMA.fields}
    data = []
    for r in rows:
        d = dict(base); d.update(r); data.append(tuple(d[f.name] for f in WEBLOG_SCHEMA.fields))
    return spark.createDataFrame(data, WEBLOG_SCHEMA)


def test_client_errors_distinct_ips_and_ties(spark):
    rows = [dict(sc_status=404, cs_referer="r", cs_uristem="/a", c_ip="1"),
            dict(sc_status=404, cs_referer="r", cs_uristem="/a", c_ip="1"),
            dict(sc_status=404, cs_referer="r", cs_uristem="/a", c_ip="2"),
            dict(sc_status=403, cs_referer=None, cs_uristem="/b", c_ip="3"),
            dict(sc_status=500, cs_referer="r", cs_uristem="/c", c_ip="4"),
            dict(sc_status=400, cs_referer="r", cs_uristem="/d", c_ip=None)]
    got = [tuple(r) for r in client_errors(_log(spark, rows), k=2).collect()]
    assert got == [(404, "r", "/a", 2), (403, None, "/b", 1)]
    everything = sorted(tuple(r) for r in client_errors(_log(spark, rows), k=None).collect())
    assert (400, "r", "/d", 0) in everything and all(r[0] != 500 for r in everything)


def test_referrers_per_day_bad_date_is_null(spark):
    rows = [dict(date="2024-01-05", sc_status=200, cs_referer="x", c_ip="1"),
            dict(date="bad", sc_status=204, cs_referer="x", c_ip="1")]
    got = sorted((tuple(r) for r in referrers_per_day(_log(spark, rows), k=None).collect()), key=repr)
    assert got == sorted([(2024, 1, 5, "x", 1), (None, None, None, "x", 1)], key=repr)


def _write_files(spark, name, files):
    import os
    root = local_path(shared_path(spark, name))
    os.makedirs(root)
    for i, lines in enumerate(files):
        with open(f"{root}/part{i}.log", "w") as fh:
            fh.write("\n".join(lines) + "\n")
    return root


def test_w3c_log_directives_in_every_file(spark):
    line = "2024-01-05 10:00:00 W3SVC1 GET /a - 80 - 1.2.3.4 UA - http://r/ host 404 0 0 10 20 -"
    files = [["#Software: x", "#Fields: date time"] + [line] * 3, ["#Software: x", "#Fields: date time", line]]
    df = read_w3c_log(spark, _write_files(spark, "w3c", files))
    assert df.count() == 4
    r = df.first()
    assert r.sc_status == 404 and r.time_taken is None and r.cs_uriquery == "-"


def test_skip_lines_many_files_and_splits(spark):
    files = [[f"h{f}a", f"h{f}b"] + [f"f{f}-{i:05d}" + "x" * 40 for i in range(400)] for f in range(3)]
    root = _write_files(spark, "skip", files)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_lines(spark, root)
        assert lines.rdd.getNumPartitions() > 3
        kept = skip_lines(lines, 2)
        got = sorted(r.value for r in kept.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = sorted(v for f in files for v in f[2:])
    assert got == want


def test_skip_lines_keeps_other_files_rows(spark):
    """A file of one line before the tail of another, packed into one task."""
    files = [["only"], [f"b{i:04d}" for i in range(23)], ["h1", "h2"], ["x", "y", "z"]]
    root = _write_files(spark, "short", files)
    for size in ("64", "16", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            for n in (1, 2, 5):
                got = sorted(r.value for r in skip_lines(read_lines(spark, root), n).collect())
                assert got == sorted(v for f in files for v in f[n:]), (size, n)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_staged_files_follow_the_splits(spark):
    from tessera.adapters import stage_files_with_header
    lines = spark.range(100).selectExpr("CAST(id AS STRING) AS value").repartition(5)
    path = stage_files_with_header(spark, lines, ["#a", "#b"], "staged")
    got = spark.read.text(path)
    assert len(got.inputFiles()) == 5 and got.count() == 110
    assert skip_lines(got, 2).count() == 100 and skip_lines(got, 2).filter("value LIKE '#%'").count() == 0
    for file in got.inputFiles():
        with open(local_path(file.replace("file:///", "/"))) as f:
            assert [next(f), next(f)] == ["#a\n", "#b\n"]
