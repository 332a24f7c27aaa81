from tessera.sources import read_w3c_by_name

SCHEMA = "date string, c_ip string, cs_uristem string, cs_useragent string, sc_status int"


def test_files_of_different_order_give_one_table(spark, tmp_path):
    (tmp_path / "a.log").write_text("#Software: x\n#Fields: date c-ip cs-uri-stem cs(User-Agent) sc-status\n"
                                    "2024-01-01 1.1.1.1 /a moz 200\n2024-01-01 - /b moz bad\n")
    (tmp_path / "b.log").write_text("#Fields:  sc-status time-taken cs-uri-stem date\n404 17 /c 2024-01-02\n500 9\n")
    (tmp_path / "c.log").write_text("1 2 3\n")  # says nothing of its fields
    schema = spark.createDataFrame([], SCHEMA).schema
    got = sorted((tuple(r) for r in read_w3c_by_name(spark, str(tmp_path), schema).collect()), key=repr)
    assert got == sorted([("2024-01-01", "1.1.1.1", "/a", "moz", 200), ("2024-01-01", "-", "/b", "moz", None),
                          ("2024-01-02", None, "/c", None, 404), (None, None, None, None, 500), (None,) * 5], key=repr)


def test_a_new_layout_within_a_file_that_splits(spark, tmp_path):
    lines, want = [], []
    for part in range(6):
        names = ["date", "c-ip", "sc-status"] if part % 2 else ["sc-status", "date", "c-ip"]
        lines.append("#Fields: " + " ".join(names))
        for i in range(60):
            row = {"date": f"2024-01-{part + 1:02d}", "c-ip": f"1.1.{part}.{i}", "sc-status": str(200 + i)}
            lines.append(" ".join(row[n] for n in names))
            want.append((row["date"], row["c-ip"], None, None, 200 + i))
    (tmp_path / "a.log").write_text("\n".join(lines) + "\n")
    before = {n: spark.conf.get(n, None) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = read_w3c_by_name(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema)
        assert df.rdd.getNumPartitions() > 10
        assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(want, key=repr)
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
