import random

import pytest

from tessera.session import shared_path
from tessera.sources import read_records, write_records
from tessera.sources.records import records

SCHEMA = "id bigint, text string, size double"


@pytest.fixture()
def small_splits(spark):
    """Files are read in pieces of some hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "1")
    spark.conf.set(names[2], "1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def same(left, right):
    key = lambda rows: sorted((tuple(r) for r in rows.collect()), key=repr)
    return key(left) == key(right)


def odd_texts(n):
    rng = random.Random(n)
    bits = ["a", "b c", "\n", "\n\n", '"', '""', ",", "\r", "\t", " ", "é", "\\", "\\N x", '",\n"', "#"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_texts_with_line_ends_and_quotes_come_back(spark, small_splits):
    rows = [(i, t, i / 4) for i, t in enumerate(odd_texts(150))] + [(None, None, None), (7, "", None), (8, None, 0.5), (9, "x" * 5000, 1.0),
            (10, "line\n" * 900, 2.0)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    path = shared_path(spark, "t-records")
    write_records(df, path)
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 20  # many splits a file
    assert same(read_records(spark, path, df.schema), df)


def test_one_long_record_over_many_splits(spark, small_splits):
    df = spark.createDataFrame([(1, "a", 1.0), (2, 'x\n"' * 2000, 2.0), (3, "b", 3.0)], SCHEMA).coalesce(1)
    path = shared_path(spark, "t-records")
    write_records(df, path)
    assert same(read_records(spark, path, df.schema), df)
    got = records(spark, path).collect()
    assert len(got) == 4 and [r.text for r in got if r.first] == ["id,text,size"]


def test_short_broken_and_blank_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\ny",2.5\n\n2,short\n\n3,z,wrong\n4,"never closed\n5,a,1.0\n')
    got = read_records(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, header=False).collect()
    assert {(1, "x\ny", 2.5), (2, "short", None), (3, "z", None)} <= {tuple(r) for r in got}
    assert len(got) == 4 and [r.id for r in got if r.text and "never" in r.text] == [4]


def test_other_separators_without_header_and_an_empty_file(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('1\t"x\ty"\t2.5\n')
    (tmp_path / "b.tsv").write_text("")
    got = read_records(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, sep="\t", header=False).collect()
    assert [tuple(r) for r in got] == [(1, "x\ty", 2.5)]


def test_whole_table_round_trip_in_several_tasks(spark, small_splits):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    path = shared_path(spark, "t-records")
    write_records(docs.coalesce(1), path)
    assert spark.read.text(path).rdd.getNumPartitions() > 8
    assert same(read_records(spark, path, docs.schema), docs)
