import pytest
from pyspark.sql.types import StructType

from tessera.operators.relational import common_schema, union_all


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("a, b, both", [
    ("int", "bigint", "bigint"), ("int", "double", "double"), ("int", "string", "string"), ("smallint", "decimal(4,2)", "decimal(7,2)"),
    ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("bigint", "decimal(38,20)", "string"), ("date", "timestamp", "timestamp"),
    ("date", "string", "string"), ("boolean", "int", "string"), ("float", "int", "double"), ("array<int>", "array<int>", "array<int>")])
def test_common_types(spark, a, b, both):
    x, y = (StructType.fromDDL(f"v {t}") for t in (a, b))
    for one, other in ((x, y), (y, x)):
        assert common_schema(one, other)["v"].dataType.simpleString() == both


def test_clashing_types_lose_nothing_by_default(spark):
    a, b = frame(spark, "k int, v int", (1, 2)), frame(spark, "v string, k bigint", ("abc", 3), (None, 4))
    out = union_all(a, b)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "string"]
    assert rows(out) == sorted([(1, "2"), (3, "abc"), (4, None)], key=repr)


def test_a_declared_schema_counts_what_does_not_fit(spark):
    a, b = frame(spark, "k int, v int", (1, 2)), frame(spark, "v string, k string", ("abc", "3"), ("5", "x"), (None, "6"), ("no", "no"))
    out = union_all(a, b, schema=StructType.fromDDL("k int, v int, w date"), clash_col="lost")
    assert rows(out) == sorted([(1, 2, None, 0), (3, None, None, 1), (None, 5, None, 1), (6, None, None, 0), (None, None, None, 2)], key=repr)


def test_by_position_and_names_in_other_cases(spark):
    a, b = frame(spark, "k int, v int", (1, 2)), frame(spark, "x string, y int", ("a", 3))
    assert rows(union_all(a, b, by_name=False)) == [("1", 2), ("a", 3)]
    assert rows(union_all(a, frame(spark, "V int, K int", (5, 4)))) == [(1, 2), (4, 5)]
    with pytest.raises(ValueError, match="by position"):
        union_all(a, frame(spark, "x int", (1,)), by_name=False)
    with pytest.raises(ValueError, match="name a schema"):
        union_all(a, frame(spark, "k int, w int", (1, 2)))


def test_repeats_stay_and_empty_sides_count_as_nothing(spark):
    a = frame(spark, "k int, v string", (1, "a"), (1, "a"))
    assert rows(union_all(a, a)) == [(1, "a")] * 4
    assert rows(union_all(a.limit(0), a)) == [(1, "a")] * 2
