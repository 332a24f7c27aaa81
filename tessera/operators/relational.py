"""Relational building blocks: deterministic top-k, per-group top-k,
positional/by-name union over tables whose types may differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DecimalType, DoubleType, NullType, NumericType, StringType, StructField,
                               StructType, TimestampType)


def _cols(cs: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def top_k(df: DataFrame, k: int, order: Sequence[Column | str], tie_keys: Sequence[Column | str] = ()) -> DataFrame:
    """The first ``k`` rows by ``order``, ties broken by ``tie_keys`` so the
    result never depends on partitioning.  Planned as a bounded per-task
    top-k plus one merge of k rows per task (``TakeOrderedAndProject``) — no
    global sort."""
    return df.orderBy(*_cols(order), *_cols(tie_keys)).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], k: int, order: Sequence[Column | str],
                    tie_keys: Sequence[Column | str] = (), rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows of every group.  ``row_number() <= k`` lets
    Catalyst insert a partial window-group limit before the shuffle, so each
    map task ships at most k rows per group: a group holding a third of the
    data costs the same shuffle as any other."""
    w = Window.partitionBy(*group).orderBy(*_cols(order), *_cols(tie_keys))
    rn = rank_col or "_rank"
    ranked = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return ranked if rank_col else ranked.drop(rn)


_WHOLE = ("tinyint", "smallint", "int", "bigint")
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def common_type(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds the values of both: the wider of two
    numbers (double beside a fraction), a timestamp for dates and timestamps,
    else text."""
    x, y = a.simpleString(), b.simpleString()
    if x == y or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if x in _WHOLE and y in _WHOLE:
        return a if _WHOLE.index(x) > _WHOLE.index(y) else b
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        if {x, y} & {"float", "double"}:
            return DoubleType()
        before = max(t.precision - t.scale if isinstance(t, DecimalType) else _DIGITS[t.simpleString()] for t in (a, b))
        scale = max(t.scale if isinstance(t, DecimalType) else 0 for t in (a, b))
        return DecimalType(before + scale, scale) if before + scale <= 38 else StringType()
    if {x, y} == {"date", "timestamp"}:
        return TimestampType()
    return StringType()


def common_schema(a: StructType, b: StructType) -> StructType:
    """Columns of ``a``, then those that only ``b`` has, each of a type that fits both."""
    other = {f.name.lower(): f for f in b.fields}
    own = [StructField(f.name, common_type(f.dataType, other[f.name.lower()].dataType) if f.name.lower() in other else f.dataType)
           for f in a.fields]
    names = {f.name.lower() for f in a.fields}
    return StructType([*own, *[StructField(f.name, f.dataType) for f in b.fields if f.name.lower() not in names]])


def fit_schema(df: DataFrame, schema: StructType, *, clash_col: str | None = None) -> DataFrame:
    """``df`` in the columns of ``schema``.  A value that cannot be read as
    its type becomes null, a column that is missing is null; ``clash_col``
    counts the values of a row that were lost that way."""
    present = {c.lower(): c for c in df.columns}
    fitted, lost = [], F.lit(0)
    for f in schema.fields:
        own = present.get(f.name.lower())
        if own is None:
            fitted.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        same = df.schema[own].dataType.simpleString() == f.dataType.simpleString()
        value = F.col(f"`{own}`") if same else F.col(f"`{own}`").try_cast(f.dataType)
        fitted.append(value.alias(f.name))
        if not same:
            lost = lost + (F.col(f"`{own}`").isNotNull() & value.isNull()).cast("int")
    return df.select(*fitted, *([lost.alias(clash_col)] if clash_col else []))


def union_all(a: DataFrame, b: DataFrame, *, by_name: bool = True, schema: StructType | None = None,
              clash_col: str | None = None) -> DataFrame:
    """UNION ALL.  By name by default (safe under column reordering); pass
    ``by_name=False`` for positional semantics.

    Columns whose types differ, as two inferred files may have them, get a type
    that holds both (``common_type``), so no value is lost and none throws.
    With ``schema`` the result has that schema: values that do not fit become
    null, and ``clash_col`` counts them by row."""
    if not by_name:
        if len(a.columns) != len(b.columns):
            raise ValueError(f"{len(a.columns)} and {len(b.columns)} columns cannot be matched by position")
        b = b.toDF(*a.columns)
    elif schema is None and {c.lower() for c in a.columns} != {c.lower() for c in b.columns}:
        raise ValueError("columns differ; name a schema to fill what is missing")
    target = schema or common_schema(a.schema, b.schema)
    return fit_schema(a, target, clash_col=clash_col).unionByName(fit_schema(b, target, clash_col=clash_col))
