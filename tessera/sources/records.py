"""CSV records that go over several lines, from files that still split.

A line end within quotes belongs to the record.  Whether a line begins within
quotes follows from the number of quotes before it in its file, so every split
is counted by itself, and splits only have to exchange one number and the
beginnings and ends of the records that they share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Text of a null; an empty text is written as two quotes.
NULL_TEXT = "\\N"
_OPTIONS = {"quote": '"', "escape": '"', "nullValue": NULL_TEXT, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_records(df: DataFrame, path: str, *, sep: str = ",", header: bool = True) -> None:
    """CSV whose texts may hold anything: quotes are doubled, nulls are NULL_TEXT."""
    df.write.options(**_OPTIONS, emptyValue='""', sep=sep, header=str(header).lower(), lineSep="\n").csv(path)


def _joined(order: Column) -> Column:
    """The lines of a group in order, as they stood in the file."""
    lines = F.array_sort(F.collect_list(F.struct(order.alias("at"), F.col("value"))))
    return F.array_join(F.transform(lines, lambda x: x["value"]), "\n")


def records(spark: SparkSession, path, *, quote: str = '"') -> DataFrame:
    """(file, first, text): every record of the files; ``first`` marks the
    first one of each.  Lines end with a line feed; quotes within a quoted
    field are doubled.

    The lines are dealt by split, so a task has one split at a time and a file
    of any size is shared; only what a split's ends cut is put together by
    file, two rows a split.  A record that its file does not close ends with
    the file."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.monotonically_increasing_id().alias("row"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    lines = lines.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit(""))))
    split = ["file", "block"]
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = (lines.groupBy(*split).agg(F.sum("quotes").alias("quotes"))
           .select(*split, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("open")))
    along = Window.partitionBy(*split).orderBy("row")
    here = F.coalesce(F.sum("quotes").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begun = (lines.withColumn("here", here).join(odd, split)
             .withColumn("number", F.sum(((F.col("here") + F.col("open")) % 2 == 0).cast("bigint")).over(
                 along.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    pieces = begun.groupBy(*split, "number").agg(_joined(F.col("row")).alias("value"), (F.sum("quotes") % 2).alias("cut"))
    done = (F.col("number") > 0) & (F.col("cut") == 0)
    first = (F.col("block") == 0) & (F.col("number") == 1)
    whole = pieces.filter(done).select("file", first.alias("first"), F.col("value").alias("text"))
    # the last record that began in this split or one before it
    owner = F.last(F.when(F.col("number") > 0, F.col("block")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shared = (pieces.filter(~done).withColumn("owner", owner).groupBy("file", "owner")
              .agg(_joined(F.struct("block", "number")).alias("text"), F.bool_or(first).alias("first")))
    return whole.unionByName(shared.select("file", "first", "text"))


def read_records(spark: SparkSession, path, schema: StructType, *, sep: str = ",", header: bool = True) -> DataFrame:
    """The records' fields, as ``write_records`` or any writer that doubles
    quotes has put them.  Blank records are left out; a short record is padded
    with nulls, a field that is not of its type is null."""
    rows = records(spark, path)
    rows = rows.filter(~F.col("first")) if header else rows
    read = F.from_csv("text", schema.simpleString()[len("struct<"):-1].replace(":", " "), {**_OPTIONS, "sep": sep, "mode": "PERMISSIVE"})
    return rows.filter("text <> ''").select(read.alias("r")).select("r.*")
