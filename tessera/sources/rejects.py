"""Bad rows kept apart instead of lost.

A scan here carries, beside its columns, the raw text of each record that did
not fit the schema, its file and the reason.  ``quarantine`` writes both kinds
in one pass and gives them back as two tables.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RAW, FILE, REASON, STATUS = "_corrupt_record", "_file", "_reason", "_status"
TOO_FEW, TOO_MANY, NO_JSON = "too few fields", "too many fields", "not JSON"


def _bad_value(fields: Column, schema: StructType) -> Column:
    """The first field whose text cannot be read as its type."""
    wrong = [F.when(F.get(fields, F.lit(i)).isNotNull() & (F.get(fields, F.lit(i)) != "")
                    & F.get(fields, F.lit(i)).try_cast(f.dataType).isNull(), F.lit(f"bad value: {f.name}"))
             for i, f in enumerate(schema.fields) if not isinstance(f.dataType, StringType)]
    return F.coalesce(*wrong, F.lit("bad record"))


def scan_delimited(spark: SparkSession, path: str, schema: StructType, *, sep: str = ",", header: bool = False,
                   comment: str | None = None) -> DataFrame:
    """CSV/TSV scan with RAW, FILE and REASON (RAW and REASON null for good
    rows).  A record is bad if it has fewer or more fields than the schema, or
    a field that is not of its type."""
    reader = (spark.read.option("sep", sep).option("header", str(header).lower()).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", RAW).option("columnPruning", "false"))
    if comment:
        reader = reader.option("comment", comment)
    df = (reader.schema(StructType([*schema.fields, StructField(RAW, StringType())])).csv(path)
          .withColumn(FILE, F.col("_metadata.file_path")))
    unquoted = F.regexp_replace(F.col(RAW), '"(?:[^"\\\\]|\\\\.|"")*"', "q")  # a separator within quotes separates nothing
    fields = F.split(unquoted, re.escape(sep), -1)
    width = len(schema.fields)
    reason = (F.when(F.col(RAW).isNull(), F.lit(None).cast("string")).when(F.size(fields) < width, TOO_FEW)
               .when(F.size(fields) > width, TOO_MANY).otherwise(_bad_value(fields, schema)))
    return df.withColumn(REASON, reason)


def scan_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with RAW, FILE and REASON.  A line is bad if it is no JSON object, or a field is not of its type."""
    lines = spark.read.text(path).withColumn(FILE, F.col("_metadata.file_path"))
    return parsed_json(lines, schema)


def parsed_json(lines: DataFrame, schema: StructType, *, value_col: str = "value") -> DataFrame:
    """The lines' fields with RAW and REASON; further columns are kept.  A blank line is bad, too."""
    wide = StructType([*schema.fields, StructField(RAW, StringType())])
    read = F.from_json(F.col(value_col), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW})
    parsed = lines.select(*[c for c in lines.columns if c != value_col], F.col(value_col).alias("_line"), read.alias("_json"))
    no_json = F.get_json_object("_line", "$").isNull()
    blank = F.trim("_line") == ""
    raw = F.when(blank | F.col("_json").isNull(), F.coalesce("_line", F.lit(""))).otherwise(F.col(f"_json.{RAW}"))
    return (parsed.withColumn(RAW, raw)
            .withColumn(REASON, F.when(F.col(RAW).isNotNull(), F.when(no_json, NO_JSON).otherwise("bad value")))
            .select(*[F.col(f"_json.`{f.name}`") for f in schema.fields], *[c for c in lines.columns if c != value_col], RAW, REASON))


def quarantine(scan: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a scan, from one pass over its files: good rows have the
    scan's own columns, bad ones FILE, REASON and RAW.  Their numbers add up
    to the records.  The pass writes a table to ``path``, which stays."""
    own = [c for c in scan.columns if c not in (RAW, FILE, REASON)]
    status = F.when(F.col(RAW).isNull(), "good").otherwise("bad")
    marked = scan.withColumn(STATUS, status)
    marked.write.partitionBy(STATUS).parquet(path)
    table = scan.sparkSession.read.schema(marked.schema).parquet(path)
    good = table.filter(F.col(STATUS) == "good").select(*own)
    bad = table.filter(F.col(STATUS) == "bad").select(*[c for c in (FILE, REASON, RAW) if c in scan.columns])
    return good, bad


def reject_counts(bad: DataFrame) -> DataFrame:
    """(reason, n) of rejected rows."""
    return bad.groupBy(F.col(REASON).alias("reason")).agg(F.count(F.lit(1)).alias("n"))

