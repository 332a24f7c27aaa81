"""File scans: delimited text with or without a header, plain text lines,
W3C access logs, and header-line skipping that is correct on any number of
files and splits.

Every reader accepts a path, a directory or a glob (Spark expands them).
Schemas are explicit by default; ``infer=True`` exists for parity with
exploratory use but costs an extra pass over the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.sources.schemas import WEBLOG_SCHEMA


def read_delimited(spark: SparkSession, path: str | Sequence[str], *, sep: str = ",",
                   header: bool = True, schema: StructType | str | None = None,
                   infer: bool = False, names: Sequence[str] | None = None,
                   comment: str | None = None) -> DataFrame:
    """CSV/TSV scan.  PERMISSIVE mode: a short row is null-padded, an
    over-long row truncated, an unparsable field becomes null."""
    reader = spark.read.option("sep", sep).option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if comment:
        reader = reader.option("comment", comment)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    df = reader.csv(path)
    if names is not None:
        df = df.toDF(*names)
    return df


def read_csv(spark: SparkSession, path, *, schema=None, infer: bool = False, header: bool = True) -> DataFrame:
    return read_delimited(spark, path, sep=",", header=header, schema=schema, infer=infer)


def read_tsv(spark: SparkSession, path, *, schema=None, infer: bool = False, header: bool = True,
             names: Sequence[str] | None = None) -> DataFrame:
    return read_delimited(spark, path, sep="\t", header=header, schema=schema, infer=infer, names=names)


def read_tsv_headerless(spark: SparkSession, path, names: Sequence[str], *,
                        schema: StructType | None = None) -> DataFrame:
    """Headerless TSV whose positional columns are renamed to ``names``.
    With ``schema`` the types are declared (preferred); otherwise every
    column stays a string, which never fails on bad input."""
    if schema is not None:
        return read_delimited(spark, path, sep="\t", header=False, schema=schema)
    return read_delimited(spark, path, sep="\t", header=False, names=names)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def read_w3c_log(spark: SparkSession, path, schema: StructType = WEBLOG_SCHEMA) -> DataFrame:
    """Space-delimited W3C extended log.  Directive lines (``#Software``,
    ``#Fields`` ...) start with ``#`` and are dropped wherever they occur —
    in every file and in every split — with no row numbering at all."""
    return read_delimited(spark, path, sep=" ", header=False, schema=schema, comment="#")


FIELDS_DIRECTIVE = "#Fields:"


def _plain_name(name: Column) -> Column:
    """A field's name without case and marks: ``cs(User-Agent)`` and ``cs_useragent`` are one."""
    return F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", ""))


def read_w3c_by_name(spark: SparkSession, path, schema: StructType = WEBLOG_SCHEMA) -> DataFrame:
    """W3C extended logs whose fields differ by file: every file says its
    fields and their order in ``#Fields`` lines, and columns are taken from
    there by name.  A field that a file does not have is null, one that the
    schema does not have is left out, and a value not of its type is null.

    A line is read by the last ``#Fields`` line before it in its file (a server
    writes a new one when it is configured anew); lines before the first are
    null in all columns.  A large file is read by many tasks: what they share
    are the layouts, one row a file, which are broadcast (the driver holds the
    listing of the same files anyway)."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("_row"), F.col("_metadata.file_path").alias("_file"),
                                         F.col("_metadata.file_block_start").alias("_block"))
    names = F.split(F.trim(F.substring("value", len(FIELDS_DIRECTIVE) + 1, 1 << 20)), "\\s+")
    places = F.array(*[F.array_position(F.col("names"), _plain_name(F.lit(f.name))) for f in schema.fields]).cast("array<int>")
    layouts = (lines.filter(F.col("value").startswith(FIELDS_DIRECTIVE))
               .select("_file", "_block", "_row", F.transform(names, _plain_name).alias("names"))
               .groupBy("_file").agg(F.sort_array(F.collect_list(F.struct("_block", "_row", places.alias("places")))).alias("layouts")))
    rows = lines.filter(~F.col("value").startswith("#")).join(F.broadcast(layouts), "_file", "left")
    before = F.filter("layouts", lambda x: F.struct(x["_block"], x["_row"]) < F.struct("_block", "_row"))
    placed = rows.select(F.split("value", " ").alias("values"), F.try_element_at(before, F.lit(-1))["places"].alias("places"))
    own = [F.get("places", F.lit(i)) for i in range(len(schema.fields))]
    return placed.select(*[F.when(at > 0, F.get("values", at - 1)).try_cast(f.dataType).alias(f.name)
                           for f, at in zip(schema.fields, own, strict=True)])


MAX_SKIPPED = 1000


def _first_lines(n: int):
    """(file, block, first, lines) of every split: the row id of its first
    line and how many it holds, counted up to ``n``.  A split that does not
    end its file is the only one of its task, which then stops."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = block = first = None
        lines, made = 0, []

        def closed() -> None:
            if file is not None:
                made.append((file, block, first, lines))

        for batch in batches:
            files, blocks = batch.column(1).dictionary_encode(), batch.column(2)
            at = 0
            while at < batch.num_rows:
                name, start = files[at].as_py(), blocks[at].as_py()
                here = pc.and_(pc.equal(files, pa.scalar(name)), pc.equal(blocks, pa.scalar(start, pa.int64())))
                rows = pc.sum(here).as_py()  # the lines of a split stand together
                if (name, start) != (file, block):
                    closed()
                    file, block, first, lines = name, start, batch.column(0)[at].as_py(), 0
                lines = min(n, lines + rows)
                at += rows
            if lines == n and not batch.column(3)[batch.num_rows - 1].as_py():
                break
        closed()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*made) if made else ((), (), (), ()), (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
            names=["_file", "_block", "_first", "_lines"])

    return run


def skip_lines(df: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` lines of every input file of a file scan.

    A split's lines are read in order by one task, so generated row ids are
    contiguous over them.  A first look at the files finds each split's first
    line and whether it holds ``n`` of them, which tells the lines to drop,
    also in files that are cut within them; of a split in the midst of a file it reads
    one batch only.  A file with ``n`` lines or fewer loses all of its own and
    none of another's.

    The ids to drop, at most ``n`` a file, are broadcast: the driver holds the
    listing of the same files anyway.
    """
    if n <= 0:
        return df
    if n > MAX_SKIPPED:
        raise ValueError(f"at most {MAX_SKIPPED} lines can be skipped a file")
    block, length = F.col("_metadata.file_block_start"), F.col("_metadata.file_block_length")
    tagged = df.withColumn("_row_id", F.monotonically_increasing_id())
    seen = tagged.select("_row_id", F.col("_metadata.file_path").alias("_file"), block.alias("_block"),
                         (block + length >= F.col("_metadata.file_size")).alias("_last"))
    splits = seen.mapInArrow(_first_lines(n), "_file string, _block bigint, _first bigint, _lines bigint")
    before = F.sum("_lines").over(Window.partitionBy("_file").orderBy("_block")
                                  .rowsBetween(Window.unboundedPreceding, -1))
    cut = splits.withColumn("_cut", F.least("_lines", n - F.coalesce(before, F.lit(0)))).filter("_cut > 0")
    ids = cut.select(F.explode(F.sequence("_first", F.col("_first") + F.col("_cut") - 1)).alias("_row_id"))
    return tagged.join(F.broadcast(ids), "_row_id", "left_anti").drop("_row_id")
