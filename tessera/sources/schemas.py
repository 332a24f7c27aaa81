"""Declared schemas and column names of the inputs the operators expect.

Explicit schemas replace ``inferSchema`` everywhere: inference costs a full
extra pass over the input at definition time and narrows or widens types
depending on the sample it sees.
"""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

# ---------------------------------------------------------------- fixed values
# Field names and order must match the files.
# W3C extended / IIS access log, in field order (all nullable).
WEBLOG_SCHEMA = StructType([
    StructField("date", StringType()),
    StructField("time", StringType()),
    StructField("s_sitename", StringType()),
    StructField("cs_method", StringType()),
    StructField("cs_uristem", StringType()),
    StructField("cs_uriquery", StringType()),
    StructField("s_port", IntegerType()),
    StructField("cs_username", StringType()),
    StructField("c_ip", StringType()),
    StructField("cs_useragent", StringType()),
    StructField("cs_cookie", StringType()),
    StructField("cs_referer", StringType()),
    StructField("cs_host", StringType()),
    StructField("sc_status", IntegerType()),
    StructField("sc_substatus", IntegerType()),
    StructField("sc_win32status", IntegerType()),
    StructField("sc_bytes", IntegerType()),
    StructField("cs_bytes", IntegerType()),
    StructField("time_taken", IntegerType()),
])

# One JSON message per text line; only the fields the pipeline reads.
MESSAGE_JSON_SCHEMA = StructType([
    StructField("id_str", StringType()),
    StructField("created_at", StringType()),
    StructField("text", StringType()),
    StructField("user", StructType([StructField("time_zone", StringType())])),
])

# Headerless tab-separated inputs: positional columns get these names.
LEXICON_COLUMNS = ("strength", "length", "word", "part_of_speech", "stemmed", "polarity")

PRODUCTS_SCHEMA = StructType([
    StructField("prod_id", LongType()),
    StructField("brand", StringType()),
    StructField("name", StringType()),
    StructField("price", DoubleType()),
    StructField("cost", DoubleType()),
    StructField("shipping_wt", DoubleType()),
])

LEXICON_SCHEMA = StructType([StructField(c, StringType()) for c in LEXICON_COLUMNS])

ZONE_SCHEMA = StructType([StructField("time_zone", StringType()), StructField("country", StringType())])

# What the header scan of the product catalogue must deliver, whatever its types are inferred to be.
PART_SCHEMA = StructType([
    StructField("p_partkey", LongType()),
    StructField("p_name", StringType()),
    StructField("p_brand", StringType()),
    StructField("p_type", StringType()),
    StructField("p_size", IntegerType()),
    StructField("p_retailprice", DoubleType()),
])
