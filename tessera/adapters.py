"""Re-aim the supplied star-schema tables into the input shapes the
pipelines consume (see FIXTURES.md).  Every adapter is a narrow projection
or a dimension join, so its cost grows linearly with the tables.

The two fixed dimension tables (time-zone map and sentiment lexicon) are
small constants defined here; they are joined against full tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.joins import left_join
from tessera.sources.schemas import LEXICON_COLUMNS

# ---------------------------------------------------------------- fixed values
# Time zone -> country.  'src3' is mapped twice on purpose (a duplicated key
# fans out in a left join); sources src15..src19 are unmapped.
ZONE_COUNTRY = (
    ("src0", "France"), ("src1", "Germany"), ("src2", "Spain"), ("src3", "United Kingdom"),
    ("src3", "Ireland"), ("src4", "Italy"), ("src5", "Portugal"), ("src6", "Belgium"),
    ("src7", "Netherlands"), ("src8", "Austria"), ("src9", "Switzerland"), ("src10", "Canada"),
    ("src11", "Mexico"), ("src12", "Brazil"), ("src13", "Japan"), ("src14", "India"),
)

# Sentiment lexicon rows (strength, length, word, part_of_speech, stemmed,
# polarity).  'and' is listed twice, 'that' is neutral, and 'The' differs
# from 'the' because matching is case-sensitive.
LEXICON = (
    ("strongsubj", "1", "and", "conj", "n", "positive"),
    ("strongsubj", "1", "and", "conj", "n", "positive"),
    ("weaksubj", "1", "with", "prep", "n", "positive"),
    ("weaksubj", "1", "is", "verb", "n", "positive"),
    ("weaksubj", "1", "la", "det", "n", "positive"),
    ("weaksubj", "1", "und", "conj", "n", "positive"),
    ("strongsubj", "1", "good", "adj", "n", "positive"),
    ("weaksubj", "1", "The", "det", "n", "positive"),
    ("strongsubj", "1", "the", "det", "n", "negative"),
    ("weaksubj", "1", "of", "prep", "n", "negative"),
    ("weaksubj", "1", "die", "det", "n", "negative"),
    ("weaksubj", "1", "des", "det", "n", "negative"),
    ("strongsubj", "1", "bad", "adj", "n", "negative"),
    ("weaksubj", "1", "that", "pron", "n", "neutral"),
)

# Product ids: the product catalogue is ``part`` with ids offset by this
# base; review products are the 20 document sources, ids base+60..base+79.
PRODUCT_ID_BASE = 1274600
REVIEW_PRODUCT_BASE = PRODUCT_ID_BASE + 60

# JSON ``created_at`` layout, e.g. 'Tue Aug 25 09:08:07 +0000 2015'.
CREATED_AT_FORMAT = "EEE MMM dd HH:mm:ss '+0000' yyyy"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zone_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ZONE_COUNTRY), "time_zone string, country string")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON), ", ".join(f"{c} string" for c in LEXICON_COLUMNS))


# ------------------------------------------------------------------- adapters
def social_messages(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """(tweet_id, country, sentiment) — country via user -> customer ->
    nation, sentiment bucketed from the event value; a few rows carry null,
    '' and 'null' countries and null sentiments."""
    e = events.select("event_id", "user_id", "value")
    c = customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined = left_join(left_join(e, c, "user_id"), n, "c_nationkey")
    eid = F.col("event_id")
    country = (F.when(eid % 97 == 0, F.lit(None).cast("string")).when(eid % 89 == 0, "")
                .when(eid % 83 == 0, "null").otherwise(F.col("n_name")))
    sentiment = F.when(eid % 31 == 0, F.lit(None).cast("int")).otherwise(
        F.floor(F.col("value") / 150).cast("int") % 3)
    return joined.select(eid.alias("tweet_id"), country.alias("country"), sentiment.alias("sentiment"))


_WEBLOG_EXPRS = [
    "CASE WHEN event_id % 101 = 3 THEN 'bad-date' ELSE date_format(ts, 'yyyy-MM-dd') END AS date",
    "date_format(ts, 'HH:mm:ss') AS time",
    "'W3SVC1' AS s_sitename",
    "CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS cs_method",
    "concat('/', event_type) AS cs_uristem",
    "CASE WHEN event_id % 10 = 0 THEN '-' "
    "WHEN event_id % 10 = 1 THEN concat('X-ARR-LOGID=', upper(_guid)) "
    "ELSE concat('k=', CAST(user_id % 5 AS STRING), '&X-ARR-LOGID=', _guid) END AS cs_uriquery",
    "80 AS s_port",
    "'-' AS cs_username",
    "concat('10.0.', CAST(user_id DIV 256 AS STRING), '.', CAST(user_id % 256 AS STRING)) AS c_ip",
    "'Mozilla/5.0+(Windows+NT+10.0)' AS cs_useragent",
    "'-' AS cs_cookie",
    "CASE WHEN event_id % 7 = 6 THEN '-' "
    "ELSE concat('http://ref', CAST(event_id % 7 AS STRING), '.example.com/') END AS cs_referer",
    "'www.example.com' AS cs_host",
    "CAST(200 + 100 * (event_id % 4) AS INT) AS sc_status",
    "0 AS sc_substatus",
    "0 AS sc_win32status",
    "CAST(floor(value * 100) AS INT) AS sc_bytes",
    "CASE WHEN event_id % 103 = 4 THEN NULL ELSE CAST(length(props) AS INT) END AS cs_bytes",
    "CAST(event_id % 1000 AS INT) AS time_taken",
]


def weblog(events: DataFrame) -> DataFrame:
    """One W3C access-log record per event (status 2xx..5xx by id, referrer
    by id, client IP by user, a tracing GUID in most query strings); some
    dates are no dates and some byte counts are missing."""
    h = F.md5(F.col("event_id").cast("string"))
    guid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
    return events.withColumn("_guid", guid).selectExpr(*_WEBLOG_EXPRS)


def weblog_lines(logs: DataFrame) -> DataFrame:
    """Render log records as space-separated text lines (``value``); a missing value is ``-``."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in logs.columns]
    return logs.select(F.concat_ws(" ", *fields).alias("value"))


def dirty_weblog_lines(logs: DataFrame) -> DataFrame:
    """Log lines of which some are cut short, some have a field too many and
    some a word where a number belongs (beside the missing byte counts)."""
    taken = F.col("time_taken")
    value = F.col("value")
    lines = logs.select("time_taken", F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in logs.columns]).alias("value"))
    return lines.select(F.when(taken % 107 == 5, F.substring_index(value, " ", 6)).when(taken % 109 == 6, F.concat(value, F.lit(" more")))
                         .when(taken % 113 == 7, F.regexp_replace(value, " 80 ", " http ")).otherwise(value).alias("value"))


def hvac_readings(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.when(F.col("l_orderkey") % 53 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("l_partkey")).alias("BuildingID"),
        F.lit(25).alias("TargetTemp"),
        F.col("l_quantity").alias("ActualTemp"),
        F.col("l_linenumber").alias("System"),
        (F.col("l_suppkey") % 30).cast("int").alias("SystemAge"))


def buildings(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("BuildingID"), F.col("p_type").alias("Country"),
                       F.col("p_brand").alias("HVACproduct"), F.col("p_name").alias("BuildingMgr"))


def ratings(documents: DataFrame) -> DataFrame:
    """One product review per document: posted in 2012 or 2013, product by
    document source, rating 1..5; a few texts are missing or blank."""
    doc = F.col("doc_id")
    message = F.when(doc % 241 == 17, F.lit(None).cast("string")).when(doc % 251 == 19, "  ").otherwise(F.col("text"))
    return documents.select(
        F.date_add(F.lit("2012-01-01").cast("date"), (doc % 731).cast("int")).alias("posted"),
        doc.alias("cust_id"),
        (F.lit(REVIEW_PRODUCT_BASE) + F.substring("source", 4, 10).try_cast("int")).alias("prod_id"),
        ((F.col("n_chars") % 5) + 1).cast("int").alias("rating"),
        message.alias("message"))


def ratings_for_year(documents: DataFrame, year: int) -> DataFrame:
    r = ratings(documents)
    return r.filter(F.year("posted") == year)


def with_written_ratings(reviews: DataFrame) -> DataFrame:
    """The reviews with ratings as text, of which some are no number."""
    rating = F.col("rating").cast("string")
    written = (F.when(F.col("cust_id") % 17 == 3, F.concat(rating, F.lit(" stars"))).when(F.col("cust_id") % 19 == 4, "n/a")
                .when(F.col("cust_id") % 23 == 5, F.lit(None).cast("string")).otherwise(rating))
    return reviews.withColumn("rating", written)


def products(part: DataFrame) -> DataFrame:
    return part.select(
        (F.lit(PRODUCT_ID_BASE) + F.col("p_partkey")).alias("prod_id"),
        F.col("p_brand").alias("brand"), F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"), (F.col("p_retailprice") * 0.75).alias("cost"),
        (F.col("p_size").cast("double") / 10).alias("shipping_wt"))


def message_timestamp(doc_id_col: str = "doc_id"):
    return F.expr(f"timestampadd(SECOND, CAST(({doc_id_col} * 86399) % 315360000 AS INT), "
                  "TIMESTAMP_NTZ '2015-01-01 00:00:00')")


def raw_messages(documents: DataFrame) -> DataFrame:
    """One JSON message per document as a text line (``value``).  Some lines
    are no JSON; some ids are no numbers or repeat the one before; some texts
    are missing or blank; some dates are no dates."""
    doc = F.col("doc_id")
    ident = (F.when(doc % 223 == 7, F.concat(F.lit("x"), doc.cast("string")))
              .when((doc % 227 == 9), (doc - 1).cast("string")).otherwise(doc.cast("string")))
    text = F.when(doc % 229 == 11, F.lit(None).cast("string")).when(doc % 233 == 13, "   ").otherwise(F.col("text"))
    created = F.when(doc % 239 == 15, "bad").otherwise(F.date_format(message_timestamp(), CREATED_AT_FORMAT))
    msg = F.struct(ident.alias("id_str"), created.alias("created_at"), text.alias("text"),
                   F.struct(F.col("source").alias("time_zone")).alias("user"))
    return documents.select(F.when(doc % 211 == 5, F.concat(F.lit("{not json "), doc.cast("string")))
                             .otherwise(F.to_json(msg)).alias("value"))


# ------------------------------------------------------------ staged files
# File-format operators need files.  These write data Spark derives from the
# supplied tables to a fresh folder under the shared checkpoint directory,
# one part file per task, and return the folder.

def stage_delimited(spark: SparkSession, df: DataFrame, name: str, *, sep: str = ",",
                    header: bool = True) -> str:
    from tessera.session import shared_path
    from tessera.sources.sinks import write_csv
    path = shared_path(spark, name)
    write_csv(df, path, header=header, sep=sep)
    return path


def stage_lines(spark: SparkSession, lines: DataFrame, name: str) -> str:
    from tessera.session import shared_path
    path = shared_path(spark, name)
    lines.select("value").write.mode("overwrite").text(path)
    return path


def stage_files_with_header(spark: SparkSession, lines: DataFrame, header: list[str], name: str) -> str:
    """Write text lines to one file for each split of the input, every file
    starting with the ``header`` lines: a split's first row (the one whose
    place in it is 0) brings them along, so no row moves."""
    from tessera.session import shared_path
    path = shared_path(spark, name)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    value = F.col("value")
    rows = lines.select(F.explode_outer(F.when(place == 0, F.array(*[F.lit(h) for h in header], value))
                                         .otherwise(F.array(value))).alias("value"))
    rows.write.mode("overwrite").text(path)
    return path


W3C_DIRECTIVES = ["#Software: Microsoft Internet Information Services 8.0", "#Version: 1.0",
                  "#Fields: date time s-sitename cs-method cs-uri-stem cs-uri-query s-port cs-username "
                  "c-ip cs(User-Agent) cs(Cookie) cs(Referer) cs-host sc-status sc-substatus "
                  "sc-win32-status sc-bytes cs-bytes time-taken"]


def w3c_directives(columns: list[str]) -> list[str]:
    """The head of a log file with these fields."""
    return [*W3C_DIRECTIVES[:2], "#Fields: " + " ".join(columns)]
