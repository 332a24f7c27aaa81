"""K7 — lexicon sentiment of JSON messages, geo-enriched by time zone.

raw text lines -> parsed fields -> sentiment code of each id (words, lexicon,
sums before the shuffle), joined back -> timestamp and country by time zone ->
valid rows with cleaned text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.temporal import created_at_field, created_at_parts, sortable_timestamp, timestamp_of
from tessera.functions.text import clean_text
from tessera.operators.joins import left_join
from tessera.operators.sentiment import explode_words, with_sentiment_code
from tessera.sources.schemas import MESSAGE_JSON_SCHEMA


def parse_messages(raw: DataFrame, schema: StructType = MESSAGE_JSON_SCHEMA, value_col: str = "value") -> DataFrame:
    """JSON text line -> typed fields.  A malformed line gives all-null
    fields, a non-numeric id a null id (never an error)."""
    j = F.from_json(F.col(value_col), schema).alias("j")
    parsed = raw.select(j)
    created = F.col("j.created_at")
    return parsed.select(
        F.col("j.id_str").try_cast("bigint").alias("id"),
        created.alias("created_at"),
        *[c.alias(name) for name, c in created_at_parts(created).items()],
        F.col("j.text").alias("text"),
        F.col("j.user.time_zone").alias("time_zone"),
    )


def simple_messages(parsed: DataFrame, *keep: str) -> DataFrame:
    ts = sortable_timestamp(F.col("created_at_year"), F.col("created_at_month"),
                            created_at_field("created_at", "day"), F.col("created_at_time"))
    return parsed.select(F.col("id").alias("tweet__id"), ts.alias("timestamp"), F.col("text").alias("msg"),
                         F.col("time_zone"), *keep)


def message_times(parsed: DataFrame) -> DataFrame:
    """(tweet_id, ts): the sortable text as a real timestamp; a bad one is null."""
    simple = simple_messages(parsed)
    return simple.select(F.col("tweet__id").alias("tweet_id"), timestamp_of("timestamp").alias("ts"))


def with_country(simple: DataFrame, zone_map: DataFrame, *keep: str) -> DataFrame:
    """(tweet_id, ts, msg, country) — country by time zone; a null or
    unknown zone gives null, a zone mapped twice gives two rows."""
    zones = zone_map.select(F.col("time_zone").alias("_zone"), "country")
    return left_join(simple, zones, F.col("time_zone") == F.col("_zone")).select(
        F.col("tweet__id").alias("tweet_id"), F.col("timestamp").alias("ts"), F.col("msg"), F.col("country"), *keep)


def message_words(parsed: DataFrame, lowercase: bool = False) -> DataFrame:
    """(id, word) rows, split on whitespace runs, case kept by default."""
    return explode_words(parsed, "id", "text", lowercase=lowercase)


def scored_messages(raw: DataFrame, zone_map: DataFrame, lexicon: DataFrame, *, lowercase: bool = False,
                    value_col: str = "value") -> DataFrame:
    """Every message with country and sentiment code (null code when the id is
    null or its messages have no words).  Words match the lexicon
    case-sensitively unless ``lowercase`` folds the message words first."""
    coded = with_sentiment_code(parse_messages(raw, value_col=value_col), lexicon, lowercase=lowercase)
    return with_country(simple_messages(coded, "sentiment"), zone_map, "sentiment")


def clean_scored(scored: DataFrame) -> DataFrame:
    """Rows with an id and a sentiment code, message reduced to [a-zA-Z0-9]
    words."""
    return (scored.filter(F.col("tweet_id").isNotNull() & F.col("sentiment").isin(0, 1, 2))
                  .select("tweet_id", "ts", clean_text("msg").alias("message"), "country", "sentiment"))
