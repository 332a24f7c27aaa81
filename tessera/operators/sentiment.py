"""Lexicon sentiment of short messages.

Words are matched case-sensitively and exactly against a lexicon, a small
dimension that the optimizer broadcasts, so word rows don't shuffle on the
word.  Scores are summed in each task before they move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.sentiment import polarity_score, score_code, sentiment_label
from tessera.functions.text import split_words
from tessera.operators.generators import explode_rows


def explode_words(df: DataFrame, id_col: str = "id", text_col: str = "text", *,
                  lowercase: bool = False, out_col: str = "word") -> DataFrame:
    """(id, word) rows; a null text yields no row."""
    return explode_rows(df, split_words(text_col, lowercase=lowercase), out_col, keep=[F.col(id_col)])


def word_polarity(words: DataFrame, lexicon: DataFrame, *, id_col: str = "id", word_col: str = "word",
                  out_id: str = "tweet_id") -> DataFrame:
    """Per-word polarity -1/0/+1 by left join to the lexicon.  A word listed
    twice in the lexicon yields two rows, as a plain join does."""
    lex = lexicon.select(F.col("word").alias("_lex_word"), "polarity")
    joined = words.join(lex, F.col(word_col) == F.col("_lex_word"), "left")
    return joined.select(F.col(id_col).alias(out_id), F.col(word_col).alias("word"),
                         polarity_score("polarity").alias("polarity"))


def net_lexicon(lexicon: DataFrame) -> DataFrame:
    """One row per word with the summed score of all its entries.  Summing a
    message against this gives exactly the sum over the fanned-out join,
    without the fan-out."""
    return (lexicon.groupBy("word").agg(F.sum(polarity_score("polarity")).alias("score"))
                   .filter(F.col("score") != 0))


def message_sentiment(words: DataFrame, lexicon: DataFrame, *, id_col: str = "id", word_col: str = "word",
                      out_id: str = "tweet_id") -> DataFrame:
    """(tweet_id, sentiment): positive / negative / neutral from the sign of
    the summed word polarities.  Every message with at least one word gets a
    row; all copies of a duplicated id are summed together."""
    lex = net_lexicon(lexicon).withColumnRenamed("word", "_lex_word")
    scored = words.join(lex, F.col(word_col) == F.col("_lex_word"), "left")
    return scored.groupBy(F.col(id_col).alias(out_id)).agg(
        sentiment_label(F.coalesce(F.sum("score"), F.lit(0))).alias("sentiment"))


def sentiment_codes(messages: DataFrame, lexicon: DataFrame, *, id_col: str = "id", text_col: str = "text",
                    lowercase: bool = False, out_col: str = "sentiment") -> DataFrame:
    """(id, code): 2 / 1 / 0 of all messages with an id together.  Ids whose
    messages have no word are left out, null ids too.  Tasks sum what they
    have read of an id before anything moves, and no text moves."""
    known = messages.filter(F.col(id_col).isNotNull())
    words = explode_words(known, id_col, text_col, lowercase=lowercase, out_col="_word")
    lex = net_lexicon(lexicon).select(F.col("word").alias("_lex_word"), "score")
    return (words.join(lex, F.col("_word") == F.col("_lex_word"), "left").groupBy(id_col)
            .agg(score_code(F.coalesce(F.sum("score"), F.lit(0))).alias(out_col)))


def with_sentiment_code(messages: DataFrame, lexicon: DataFrame, *, id_col: str = "id", text_col: str = "text",
                        lowercase: bool = False, out_col: str = "sentiment") -> DataFrame:
    """Adds to every message the code (2 / 1 / 0) of all messages with its id
    together; null where the id is null or none of them has a word.

    The codes, a row an id, are joined back to the messages.  No step needs an
    id's messages in one place: if the codes are too many to be broadcast, the
    copies of a frequent id are a skewed partition, which AQE splits.  Messages
    without an id are dealt by their place in the input, equal ones too."""
    codes = sentiment_codes(messages, lexicon, id_col=id_col, text_col=text_col, lowercase=lowercase, out_col="_code")
    # a key of its own on both sides: their exchanges are the join's alone, as splitting a skewed partition asks for
    place = F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string"))
    keyed = messages.select("*", F.coalesce(F.col(id_col).cast("string"), place).alias("_key"))
    found = keyed.join(codes.select(F.col(id_col).cast("string").alias("_key"), "_code"), "_key", "left")
    return found.select(*messages.columns, F.col("_code").alias(out_col))
