"""Lexicon sentiment column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lexicon polarity labels and the sentiment labels/codes the
# downstream reports use.
POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"
SENTIMENT_CODES = ((POSITIVE, 2), (NEUTRAL, 1), (NEGATIVE, 0))


def polarity_score(polarity: Column | str) -> Column:
    """negative -> -1, positive -> +1, anything else (neutral, unknown,
    unmatched) -> 0."""
    p = F.col(polarity) if isinstance(polarity, str) else polarity
    return F.when(p == NEGATIVE, -1).when(p == POSITIVE, 1).otherwise(0)


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0, POSITIVE).when(score < 0, NEGATIVE).otherwise(NEUTRAL)


def sentiment_code(label: Column | str) -> Column:
    """positive -> 2, neutral -> 1, negative -> 0, anything else -> null."""
    lab = F.col(label) if isinstance(label, str) else label
    expr = None
    for name, code in SENTIMENT_CODES:
        expr = F.when(lab == name, code) if expr is None else expr.when(lab == name, code)
    return expr


def score_code(score: Column) -> Column:
    """The code of a summed score's label."""
    return sentiment_code(sentiment_label(score))
