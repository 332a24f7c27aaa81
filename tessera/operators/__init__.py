from tessera.operators.generators import explode_rows
from tessera.operators.joins import left_join, semi_join
from tessera.operators.relational import common_schema, fit_schema, top_k, top_k_per_group, union_all
from tessera.operators.sentiment import (explode_words, message_sentiment, net_lexicon, with_sentiment_code,
                                         word_polarity)
from tessera.operators.sketches import distinct_sketches, estimated_ngrams, merge_sketches
from tessera.operators.text import (Context, context_ngram, context_ngrams, explode_ngrams, ngram_counts, ngram_frequency,
                                    ngram_regex_filter)

__all__ = [
    "explode_rows", "left_join", "semi_join", "top_k", "top_k_per_group", "union_all", "common_schema", "fit_schema", "distinct_sketches", "merge_sketches", "estimated_ngrams", "explode_words",
    "message_sentiment", "net_lexicon", "with_sentiment_code", "word_polarity", "Context", "context_ngram", "context_ngrams",
    "explode_ngrams", "ngram_counts", "ngram_frequency", "ngram_regex_filter",
]
