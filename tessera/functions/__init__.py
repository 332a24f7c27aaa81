from tessera.functions.predicates import half_open, valid_value
from tessera.functions.sensors import extreme_flag, temp_diff, temperature_band
from tessera.functions.sentiment import polarity_score, sentiment_code, sentiment_label
from tessera.functions.temporal import created_at_parts, date_parts, month_number, sortable_timestamp
from tessera.functions.text import clean_text, ngrams, ngrams_starting_with, split_words, tokenize
from tessera.functions.weblog import LOG_ID_PATTERN, page_key, strip_log_id

__all__ = [
    "half_open", "valid_value", "extreme_flag", "temp_diff", "temperature_band", "polarity_score",
    "sentiment_code", "sentiment_label", "created_at_parts", "date_parts", "month_number",
    "sortable_timestamp", "clean_text", "ngrams", "ngrams_starting_with", "split_words", "tokenize",
    "LOG_ID_PATTERN", "page_key", "strip_log_id",
]
