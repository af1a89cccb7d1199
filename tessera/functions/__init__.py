from tessera.functions.logs import (
    ACCESS_LOG_PATTERN,
    ACCESS_LOG_PATTERN_ORIGINAL,
    day_of_month,
    hour_of_day,
    parse_apache_time,
)
from tessera.functions.numeric import safe_ratio, similarity_bin, squared_error
from tessera.functions.text import (
    append_suffix,
    clean_text,
    remove_quotes,
    simple_tokenize,
    split_lines,
    split_words,
    tokenize,
)

__all__ = [
    "ACCESS_LOG_PATTERN",
    "ACCESS_LOG_PATTERN_ORIGINAL",
    "append_suffix",
    "clean_text",
    "day_of_month",
    "hour_of_day",
    "parse_apache_time",
    "remove_quotes",
    "safe_ratio",
    "similarity_bin",
    "simple_tokenize",
    "split_lines",
    "split_words",
    "squared_error",
    "tokenize",
]
