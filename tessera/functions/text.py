"""Text column functions (all JVM-side expressions, no Python UDFs).

Regex classes are ASCII: Java's ``\\W`` is ``[^a-zA-Z0-9_]`` unless the
UNICODE_CHARACTER_CLASS flag is set, which matches the byte-string semantics
of the source data, and RE2 (DuckDB) agrees.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must match the original semantics exactly.
CLEAN_PATTERN = "[^a-zA-Z0-9 ]"   # characters removed by clean_text
TOKEN_SPLIT_PATTERN = r"\W+"      # separator of simple_tokenize
WORD_SEPARATOR = " "              # split_words splits on exactly one space
LINE_SEPARATOR = "\n"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Lower-case, drop everything but ASCII letters, digits and spaces, trim.

    Punctuation is removed before trimming, so ``" The Elephant's 4 cats. "``
    becomes ``"the elephants 4 cats"``.
    """
    return F.trim(F.regexp_replace(F.lower(_col(c)), CLEAN_PATTERN, ""))


def split_words(c: Column | str) -> Column:
    """Array of the pieces between single spaces (empty pieces kept)."""
    return F.split(_col(c), WORD_SEPARATOR)


def split_lines(c: Column | str) -> Column:
    """Array of the lines of a text value."""
    return F.split(_col(c), LINE_SEPARATOR)


def simple_tokenize(c: Column | str) -> Column:
    """Non-empty lower-cased tokens between runs of non-word characters.

    Splitting happens before lower-casing so the tokens are exactly the ASCII
    word runs of the input (lower-casing a non-ASCII letter can never turn it
    into a token character).
    """
    parts = F.split(_col(c), TOKEN_SPLIT_PATTERN)
    return F.filter(F.transform(parts, lambda t: F.lower(t)), lambda t: t != "")


def tokenize(c: Column | str, stopwords: Iterable[str] = ()) -> Column:
    """``simple_tokenize`` without the given stopwords (duplicates kept).

    For a stopword list held as a DataFrame (of any size), explode first
    and use ``tessera.operators.similarity.drop_stopwords`` (an anti join).
    """
    words = sorted(set(stopwords))
    tokens = simple_tokenize(c)
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(words))


def remove_quotes(c: Column | str) -> Column:
    """Drop every double-quote character."""
    return F.translate(_col(c), '"', "")


def append_suffix(c: Column | str, suffix: str) -> Column:
    """``word + suffix`` (the pluralise example)."""
    return F.concat(_col(c), F.lit(suffix))
