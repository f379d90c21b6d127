"""Text functions as native column expressions (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.split() and \S treat as white space, as a Java regex class body.
UNICODE_SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
URL = rf"http[^{UNICODE_SPACE}]+|www[^{UNICODE_SPACE}]+"

# Words about the reviewed works, left out of the keyword lists.
DOMAIN_STOPWORDS_LONG = (
    "album", "albums", "also", "dark", "dont", "floyd", "get", "going", "good", "great", "just",
    "like", "made", "make", "moon", "movie", "movies", "music", "netflix", "one", "pink", "que",
    "really", "series", "show", "shows", "song", "songs", "story", "take", "thing", "time", "watch",
    "watched", "watching", "will",
)
# The shorter list used with the 24-keyword report.
DOMAIN_STOPWORDS_SHORT = (
    "album", "albums", "dark", "dont", "floyd", "good", "great", "just", "like", "moon", "movie",
    "movies", "music", "netflix", "one", "pink", "que", "really", "series", "show", "shows", "song",
    "songs", "story", "time", "watch", "watched", "watching",
)


def english_stopwords() -> list[str]:
    """Spark's own English list."""
    return StopWordsRemover.loadDefaultStopWords("english")


def clean_text_letters(text: Column) -> Column:
    """Lower case; everything but ASCII letters and white space becomes a space."""
    return F.lower(F.regexp_replace(text, r"[^a-zA-Z\s]", " "))


def clean_text_sql(text: Column) -> Column:
    """Lower case; everything but ASCII letters, tabs and newlines included, becomes a space."""
    return F.lower(F.regexp_replace(text, r"[^a-zA-Z]", " "))


def tokenize_whitespace(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda token: token != "")


def tokenize_nonword(text: Column) -> Column:
    """Runs of ASCII letters, digits and underscores."""
    return F.filter(F.split(F.lower(text), r"\W+"), lambda token: token != "")


def remove_stopwords(tokens: Column, stopwords: Iterable[str]) -> Column:
    words = sorted({word.lower() for word in stopwords})
    return F.filter(tokens, lambda token: ~F.lower(token).isin(words))


def embed_clean_string(text: Column) -> Column:
    """Lower-case words separated by single spaces, without URLs; null becomes ''."""
    without_urls = F.regexp_replace(F.lower(text), URL, " ")
    return F.coalesce(F.trim(F.regexp_replace(without_urls, "[^a-z]+", " ")), F.lit(""))


def embed_clean_tokens(text: Column) -> Column:
    """The words of ``embed_clean_string``; null becomes an empty list."""
    without_urls = F.regexp_replace(F.lower(text), URL, " ")
    words = F.regexp_extract_all(without_urls, F.lit("[a-z]+"), F.lit(0))
    return F.coalesce(words, F.array().cast("array<string>"))


def keyword_tokens(text: Column) -> Column:
    """Runs of three and more ASCII letters."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0))


def word_count_clean(text: Column) -> Column:
    """Words after letters-only cleaning. Empty text and a leading newline each count one."""
    return F.size(F.split(F.trim(F.regexp_replace(text, r"[^a-zA-Z\s]", " ")), r"\s+"))


def word_count_raw(text: Column) -> Column:
    """White-space separated words of the raw text."""
    return F.size(F.filter(F.split(text, f"[{UNICODE_SPACE}]+"), lambda word: word != ""))


def word_unigrams(text: Column) -> Column:
    """Runs of two and more letters, digits and underscores, in any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def with_bigrams(words: Column) -> Column:
    """The words followed by all pairs of neighbours."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    bigrams = F.zip_with(
        F.slice(words, 1, pairs), F.slice(words, 2, pairs), lambda left, right: F.concat_ws(" ", left, right)
    )
    return F.concat(words, bigrams)


def ngrams_1_2(text: Column) -> Column:
    return with_bigrams(word_unigrams(text))
