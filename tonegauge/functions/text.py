"""Text expressions; all of them stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonegauge.constants import TERM_STOPWORDS
from tonegauge.functions.coerce import flag

WORD = r"(?U)\S+"
TERM = "[a-záéíóúñü]+"
# A run of two or more word characters: ASCII ones, or letters and digits beyond ASCII.
# Naming ASCII first and never backing out of a run makes it several times faster.
TOKEN = r"[\w[\p{L}\p{N}&&[^\x00-\x7F]]]{2,}+"


def or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def text_len(col: Column) -> Column:
    return F.length(or_empty(col))


def word_count(col: Column) -> Column:
    return F.regexp_count(or_empty(col), F.lit(WORD))


def char_count(col: Column, char: str) -> Column:
    """P20: occurrences of one character."""
    text = or_empty(col)
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def item_count(col: Column) -> Column:
    """Comma-separated items, empty items included; missing or '' is 0."""
    return F.when(or_empty(col) == "", F.lit(0)).otherwise(F.size(F.split(col, ",")))


def has_char(col: Column, char: str) -> Column:
    return flag(F.contains(or_empty(col), F.lit(char)))


def upper_count(col: Column) -> Column:
    return F.regexp_count(or_empty(col), F.lit(r"\p{Lu}"))


def mean_word_length(col: Column) -> Column:
    """Letters per word, 0 for a text without words."""
    packed = F.length(F.regexp_replace(or_empty(col), r"(?U)\s+", "")).cast("double")
    return F.coalesce(F.try_divide(packed, word_count(col).cast("double")), F.lit(0.0))


def terms(col: Column, stopwords: list[str] = TERM_STOPWORDS) -> Column:
    """Lower-case terms longer than two letters that are no stop words."""
    found = F.regexp_extract_all(F.lower(or_empty(col)), F.lit(TERM), F.lit(0))
    return F.filter(found, lambda t: (F.length(t) > 2) & ~t.isin(stopwords))


def tokens(col: Column) -> Column:
    """Lower-case word tokens as TF-IDF sees them."""
    return F.regexp_extract_all(F.lower(or_empty(col)), F.lit(TOKEN), F.lit(0))


def with_pairs(words: Column) -> Column:
    """The words followed by the pairs of neighbours, joined by one blank."""
    last = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(words, F.lit(1), last), F.slice(words, F.lit(2), last),
        lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, pairs)


def normalise_tweet(col: Column) -> Column:
    """User names first, then links."""
    masked = F.regexp_replace(or_empty(col), r"@[\p{L}\p{N}_]+", "@user")
    return F.regexp_replace(masked, r"https?://\S+", "http")
