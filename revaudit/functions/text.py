"""Text expressions. All are native columns, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python counts as whitespace (Java's \s is ASCII only).
WHITESPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The sentiment lexicons.
POSITIVE_WORDS = ("great", "excellent", "amazing", "wonderful", "fantastic", "love", "best")
NEGATIVE_WORDS = ("terrible", "awful", "horrible", "worst", "hate", "disappointing", "poor")

# The character after "www" may be anything but a newline, a blank included.
_URL = f"http[^{WHITESPACE}]+|www[^\\n][^{WHITESPACE}]+"
_TAG = r"<[^\n]*?>"

# Kept characters of lower-cased text. They are listed one by one, and ahead of the whitespace,
# because Java looks single Latin-1 characters up in a table but tests ranges one after another.
_KEPT = "abcdefghijklmnopqrstuvwxyz0123456789.,!?"
_DROPPED = f"[^[ {_KEPT}][{WHITESPACE}]]+"
# Once symbols are gone, whatever is not kept is whitespace, and only kept characters lie between
# "!" and "z". One plain range runs several times faster here than a second listed class.
_BLANKS = "[^!-z]+"


def clean_text(text: Column, strip_tags: bool = False) -> Column:
    """Lower-case, drop URLs (then tags, if asked) and symbols, single-space; null gives ''.

    Texts without any URL or tag skip those patterns.
    """
    out = F.lower(F.coalesce(text, F.lit("")))
    linked = F.contains(out, F.lit("http")) | F.contains(out, F.lit("www"))
    out = F.when(linked, F.regexp_replace(out, _URL, "")).otherwise(out)
    if strip_tags:
        tagged = F.contains(out, F.lit("<"))
        out = F.when(tagged, F.regexp_replace(out, _TAG, "")).otherwise(out)
    return F.trim(F.regexp_replace(F.regexp_replace(out, _DROPPED, ""), _BLANKS, " "))


def word_count(cleaned: Column) -> Column:
    """Number of words of a single-spaced text: its blanks plus one."""
    blanks = F.length(cleaned) - F.length(F.replace(cleaned, F.lit(" "), F.lit("")))
    return F.when(F.length(cleaned) == 0, 0).otherwise(blanks + 1).cast("bigint")


def average_word_length(text_length: Column, words: Column) -> Column:
    """Mean word length from the length and word count of a single-spaced text; 0 if empty."""
    return F.when(words > 0, (text_length - words + 1) / words).otherwise(F.lit(0.0))


def lexicon_count(cleaned: Column, words: Sequence[str]) -> Column:
    """How many distinct lexicon entries occur in the text, also inside longer words."""
    lowered = F.lower(F.coalesce(cleaned, F.lit("")))
    total = F.lit(0)
    for word in words:
        total = total + F.contains(lowered, F.lit(word)).cast("int")
    return total


def sentiment_label(rating: Column, positive_from: float = 4, negative_to: float = 2) -> Column:
    return (
        F.when(rating >= positive_from, "positive")
        .when(rating <= negative_to, "negative")
        .otherwise("neutral")
    )
