"""Text expressions, all evaluated in the JVM.

White space is what Python's str.isspace() calls so, spelled as an explicit class because `\\s` differs between engines.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character class of white space (fixed value).
WS = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]"
#: Everything that is neither a letter nor white space (fixed value).
NOT_ALPHA = r"[^\p{L}\x09-\x0d\x1c-\x20\x85\p{Z}]"
#: Words of two or more word characters (fixed value).
TERM = r"[\p{L}\p{N}_]{2,}"
#: English stop words of the common search library (fixed values).
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of", "on", "or", "such",
    "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)
#: Phrases that mark navigation and legal boilerplate (fixed values).
BOILERPLATE = ("click here", "next page", "previous page", "copyright ©", "all rights reserved", "terms of service", "privacy policy")


def words(text: Column) -> Column:
    """Words between white space, without empty ones."""
    return F.filter(F.split(text, f"{WS}+"), lambda w: w != "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WS}+|{WS}+$", "")


def stripped_at_least(text: Column, chars: int) -> Column:
    """Whether `strip` leaves so many characters; mostly the start of the text shows it."""
    return (F.length(strip(F.substring(text, 1, 4 * chars))) >= chars) | (F.length(strip(text)) >= chars)


def word_count(text: Column) -> Column:
    return F.size(words(text))


def truncate_words(text: Column, most: int = 512) -> Column:
    """The text as it is if it has at most that many words, else so many words joined by one space."""
    return F.when(word_count(text) <= most, text).otherwise(F.array_join(F.slice(words(text), 1, most), " "))


def alpha_ratio(text: Column) -> Column:
    """Letters and white space, as a share of all characters."""
    return F.length(F.regexp_replace(text, NOT_ALPHA, "")) / F.greatest(F.length(text), F.lit(1))


def has_boilerplate(text: Column) -> Column:
    """A search for each phrase, by far cheaper than one expression of alternatives, in a text lowered once (a filter would
    work out a repeated lower() again)."""
    return F.exists(F.array(F.lower(text)), lambda low: reduce(or_, (F.contains(low, F.lit(p)) for p in BOILERPLATE)))


def dedup_key(text: Column, chars: int = 200) -> Column:
    return F.md5(F.substring(text, 1, chars))


def query_hash(query: Column) -> Column:
    return F.substring(F.md5(query), 1, 16)


def terms(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Search terms in order, repeats included, stop words left out."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*stop_words)) if stop_words else found


def query_term_set(query: Column) -> Column:
    return F.array_distinct(words(F.lower(query)))


def passage_term_set(text: Column, most: int = 100) -> Column:
    return F.array_distinct(F.slice(words(F.lower(text)), 1, most))


def line_feeds(text: Column) -> Column:
    """Without NUL, and with line feeds alone."""
    cut = F.replace(text, F.lit("\0"), F.lit(""))
    return F.replace(F.replace(cut, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def sanitized(text: Column, chars: int = 500) -> Column:
    """The first characters, then `line_feeds`."""
    return line_feeds(F.substring(text, 1, chars))


def query_id(number: Column) -> Column:
    """q and at least six digits."""
    return F.format_string("q%06d", number)


def chunk_id(doc_id: Column, index: Column) -> Column:
    return F.concat(doc_id, F.lit("_chunk_"), index.cast("string"))


def first_truthy(*columns: tuple[Column, str]) -> Column:
    """The first value that is neither null, empty nor the number 0, as a string. columns: (column, its type)."""

    def one(column: Column, kind: str) -> Column:
        return F.nullif(column, F.lit("")) if kind == "string" else F.nullif(column, F.lit(0)).cast("string")

    return F.coalesce(*(one(c, k) for c, k in columns))


def duration(seconds: Column) -> Column:
    """Hours and minutes, by floor division."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%dh %dm", F.floor(whole / 3600).cast("long"), F.floor((whole % 3600) / 60).cast("long"))
