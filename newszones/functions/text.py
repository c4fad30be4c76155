"""Text normalisation as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newszones import fixed_values as fixed

WHITESPACE = "".join(chr(c) for lo, hi in fixed.WHITESPACE_RANGES for c in range(lo, hi + 1))

# The same set as the inside of a regular expression class, for Spark and for RE2 alike.
WS_CLASS = "".join(
    rf"\x{{{lo:x}}}" if lo == hi else rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in fixed.WHITESPACE_RANGES
)

# The set once more for Java alone: its property lacks four control characters. Two tests per character
# instead of one per range make the hot patterns several times faster.
_JAVA_WS = r"\p{IsWhite_Space}\x1c-\x1f"


def strip(col: Column) -> Column:
    """Remove Unicode whitespace at both ends; ``trim`` alone removes only U+0020."""
    return F.btrim(col, F.lit(WHITESPACE))


def normalize_text(col: Column) -> Column:
    return strip(F.lower(col))


def null_tokens(col: Column) -> Column:
    """NULL for texts that stand for a missing value; expects normalised text."""
    return F.when(~col.isin(fixed.NULL_TOKENS), col)


def join_list(col: Column) -> Column:
    return F.array_join(col, " ")


def clean_text(col: Column) -> Column:
    """Keep unaccented letters, digits and whitespace; every whitespace run becomes one space."""
    kept = F.regexp_replace(col, rf"[^\p{{Alnum}}{_JAVA_WS}]+", "")
    # Now whatever is not alphanumeric is whitespace. A lone space, by far the most frequent run, stays as it is
    # instead of being replaced by itself.
    return F.btrim(F.regexp_replace(kept, r"[^\p{Alnum}](?:(?<! )|[^\p{Alnum}])[^\p{Alnum}]*", " "))


def remove_links(col: Column) -> Column:
    no_urls = F.regexp_replace(col, f"https?://[{fixed.LINK_CHARS}]+", "")
    return strip(F.regexp_replace(no_urls, rf"www\.[^{WS_CLASS}]+", ""))


def clean_description(col: Column, order: str = "clean_then_links") -> Column:
    """Clean a description.

    ``clean_then_links`` is the established order: cleaning takes ``:``, ``/`` and ``.`` away first, so
    links end up as one word, and the link step, which looks for those characters, has nothing left to do.
    ``links_then_clean`` really drops them.
    """
    if order == "clean_then_links":
        return clean_text(col)
    if order == "links_then_clean":
        return clean_text(remove_links(col))
    raise ValueError(f"unknown order: {order}")
