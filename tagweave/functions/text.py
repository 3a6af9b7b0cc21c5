"""Column functions over post text. All built-in Spark expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values. A hashtag is '#' followed by one or more letters, digits or
# underscores, matched anywhere (no word boundary before '#'). The class is
# written with Unicode properties so Java (Spark) and RE2 (DuckDB) agree with
# a Unicode-aware word class on accented and non-Latin letters.
TAG_PATTERN = r"#([\p{L}\p{N}_]+)"
# A word (used to turn free text into tags in the fixtures, and by tokens).
WORD_PATTERN = r"[\p{L}\p{N}_]+"
# Tokens: a word with an optional apostrophe suffix, or one other character
# that is not white space. White space is spelled out: Java's and RE2's \s
# differ on the vertical tab.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+(?:'\p{L}+)?|[^\t\n\x0B\f\r \p{L}\p{N}_]"
# White space collapsed by the "shrink" clean-up.
SPACE_RUN_PATTERN = r"[\t\n\x0B\f\r ]+"


def text_or_empty(text) -> Column:
    """Null text reads as the empty string."""
    return F.coalesce(as_col(text), F.lit(""))


def hashtags(text) -> Column:
    """Lower-cased hashtags of a text, in order, duplicates kept.

    Null text gives an empty array (not null), so ``size`` is 0.
    """
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(TAG_PATTERN), F.lit(1))


def distinct_hashtags(text_or_tags, from_tags: bool = False) -> Column:
    """The set of a post's hashtags, as a sorted array (stream preparation)."""
    tags = as_col(text_or_tags) if from_tags else hashtags(text_or_tags)
    return F.array_sort(F.array_distinct(tags))


def has_hash(text) -> Column:
    """True when the text contains a '#' at all (even without a tag)."""
    return F.coalesce(as_col(text).contains("#"), F.lit(False))


def tags_to_json(tags) -> Column:
    return F.to_json(as_col(tags))


def tags_from_json(s) -> Column:
    """JSON array string to ``array<string>``; malformed or null gives null."""
    return F.from_json(as_col(s), "array<string>")


def shrink(text) -> Column:
    """Collapse every run of white space to one blank and trim the ends."""
    return F.trim(F.regexp_replace(as_col(text), SPACE_RUN_PATTERN, " "))


def tokens(text) -> Column:
    """Tokens of a text: words (with an apostrophe suffix) and punctuation."""
    return F.regexp_extract_all(text_or_empty(text), F.lit(TOKEN_PATTERN), F.lit(0))


def words_as_tags(text) -> Column:
    """Prefix every word of the text with '#', keeping the rest of the text."""
    return F.regexp_replace(as_col(text), WORD_PATTERN, "#$0")


def display_label(tag) -> Column:
    """Display label of a tag: '#' followed by the tag."""
    return F.concat(F.lit("#"), as_col(tag))


def json_value(c) -> Column:
    """A value as JSON text, null as ``null``; strings keep their letters."""
    inside = F.to_json(F.array(as_col(c)))
    return F.substr(inside, F.lit(2), F.length(inside) - 2)


def ascii_json(json) -> Column:
    """JSON text with everything beyond printable ASCII (but line ends) as ``\\uXXXX``, in UTF-16 units."""
    c = as_col(json)
    units = F.regexp_extract_all(F.hex(F.encode(c, "UTF-16BE")), F.lit(".{4}"), F.lit(0))
    escaped = F.array_join(F.transform(units, lambda u: F.when(
        u.between("0020", "007E") | (u == "000A"), F.char(F.conv(u, 16, 10).cast("int"))).otherwise(F.concat(F.lit("\\u"), F.lower(u)))), "")
    return F.when(c.rlike(r"[^ -~\n]"), escaped).otherwise(c)
