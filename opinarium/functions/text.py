"""Text functions, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Unicode-aware string stripping removes. Spark's plain
# trim() only knows the blank.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: one tag, from "<" to the next ">" with no "<" between.
HTML_TAG = "<[^<]+?>"

_WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(text: Column) -> Column:
    """Removes leading and trailing Unicode whitespace; null stays null."""
    return F.btrim(text, F.lit(WHITESPACE))


def remove_tags(text: Column) -> Column:
    """Removes HTML tags and strips the rest; null stays null.

    Text without a "<" has no tag and skips the pattern.
    """
    untagged = F.when(text.contains("<"), F.regexp_replace(text, HTML_TAG, ""))
    return strip(untagged.otherwise(text))


def strip_html(text: Column) -> Column:
    """Like :func:`remove_tags`, but a missing text becomes an empty one."""
    return F.coalesce(remove_tags(text), F.lit(""))


def normalize_whitespace(text: Column) -> Column:
    """Strips and turns each run of whitespace into one blank; null becomes empty."""
    return F.coalesce(F.btrim(F.regexp_replace(text, _WHITESPACE_RUN, " ")), F.lit(""))


def id_key(identifier: Column) -> Column:
    """The form in which review ids are compared: text without surrounding whitespace.

    Text that begins and ends with a visible ASCII character, as most ids do, is taken as it is:
    comparing two characters costs far less than looking each up among the whitespace.
    """
    text = identifier.cast("string")
    bare = text.between("!", "~") & F.substring(text, -1, 1).between("!", "~")
    return F.when(bare, text).otherwise(strip(text))


def label(text: Column) -> Column:
    """Lower-cased and stripped label."""
    return F.lower(strip(text))


def snake_label(text: Column) -> Column:
    """Label with blanks turned into underscores, as used for aspect names."""
    return F.replace(label(text), F.lit(" "), F.lit("_"))


def is_blank(text: Column) -> Column:
    """True for a null or whitespace-only text."""
    return F.coalesce(strip(text), F.lit("")) == ""
