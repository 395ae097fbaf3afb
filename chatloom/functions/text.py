"""Text primitives with the meaning Python's str and re give them, as Column expressions.

Null in gives null out everywhere; callers decide what a null text means.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that str.strip, str.split and \s take as white space.
WHITESPACE = "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of word characters: letters, numbers and the underscore.
WORD = r"[\p{L}\p{N}_]+"
#: A line boundary as str.splitlines knows it.
LINE_END = "\\r\\n|[\\n-\\r\\x1c-\\x1e\\x85\\u2028\\u2029]"
_SPACE_RUN = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def lines(text: Column) -> Column:
    """The lines of a text; a closing line end opens no further line."""
    parts = F.split(text, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def spaced_words(text: Column) -> Column:
    """str.split(): the runs between white space."""
    return F.filter(F.split(text, _SPACE_RUN, -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.lower(text), F.lit(WORD)).cast("bigint")


def split_exactly_two(text: Column, token: str) -> tuple[Column, Column]:
    """The two sides of ``token``; an error at run time where the token doesn't occur exactly once. Nulls stay null."""
    parts = F.split(text, r"\Q" + token + r"\E", -1)
    wrong = F.raise_error(F.concat(F.lit(f"expected exactly one {token!r}, found "), (F.size(parts) - 1).cast("string")))
    sound = F.when(text.isNull() | (F.size(parts) == 2), parts).otherwise(wrong.cast("array<string>"))
    return sound[0], sound[1]
