"""Cleaners: text column in, text column out. Null stays null unless said otherwise."""

from __future__ import annotations

import html
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions import lexicons, text

_LATIN_BYTES = {chr(b): b for b in range(0x80, 0x100)} | {
    c: b for b in range(0x80, 0xA0) for c in [bytes([b]).decode("cp1252", "replace")] if c != "�"
}
_MISREAD = re.compile("(?:{2}{t}|{3}{t}{t}|{4}{t}{t}{t})+".format(None, None, *(
    "[" + "".join(re.escape(c) for c, b in _LATIN_BYTES.items() if low <= b <= high) + "]" for low, high in ((0xC2, 0xDF), (0xE0, 0xEF), (0xF0, 0xF4))
), t="[" + "".join(re.escape(c) for c, b in _LATIN_BYTES.items() if 0x80 <= b <= 0xBF) + "]"))
_LIGATURES = {c: unicodedata.normalize("NFKC", c) for c in "ﬀﬁﬂﬃﬄﬅﬆĲĳ"}
_PLAIN = str.maketrans(_LIGATURES | dict.fromkeys("‘’‚‛", "'") | dict.fromkeys("“”„‟", '"') | dict.fromkeys("\u2028\u2029\x85", "\n") | {
    c: unicodedata.normalize("NFKC", c) for c in map(chr, [*range(0xFF01, 0xFFEF), 0x3000]) if unicodedata.decomposition(c).startswith(("<wide>", "<narrow>"))
})
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0e-\x1f\x7f\ufeff]|\x1b\[[0-9;]*m")


def normalize_whitespace(column: Column) -> Column:
    """Ten kinds of white space and filler become a plain space; the no-break space stays."""
    return F.translate(column, lexicons.SPACES, " " * len(lexicons.SPACES))


def normalize_punctuation(column: Column) -> Column:
    """Typographic and East Asian punctuation becomes its ASCII form."""
    short = {mark: plain for mark, plain in lexicons.PUNCTUATION.items() if len(plain) == 1}
    out = F.translate(column, "".join(short), "".join(short.values()))
    for mark, plain in lexicons.PUNCTUATION.items():
        if len(plain) > 1:
            out = F.replace(out, F.lit(mark), F.lit(plain))
    return out


def remove_empty_lines(column: Column, intended: bool = False) -> Column:
    """Observed: every text becomes empty. Intended: lines of white space only are dropped."""
    if not intended:
        return F.when(column.isNotNull(), F.lit(""))
    return F.array_join(F.filter(text.lines(column), lambda line: text.strip(line) != ""), "\n")


def clean_new_lines(column: Column) -> Column:
    """Outer white space and all line feeds are removed."""
    return F.replace(text.strip(column), F.lit("\n"), F.lit(""))


def _reread(match: re.Match[str]) -> str:
    try:
        return bytes(_LATIN_BYTES[c] for c in match.group()).decode("utf-8")
    except UnicodeDecodeError:
        return match.group()


def fix_text(value: str | None) -> str:
    """One text with UTF-8 read as Windows-1252 repaired, entities, ligatures, widths, quotes, line ends and controls made
    plain, and accents composed; '' for null."""
    if not value:
        return ""
    if value.isascii() and "&" not in value and "\r" not in value and not _CONTROL.search(value):
        return value
    if "&" in value and "<" not in value:
        value = html.unescape(value)
    value = _MISREAD.sub(_reread, value)
    value = _CONTROL.sub("", value.translate(_PLAIN))
    return unicodedata.normalize("NFC", value.replace("\r\n", "\n").replace("\r", "\n"))


def fix_utf8_encoding(column: Column) -> Column:
    """``fix_text`` in Arrow batches; null becomes ''."""

    @F.pandas_udf("string")
    def fixed(values):
        return values.map(fix_text, na_action=None)

    return fixed(column)
