"""Problem 5: repetition inside a single document.

Every text gets two histograms: of its characters by class, and of its words by common word of its language or other word,
each where it stands beside its predecessor for the first time and where it does so again. The histograms of a language
summed over the whole corpus are its reference. A text's Jensen-Shannon distance from it tells how far the text is from
ordinary use: texts in which at least ``share`` of the words recur lie at least ``floor_distance`` away, so the distance chooses
the candidates, without loss, and recurring passages are sought in these only. Texts of fewer than ``MIN_WORDS`` words can't
repeat a passage and have share 0. The distance of the character classes is reported beside that of the words.

A word is a maximal run of letters and digits, in lower case. Null, empty and blank texts: 0 words, share 0, distance 0. Unknown
and null languages share one reference. Repeated rows stay repeated; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.session import spread

PASSAGE = 4
MIN_WORDS = PASSAGE + 1
# Common words by language.
COMMON = {
    "en": "the a of to and is in that it for on with as at by this be or from not",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un une du dans est que pour qui sur pas au par ne",
    "es": "de la que el en y a los se del las un por con no una su para es al",
    "pt": "de a o que e do da em um para com não uma os no se na por mais as",
    "ru": "и в не на я что он с а как это по но из у за от так же для",
    "pl": "i w nie na się z że do to jest o jak ale po co za od czy dla przez",
    "ja": "の に は を た が で て と し れ さ ある いる も する から な こと として",
}
OTHER = "other"
CLASSES = ("lower", "upper", "letter", "digit", "space", "mark", "line", "rest")
_WORD = re.compile(r"[^\W_]+")
_SETS = {lang: {w: i for i, w in enumerate(words.split())} for lang, words in COMMON.items()}
_WIDTH = max(len(w) for w in _SETS.values())
#: Word bins: each common word and other words, beside their predecessor for the first time; then the same again.
WORD_BINS = 2 * (_WIDTH + 1)
#: Of the words of recurring passages at least so many come again beside their predecessor: all but the first of four.
PAIRED = (PASSAGE - 1) / PASSAGE


def _char_table() -> np.ndarray:
    table = np.full(0x250, CLASSES.index("rest"), np.uint8)
    for code in range(0x250):
        c = chr(code)
        kind = "line" if c in "\n\r" else "space" if c.isspace() else "digit" if c.isdigit() else "lower" if c.islower() else "upper" if c.isupper() else "mark" if not c.isalnum() else "letter"
        table[code] = CLASSES.index(kind)
    return table


def recurring(words: list[str], least: int = PASSAGE) -> np.ndarray | None:
    """Which words stand in a passage of ``least`` or more words that began earlier; None where none does."""
    grams = list(zip(*(words[k:] for k in range(least)), strict=False))
    if len(set(grams)) == len(grams):
        return None
    first: dict[tuple[str, ...], int] = {}
    covered = np.zeros(len(words) + 1, np.int64)
    for i, gram in enumerate(grams):
        if first.setdefault(gram, i) != i:
            covered[i] += 1
            covered[i + least] -= 1
    return np.cumsum(covered[:-1]) > 0


def repeated_share(text: str | None) -> float:
    """The share of a text's words that stand in recurring passages."""
    words = _WORD.findall((text or "").lower())
    found = recurring(words) if len(words) >= MIN_WORDS else None
    return 0.0 if found is None else float(found.mean())


def word_bins(words: list[str], lang: str) -> np.ndarray:
    """A text's words by bin: common words of the language and others, each where the word beside its predecessor comes for
    the first time, and again."""
    known = _SETS.get(lang, {})
    pairs = list(zip([None, *words], words, strict=False))
    spots = np.fromiter((known.get(w, _WIDTH) for w in words), np.int64, len(words))
    if len(set(pairs)) < len(pairs):
        seen: set[tuple[str | None, str]] = set()
        for i, pair in enumerate(pairs):
            if pair in seen:
                spots[i] += _WIDTH + 1
            else:
                seen.add(pair)
    return np.bincount(spots, minlength=WORD_BINS)


def char_bins(text: str, table: np.ndarray) -> np.ndarray:
    """A text's characters by class."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    low = table[np.minimum(codes, 0x24F)]
    low[codes > 0x24F] = CLASSES.index("letter")
    return np.bincount(low, minlength=len(CLASSES))


def references(df: DataFrame, text: str, lang: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """(shares of character classes, shares of word bins) of each language and OTHER over the whole corpus; summed per batch
    before the shuffle. At most one row per known language reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _char_table()
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for own, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, value = own if own in COMMON else OTHER, value or ""
                both = np.concatenate([char_bins(value, table), word_bins(_WORD.findall(value.lower()), own)])
                sums[own] = sums.get(own, 0) + both
            flat = [(own, i, int(n)) for own, both in sums.items() for i, n in enumerate(both) if n]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in flat], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64()))], names=["lang", "bin", "n"])

    rows = spread(df.select(lang, text)).mapInArrow(run, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n")).collect()
    out: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for own in {r["lang"] for r in rows} | {OTHER}:
        both = np.zeros(len(CLASSES) + WORD_BINS)
        for r in rows:
            if r["lang"] == own:
                both[r["bin"]] = r["n"]
        parts = both[: len(CLASSES)], both[len(CLASSES) :]
        out[own] = tuple(p / max(1.0, p.sum()) for p in parts)
    return out


def js_distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """The Jensen-Shannon distance (base 2, 0 to 1) of a histogram of counts from a reference of shares; 0 for no counts."""
    total = counts.sum()
    if not total:
        return 0.0
    p, middle = counts / total, (counts / total + reference) / 2
    parts = sum(float((x[x > 0] * np.log2(x[x > 0] / middle[x > 0])).sum()) for x in (p, reference))
    return math.sqrt(max(0.0, parts / 2))


def floor_distance(share: float, reference: np.ndarray) -> float:
    """The least distance from a reference of word bins of a text of whose words at least ``share`` come again in their bins.

    Merging bins never raises the distance, so it is at least that of the two bins 'first' and 'again'; where the reference's
    own share of words that come again is as great, nothing follows.
    """
    again = float(reference[_WIDTH + 1 :].sum())
    if again >= share:
        return 0.0
    return js_distance(np.array([1 - share, share]), np.array([1 - again, again]))


def repetition(df: DataFrame, key: str, text: str, lang: str, share: float = 0.0) -> DataFrame:
    """(``key``, words, repeated, share, char_distance, word_distance, candidate) of every row.

    A text is a candidate where its word histogram lies as far from its language's reference, and holds as many words that come
    again, as that of a text with ``share`` must. Recurring passages are sought in candidates only; others have less than ``share``
    for certain, and their share is given as 0.
    """
    known = references(df, text, lang)
    floors = {own: floor_distance(PAIRED * share, words) for own, (_, words) in known.items()}
    names = [key, "words", "repeated", "share", "char_distance", "word_distance", "candidate"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _char_table()
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for own, value in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own, value = own if own in COMMON else OTHER, value or ""
                words = _WORD.findall(value.lower())
                chars, bins = char_bins(value, table), word_bins(words, own)
                char_reference, word_reference = known.get(own, known[OTHER])
                far = js_distance(bins, word_reference)
                # far enough from ordinary use, in the direction of repetition
                candidate = len(words) >= MIN_WORDS and far >= floors.get(own, floors[OTHER]) - 1e-9 and bins[_WIDTH + 1 :].sum() >= max(PAIRED * share * len(words) - 1e-9, PASSAGE - 1)
                found = recurring(words) if candidate else None
                repeated = 0 if found is None else int(found.sum())
                for column, item in zip(out, (len(words), repeated, repeated / max(1, len(words)), js_distance(chars, char_reference), far, candidate), strict=True):
                    column.append(item)
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, kinds, strict=True)]], names=names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, words int, repeated int, share double, char_distance double, word_distance double, candidate boolean"
    return spread(df.select(key, lang, text)).mapInArrow(run, schema)


def repetitive(df: DataFrame, key: str, text: str, lang: str, share: float = 0.3) -> DataFrame:
    """The distinct ``key`` of the texts of which at least ``share`` of the words stand in recurring passages."""
    return repetition(df, key, text, lang, share).where("candidate").where(F.col("share") >= share).select(key).distinct()
