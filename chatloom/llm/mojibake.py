"""Problem 4: text garbled by decoding with a wrong character encoding.

Adjacent character pairs are scored by their discounted mutual information in the whole corpus: a pair that meets more often
than its characters' frequencies suggest is ordinary, any other pair that isn't pure ASCII is improbable. Maximum-scoring
segments of that score isolate improbable runs, and only inside those runs are inverse mappings tested: the run's characters
are mapped back to bytes of each known single-byte encoding (and Shift JIS), and accepted where they form UTF-8 of plausible
characters. The test repeats for text that was garbled twice. Replacement characters mark garbling that can't be undone.

Null and pure ASCII texts are never affected; null stays null. Repeated rows stay repeated; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.session import stage

#: A pair's mutual information counts half where it makes up this share of all pairs.
DISCOUNT = 1e-3
#: The same as a number of occurrences, in a small corpus.
LEAST_COUNT = 8.0
#: Discounted mutual information (nats) from which a pair is ordinary.
ORDINARY = 4.0
#: Score of a pair of ASCII characters: a wrong decoding leaves them alone, so they end a run.
ASCII_SCORE = -2.0
#: Mean discounted information from which a text of another alphabet reads as ordinary.
SENSIBLE = 0.15
#: A run ends where its sum has fallen so far below its best.
DROP = 8.0
#: Pairs below this share of all pairs have next to no discounted information and are not kept; bounds the table.
LEAST_SHARE = 1e-6
#: Exchanged Latin letters: the least number, the greatest part of their pairs' mean information that these have as they stand, and
#: the least mean information when they are restored.
LATIN_LETTERS, LATIN_UNKNOWN, LATIN_KNOWN = 3, 0.1, 0.1
LOST = "�"
# Encodings that UTF-8 bytes were read as, the likeliest first.
ENCODINGS = ("cp1252", "latin-1", "cp1251", "cp437", "mac_roman", "cp1250", "cp850", "cp866", "koi8_r", "cp1254", "cp1257", "iso8859_2", "iso8859_15")
# Fixed values: (read as, written as) of texts in one national encoding that were read as another.
EXCHANGED = (
    ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp1252", "cp1251"), ("cp1252", "koi8_r"), ("cp1252", "cp866"), ("cp866", "cp1251"),
    ("cp1251", "cp866"), ("cp866", "koi8_r"), ("koi8_r", "cp866"), ("mac_roman", "cp1251"), ("mac_cyrillic", "cp1251"), ("cp1251", "mac_cyrillic"),
)
# The same among encodings of Latin letters.
EXCHANGED_LATIN = (("cp1252", "cp1250"), ("cp1252", "iso8859_2"), ("cp1250", "cp1252"), ("cp1252", "cp1257"), ("cp1252", "cp1254"))
EXCHANGED_WIDE = (("cp1252", "euc_jp"), ("cp1252", "cp932"), ("mac_roman", "cp932"), ("cp437", "cp932"))
# Ranges of characters that restored text plausibly holds.
PLAUSIBLE = (
    (0xA0, 0x17F), (0x192, 0x192), (0x218, 0x21B), (0x2C6, 0x2DC), (0x300, 0x328), (0x384, 0x3CE), (0x401, 0x45F), (0x490, 0x491),
    (0x2002, 0x200F), (0x2010, 0x2027), (0x202F, 0x203B), (0x2060, 0x2063), (0x2070, 0x209C), (0x20AC, 0x20AC), (0x2116, 0x2122),
    (0x2150, 0x21FF), (0x2200, 0x22FF), (0x2460, 0x27BF), (0x3000, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xFB00, 0xFB06),
    (0xFE0E, 0xFE0F), (0xFEFF, 0xFEFF), (0xFF00, 0xFFEF), (0x1F000, 0x1FAFF),
)
#: Marks that ordinary text sets after a capital letter or beside another mark; alone they are no sign of garbling.
_TYPOGRAPHY = set("»«…—–“”’‘„‹›•№ёЁ  ")
_BOX = re.compile(r"[─-▟]+")
_RUSSIAN = re.compile(r"[А-Яа-яЁё\xa0]+")
_CYRILLIC = re.compile(r"[Ѐ-џҐґ]")
_PLAUSIBLE_SET = frozenset(c for low, high in PLAUSIBLE for c in range(low, high + 1))


@lru_cache(1)
def _codecs() -> list[tuple[str, dict[str, int], re.Pattern[str]]]:
    out = []
    for name in ENCODINGS:
        to_byte: dict[str, int] = {}
        for byte in range(0x80, 0x100):
            try:
                char = bytes([byte]).decode(name)
            except UnicodeDecodeError:
                char = chr(byte)  # undefined bytes are commonly passed through
            to_byte.setdefault(char, byte)
        if name == "cp1252":
            for byte in range(0x80, 0xA0):
                to_byte.setdefault(chr(byte), byte)

        def chars(low: int, high: int, known: dict[str, int] = to_byte) -> str:
            return "[" + "".join(re.escape(c) for c, b in known.items() if low <= b <= high) + "]"

        tail = chars(0x80, 0xBF)
        out.append((name, to_byte, re.compile(f"(?:{chars(0xC2, 0xDF)}{tail}|{chars(0xE0, 0xEF)}{tail}{{2}}|{chars(0xF0, 0xF4)}{tail}{{3}})+")))
    return out


def _decoded(match: str, to_byte: dict[str, int], name: str, in_word: bool) -> str | None:
    """The plausible text whose UTF-8 bytes were read as ``match``, else None; ``in_word`` if a letter stands beside it."""
    if _RUSSIAN.fullmatch(match):
        return None
    try:
        text = bytes(to_byte[c] for c in match).decode("utf-8")
    except UnicodeDecodeError:
        return None
    if any(ord(c) not in _PLAUSIBLE_SET and not 0x80 <= ord(c) < 0xA0 for c in text):
        return None
    if len(_CYRILLIC.findall(text)) == 1 and len(text) == 1:
        return None  # one letter is too little to tell
    if name in ("koi8_r", "cp866") and len(_CYRILLIC.findall(text)) < 2:
        return None  # only garbled Cyrillic is told from text in these
    if _BOX.fullmatch(match) and len(_CYRILLIC.findall(text)) < 2 and not (in_word and text.isalpha()):
        return None  # a drawing
    if len(text) == 1 and len(match) == 2 and match[1] in _TYPOGRAPHY and (_CYRILLIC.match(match[0]) or match[0] in "–—œŒ"):
        return None
    return text


def _from_shift_jis(run: str) -> str | None:
    """The text whose UTF-8 bytes were read as Shift JIS, with lost characters marked, where most of it makes sense."""
    try:
        data = b"".join(b"\xff" if c in "�・" else c.encode("cp932") for c in run)
    except UnicodeEncodeError:
        return None
    text = re.sub(f"{LOST}+", LOST, data.decode("utf-8", "replace"))
    good = sum(ord(c) >= 0x3000 for c in text)
    return text if good >= 2 and good >= 0.6 * len(text) else None


_SJIS = re.compile(r"[　-鿿！-￯–-●�ЁА-я´¨°±¶]{3,}")
_SJIS_HINT = re.compile(r"[縺繧繝]|[蜀-髻][｡-ﾟ]|[ｦ-ﾟ]")
_KANA_LATIN = re.compile(r"(?<![ｦ-ﾟ])ﾃ[｡-ｿ](?![ｦ-ﾟ])")
_HALF = re.compile(r"â€(?![\x80-\xbf€-™])|(?<![^\s(«\"'])Ã (?=[a-z ])")


def _to_bytes(text: str, name: str) -> bytes | None:
    out = bytearray()
    for char in text:
        try:
            out += char.encode(name)
        except UnicodeEncodeError:
            if not 0x80 <= ord(char) < 0x100:
                return None
            out.append(ord(char))  # undefined bytes are commonly passed through
    return bytes(out)


class _Reread(dict):
    """Characters of one single-byte encoding as another one has them, filled as they are met; '\0' where there is none."""

    def __init__(self, name: str, true: str):
        super().__init__()
        self.name, self.true = name, true

    def __missing__(self, code: int) -> str:
        data = _to_bytes(chr(code), self.name)
        try:
            self[code] = data.decode(self.true) if data else "\0"
        except UnicodeDecodeError:
            self[code] = "\0"
        return self[code]


@lru_cache(64)
def _reread(name: str, true: str) -> _Reread:
    return _Reread(name, true)


def information(text: str, keys: np.ndarray, scores: np.ndarray, at: np.ndarray | None = None) -> float:
    """Mean discounted mutual information of the pairs of ``text`` that aren't ASCII on either side, or of those on either side of
    the positions ``at``."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    pairs = codes[:-1] << 21 | codes[1:]
    if at is None:
        pairs = pairs[(codes[:-1] > 127) & (codes[1:] > 127)]
    else:
        beside = np.concatenate([at - 1, at])
        pairs = pairs[np.unique(beside[(beside >= 0) & (beside < len(pairs))])]
    if not len(pairs) or not len(keys):
        return 0.0
    at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
    return float(np.where(keys[at] == pairs, ORDINARY - scores[at], 0.0).mean())


def exchanged_latin(runs: str, keys: np.ndarray, scores: np.ndarray) -> _Reread | None:
    """How the improbable runs of one text read as they were written in another encoding of Latin letters: where the pairs beside
    the letters that change are next to unknown as they stand and known then, else None."""
    best, found = LATIN_KNOWN, None
    for name, true in EXCHANGED_LATIN:
        how = _reread(name, true)
        text = runs.translate(how)
        if "\0" in text or text == runs:
            continue
        at = np.array([i for i, (a, b) in enumerate(zip(runs, text, strict=True)) if a != b])
        if len(at) < LATIN_LETTERS or not all(text[i].isalpha() for i in at):
            continue
        before, after = (information(x, keys, scores, at) for x in (runs, text))
        if before <= LATIN_UNKNOWN * after and after > best:
            best, found = after, how
    return found


def exchanged(run: str, keys: np.ndarray, scores: np.ndarray) -> str | None:
    """``run`` as it was written in another national encoding, where its pairs are then far more ordinary, else None."""
    wide = sum(not c.isascii() for c in run)
    if wide < 4:
        return None
    if any("\x80" <= c <= "ÿ" or c in "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ" for c in run):
        for name, true in EXCHANGED_WIDE:
            data = _to_bytes(run, name)
            try:
                text = data.decode(true) if data else ""
            except UnicodeDecodeError:
                continue
            kana = sum("\u3040" <= c <= "\u30ff" for c in text)
            east = sum(c >= "\u3000" and not "\uff61" <= c <= "\uff9f" for c in text)
            if kana >= 2 and east >= 0.8 * sum(not c.isascii() for c in text) and east >= 0.25 * wide:
                return text
    before, best, found = information(run, keys, scores), 0.0, None
    for name, true in EXCHANGED:
        text = run.translate(_reread(name, true))
        if "\0" in text:
            continue
        letters = len(_CYRILLIC.findall(text))
        if letters >= 4 and letters >= 0.9 * sum(not c.isascii() for c in text) and (after := information(text, keys, scores)) > best:
            best, found = after, text
    return found if best > SENSIBLE and best > 3 * before else None


@lru_cache(50_000)
def _restored(run: str, table: _Table) -> tuple[str, bool]:
    """``restore`` of a run that was met before."""
    return restore(run, table.keys, table.scores)


class _Table:
    """The pair scores of one corpus."""

    def __init__(self, keys: np.ndarray, scores: np.ndarray):
        self.keys, self.scores = keys, scores


def restore(run: str, keys: np.ndarray, scores: np.ndarray) -> tuple[str, bool]:
    """``run`` with its garbled stretches restored, and whether it holds any."""
    found, wide = False, sum(not c.isascii() for c in run)
    for again in range(3):
        best, text = 0, run
        for name, to_byte, pattern in _codecs():
            gained = 0

            def put(m: re.Match[str], to_byte: dict[str, int] = to_byte, name: str = name) -> str:
                nonlocal gained
                beside = m.string[max(0, m.start() - 1) : m.start()] + m.string[m.end() : m.end() + 1]
                text = _decoded(m.group(), to_byte, name, any(c.isalpha() for c in beside))
                if text is None:
                    return m.group()
                gained += len(m.group())
                return text

            tried = pattern.sub(put, run)
            if gained > best:
                best, text = gained, tried
        if not again and best < 0.5 * wide and (other := exchanged(run, keys, scores)) is not None:
            return other, True
        if not best:
            break
        run, found = text, True
    if _SJIS_HINT.search(run):

        def put_sjis(m: re.Match[str]) -> str:
            nonlocal found
            text = _from_shift_jis(m.group())
            found = found or text is not None
            return m.group() if text is None else text

        run = _SJIS.sub(put_sjis, run)

        def put_latin(m: re.Match[str]) -> str:
            nonlocal found
            text = m.group().encode("cp932").decode("utf-8", "replace")
            around = m.string[max(0, m.start() - 1) : m.start()] + m.string[m.end() : m.end() + 1]
            if not text.isalpha() or not around.isascii() or not any(c.isalpha() for c in around):
                return m.group()
            found = True
            return text

        run = _KANA_LATIN.sub(put_latin, run)
    if LOST in run or _HALF.search(run):
        found = True
        run = _HALF.sub(lambda m: "à " if m.group() == "Ã " else LOST, run)
    return run, found


def pair_table(df: DataFrame, text: str) -> DataFrame:
    """The staged table (left, right, score) of the ordinary pairs of a corpus that aren't pure ASCII.

    Counts are summed per batch, then by pair. Only pairs of at least LEAST_SHARE are kept: at most 1 / LEAST_SHARE rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer("\n".join(x for x in batch.column(0).to_pylist() if x).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
            pairs, n = np.unique(codes[:-1] << 21 | codes[1:], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs >> 21), pa.array(pairs & 0x1FFFFF), pa.array(n)], names=["left", "right", "n"])

    pairs = df.select(text).mapInArrow(count, "left bigint, right bigint, n bigint").groupBy("left", "right").agg(F.sum("n").alias("n"))
    pairs = stage(pairs, "pairs")
    total = pairs.agg(F.sum("n")).first()[0] or 1
    lefts = pairs.groupBy("left").agg(F.sum("n").alias("n_left"))
    rights = pairs.groupBy("right").agg(F.sum("n").alias("n_right"))
    kept = pairs.where((F.col("n") >= LEAST_SHARE * total) & ((F.col("left") > 127) | (F.col("right") > 127)))
    information = F.log(F.col("n") * F.lit(float(total)) / (F.col("n_left") * F.col("n_right"))) * F.col("n") / (F.col("n") + max(DISCOUNT * total, LEAST_COUNT))
    return stage(kept.join(lefts, "left").join(rights, "right").select("left", "right", (ORDINARY - information).alias("score")).coalesce(1), "scores")


def segments(codes: np.ndarray, keys: np.ndarray, scores: np.ndarray) -> list[tuple[int, int]]:
    """Maximum-scoring segments as (first, last) positions of characters: a run grows until its sum is used up or falls
    DROP below its best, and ends at its best sum."""
    pairs = codes[:-1].astype(np.int64) << 21 | codes[1:]
    score = np.full(len(pairs), ORDINARY)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        score = np.where(keys[at] == pairs, scores[at], score)
    score[(codes[:-1] < 128) & (codes[1:] < 128)] = ASCII_SCORE
    if not (score > 0).any():
        return []  # all pairs are ordinary
    out: list[tuple[int, int]] = []
    total, best, first, last, before = 0.0, 0.0, -1, -1, -1
    spots = np.flatnonzero(score > ASCII_SCORE)
    for i, value in zip(spots.tolist(), score[spots].tolist(), strict=True):  # stretches of ASCII are walked over at once
        if first >= 0:
            total += (i - 1 - before) * ASCII_SCORE
            if total <= max(0.0, best - DROP):
                if best > 0:
                    out.append((first, last))
                first = -1
        before = i
        if first < 0:
            if value <= 0:
                continue  # a run begins with an improbable pair
            total, best, first = 0.0, 0.0, i
        total += value
        if total > best:
            best, last = total, i + 1
    if first >= 0 and best > 0:
        out.append((first, last))
    return out


def garbled(df: DataFrame, text: str, out: str = "restored", flag: str = "garbled") -> DataFrame:
    """``df`` with ``flag`` (boolean) and ``out``: the text as it was written, as far as it can be told; null for null."""
    scores = pair_table(df, text)
    rows = scores.toArrow()  # at most 1 / LEAST_SHARE rows of ordinary pairs
    keys, values = rows.column("left").to_numpy() << 21 | rows.column("right").to_numpy(), rows.column("score").to_numpy()
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    shared = df.sparkSession.sparkContext.broadcast((keys, values))

    @F.pandas_udf(f"{flag} boolean, {out} string")
    def mend(texts):
        import pandas as pd

        flags, restored, table = [], [], _table(shared.value)
        for value in texts:
            hit, mended = (False, value) if value is None or value.isascii() else mend_text(value, table)
            flags.append(hit)
            restored.append(mended)
        return pd.DataFrame({flag: flags, out: restored})

    return df.withColumn("__mended", mend(F.col(text))).withColumns({flag: F.col(f"__mended.{flag}"), out: F.col(f"__mended.{out}")}).drop("__mended")


_TABLES: list[_Table] = []


def _table(pair: tuple[np.ndarray, np.ndarray]) -> _Table:
    """One table object for each broadcast, so that what is known of a run stays known in later batches."""
    if not _TABLES or _TABLES[0].keys is not pair[0]:
        _TABLES[:] = [_Table(*pair)]
    return _TABLES[0]


def mend_text(text: str, table: _Table) -> tuple[bool, str]:
    """Whether ``text`` holds a garbled run, and the text with those runs restored."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    runs, at, found = [], 0, False
    for first, last in segments(codes, table.keys, table.scores) if len(codes) > 1 else [(0, 0)]:
        # whole words: a run may begin or end inside one
        while first > at and not text[first - 1].isspace():
            first -= 1
        while last + 1 < len(text) and not text[last + 1].isspace():
            last += 1
        if last < at:
            continue
        runs.append((max(first, at), last + 1))
        at = last + 1
    parts, at = [], 0
    left = "\n".join(text[a:b] for a, b in runs)
    # the information of a few letters is told from chance over all runs of the text together
    how = None if sum("\x80" <= c <= "ƿ" for c in left) < LATIN_LETTERS else exchanged_latin(left, table.keys, table.scores)
    for first, end in runs:
        run, hit = _restored(text[first:end], table)
        if not hit and how is not None:
            run = run.translate(how)
            hit = run != text[first:end]
        parts += [text[at:first], run]
        at, found = end, found or hit
    return found, "".join(parts) + text[at:]
