"""Problem 10: cutting oversized texts at natural boundaries, with an overlap between consecutive pieces.

A text of more than ``limit`` tokens is cut by dynamic programming over its boundary positions: the sum of the penalties of
the cuts (paragraph, line, sentence, clause, word, inside a word) and of the squared deviation of each piece from an even
size is least, no piece has more than ``limit`` tokens, and every piece but the first repeats up to ``overlap`` tokens
before its cut, beginning at the earliest sentence in reach, else the earliest word.

Words are those of the distinct-word table, whose ids don't depend on their place, so the tokens of a piece are the sum over
its words. A word of more than ``limit`` tokens is itself cut where its ids end with whole characters. Null, empty and short
texts are not cut and give no pieces; repeated rows give repeated pieces; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm import tokens as T
from chatloom.session import stage

LIMIT, OVERLAP = 1024, 64
#: Of boundaries inside sentences one is considered in each stretch of the limit by so many tokens.
STRETCHES = 64
#: Penalties of a cut before a word, by the kind of boundary.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, INSIDE = 0.0, 1.0, 2.0, 5.0, 10.0, 50.0
PIECES_SCHEMA = "piece int, first_char bigint, last_char bigint, tokens bigint, text string"
_END = re.compile(r"[.!?。！？…][\"'”’»)\]]*$")
_CLAUSE = re.compile(r"[,;:，、；：–—][\"'”’»)\]]*$")
_ATOM = re.compile(r"[^。！？]*[。！？]+|[^。！？]+")


def marks(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each word: the penalty of a cut before it for its leading white space, and of one after it for its last mark."""
    lead, last = np.full(len(words), WORD), np.full(len(words), WORD)
    for i, word in enumerate(words):
        lines = word.count("\n", 0, len(word) - len(word.lstrip()))
        if lines:
            lead[i] = PARAGRAPH if lines > 1 else LINE
        if not word[-1:].isalnum():
            last[i] = SENTENCE if _END.search(word) else CLAUSE if _CLAUSE.search(word) else WORD
    return lead, last


def atoms(words: list[str], counts: np.ndarray, lead: np.ndarray, last: np.ndarray, bpe, most: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words with those of more than ``most`` tokens cut up, their tokens, and the penalty of a cut before each."""
    before = np.concatenate([[WORD], last[:-1]])
    penalty = np.minimum(lead, before)
    long = np.flatnonzero(counts > most)
    if not len(long):
        return words, counts, penalty
    cut, n, p, at = [], [], [], 0
    for i in [*long, len(words)]:
        cut += words[at:i]
        n.append(counts[at:i])
        p.append(penalty[at:i])
        if i < len(words):
            parts = _whole_parts(words[i], bpe, most)
            ends = marks(parts)[1]
            cut += parts
            n.append(np.array([len(bpe.encode_ordinary(w)) for w in parts], np.int64))
            p.append(np.concatenate([[penalty[i]], np.where(ends[:-1] < WORD, ends[:-1], INSIDE)]))
        at = i + 1
    return cut, np.concatenate(n), np.concatenate(p)


def _whole_parts(word: str, bpe, most: int) -> list[str]:
    """``word`` cut into parts of about ``most`` tokens at most, after sentence marks, else where ids end with a character."""
    parts: list[str] = []
    for part in _ATOM.findall(word) or [word]:
        pieces, held, n = bpe.decode_tokens_bytes(bpe.encode_ordinary(part)), b"", 0
        for piece in pieces:
            if n >= most and _whole(held):
                parts.append(held.decode("utf-8"))
                held, n = b"", 0
            held += piece
            n += 1
        parts.append(held.decode("utf-8"))
    return parts


def _whole(data: bytes) -> bool:
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def cuts(counts: np.ndarray, penalty: np.ndarray, limit: int, overlap: int, stretch: int | None = None) -> list[tuple[int, int]]:
    """(first word, word after the last) of each piece, by dynamic programming over the words' boundaries.

    A piece that ends before word j and whose own part begins with word i starts at ``reach[i]``, the word its overlap
    begins with; it may hold at most ``limit`` tokens.
    """
    n = len(counts)
    at = np.concatenate([[0], np.cumsum(counts)])
    total = int(at[-1])
    # the overlap of a cut before word i: the earliest sentence start within reach, else the earliest word
    reach = np.searchsorted(at, at[:n] - overlap, "left")
    reach[0] = 0
    natural = np.flatnonzero(penalty <= SENTENCE)
    if len(natural):
        nearest = np.searchsorted(natural, reach)
        found = natural[np.minimum(nearest, len(natural) - 1)]
        reach = np.where((nearest < len(natural)) & (found < np.arange(n)) & (found >= reach), found, reach)
    begin = at[reach]
    even = total / np.ceil(total / max(1, limit - overlap))
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    came = np.zeros(n + 1, np.int64)
    stops = _stops(at, penalty, max(1, limit // STRETCHES) if stretch is None else stretch)
    starts = np.concatenate([[0], stops])  # positions a piece may begin its own part at; the first `known` have a cost
    begins, costs, known = begin[np.minimum(starts, n - 1)], np.full(len(starts), np.inf), 1
    costs[0] = 0.0
    came = np.zeros(len(starts), np.int64)
    for k, j in enumerate(stops, 1):
        low = int(np.searchsorted(begins[:known], at[j] - limit, "left"))
        cost = costs[low:k] + 20.0 * ((at[j] - at[starts[low:k]] - even) / even) ** 2
        if len(cost):
            i = int(cost.argmin())
            costs[k] = cost[i] + (penalty[j] if j < n else 0.0)
            came[k] = low + i
        known = k + 1
    pieces, k = [], len(stops)
    while k > 0:
        i = int(came[k])
        pieces.append((int(reach[starts[i]]), int(starts[k])))
        k = i
    return pieces[::-1]


def _stops(at: np.ndarray, penalty: np.ndarray, stretch: int) -> np.ndarray:
    """Positions to consider, and the end: all boundaries of sentences, lines and paragraphs, and of the others the most natural
    one in each ``stretch`` tokens; with a stretch of 0 all of them."""
    n = len(penalty)
    if not stretch:
        return np.arange(1, n + 1)
    part = at[1:n] // stretch
    order = np.lexsort((penalty[1:n], part))
    first = np.concatenate([[True], np.diff(part[order]) > 0]) if n > 1 else np.zeros(0, bool)
    natural = np.flatnonzero(penalty[1:n] <= SENTENCE) + 1
    return np.concatenate([np.union1d(order[first] + 1, natural), [n]]).astype(np.int64)


def pieces_of(words: list[str], counts: np.ndarray, lead: np.ndarray, last: np.ndarray, bpe, limit: int, overlap: int) -> list[tuple[int, int, int, str]]:
    """(first character, character after the last, tokens, text) of each piece of a text given as words with their marks."""
    words, counts, penalty = atoms(words, counts, lead, last, bpe, max(1, limit // 8))
    chars = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
    whole = "".join(words)
    return [(int(chars[i]), int(chars[j]), int(counts[i:j].sum()), whole[chars[i] : chars[j]]) for i, j in cuts(counts, penalty, limit, overlap)]


def split(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP, name: str = T.TOKENIZER, folder: str | None = None, word_table_bytes: int = T.WORD_TABLE_BYTES) -> DataFrame:
    """(``key``, piece, first_char, last_char, tokens, text) of every text of more than ``limit`` tokens, in order of piece.

    ``first_char`` counts from 0, ``last_char`` is exclusive, both in code points.
    """
    folder = folder or T.tokenizer_dir()
    path, rare = T.frequent_and_rare(T.word_table(df, text, name, folder), word_table_bytes)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = T.load_vocabulary(path)
        bpe = T.encoding(folder, name)
        if not hasattr(known, "marks"):
            known.marks = marks(known.words.to_pylist())
        for batch in batches:
            spans, fills = batch.column(2), batch.column(3).to_pylist()
            flat = spans.flatten()
            index = known.index(flat)
            missing = index < 0
            counts = np.where(missing, 0, known.counts[np.where(missing, 0, index)]) if len(known.counts) else np.zeros(len(index), np.int64)
            ends = np.cumsum(pc.list_value_length(spans).to_numpy(zero_copy_only=False).astype(np.int64))
            begins = np.concatenate([[0], ends[:-1]])
            counts[missing] = [n for fill in fills for n in fill or ()]
            sums = np.concatenate([[0], np.cumsum(counts)])
            source, out = [], []
            for row in np.flatnonzero(sums[ends] - sums[begins] > limit):
                low, high = int(begins[row]), int(ends[row])
                own, words = index[low:high], flat.slice(low, high - low).to_pylist()
                if fills[row]:
                    lead, last = marks(words)
                else:
                    lead, last = (m[own] for m in known.marks)
                for k, piece in enumerate(pieces_of(words, counts[low:high], lead, last, bpe, limit, overlap)):
                    source.append(int(row))
                    out.append((k, *piece))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            arrays = [batch.column(0).take(pa.array(source, pa.int32())), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "piece", "first_char", "last_char", "tokens", "text"])

    rows = T.with_digest(df, key, text)
    if rare is None:
        rows = rows.withColumn("fill", F.lit(None).cast("array<int>"))
    else:
        # a rare word has at most as many tokens as bytes; only texts that may pass the limit are moved
        def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = T.load_vocabulary(path)
            for batch in batches:
                for found in T._counted(batch, known, key):
                    missing = found.column(3)
                    sizes = pc.binary_length(missing.flatten()).to_numpy(zero_copy_only=False).astype(np.int64)
                    ends = np.cumsum(pc.list_value_length(missing).to_numpy(zero_copy_only=False).astype(np.int64))
                    sums = np.concatenate([[0], np.cumsum(sizes)])
                    kept = pa.array(found.column(2).to_numpy() + np.diff(sums[np.concatenate([[0], ends])]) > limit)
                    yield pa.RecordBatch.from_arrays([c.filter(kept) for c in (batch.column(0), batch.column(1), batch.column(2), missing)], names=[key, "digest", "words", "gaps"])

        partial = stage(rows.mapInArrow(gaps, f"`{key}` {kind}, digest string, words array<string>, gaps array<string>"), "partial")
        rows = partial.join(T.fetched(partial, rare, F.size("ids"), "fill"), "digest", "left").select(key, "digest", "words", "fill")
    return rows.mapInArrow(run, f"`{key}` {kind}, {PIECES_SCHEMA}")
