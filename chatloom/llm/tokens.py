"""Problem 8: encoding of a whole corpus with a public byte-level BPE tokenizer.

Texts are split into words in the JVM at white space, every distinct word is encoded once, and the ids are joined back by
position. The plan is the same for any vocabulary: the frequent words, as many as fit ``word_table_bytes``, are looked up in
Arrow batches by all tasks and leave gaps at the rare ones, and the rare words' ids are fetched by a join on the word and put
into the gaps by position; where all words are frequent, no text has a gap and nothing is joined. Decoding joins ids with the
id-to-piece table.

Null, empty: an empty list of ids, 0 tokens. Blank, very long and unbroken texts are ordinary texts; strings that look
like special tokens are ordinary text. Repeated rows stay repeated.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.session import spread, stage

TOKENIZER = "byte_bpe_50k"
#: Most bytes of the frequent words and their ids that tasks hold in memory.
WORD_TABLE_BYTES = 48 << 20
# White space of the tokenizer's pattern beyond Java's \s.
BLANKS = r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Words begin where white space follows another character. The tokenizer's own pattern never joins characters across such
#: a place and looks ahead only inside white space, so a word's ids don't depend on its place in the text.
WORD_START = rf"(?=\s)(?<=[^\s{BLANKS}])"
# Fixed value: the pattern that splits a text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_dir() -> str:
    """The folder of the vocabulary files: CHATLOOM_TOKENIZERS, else the installed package's, else /opt/tokenizers."""
    found = importlib.util.find_spec("public_tokenizers")
    return os.environ.get("CHATLOOM_TOKENIZERS") or (os.path.dirname(found.origin) if found and found.origin else "/opt/tokenizers")


@lru_cache(4)
def ranks(folder: str, name: str) -> dict[bytes, int]:
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in file if line.strip())}


@lru_cache(4)
def encoding(folder: str, name: str):
    import tiktoken

    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks(folder, name), special_tokens={})


def words(text: Column) -> Column:
    """The words of ``text`` in order; their concatenation is the text."""
    return F.split(F.coalesce(text, F.lit("")), WORD_START)


def word_table(df: DataFrame, text: str, name: str = TOKENIZER, folder: str | None = None) -> DataFrame:
    """The staged table (word, n, ids) of every distinct word of a corpus and how often it occurs, each encoded once.

    Words are counted per task before the shuffle, so a word that all texts share arrives once per task.
    """
    folder = folder or tokenizer_dir()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(folder, name)
        for batch in batches:
            ids = [bpe.encode_ordinary(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=["word", "n", "ids"])

    counted = spread(df.select(text)).select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return stage(counted.mapInArrow(encode, "word string, n bigint, ids array<int>"), "words")


class Vocabulary:
    """A distinct-word table in memory: words, the flat ids and where each word's ids begin."""

    def __init__(self, table: pa.Table):
        order = pc.sort_indices(table.column("word"))  # the same order on every task
        table = table.take(order).combine_chunks()
        self.words = table.column("word").combine_chunks() if table.num_rows else pa.array([], pa.string())
        ids = table.column("ids").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
        self.flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        self.counts = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.int64) if len(self.counts) else np.zeros(0, np.int64)

    def index(self, words: pa.Array) -> np.ndarray:
        """Where each word is; -1 for a word that isn't in the table."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def gather(self, index: np.ndarray) -> np.ndarray:
        """The ids of the words at ``index``, one after the other."""
        counts = self.counts[index]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.starts[index] - (ends - counts), counts)]


_LOADED: dict[str, Vocabulary] = {}


def load_vocabulary(path: str) -> Vocabulary:
    """The table at ``path``, read once per worker process from the shared folder."""
    if path not in _LOADED:
        from pyarrow import dataset, fs

        system, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        _LOADED.clear()
        _LOADED[path] = Vocabulary(dataset.dataset(place, filesystem=system, format="parquet").to_table(columns=["word", "ids"]))
    return _LOADED[path]


def frequent_and_rare(vocabulary: DataFrame, most: int) -> tuple[str, DataFrame | None]:
    """(path of the table of the frequent words, the rare words as a table, None where there are none).

    Frequent are the words of at least 2^k occurrences, k being the least for which they take at most ``most`` bytes: tasks hold
    these in memory at any size of the collection. A rare word has few occurrences by definition, so the join that fetches the
    others' ids knows no hot key.
    """
    size = F.sum(F.octet_length("word") + 8 + 4 * F.size("ids"))
    sizes = {r["k"]: r["bytes"] for r in vocabulary.groupBy(F.floor(F.log2("n")).alias("k")).agg(size.alias("bytes")).collect()}  # at most 63 rows
    held, least = 0, max(sizes, default=-1) + 1
    for k in sorted(sizes, reverse=True):
        held += sizes[k]
        if held > most:
            break
        least = k
    whole = least <= min(sizes, default=0)
    frequent = vocabulary if whole else stage(vocabulary.where(F.col("n") >= 2**least), "frequent")
    path = shared_path(frequent)
    return path, None if whole else vocabulary.where(F.col("n") < 2**least).select("word", "ids")


def shared_path(staged: DataFrame) -> str:
    """The folder of a staged table."""
    path = staged._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location().rootPaths().head().toString()
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


def with_digest(df: DataFrame, key: str, text: str) -> DataFrame:
    """(``key``, digest, words) of every row; the digest tells texts apart."""
    return spread(df.select(key, text)).select(key, F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"), words(F.col(text)).alias("words"))


def fetched(partial: DataFrame, rare: DataFrame, value: Column, out: str) -> DataFrame:
    """(digest, ``out``): for each text with rare words (column ``gaps``, in order) an array of ``value`` of each, joined by
    position. Copies of a text are looked up once."""
    each = partial.where(F.size("gaps") > 0).select("digest", "gaps").dropDuplicates(["digest"]).select("digest", F.posexplode("gaps").alias("at", "word"))
    found = each.join(rare, "word").groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("at", value.alias("value")))).alias("found"))
    return found.select("digest", F.transform("found", lambda x: x["value"]).alias(out))


def encode(df: DataFrame, key: str, text: str, name: str = TOKENIZER, folder: str | None = None, word_table_bytes: int = WORD_TABLE_BYTES) -> DataFrame:
    """(``key``, ids) for every row of ``df``: the ids of ``text`` without special tokens."""
    path, rare = frequent_and_rare(word_table(df, text, name, folder), word_table_bytes)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load_vocabulary(path)
        for batch in batches:
            spans = batch.column(2)
            flat, ends = spans.flatten(), np.cumsum(pc.list_value_length(spans).to_numpy(zero_copy_only=False).astype(np.int64))
            index = known.index(flat)
            # ids of frequent words in stretches, a new one after each rare word
            missing = np.flatnonzero(index < 0)
            row = np.searchsorted(ends, missing, "right")
            per_row = np.bincount(row, minlength=len(ends))
            held = np.where(index < 0, 0, index)
            counts = np.where(index < 0, 0, known.counts[held]) if len(known.counts) else np.zeros(len(index), np.int64)
            sums = np.concatenate([[0], np.cumsum(counts)])
            # a stretch ends at each rare word and at the end of each text
            stops = np.sort(np.concatenate([missing, ends]), kind="stable")
            offsets = np.concatenate([[0], sums[stops]]).astype(np.int32)
            stretches = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(known.gather(index[index >= 0]), pa.int32()))
            segments = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row + 1)]).astype(np.int32)), stretches)
            gaps = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)), flat.take(pa.array(missing)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), segments, gaps], names=[key, "digest", "segments", "gaps"])

    kind = df.schema[key].dataType.simpleString()
    partial = with_digest(df, key, text).mapInArrow(look_up, f"`{key}` {kind}, digest string, segments array<array<int>>, gaps array<string>")
    if rare is None:  # no text has a gap
        return partial.select(key, F.col("segments")[0].alias("ids"))
    partial = stage(partial, "partial")
    joined = partial.join(fetched(partial, rare, F.col("ids"), "filled"), "digest", "left")
    filled = F.flatten(F.transform("filled", lambda ids, i: F.concat(ids, F.element_at("segments", i + 2))))
    return joined.select(key, F.concat(F.col("segments")[0], F.coalesce(filled, F.array().cast("array<int>"))).alias("ids"))


def sizes(df: DataFrame, key: str, text: str, name: str = TOKENIZER, folder: str | None = None, word_table_bytes: int = WORD_TABLE_BYTES) -> DataFrame:
    """(``key``, tokens) for every row of ``df``: how many ids ``text`` has."""
    path, rare = frequent_and_rare(word_table(df, text, name, folder), word_table_bytes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load_vocabulary(path)
        for batch in batches:
            yield from _counted(batch, known, key)

    kind = df.schema[key].dataType.simpleString()
    partial = with_digest(df, key, text).mapInArrow(count, f"`{key}` {kind}, digest string, tokens bigint, gaps array<string>")
    if rare is None:
        return partial.select(key, "tokens")
    partial = stage(partial, "partial")
    joined = partial.join(fetched(partial, rare, F.size("ids"), "sizes"), "digest", "left")
    more = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return joined.select(key, (F.col("tokens") + F.coalesce(more, F.lit(0))).alias("tokens"))


def _counted(batch: pa.RecordBatch, known: Vocabulary, key: str) -> Iterator[pa.RecordBatch]:
    """(``key``, digest, tokens of the frequent words, rare words in order) of each row of (``key``, digest, words)."""
    spans = batch.column(2)
    flat, ends = spans.flatten(), np.cumsum(pc.list_value_length(spans).to_numpy(zero_copy_only=False).astype(np.int64))
    index = known.index(flat)
    missing = np.flatnonzero(index < 0)
    counts = np.where(index < 0, 0, known.counts[np.where(index < 0, 0, index)]) if len(known.counts) else np.zeros(len(index), np.int64)
    sums = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.diff(sums[np.concatenate([[0], ends])])
    per_row = np.bincount(np.searchsorted(ends, missing, "right"), minlength=len(ends))
    gaps = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)), flat.take(pa.array(missing)))
    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens), gaps], names=[key, "digest", "tokens", "gaps"])


def piece_table(spark: SparkSession, name: str = TOKENIZER, folder: str | None = None) -> DataFrame:
    """(id, piece) of a public tokenizer; its size is that of the vocabulary file."""
    known = ranks(folder or tokenizer_dir(), name)
    return spark.createDataFrame([(i, bytearray(p)) for p, i in known.items()], "id int, piece binary")


def decode(df: DataFrame, key: str, ids: str, name: str = TOKENIZER, folder: str | None = None) -> DataFrame:
    """(``key``, text) from ids, by a join of every id with its piece; ``key`` must be unique.

    A null list gives null, an empty one ''. The piece table is as large as the tokenizer's vocabulary file, so it is
    broadcast.
    """
    pieces = F.broadcast(piece_table(df.sparkSession, name, folder))
    spread = df.select(key, F.posexplode(ids).alias("pos", "id"))
    hexed = (
        spread.join(pieces, "id")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("pos", F.hex("piece").alias("hex")))).alias("found"))
        .select(key, F.decode(F.unhex(F.array_join(F.transform("found", lambda x: x["hex"]), "")), "UTF-8").alias("text"))
    )
    rows = df.select(key, F.col(ids).isNull().alias("none"))
    return rows.join(hexed, key, "left").select(key, F.when(F.col("none"), None).otherwise(F.coalesce("text", F.lit(""))).alias("text"))
