"""Near-duplicates by MinHash signatures, locality-sensitive bands and connected components.

The survivor of a component is its least row id, so a stable, unique row id is required. Null texts count as empty. A
collision in one band makes a duplicate; candidates are not verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.operators.components import connected_components
from chatloom.session import spread, stage

# The prime and the largest value of the hash family, and the seed of its parameters.
PRIME = (1 << 61) - 1
LARGEST = (1 << 32) - 1
SEED = 42
#: Anything but these ends a token; neighbouring ends leave empty tokens.
TOKEN_END = "[^A-Za-z_0-9]"


@lru_cache(16)
def permutations(num_perm: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The factors and shifts of ``num_perm`` hash functions; ``skip`` functions were drawn by earlier calls."""
    source = np.random.RandomState(SEED)
    pairs = [(source.randint(1, PRIME, dtype=np.uint64), source.randint(0, PRIME, dtype=np.uint64)) for _ in range(skip + num_perm)]
    drawn = np.array(pairs[skip:], np.uint64).reshape(-1, 2)
    return drawn[:, 0], drawn[:, 1]


@lru_cache(64)
def optimal_bands(threshold: float, num_perm: int) -> tuple[int, int]:
    """(bands, rows): the split of a signature with the least sum of the areas of false positives and false negatives."""
    nodes, weights = np.polynomial.legendre.leggauss(64)

    def area(low: float, high: float, bands: int, rows: int, miss: bool) -> float:
        s = (high - low) / 2 * nodes + (high + low) / 2
        passed_over = (1 - s**rows) ** bands
        return float((weights * (passed_over if miss else 1 - passed_over)).sum() * (high - low) / 2)

    splits = ((b, r) for b in range(1, num_perm + 1) for r in range(1, num_perm // b + 1))
    return min(splits, key=lambda x: area(0, threshold, *x, False) / 2 + area(threshold, 1, *x, True) / 2)


def tokens(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), TOKEN_END, -1)


def shingles(words: Column, size: int, least: int) -> Column:
    """The distinct runs of ``size`` tokens, joined by a space; none for texts of fewer than ``least`` tokens."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.array_join(F.slice(words, i, F.lit(size)), " "))
    return F.when(F.size(words) >= max(size, least), F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def _hash32(token: str) -> int:
    return int.from_bytes(hashlib.sha1(token.encode("utf-8", "replace")).digest()[:4], "little")


def minhash(runs: list[str], factors: np.ndarray, shifts: np.ndarray, block: int = 512) -> np.ndarray:
    """The signature of a set of shingles; LARGEST everywhere for an empty one."""
    out = np.full(len(factors), LARGEST, np.uint64)
    hashes = np.fromiter(map(_hash32, runs), np.uint64, len(runs))
    for low in range(0, len(hashes), block):  # bounds the memory of very long texts
        values = hashes[low : low + block, None] * factors + shifts
        # modulo 2^61 - 1 without a division: fold the top bits once, then subtract the prime where it is reached
        values = (values & np.uint64(PRIME)) + (values >> np.uint64(61))
        values -= np.where(values >= np.uint64(PRIME), np.uint64(PRIME), np.uint64(0))
        out = np.minimum(out, (values & np.uint64(LARGEST)).min(0))
    return out


def signatures(df: DataFrame, key: str, text: str, ngram_size: int = 5, num_perm: int = 256, min_ngram_size: int = 5, skip: int = 0) -> DataFrame:
    """(``key``, signature array<bigint>) of every row."""
    drawn = permutations(num_perm, skip)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for words in batch.column(1).to_pylist():
                n = len(words) - ngram_size + 1
                runs = {" ".join(words[i : i + ngram_size]) for i in range(n)} if len(words) >= min_ngram_size and n > 0 else ()
                found.append(minhash(list(runs), *drawn).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=[key, "signature"])

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(key, text)).select(key, tokens(F.col(text)).alias("words")).mapInArrow(run, f"`{key}` {kind}, signature array<bigint>")


def band_keys(signed: DataFrame, key: str, bands: int, rows: int) -> DataFrame:
    """(``key``, band, band_key): each band's values in hexadecimal, 16 digits a value."""
    spans = F.array(*[F.array_join(F.transform(F.slice("signature", b * rows + 1, rows), lambda v: F.lpad(F.hex(v), 16, "0")), "") for b in range(bands)])
    return signed.select(key, F.posexplode(spans).alias("band", "band_key"))


def cluster(df: DataFrame, key: str, text: str, ngram_size: int = 5, num_perm: int = 256, threshold: float = 0.7, min_ngram_size: int = 5, skip: int = 0, intended: bool = False, out: str = "__cluster__") -> DataFrame:
    """``df`` with the component of every row, its least row id.

    Observed behaviour puts all texts without shingles into one component; ``intended`` leaves each in its own. Every bucket
    is a star around its least row, whose minimum combines map-side, so the bucket of all short texts emits no pairs.
    """
    bands, rows = optimal_bands(threshold, num_perm)
    signed = signatures(df, key, text, ngram_size, num_perm, min_ngram_size, skip)
    if intended:
        signed = signed.where(F.exists("signature", lambda v: v != LARGEST))
    keys = stage(band_keys(signed, key, bands, rows).select(F.col(key).alias("node"), F.xxhash64("band", "band_key").alias("h1"), F.xxhash64("band_key", "band", F.lit(1)).alias("h2")), "bands")
    least = keys.groupBy("h1", "h2").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last").select("h1", "h2", "first")
    edges = keys.join(least, ["h1", "h2"]).where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    found = connected_components(edges).select(F.col("node").alias(key), F.col("component").alias(out))
    return df.join(found, key, "left").withColumn(out, F.coalesce(out, key))


def deduplicate(df: DataFrame, key: str, text: str, **options) -> DataFrame:
    """The first row of every component, with its component."""
    return cluster(df, key, text, **options).where(F.col(options.get("out", "__cluster__")) == F.col(key))
