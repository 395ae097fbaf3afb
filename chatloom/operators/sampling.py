"""Sampling by user: large groups are cut down, small ones stay whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import stage

#: Groups of fewer rows are never cut down.
SMALL_GROUP = 5


def sample_by_group(df: DataFrame, size: float, order: Column, group: str = "user_id") -> DataFrame:
    """Of every group of SMALL_GROUP or more rows its first floor(n * size) rows by ``order``; smaller groups whole.

    Rows of a null group drop out. ``order`` should be a distinct value per row, such as a hash of its key. The rank inside
    a group is the rank inside one of its salted parts plus the rows of the parts before it, parts being ranges of a hash
    of ``order``, so a group that holds a third of all rows is spread over tasks.
    """
    spread = F.md5(order.cast("string"))
    salted = df.where(F.col(group).isNotNull()).withColumns({"__order": spread, "__part": F.substring(spread, 1, 2)})
    parts = salted.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    known = parts.withColumns({"__n": F.sum("__rows").over(whole), "__before": F.coalesce(F.sum("__rows").over(before), F.lit(0))}).drop("__rows")
    rank = F.row_number().over(Window.partitionBy(group, "__part").orderBy("__order")) + F.col("__before")
    ranked = salted.join(known, [group, "__part"]).withColumn("__rank", rank)
    kept = ranked.where((F.col("__n") < SMALL_GROUP) | (F.col("__rank") <= F.floor(F.col("__n") * F.lit(size))))
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])


def sample_datasets(parts: list[DataFrame], proportions: list[float], target_size: float, key: str, seed: int = 42) -> DataFrame:
    """The union of samples of data sets in the given proportions, as large as the target and all of them allow."""
    kept = [stage(df, "sample") for df in parts]
    counts = [df.count() for df in kept]
    total = min([target_size, *(n / p for n, p in zip(counts, proportions, strict=True) if p)])
    order = F.concat_ws("|", F.col(key).cast("string"), F.lit(seed).cast("string"))
    sampled = [sample_by_group(df, total * p / n, order) for df, n, p in zip(kept, counts, proportions, strict=True) if n]
    return reduce(lambda a, b: a.unionByName(b), sampled) if sampled else kept[0]


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in an order drawn from a hash of ``key``: the same for the same seed, whatever the partitions."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key))
