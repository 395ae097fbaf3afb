"""Problem 2: mixing sources to target shares of the total size.

A low-discrepancy schedule: the points frac((i + 1/2) · golden ratio) are mapped through the cumulative weights of the
sources, which gives every slot of the mixture a source with the right frequency in every stretch; slots are ranked per
source, and the r-th slot of a source takes its r-th block of rows, going round its shuffled blocks again up to
``max_repeats`` times. Blocks hold (nearly) equal sizes: a source's rows in hash order are cut where the running size passes
a multiple of the block size.

The mixture is the largest one the caps allow. A source of the targets without rows can give nothing; the others' shares are
then scaled up to 1 and the report shows the wanted and the actual share. Sources are compared without regard to case,
white space and a closing slash; rows of a source that is null or not in the targets are not used and are reported with target share 0.
Keys delivered twice count once; rows of size 0 are used with their block. Empty tables give an empty mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.session import stage

GOLDEN = 0.6180339887498949
#: Most slots of a mixture; a slot takes at least the size of an average row, and shares are exact to about one slot.
SLOTS = 1 << 16
#: Buckets that the running size of one source is spread over.
BUCKETS = 256


def source_name(source: Column) -> Column:
    """The spelling sources are compared by."""
    return F.regexp_replace(F.lower(source), r"[\s\u00a0]+|/+\s*$", "")


def sized_rows(rows: DataFrame, key: str, source: str, size: Column) -> DataFrame:
    """(key, source, size) of distinct keys; a key's first row by source and size counts."""
    one = rows.select(F.col(key).alias("key"), F.struct(source_name(F.col(source)).alias("source"), F.coalesce(size, F.lit(0)).cast("bigint").alias("size")).alias("row"))
    return one.groupBy("key").agg(F.min("row").alias("row")).select("key", "row.source", "row.size")


def plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target source: rows, available size, weight (share scaled to the sources that have rows), low and high
    cumulative weight, slots to use and block size. As small as the table of targets."""
    have = sized.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("available"))
    wanted = targets.groupBy(source_name(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    both = wanted.where("source is not null and target_share > 0 and max_repeats > 0").join(have, "source", "left").na.fill(0, ["rows", "available"])
    usable = F.when(F.col("available") > 0, F.col("target_share")).otherwise(0.0)
    everything = Window.partitionBy()
    in_order = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, 0)
    weighted = both.withColumn("weight", F.try_divide(usable, F.sum(usable).over(everything)))
    most = F.min(F.when(F.col("weight") > 0, F.col("available") * F.col("max_repeats") / F.col("weight"))).over(everything)
    return (
        weighted.withColumn("total", most)
        .withColumn("high", F.sum("weight").over(in_order))
        .withColumn("low", F.col("high") - F.col("weight"))
        .withColumn("mean", F.sum("available").over(everything) / F.greatest(F.sum("rows").over(everything), F.lit(1)))
        .withColumn("block", F.greatest(F.ceil(F.col("total") / SLOTS), F.ceil("mean"), F.lit(1)).cast("bigint"))
        .withColumn("slots", F.floor(F.coalesce("total", F.lit(0)) / F.col("block")).cast("bigint"))
    )


def blocks(sized: DataFrame, planned: DataFrame, seed: int = 42) -> DataFrame:
    """(source, key, size, block_no): rows in shuffled order, cut into blocks of the plan's size.

    The running size is a sum within hash buckets of a source plus the buckets before it, so a source that holds a third of
    all rows is spread over as many tasks as it has buckets.
    """
    spread = sized.join(F.broadcast(planned.where("weight > 0").select("source", "block")), "source").withColumn("order", F.xxhash64("key", F.lit(seed)))
    spread = stage(spread.withColumn("bucket", F.pmod(F.shiftright("order", 20), F.lit(BUCKETS)).cast("int")), "mixing")
    per_bucket = spread.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("source", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("order", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most BUCKETS rows per target source
    placed = spread.join(F.broadcast(offsets), ["source", "bucket"]).withColumn("running", F.col("offset") + F.sum("size").over(inside))
    # a row belongs to the block that its middle lies in
    middle = (F.col("running") - F.col("size") / 2) / F.col("block")
    return placed.select("source", "key", "size", F.floor(middle).cast("bigint").alias("block_no"))


def schedule(spark: SparkSession, planned: DataFrame) -> DataFrame:
    """(slot, source, rank): the source of every slot and the slot's rank among its source's."""
    slots = planned.agg(F.max("slots")).first()[0] or 0
    point = (F.col("id") + 0.5) * GOLDEN
    points = spark.range(slots).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("u"))
    last = F.col("high") >= 1 - 1e-9
    named = points.join(F.broadcast(planned.where("weight > 0")), (F.col("u") >= F.col("low")) & ((F.col("u") < F.col("high")) | last))
    # at most SLOTS rows, so the window is bounded
    return named.select("slot", "source", (F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1).cast("bigint").alias("rank"))


def mix(rows: DataFrame, key: str, source: str, size: Column, targets: DataFrame, seed: int = 42) -> DataFrame:
    """(slot, source, ``key``, repeat, size): the mixture in the order of its slots; ``repeat`` counts from 0."""
    sized = stage(sized_rows(rows, key, source, size), "sized")
    planned = stage(plan(sized, targets).coalesce(1), "plan")
    cut = stage(blocks(sized, planned, seed), "blocks")
    counts = cut.groupBy("source").agg((F.max("block_no") + 1).alias("n_blocks"))
    slots = schedule(rows.sparkSession, planned).join(F.broadcast(counts), "source").join(F.broadcast(planned.select("source", "max_repeats")), "source")
    taken = slots.select("source", "slot", (F.col("rank") % F.col("n_blocks")).alias("block_no"), F.floor(F.col("rank") / F.col("n_blocks")).cast("int").alias("repeat"), "max_repeats")
    mixed = cut.join(taken.where("repeat < max_repeats"), ["source", "block_no"])
    return mixed.select("slot", "source", F.col("key").alias(key), "repeat", "size")


def report(mixed: DataFrame, targets: DataFrame, key: str, seen: DataFrame | None = None) -> DataFrame:
    """(source, target_share, actual_share, rows, distinct_rows, most_repeats, size) per source.

    ``seen`` may give further sources (column source), which are reported with target share 0.
    """
    used = mixed.groupBy("source", key).agg(F.count(F.lit(1)).alias("times"), F.sum("size").alias("size"))
    used = used.groupBy("source").agg(F.sum("times").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"), F.max("times").alias("most_repeats"), F.sum("size").alias("size"))
    wanted = targets.where("source is not null").groupBy(source_name(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"))
    if seen is not None:
        others = seen.select(source_name(F.col("source")).alias("source")).distinct().where("source is not null")
        wanted = wanted.join(others, "source", "full")
    total = F.greatest(F.sum(F.coalesce("size", F.lit(0))).over(Window.partitionBy()), F.lit(1))
    joined = wanted.join(used, "source", "left").na.fill(0)
    return joined.select("source", "target_share", (F.col("size") / total).alias("actual_share"), "rows", "distinct_rows", "most_repeats", "size")
