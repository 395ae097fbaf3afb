"""Cleaners and filters on a stream: they look at one row at a time and keep no state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatloom.functions.filters import Filter
from chatloom.operators import minhash
from chatloom.plans.pipeline import apply_cleaners, apply_filters
from chatloom.plans.registry import Cleaner


def read(spark: SparkSession, path: str, schema: str, kind: str = "parquet", files_a_trigger: int = 64) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_a_trigger).load(path)


def prepare(stream: DataFrame, column: str, cleaners: list[Cleaner], filters: list[Filter]) -> DataFrame:
    return apply_filters(apply_cleaners(stream, column, cleaners), column, filters)


def write_deduplicated(stream: DataFrame, key: str, column: str, path: str, checkpoint: str, **options):
    """Starts a query that deduplicates every micro-batch in itself and writes it to its own folder, so that a batch that
    is run again replaces what it wrote before."""

    def each(batch: DataFrame, number: int) -> None:
        minhash.deduplicate(batch, key, column, **options).write.mode("overwrite").parquet(f"{path}/batch={number}")

    handler: Callable[[DataFrame, int], None] = each
    return stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
