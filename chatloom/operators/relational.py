"""Relational operators: union with a source column, subtraction, splitting by a filter, statistics of a score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def combine(parts: dict[str, DataFrame]) -> DataFrame:
    """The union of data sets by name; each gets its name as column source where it has none."""
    named = [df if "source" in df.columns else df.withColumn("source", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def subtract(minuend: DataFrame, subtrahend: DataFrame, key: str) -> DataFrame:
    """The rows of the minuend whose key the subtrahend doesn't hold; null keys are never subtracted."""
    return minuend.join(subtrahend.select(key), key, "left_anti")


def split_by(df: DataFrame, keeps: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that the condition keeps, all others); an unknown condition keeps nothing. Two scans, no join."""
    sure = F.coalesce(keeps, F.lit(False))
    return df.where(sure), df.where(~sure)


def describe_values(df: DataFrame, score: str) -> DataFrame:
    """One row for a boolean or text score: count, number of distinct values, the most frequent one (of several the least), and how
    often it occurs. Nulls don't count."""
    counts = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    top = F.min_by("value", F.struct((-F.col("n")).alias("n"), "value"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.count(F.lit(1)).alias("unique"), top.alias("top"), F.max("n").alias("freq"))


def describe(df: DataFrame, score: str) -> DataFrame:
    """One row: count, mean, sample deviation, least, quartiles and greatest value of a numeric or boolean score."""
    value = F.col(score).cast("double")
    quartiles = {f"q{int(q * 100)}": F.percentile(value, F.lit(q)) for q in (0.25, 0.5, 0.75)}
    return df.agg(
        F.count(value).alias("count"), F.mean(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
        *[column.alias(name) for name, column in quartiles.items()], F.max(value).alias("max"),
    )
