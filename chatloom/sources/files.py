"""Reading and writing of data sets as files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.operators.edits import prepare_edits
from chatloom.operators.relational import combine

_FORMATS = {".json": "json", ".jsonl": "json", ".csv": "csv", ".orc": "orc", ".parquet": "parquet"}


def load(spark: SparkSession, path: str, schema: str | None = None, split: str | None = None) -> DataFrame:
    """A data set by path; the format follows the ending and is Parquet for folders without one. ``split`` names one of its splits:
    the folder or the files whose names begin with it, in the folder or in its folder data."""
    if split is not None:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{{,data/}}{split}{{,[-_.]*}}")
        files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
        if not files:
            raise ValueError(f"{path!r} has no split {split!r}")
        return reduce(lambda a, b: a.unionByName(b), [load(spark, f.getPath().toString(), schema) for f in files])
    kind = next((f for ending, f in _FORMATS.items() if path.rstrip("/").endswith(ending)), "parquet")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("header", "true").format(kind).load(path) if kind == "csv" else reader.format(kind).load(path)


def load_edits(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """Edited rows of one split, as (input_text, output_text, user_id, response)."""
    return prepare_edits(load(spark, path, split=split))


def load_all(spark: SparkSession, paths: list[str], id_column: str) -> DataFrame:
    """The union of all data sets, their paths as source where they have none, with ``id_column``.

    Where a data set has no such column, ids follow the order of its files: a numbering inside each file block plus the rows
    of the blocks before it, so no single task numbers all rows. The numbering goes on over the data sets, after the greatest
    number that one brings along, so no two of its ids coincide.
    """
    parts = {path: load(spark, path) for path in paths}
    own = [df.agg(F.max(F.expr(f"try_cast(`{id_column}` AS bigint)"))).first()[0] for df in parts.values() if id_column in df.columns] if any(id_column not in df.columns for df in parts.values()) else []
    start = max((n for n in own if n is not None), default=-1) + 1
    for path, df in parts.items():
        if id_column not in df.columns:
            parts[path] = number(df, id_column).withColumn(id_column, F.col(id_column) + F.lit(start).cast("bigint"))
            start += df.count()
    return combine(parts)


def number(df: DataFrame, out: str) -> DataFrame:
    """``df`` with consecutive numbers from 0 in the order of its partitions; two passes, no shuffle of the rows."""
    marked = df.withColumns({"__part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()})
    counts = marked.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the scan
    offsets = counts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    inside = F.col("__id") - F.shiftleft(F.col("__part").cast("bigint"), 33)
    return marked.join(F.broadcast(offsets), "__part").withColumn(out, inside + F.col("__before")).drop("__part", "__id", "__before")


def write(df: DataFrame, path: str, kind: str = "parquet") -> None:
    df.write.mode("overwrite").format(kind).save(path)
