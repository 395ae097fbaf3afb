"""Rows of edited answers: renaming, projecting and pairing their texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.cleaners import clean_new_lines

_FIXED = ("output_text", "input_text", "summary", "user_id")


def prepare_edits(df: DataFrame) -> DataFrame:
    """(input_text, output_text, user_id, response) from model_input and edited_response."""
    return df.select(F.col("model_input").alias("input_text"), F.col("edited_response").alias("output_text"), "user_id", "response")


def remove_unused_columns(df: DataFrame) -> DataFrame:
    return df.select("user_id", "input_text", "output_text")


def rename_dry_run_columns(df: DataFrame, name: str) -> DataFrame:
    """Prefixes ``name`` and two underscores, except to the text columns and to names that hold two underscores already."""
    return df.withColumnsRenamed({c: f"{name}__{c}" for c in df.columns if c not in _FIXED and "__" not in c})


def add_concatenated_column(df: DataFrame, column: str, token: str) -> DataFrame:
    """Adds response, token and output_text in one string; null where one of them is."""
    return df.withColumn(column, F.concat("response", F.lit(token), "output_text"))


def post_process_output_text(df: DataFrame) -> DataFrame:
    """output_text on one line, after a space and before a line feed."""
    return df.withColumn("output_text", F.concat(F.lit(" "), clean_new_lines(F.col("output_text")), F.lit("\n")))
