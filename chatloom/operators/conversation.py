"""Conversations as arrays of messages, and their reshaping into training rows and back.

A message is a struct (content, do_train, role). Null conversations give no rows; null contents stay null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import strip


def to_input_output(df: DataFrame, conversation: str = "conversation", keep: tuple[str, ...] = ()) -> DataFrame:
    """(``keep``, turn, input, output, source): a row for every message to train on; input is all messages before it."""
    rows = df.select(*keep, "source", conversation, F.posexplode(conversation).alias("turn", "output")).where("output.do_train")
    return rows.select(*keep, F.col("turn").cast("bigint").alias("turn"), F.slice(conversation, F.lit(1), F.col("turn")).alias("input"), "output", "source")


def add_content_columns(df: DataFrame) -> DataFrame:
    """Adds response (of the output) and instruction (of the last input message, '' without one), both stripped."""
    last = F.when(F.size("input") > 0, strip(F.element_at("input", -1)["content"])).otherwise("")
    return df.withColumns({"response": strip(F.col("output.content")), "instruction": last})


def _message(content: Column, do_train: Column, role: Column) -> Column:
    return F.struct(content.alias("content"), do_train.alias("do_train"), role.alias("role"))


def rebuild(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(``keep``, conversation, source): the input without training marks, then the (cleaned) response to train on."""
    before = F.transform("input", lambda m: _message(m["content"], F.lit(False), m["role"]))
    answer = F.array(_message(F.col("response"), F.lit(True), F.col("output.role")))
    return df.select(*keep, F.concat(before, answer).alias("conversation"), "source")


def training_text(df: DataFrame, conversation: str = "conversation", out: str = "text") -> DataFrame:
    """Adds the contents of the messages to train on, with an empty line between two."""
    contents = F.transform(F.filter(conversation, lambda m: m["do_train"]), lambda m: m["content"])
    return df.withColumn(out, strip(F.array_join(contents, "\n\n")))
