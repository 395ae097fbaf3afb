"""Filters: a score of a text and the rule that keeps it. Rows are kept where the rule is true; null texts are dropped."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import isqrt
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions import lexicons, text


@dataclass(frozen=True)
class Filter:
    """A named filter: ``score`` is what a dry run shows, ``keep`` decides from the score."""

    name: str
    score: Callable[[Column], Column]
    keep: Callable[[Column], Column]

    def keeps(self, column: Column) -> Column:
        return F.coalesce(self.keep(self.score(column)), F.lit(False))


def _between(low: float, high: float) -> Callable[[Column], Column]:
    return lambda score: score.between(low, high)


def _flag(score: Column) -> Column:
    return score.cast("boolean")


def check_word_number(min_word_threshold: int = 5, max_word_threshold: int = 512) -> Filter:
    return Filter("check_word_number", text.word_count, _between(min_word_threshold, max_word_threshold))


def check_nsfw_words(flagged_words_threshold: float = 0.025, words: tuple[str, ...] = lexicons.EXPLICIT) -> Filter:
    """Occurrences of explicit terms, as substrings, per word; 0 without words."""

    @F.pandas_udf("bigint")
    def found(values):
        # an Arrow batch at a time: hundreds of terms cost the JVM a replacement each, Python a search
        return values.map(lambda low: None if low is None else sum(map(low.count, words)), na_action=None).astype("Int64")

    def ratio(column: Column) -> Column:
        return F.when(text.word_count(column) > 0, found(F.lower(column)) / text.word_count(column)).when(column.isNotNull(), 0.0)

    return Filter("check_nsfw_words", ratio, lambda score: score <= flagged_words_threshold)


def check_lowercase_ratio(lowercase_threshold: float = 0.75) -> Filter:
    def ratio(column: Column) -> Column:
        return F.when(F.length(column) > 0, F.length(F.regexp_replace(column, "[^a-z]", "")) / F.length(column)).when(column.isNotNull(), 0.0)

    return Filter("check_lowercase_ratio", ratio, lambda score: score >= lowercase_threshold)


def repetition_ratio(value: str | None, size: int) -> float | None:
    """The share of a text's character n-grams that its most repeated ones make up; 0 for shorter texts."""
    if value is None:
        return None
    counts = Counter(map("".join, zip(*(value[i:] for i in range(size)), strict=False)))
    if not counts:
        return 0.0
    repeated = sorted((n for n in counts.values() if n > 1), reverse=True)
    return sum(repeated[: isqrt(len(counts))]) / (len(value) - size + 1)


def check_char_repetition(char_repetition_len: int = 10, char_repetition_threshold: float = 0.2) -> Filter:
    """Counting in Arrow batches: a text's n-grams never leave its batch, where an exploding plan would shuffle them all."""

    @F.pandas_udf("double")
    def ratio(values):
        return values.map(lambda v: repetition_ratio(v, char_repetition_len), na_action=None).astype("float64")

    return Filter("check_char_repetition", ratio, lambda score: score <= char_repetition_threshold)


def check_truncation(splitter_token: str = "<|truncation_splitter|>") -> Filter:
    """Keeps pairs whose edited side isn't part of the first one; exactly one token is required."""

    def truncated(column: Column) -> Column:
        first, edited = text.split_exactly_two(column, splitter_token)
        return (~F.contains(first, edited)).cast("int")

    return Filter("check_truncation", truncated, _flag)


def check_completion() -> Filter:
    def complete(column: Column) -> Column:
        return F.right(text.strip(column), F.lit(1)).isin(*lexicons.COMPLETED).cast("int")

    return Filter("check_completion", complete, _flag)


def check_gender(splitter_token: str = "<|gender_splitter|>") -> Filter:
    """Keeps pairs with two different gendered words in the same place; exactly one token is required."""

    def differs(column: Column) -> Column:
        first, edited = text.split_exactly_two(F.lower(column), splitter_token.lower())
        known = lexicons.GENDERED
        same_place = F.arrays_zip(text.spaced_words(first).alias("a"), text.spaced_words(edited).alias("b"))
        return F.exists(same_place, lambda p: F.coalesce(p["a"].isin(*known) & p["b"].isin(*known) & (p["a"] != p["b"]), F.lit(False)))

    return Filter("check_gender", differs, _flag)


def check_empty() -> Filter:
    def filled(column: Column) -> Column:
        return text.strip(F.replace(F.replace(column, F.lit("..."), F.lit("")), F.lit("…"), F.lit(""))) != ""

    return Filter("check_empty", filled, _flag)


def _without(name: str, phrases: tuple[str, ...]) -> Filter:
    def clean(column: Column) -> Column:
        low = F.lower(column)
        return ~reduce(or_, (F.contains(low, F.lit(phrase)) for phrase in phrases))

    return Filter(name, clean, _flag)


def check_ethics(intended: bool = False) -> Filter:
    return _without("check_ethics", lexicons.policy_phrases(intended))


def check_ethics_harsh(intended: bool = False) -> Filter:
    return _without("check_ethics_harsh", lexicons.harsh_phrases(intended))


def check_perplexity(model, min_perplexity_threshold: float = 300, max_perplexity_threshold: float = 3000) -> Filter:
    """Perplexity under a language model (see functions.lm), in Arrow batches."""

    @F.pandas_udf("double")
    def perplexity(values):
        return values.map(lambda v: None if v is None else model.perplexity(v), na_action=None).astype("float64")

    return Filter("check_perplexity", perplexity, _between(min_perplexity_threshold, max_perplexity_threshold))
