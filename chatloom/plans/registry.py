"""Names that a configuration may use, and what they stand for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions import cleaners, filters

Cleaner = Callable[[Column], Column]
_CLEANERS: dict[str, Cleaner] = {c.__name__: c for c in (cleaners.fix_utf8_encoding, cleaners.normalize_whitespace, cleaners.normalize_punctuation, cleaners.remove_empty_lines, cleaners.clean_new_lines)}
_FILTERS: dict[str, Callable[..., filters.Filter]] = {
    f.__name__: f
    for f in (filters.check_word_number, filters.check_perplexity, filters.check_nsfw_words, filters.check_lowercase_ratio, filters.check_char_repetition,
              filters.check_truncation, filters.check_completion, filters.check_gender, filters.check_empty, filters.check_ethics, filters.check_ethics_harsh)
}


def register_cleaner(name: str, cleaner: Cleaner) -> None:
    """Adds a cleaner: a function of a Column."""
    _CLEANERS[name] = cleaner


def register_filter(name: str, make: Callable[..., filters.Filter]) -> None:
    """Adds a filter: a function of its arguments that gives a Filter."""
    _FILTERS[name] = make


def python_cleaner(function: Callable[[str], str]) -> Cleaner:
    """A cleaner from a function of one string, run in Arrow batches; null stays null."""

    @F.pandas_udf("string")
    def run(values):
        return values.map(lambda v: None if v is None else function(v), na_action=None)

    return run


def python_filter(function: Callable[[str], bool | float]) -> filters.Filter:
    """A filter from a function of one string, whose true results are kept, run in Arrow batches."""

    @F.pandas_udf("double")
    def run(values):
        return values.map(lambda v: None if v is None else float(function(v)), na_action=None).astype("float64")

    return filters.Filter(function.__name__, run, lambda score: score != 0)


def cleaner(name: str, intended: bool = False) -> Cleaner:
    if name not in _CLEANERS:
        raise ValueError(f"unknown cleaner {name!r}; known: {sorted(_CLEANERS)}")
    found = _CLEANERS[name]
    return (lambda c: cleaners.remove_empty_lines(c, intended)) if found is cleaners.remove_empty_lines else found


def filter_of(name: str, args: dict | None = None, intended: bool = False) -> filters.Filter:
    if name not in _FILTERS:
        raise ValueError(f"unknown filter {name!r}; known: {sorted(_FILTERS)}")
    args = dict(args or {})
    if intended and _FILTERS[name] in (filters.check_ethics, filters.check_ethics_harsh):
        args.setdefault("intended", True)
    return _FILTERS[name](**args)


def cleaners_from_config(config: dict | None, intended: bool = False) -> list[Cleaner]:
    """The cleaners of a mapping of names to true or false, in its order."""
    return [cleaner(name, intended) for name, wanted in ((config or {}).get("cleaners") or {}).items() if wanted]


def filters_from_config(config: dict | None, intended: bool = False) -> list[filters.Filter]:
    """The filters of a mapping of names to {args: {...}} or nothing, in its order."""
    return [filter_of(name, (value or {}).get("args"), intended) for name, value in ((config or {}).get("filters") or {}).items()]


def output_cleaners(intended: bool = False) -> list[Cleaner]:
    return [cleaner(n, intended) for n in ("normalize_whitespace", "normalize_punctuation", "fix_utf8_encoding", "remove_empty_lines")]


def input_cleaners(intended: bool = False) -> list[Cleaner]:
    return [cleaner(n, intended) for n in ("normalize_whitespace", "remove_empty_lines")]


def output_filters(explicit_words: bool = False, model=None) -> list[filters.Filter]:
    """The preset for answers, with the explicit-word ratio and, given a model, the perplexity if wanted."""
    found = [filters.check_word_number(5, 128), filters.check_completion(), filters.check_char_repetition(10, 0.2), filters.check_lowercase_ratio(0.75)]
    found += [filters.check_nsfw_words(0.025)] if explicit_words else []
    return found + ([filters.check_perplexity(model, 300, 10_000)] if model else [])


def input_filters() -> list[filters.Filter]:
    return [filters.check_lowercase_ratio(0.55)]


def truncation_filters(token: str) -> list[filters.Filter]:
    return [filters.check_truncation(token)]
