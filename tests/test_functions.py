"""Cleaners and filters against plain Python, on edge texts."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatloom.functions import cleaners, filters, lexicons, lm, text

TEXTS = [
    "", " ", "_", "½ café a_1", "İstanbul", "日本語 です", "abcD", "é", "a" * 100, "0123456789", "012345678", "ok. ", "ok”", "ok:", "...", "…", ".. ..", " ... x",
    "As An AI", "said again", "sorry!", "xxx ass class", "a\n\n b \n", "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g h i\r\nj\rk", "a b　c￼d e",
    "“q” «q» … — ．１", "  x 　", "one two three four five six", "\U0001f595 ok", "word " * 600, None,
]


def column(spark, expression, values=None):
    rows = [(i, v) for i, v in enumerate(TEXTS if values is None else values)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(3)
    return [r[1] for r in df.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def each(function):
    return [None if t is None else function(t) for t in TEXTS]


def words(t):
    return re.findall(r"\w+", t.lower())


def test_scores(spark):
    assert column(spark, filters.check_word_number().score) == each(lambda t: len(words(t)))
    assert column(spark, filters.check_lowercase_ratio().score) == each(lambda t: sum(c in "abcdefghijklmnopqrstuvwxyz" for c in t) / len(t) if t else 0)
    assert column(spark, filters.check_completion().score) == each(lambda t: int(t.strip()[-1:] in lexicons.COMPLETED))
    assert column(spark, filters.check_empty().score) == each(lambda t: t.replace("...", "").replace("…", "").strip() != "")
    ratio = column(spark, filters.check_nsfw_words().score)
    assert ratio == pytest.approx(each(lambda t: sum(t.lower().count(w) for w in lexicons.EXPLICIT) / len(words(t)) if words(t) else 0))
    assert column(spark, filters.check_nsfw_words(words=("zz",)).score, ["zz zz", "zzz"]) == [1.0, 1.0]


def test_phrases(spark):
    for one, phrases in ((filters.check_ethics(), lexicons.policy_phrases()), (filters.check_ethics_harsh(), lexicons.harsh_phrases()), (filters.check_ethics_harsh(True), lexicons.harsh_phrases(True))):
        assert column(spark, one.score) == each(lambda t, p=phrases: not any(w in t.lower() for w in p))
    assert (len(lexicons.policy_phrases()), len(lexicons.harsh_phrases())) == (49, 69)
    lost = ["ethical principles", "as a language model", "please assist"]
    assert column(spark, filters.check_ethics().keeps, lost[:2]) == [True, True]
    assert column(spark, filters.check_ethics(True).keeps, lost[:2]) == [False, False]


def test_bounds_and_nulls(spark):
    assert column(spark, filters.check_word_number(2, 3).keeps, ["a", "a b", "a b c", "a b c d", None]) == [False, True, True, False, False]
    assert column(spark, filters.check_lowercase_ratio(0.75).keeps, ["abcD", "abCD"]) == [True, False]


def test_repetition(spark):
    def plain(t, n):
        counts = sorted(Counter(t[i : i + n] for i in range(len(t) - n + 1)).values(), reverse=True)
        k = min(int(len(counts) ** 0.5), sum(c > 1 for c in counts))
        return sum(counts[:k]) / sum(counts) if counts else 0

    assert column(spark, filters.check_char_repetition().score) == pytest.approx(each(lambda t: plain(t, 10)))


def test_pairs(spark):
    cut = filters.check_truncation("<|t|>")
    assert column(spark, cut.keeps, ["abc<|t|>b", "abc<|t|>x", "abc<|t|>", None]) == [False, True, False, False]
    for wrong in ("abc", "a<|t|>b<|t|>c"):
        with pytest.raises(Exception, match="exactly one"):
            column(spark, cut.keeps, [wrong])
    gender = filters.check_gender("<|g|>")
    assert column(spark, gender.keeps, ["He ran<|g|>she ran", "he ran<|g|>he ran", "a he<|g|>he a", "x he<|g|>x", "a boy<|g|>a girl"]) == [True, False, False, False, True]


def test_cleaners(spark):
    spaces = set(lexicons.SPACES)
    marks = lexicons.PUNCTUATION
    assert column(spark, cleaners.normalize_whitespace) == each(lambda t: "".join(" " if c in spaces else c for c in t))
    assert column(spark, cleaners.normalize_punctuation) == each(lambda t: "".join(marks.get(c, c) for c in t))
    assert len(marks) == 34 and len(lexicons.EXPLICIT) == 403
    assert column(spark, cleaners.remove_empty_lines) == each(lambda t: "")
    assert column(spark, lambda c: cleaners.remove_empty_lines(c, True)) == each(lambda t: "\n".join(x for x in t.splitlines() if x.strip()))
    assert column(spark, cleaners.clean_new_lines) == each(lambda t: t.strip().replace("\n", ""))
    assert column(spark, text.spaced_words) == each(str.split)
    assert column(spark, text.lines) == each(lambda t: t.splitlines())


def test_repair(spark):
    found = column(spark, cleaners.fix_utf8_encoding, ["cafÃ© isnâ€™t", "&lt; <b>&amp;</b>", "&amp;", "ﬁne ＡＢ", "a\r\nb\rc", "é", "plain", "", None])
    assert found == ["café isn't", "&lt; <b>&amp;</b>", "&", "fine AB", "a\nb\nc", "é", "plain", "", ""]


def test_language_model(spark):
    model = lm.LanguageModel(lm.SAMPLE_ARPA)
    assert model.score("the") == pytest.approx(-0.6 - 0.3 - 1.4)
    assert model.score("zebra") == pytest.approx(-0.4 - 1.2 - 0.1 - 1.4)
    assert model.perplexity("The") == round(10 ** ((0.6 + 0.3 + 1.4) / 2), 1)
    assert lm.normalize(" Ré\n１2 ") == "re" + '"0'.replace('"', "0")
    assert lm.normalize("a—b…", punctuation=2) == "ab"
    assert column(spark, filters.check_perplexity(model, 1, 1000).keeps, ["the", None]) == [True, False]
