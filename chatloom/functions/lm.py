"""Perplexity under an n-gram language model in ARPA form, with text normalisation and optional subword pieces."""

from __future__ import annotations

import gzip
import io
import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

from chatloom.functions import lexicons

_DIGIT = re.compile(r"\d")
_UNSEEN = re.compile("[\x00-\x1f\x7f-\x9f]")


def normalize(text: str, lower: bool = True, accents: bool = True, numbers: bool = True, punctuation: int = 1) -> str:
    """A text as the model saw its training data: lower case, without accents, digits as 0, plain (1) or no (2) typographic
    punctuation, and no control characters, which glues the words at a line end."""
    text = text.strip()
    if lower:
        text = text.lower()
    if accents:
        text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    if numbers:
        text = _DIGIT.sub("0", text)
    if punctuation:
        text = text.translate(str.maketrans(lexicons.PUNCTUATION if punctuation == 1 else dict.fromkeys(lexicons.PUNCTUATION, "")))
    return _UNSEEN.sub("", text)


@lru_cache(4)
def load_arpa(path: str) -> tuple[int, dict[tuple[str, ...], tuple[float, float]]]:
    """(order, {n-gram: (log10 probability, log10 backoff)}) of an ARPA file, plain or gzipped, or of its text; once per process."""
    order, size, grams = 0, 0, {}
    with io.StringIO(path) if "\\data\\" in path else gzip.open(path, "rt", encoding="utf-8") if path.endswith(".gz") else open(path, encoding="utf-8") as file:
        for line in map(str.strip, file):
            if line.endswith("-grams:"):
                size = int(line[1 : line.index("-")])
                order = max(order, size)
            elif size and line and not line.startswith("\\"):
                parts = line.split()
                grams[tuple(parts[1 : 1 + size])] = (float(parts[0]), float(parts[1 + size]) if len(parts) > 1 + size else 0.0)
    return order, grams


@lru_cache(4)
def load_pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@dataclass(frozen=True)
class LanguageModel:
    """An ARPA model and, if given, a sentencepiece model; both are paths that every executor can read, the ARPA model may
    be given as text."""

    arpa: str
    pieces: str | None = None
    options: dict = field(default_factory=dict, hash=False)

    def score(self, line: str) -> float:
        """log10 probability of a line between sentence marks, by back-off."""
        order, grams = load_arpa(self.arpa)
        words = [w if (w,) in grams else "<unk>" for w in line.split()] + ["</s>"]
        history, total = ["<s>"], 0.0
        for word in words:
            context = tuple(history[-(order - 1) :]) if order > 1 else ()
            while context and (*context, word) not in grams:
                total += grams.get(context, (0.0, 0.0))[1]
                context = context[1:]
            total += grams.get((*context, word), (-100.0, 0.0))[0]
            history.append(word)
        return total

    def perplexity(self, text: str) -> float:
        """Rounded to one decimal, over all lines; a line counts its words and its end."""
        text = normalize(text, **self.options)
        if self.pieces:
            text = " ".join(load_pieces(self.pieces).encode(text, out_type=str))
        lines = text.split("\n")
        total, length = sum(map(self.score, lines)), sum(len(line.split()) + 1 for line in lines)
        return round(10.0 ** (-total / length), 1)


#: A bigram model of a few frequent English words, for tests and examples.
SAMPLE_ARPA = """\\data\\
ngram 1=9
ngram 2=5

\\1-grams:
-1.2 <unk> -0.1
-99 <s> -0.4
-1.4 </s>
-1.1 the -0.3
-1.3 of -0.2
-1.3 and -0.2
-1.4 a -0.3
-1.5 to -0.2
-1.6 is -0.2

\\2-grams:
-0.6 <s> the
-0.7 of the
-0.9 and the
-0.8 is a
-0.9 to the

\\end\\
"""
