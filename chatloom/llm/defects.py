"""Problem 6: broken prompt and response pairs.

Refusals are revealed by their templates. A clause of a response's first sentence that holds a cue of declining is a candidate;
the openings of these clauses (their first words, with names and numbers masked) are clustered by MinHash with verified
similarity. A cluster that recurs before prompts of unrelated topics is a template, and its members are refusals where nothing
but set phrases follows, which are the sentences that recur in the same way. Only a pair that no template reveals, as where its
clauses recur too rarely, is judged by its own words: a third of its sentences decline. Texts of any length are read whole.

Checks on the single pair label the rest: nothing but filler (empty), nothing but the instruction (copied), another language than
the instruction's without being asked for (other_language), and no end (truncated). Whether an unpunctuated last word can end a
text is told by how often the word ends sentences in the corpus.

Order of precedence: empty, copied, refusal, other_language, truncated; a pair has at most one defect. A null instruction
counts as empty and is no defect. Keys delivered twice count once (their least defect by name); empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators.components import connected_components
from chatloom.session import spread, stage

OPENING_WORDS = 6
HASHES, ROWS = 24, 3
#: Openings of a block: a larger bucket is cut into blocks, and every block is compared with every other.
SMALL_BUCKET = 512
SIMILAR = 0.5
#: A template stands before prompts of at least so many topics.
PROMPTS = 3
#: What follows a refusal is itself a set phrase: it stands in this share of the candidates.
FOLLOWING = 0.02
#: Of a text that declines in words of its own so many sentences do; it declines within so many sentences.
OWN_SHARE, HEAD = 1 / 3, 3
#: A word that ends sentences in this share of its occurrences can end a text without a mark.
ENDING = 0.35
# Placeholders that stand for no answer, without their marks.
PLACEHOLDERS = frozenset("null none nil nan na n/a undefined empty blank todo tbd noanswer noresponse noinput nocontent placeholder insertanswerhere loremipsum deleted removed".split())
# Frequent short words by language.
FREQUENT = {
    "en": "me my give all every one two only because about more before after once never the a an of to and is in that it for on with as at by this be or from not you are what how why who can do does should i we they there if when which would will has have was were my your its than then",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine einen als auch wie warum wann wer kann ich du er sie wir ihr dass weil wenn oder aber vor nach über unter am zum zur bei aus sei seit mir mich was hat bitte",
    "fr": "de la le les et des en un une du dans est que pour qui sur pas au par ne plus je tu il elle nous vous ce cette ces comment pourquoi quand quel quelle avec sans à aux où même si dès puis car mais sont ont",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ya o este sí porque esta cuando muy sin sobre también me hay donde quien desde todo nos durante qué cómo ha hace años entre puedo aunque",
    "pt": "lê ninguém põe vê dê de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua ou quando muito nos já também só pelo pela até isso ela entre depois sem mesmo aos são está foi tem há você porque pode às",
    "pl": "i w nie na się z że do to jest o jak ale po co za od czy dla przez tak już tylko jego jej ich ten ta te tym który która gdy bo przy pod nad bez może być był była są ma mnie mi ci we ze oraz jeśli dlaczego każdy",
}
# Stems of the names of languages, in several languages.
LANGUAGE_NAMES = {
    "en": "english|englisch|anglais|inglés|ingles|inglês|английск|angielsk|英語",
    "de": "german|deutsch|allemand|alemán|aleman|alemão|немец|niemieck|ドイツ語",
    "fr": "french|französisch|français|francais|francés|frances|francês|француз|francusk|フランス語",
    "es": "spanish|spanisch|espagnol|español|espanol|espanhol|испан|hiszpańsk|スペイン語",
    "pt": "portugu|portugies|português|португал|portugalsk|ポルトガル語",
    "ru": "russian|russisch|russe|ruso|russo|русск|rosyjsk|ロシア語",
    "pl": "polish|polnisch|polonais|polaco|polonês|polones|польск|polsk|ポーランド語",
    "ja": "japan|japon|японск|japońsk|日本語",
}
# Ways to say that one can't or mustn't answer; the second pattern alone is not enough.
DECLINES = re.compile(
    r"\bi(?:'m| am)? (?:unable|not able|not allowed|not permitted|afraid i)\b|\bi (?:can ?not|can'?t|won'?t|will not|must decline|have to decline|have to pass|have no way|do not feel comfortable|don'?t feel comfortable|may not)\b"
    r"|\bmust decline\b|\bnot allowed to (?:talk|speak|discuss|answer|help|share)|\bgoes against my\b|\bagainst my (?:guidelines|programming|policy)|\boutside what i (?:may|can)\b|\bi(?:'d| would) rather not\b|\bnot something i (?:can|may)\b|\bi refuse\b"
    r"|\bi (?:don'?t|do not) respond to\b|\brequest is declined\b|\bviolates? my\b|\bprefer not to (?:answer|respond|say)\b|\bwill not do that\b|\bnot comply\b"
    r"|\bkann ich (?:\w+ ){0,3}nicht\b|\bkann ich dazu nichts\b|\bich kann (?:\w+ ){0,4}nicht\b|\bdarf ich (?:\w+ ){0,3}nicht\b|\bich darf (?:\w+ ){0,4}nicht\b|\bmuss (?:ich )?(?:\w+ ){0,2}ablehnen\b|\bmöchte (?:ich )?(?:\w+ ){0,4}nicht (?:beantworten|antworten|sprechen)|\blehne ich ab\b"
    r"|\bje (?:ne )?(?:peux|suis|puis) (?:pas|dans l'impossibilité)|\bne peux pas\b|\bm['’]est impossible\b|\bje (?:dois|préfère) (?:refuser|décliner|ne pas)"
    r"|\bno puedo\b|\bdebo (?:rechazar|negarme|declinar)|\bno me es posible\b|\bno estoy autorizad|\bprefiero no (?:responder|contestar)"
    r"|\bnão posso\b|\bnão consigo\b|\bdevo recusar|\bnão me é possível\b|\bnão estou autorizad|\bprefiro não responder"
    r"|\bне могу\b|\bвынужден[аы]? отказ|\bмне (?:нельзя|запрещено)|\bне имею права\b|\bне буду отвечать|\bпредпочту не отвечать|\bпредпоч\w+ не\b"
    r"|\bnie mogę\b|\bmuszę odmówić|\bnie wolno mi\b|\bodmawiam\b|\bwolę nie\b"
    r"|できません|できかねます|お断り|控えさせて|答えたくありません|お答えできない",
    re.I,
)
# What a clause that declines may say. It is no proof: a clause with one is only a candidate for a template.
CUES = re.compile(
    r"\b(?:unable|can ?not|can'?t|won'?t|will not|not able|afraid|declin\w*|refus\w*|not allowed|not permitted|no way|guidelines?|polic(?:y|ies)|not feel|comfortable|comply|rather not|prefer not|programming|violat\w*|against my|outside what|not something|not respond|don'?t respond|may not"
    r"|ablehn\w*|lehne|(?:kann|darf|möchte|werde) ich|ich (?:kann|darf|möchte|werde)\b.*\bnicht|m'est impossible|je (?:ne|dois|préfère)|no puedo|negarme|rechazar|prefiero no|no me es|não (?:posso|consigo|me é|estou)|recusar|prefiro não"
    r"|не могу|нельзя|отказ\w*|не имею|не буду|не отвечать|nie mogę|nie wolno|wolę nie|odmówić|odmawiam)\b|ません|断り|かねます|控え",
    re.I,
)
# Parts of words one of which stands wherever a cue or a way to decline does, for a quick look.
STEMS = tuple(
    "unable|can not|cannot|can't|cant|won't|wont|will not|not able|afraid|declin|refus|not allowed|not permitted|no way|guideline|polic|not feel|comfortable|comply|rather not|prefer not|programming|violat|against my|outside what|not something|not respond|don't respond|dont respond|don't feel|dont feel|may not|to pass"
    "|ablehn|lehne|kann ich|darf ich|möchte|werde ich|ich kann|ich darf|ich werde|impossib|je ne|je dois|je préfère|peux|suis pas|puis pas|no puedo|negarme|rechazar|prefiero no|no me es|no estoy|não posso|não consigo|não me é|não estou|recusar|prefiro não"
    "|не могу|нельзя|отказ|не имею|не буду|не отвечать|вынужден|запрещено|предпоч|nie mogę|nie wolno|wolę nie|odmówić|odmawiam|ません|断り|かねます|控え|できない".split("|")
)
_NOT_DECLINING = re.compile(r"\bi can(?:no|')?t (?:recommend|thank|wait|stress|believe|imagine|stop|help but)\b|\bfull answer\b|\bhere is (?:what|how|the)\b|\bthere is another way\b", re.I)
_WORD = re.compile(r"[^\W_]+")
_ENDS = re.compile(r"([^\W_]+)[\"'”’»)\]]*[.!?。！？…]")
_SENTENCE = re.compile(r"(?<=[.!?。！？])[\"'”)]*\s+|(?<=[。！？])|\n+")
_CLAUSE = re.compile(r"[,;:、]")
_GOES_ON = ",;:-–—(、"
_ITEM = re.compile(r"^\s*(?:[-*•]|\d+[.)])\s+")
_LETTER = re.compile(r"[^\W\d_]")
_KANA = re.compile(r"[぀-ヿ一-鿿]")
_CYRILLIC = re.compile(r"[Ѐ-ӿ]")
_NAME = re.compile(r"(?<!^)\b[A-Z][\w'’-]*")
_SHARED = Counter(w for words in FREQUENT.values() for w in set(words.split()))
#: A word counts less the more of the languages have it.
_LANGUAGES_OF = {w: [(lang, 1 / n) for lang, words in FREQUENT.items() if w in words.split()] for w, n in _SHARED.items()}
# Letters and elisions that only one of the languages has.
_LETTERS = {"de": re.compile("[äßÄ]|ö|ü"), "fr": re.compile("[èîûœëù]|\\b[ldnsj]['’](?=\\w)|\\bqu['’]"), "es": re.compile("[ñ¿¡]"), "pt": re.compile("[ãõ]"), "pl": re.compile("[ąćęłńśźż]")}
_NAMES = {lang: re.compile(stems, re.I) for lang, stems in LANGUAGE_NAMES.items()}
_FENCE = re.compile(r"```.*?(?:```|$)", re.S)


def language(text: str, words: list[str] | None = None) -> str | None:
    """The language of a text by its script, else by frequent words; None where it can't be told. ``words`` may give the
    text's words in lower case."""
    if "```" in text:
        text, words = _FENCE.sub(" ", text), None
    plain = text.isascii()
    if not plain:
        letters = len(_LETTER.findall(text))
        if len(_KANA.findall(text)) > 0.4 * letters > 0:
            return "ja"
        if len(_CYRILLIC.findall(text)) > 0.4 * letters > 0:
            return "ru"
    if words is None:
        words = _WORD.findall(text.lower())
    if not words:
        return None
    found = Counter(words)
    scores = dict.fromkeys(FREQUENT, 0.0)
    for word in found.keys() & _LANGUAGES_OF.keys():
        for lang, weight in _LANGUAGES_OF[word]:
            scores[lang] += weight * found[word]
    for lang, letters_of in _LETTERS.items() if not plain else ():
        scores[lang] += len(letters_of.findall(text))
    (best, lang), (second, _) = sorted(((n, lang) for lang, n in scores.items()), reverse=True)[:2]
    return lang if best >= 0.8 and best >= 1.25 * second and best >= 0.06 * len(words) else None


def squeezed(text: str) -> str:
    """Letters and digits in lower case, without anything between them."""
    return "".join(_WORD.findall(text.lower()))


def is_empty(text: str | None) -> bool:
    """Null, blank, only marks, or a placeholder."""
    if text is None:
        return True
    if len(text) > 200 and _WORD.search(text) and len(_WORD.findall(text)) > 3:
        return False
    inner = squeezed(text)
    if not inner:
        return not any(ord(c) >= 0x2190 and ord(c) not in (0xFEFF, 0x3000, 0xFFFC, 0xFFFD) and not c.isspace() for c in text)
    return inner in PLACEHOLDERS and len(text.strip()) <= len(inner) + 8


def is_copied(instruction: str, text: str) -> bool:
    """Nothing but the instruction again, with a few words about it at most."""
    if len(text) > 3 * len(instruction) + 80:
        most = sum(c.isalnum() for c in text)
        if most > 1.3 * len(instruction) + 16:
            return False
    asked, said = squeezed(instruction), squeezed(text)
    return len(asked) >= 4 and asked in said and len(said) - len(asked) <= max(16, 0.3 * len(asked)) or (len(asked) >= 20 and said in asked and len(said) >= 0.9 * len(asked))


def maybe_declines(text: str) -> bool:
    """Whether one of STEMS stands in the first sentences of a text."""
    at = 0
    for _, m in zip(range(HEAD + 1), _SENTENCE.finditer(text.lstrip()), strict=False):
        at = m.end()
    # a text of fewer sentences is looked at whole, and so is one whose sentences can't be told
    head = text if at == 0 else text.lstrip()[:at]
    last = text.lstrip()[at:] if len(head) < len(text) and at and not _SENTENCE.search(text.lstrip(), at) else ""
    low = (head + last).lower().replace("’", "'")
    return any(stem in low for stem in STEMS)


def declines(parts: list[str]) -> bool:
    """Whether a text, given as its sentences, mostly says that it can't or mustn't answer."""
    if not any(DECLINES.search(p) for p in parts[:HEAD]):
        return False
    return not any(_NOT_DECLINING.search(p) for p in parts) and sum(bool(DECLINES.search(p)) for p in parts) >= OWN_SHARE * len(parts)


def opening(text: str) -> str:
    """The first words of a clause, names and numbers masked, in lower case; of unspaced text its last characters."""
    if _KANA.search(text[:20]):
        return text[-12:]
    return " ".join(re.findall(r"[\w']+", re.sub(r"\d+", "0", _NAME.sub("_", text)).lower())[:OPENING_WORDS])


def topic(words: list[str], text: str) -> int:
    """A number that prompts about the same have in common: the hash of the longest word, of several the least."""
    longest = min(words, key=lambda w: (-len(w), w), default=text)
    return xxhash.xxh64_intdigest(longest.encode("utf-8", "replace")) >> 1


def open_end(text: str, n_words: int | None = None) -> str | None:
    """The last word of a text that doesn't visibly end; '' where its end is certainly missing, None where it ends."""
    text = text.rstrip()
    if text.count("```") % 2:
        return ""
    n_words = len(_WORD.findall(text)) if n_words is None else n_words
    if n_words and text[-1] in _GOES_ON:
        return ""
    if not text or n_words < 4 and "\n" not in text and not _KANA.search(text):
        return None
    if not text[-1].isalnum():
        return None
    lines = [x for x in text.split("\n") if x.strip()]
    tail = lines[-1]
    words = _WORD.findall(tail)
    if not words:
        return None
    gap = text[max(0, text.rindex(tail) - 40) : text.rindex(tail)]
    blank_before = len(lines) > 1 and gap.replace(" ", "").replace("\r", "").endswith("\n\n")
    if blank_before and len(words) <= 4 and not _ITEM.match(tail):
        return None  # a signature or a note of the source
    if _ITEM.match(tail):
        others = [x.rstrip() for x in lines[:-1] if _ITEM.match(x)]
        if not others or sum(x[-1] in ".!?。！？" for x in others) < 0.5 * len(others):
            return None  # a list of catchwords
    return "" if words[-1].isdigit() else words[-1].lower()


def facts(df: DataFrame, key: str, instruction: str, response: str) -> DataFrame:
    """Staged facts of every pair: (key, label, clauses, following, topic, declining, last); label is what the pair alone tells.

    ``clauses`` are the openings of the clauses of its first sentence that hold a cue; where there is one, ``following`` are the
    openings of its other sentences.
    """
    names = ["key", "label", "clauses", "following", "topic", "declining", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for asked, said in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                asked = asked or ""
                label, clauses, following, about, declining, last = None, [], [], None, False, None
                if is_empty(said):
                    label = "empty"
                elif is_copied(asked, said):
                    label = "copied"
                else:
                    words, prompt = _WORD.findall(said.lower()), _WORD.findall(asked.lower())
                    if maybe_declines(said):
                        parts = [p for p in _SENTENCE.split(said.replace("’", "'")) if p and not p.isspace()]
                        declining = declines(parts)
                        clauses = list(dict.fromkeys(opening(c.strip()) for c in _CLAUSE.split(parts[0]) if CUES.search(c)))
                    if clauses:
                        following, about = list(dict.fromkeys(map(opening, parts[1:]))), topic(prompt, asked)
                    last = open_end(said, len(words))
                    own, other = language(asked, prompt), language(said, words)
                    if own and other and own != other and not _NAMES[other].search(asked):
                        label = "other_language"
                for column, value in zip(out, (label, clauses, following, about, declining, last), strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, kinds, strict=True)]], names=names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, label string, clauses array<string>, following array<string>, topic bigint, declining boolean, last string"
    return stage(spread(df.select(key, instruction, response)).mapInArrow(run, schema), "facts")


def word_ends(df: DataFrame, response: str) -> DataFrame:
    """(last, ends): the share of its occurrences in which a word ends a sentence, over the whole corpus.

    Words are counted per batch before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[str] = Counter()
            ends: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                low = (text or "").lower()
                total.update(_WORD.findall(low))
                ends.update(_ENDS.findall(low))
            words = list(total)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([total[w] for w in words], pa.int64()), pa.array([ends[w] for w in words], pa.int64())], names=["last", "n", "e"])

    counted = spread(df.select(response)).mapInArrow(run, "last string, n bigint, e bigint")
    return counted.groupBy("last").agg((F.sum("e") / F.sum("n")).alias("ends"))


def _grams(text: str) -> set[str]:
    return {text[i : i + 3] for i in range(max(1, len(text) - 2))}


def linked(left: list[str], right: list[str] | None = None) -> list[tuple[str, str]]:
    """Links that join what is similar within one block, or across two, with no more links than that takes.

    Each opening is compared with all that aren't joined yet, so no similar pair stays apart."""
    rest = [{m: _grams(m) for m in sorted(side)} for side in (left, right) if side is not None]
    out: list[tuple[str, str]] = []
    while rest[0]:
        todo = [(0, *rest[0].popitem())]
        while todo:
            side, m, grams = todo.pop()
            other = (side + 1) % len(rest)
            same = [(x, gx) for x, gx in rest[other].items() if len(grams & gx) >= SIMILAR * len(grams | gx)]
            for x, gx in same:
                del rest[other][x]
                out.append((m, x))
                todo.append((other, x, gx))
    return out


def opening_clusters(openings: DataFrame) -> DataFrame:
    """(opening, cluster) of every distinct opening: verified MinHash buckets, joined into components.

    All openings of a bucket are compared. One of more than SMALL_BUCKET is cut into blocks by hash, and each pair of blocks is a
    row of its own, so that no task meets a whole large bucket.
    """
    distinct = stage(openings.select("opening").distinct(), "openings")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(11)
        factors, shifts = rng.integers(1, 2**32, HASHES, np.uint64) | np.uint64(1), rng.integers(0, 2**32, HASHES, np.uint64)
        for batch in batches:
            texts, bands, keys = [], [], []
            for text in batch.column(0).to_pylist():
                grams = np.fromiter((xxhash.xxh32_intdigest(g.encode("utf-8", "replace")) for g in _grams(text)), np.uint64)
                least = ((grams[:, None] * factors + shifts) & np.uint64(0xFFFFFFFF)).min(0)
                for b in range(HASHES // ROWS):
                    texts.append(text)
                    bands.append(b)
                    keys.append(xxhash.xxh64_intdigest(least[b * ROWS : (b + 1) * ROWS].tobytes()) >> 1)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(bands, pa.int32()), pa.array(keys, pa.int64())], names=["opening", "band", "bucket"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[str, str]] = set()
            for members, others in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.update(linked(members, others))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.string()) for k in (0, 1)], names=["a", "b"])

    bucket = ["band", "bucket"]
    keys = stage(distinct.mapInArrow(sign, "opening string, band int, bucket bigint"), "opening_keys")
    sizes = keys.groupBy(bucket).agg(F.ceil(F.count(F.lit(1)) / F.lit(SMALL_BUCKET)).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    cut = keys.join(sizes, bucket).withColumn("block", F.pmod(F.xxhash64("opening"), F.col("blocks")).cast("int"))
    blocks = stage(cut.groupBy(*bucket, "blocks", "block").agg(F.collect_list("opening").alias("members")), "blocks")
    alone = blocks.select("members", F.lit(None).cast("array<string>").alias("others"))
    several = blocks.where("blocks > 1")
    first = several.where(F.col("block") < F.col("blocks") - 1).select(*bucket, "members", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)).alias("block"))
    across = first.join(several.select(*bucket, "block", F.col("members").alias("others")), [*bucket, "block"]).select("members", "others")
    edges = alone.unionByName(across).mapInArrow(compare, "a string, b string")
    parts = connected_components(edges.distinct()).withColumnsRenamed({"node": "opening", "component": "cluster"})
    return distinct.join(parts, "opening", "left").select("opening", F.coalesce("cluster", "opening").alias("cluster"))


def refusals(found: DataFrame) -> DataFrame:
    """(key, template): the pairs with a clause whose template recurs before unrelated prompts; ``template`` is true where
    nothing but set phrases follows, so that the template reveals a refusal, and false where an answer follows."""
    rows = stage(found.where(F.size("clauses") > 0).select("key", "clauses", "following", "topic").distinct(), "candidates")
    each = rows.select("key", "topic", F.explode("clauses").alias("opening"))
    clustered = stage(each.join(opening_clusters(each), "opening").select("key", "topic", "cluster").distinct(), "clustered")
    # topics are made distinct before they are counted, so a cluster of many rows meets no single task
    recurring = clustered.select("cluster", "topic").distinct().groupBy("cluster").agg(F.count(F.lit(1)).alias("topics")).where(F.col("topics") >= PROMPTS)
    least = FOLLOWING * rows.select("key").distinct().count()
    following = rows.select("key", "topic", F.explode("following").alias("following"))
    times = following.select("following", "key").distinct().groupBy("following").agg(F.count(F.lit(1)).alias("n"))
    topics = following.select("following", "topic").distinct().groupBy("following").agg(F.count(F.lit(1)).alias("topics"))
    phrases = times.where(F.col("n") >= least).join(topics.where(F.col("topics") >= PROMPTS), "following").select("following")
    answered = following.join(phrases, "following", "left_anti").select("key", F.lit(False).alias("template")).distinct()
    known = clustered.join(recurring, "cluster", "left_semi").select("key").distinct()
    return known.join(answered, "key", "left").select("key", F.coalesce("template", F.lit(True)).alias("template"))


def defects(df: DataFrame, key: str, instruction: str, response: str) -> DataFrame:
    """(``key``, defect) of every defective pair."""
    found = facts(df, key, instruction, response)
    open_ends = found.where("last is not null and last <> ''").select("last").distinct()
    endings = word_ends(df, response).join(open_ends, "last", "left_semi").where(F.col("ends") >= ENDING).select("last", F.lit(True).alias("can_end"))
    known = found.select("key", "label", "declining", "last").join(refusals(found), "key", "left").join(endings, "last", "left")
    # a pair's own words decide only where no template reveals it
    refusal = F.coalesce("template", F.lit(False)) | F.col("declining")
    defect = (
        F.when(F.col("label").isin("empty", "copied"), F.col("label"))
        .when(refusal, F.lit("refusal"))
        .when(F.col("label").isNotNull(), F.col("label"))
        .when(F.col("last").isNotNull() & F.col("can_end").isNull(), F.lit("truncated"))
    )
    labelled = known.select("key", defect.alias("defect")).where("defect is not null")
    return labelled.groupBy("key").agg(F.min("defect").alias("defect")).withColumnRenamed("key", key)
