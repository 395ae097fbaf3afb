"""Problem 1: texts that look alike on the screen but differ in characters.

Characters are mapped to one look (width, ligatures, look-alike letters, kinds of space and hyphen, characters that
cannot be seen), the mapped values are grouped under the accent- and case-sensitive Unicode collation of Spark SQL, each
group gets a deterministic canonical member, and that member is joined back. The collation makes composed and decomposed
accents equal and keeps raised, circled or lowered digits, case and accents apart.

Nulls have no form (null in, null out); an empty text is its own form. Everything runs in the JVM.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.session import stage

# Letters of other alphabets that look like Latin ones, as (look-alikes, Latin letters).
LOOKALIKES = (
    ("АВЕЅІЈКМНОРСТУХҮԌԚԜӀ", "ABESIJKMHOPCTYXYGQWI"),  # Cyrillic capitals
    ("аеіјорсухѕԁһѵԛԝӏүѡ", "aeijopcyxsdhvqwlyw"),  # Cyrillic small letters
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ABEZHIKMNOPTYXCJ"),  # Greek capitals
    ("ορϲϳναγικσυχ", "opcjvayikoux"),  # Greek small letters
    ("օսոհցՕՍյզԼ", "ounhgOUjqL"),  # Armenian
    ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃᎥ", "ABCDEGHJKLMPRSTVWZi"),  # Cherokee
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),  # Lisu
    ("ⲟⲣⲥⲞⲢⲤ", "opcOPC"),  # Coptic
    ("ɑɡɩᴏᴄᴠᴡᴢꜱ", "agiocvwzs"),  # Latin letter forms
    ("ⅰⅴⅹⅼⅽⅾⅿⅠⅤⅩⅬⅭⅮⅯ", "ivxlcdmIVXLCDM"),  # numerals of one letter
)
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
HYPHENS = "\u2010\u2011\ufe63\uff0d"
#: Code points that are never seen, as inclusive ranges.
UNSEEN = (
    (0x00, 0x08), (0x0E, 0x1B), (0x7F, 0x84), (0x86, 0x9F), (0xAD, 0xAD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160),
    (0x17B4, 0x17B5), (0x180B, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164),
    (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF9, 0xFFFB), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
)
#: Compatibility forms that only differ in width or in how a ligature is composed.
WIDTHS = ("<wide>", "<narrow>", "<small>", "<vertical>")
LIGATURES = "Ĳĳﬀﬁﬂﬃﬄﬅﬆﬓﬔﬕﬖﬗ"
#: A joiner between pictographs changes what is seen; it is kept as this private character.
JOINER = "\ue000"
PICTOGRAPHS = r"[\x{2190}-\x{2BFF}\x{1F000}-\x{1FAFF}\x{FE0F}]"


@lru_cache(1)
def look_table() -> tuple[dict[str, str], dict[str, str]]:
    """Maps of one character to one ('' deletes) and of one to several, made from the rules above."""
    base = {a: b for froms, tos in LOOKALIKES for a, b in zip(froms, tos, strict=True)}
    base |= dict.fromkeys(SPACES, " ") | dict.fromkeys(HYPHENS, "-")
    one: dict[str, str] = {}
    many: dict[str, str] = {}
    for code in range(0x80, 0x10000):
        char = chr(code)
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4 or 0x1F00 <= code < 0x2000:
            continue  # surrogates, Hangul syllables, and polytonic Greek, whose marks no Latin letter carries
        kind = unicodedata.decomposition(char).split(" ")[0]
        plain = unicodedata.normalize("NFKC", char) if kind in WIDTHS or char in LIGATURES else char
        parts = unicodedata.normalize("NFD", plain)
        look = unicodedata.normalize("NFC", "".join(base.get(c, c) for c in parts))
        if look == char or (len(look) > 1 and look == parts and char not in LIGATURES and kind not in WIDTHS):
            continue
        (one if len(look) == 1 else many)[char] = look
    for low, high in UNSEEN:
        if high < 0x10000:  # those beyond go by a pattern
            one |= {chr(c): "" for c in range(low, high + 1)}
    return one, many


@lru_cache(1)
def inert_characters() -> str:
    """The inside of a pattern's class: characters below U+2100 that look like no other, so that a text of these alone is its own look."""
    one, many = look_table()
    codes = [c for c in (*range(9, 14), *range(0x20, 0x250), *range(0x2010, 0x2060), *range(0x20A0, 0x20C0)) if chr(c) not in one and chr(c) not in many]
    starts = [c for c in codes if c - 1 not in set(codes)]
    ends = [c for c in codes if c + 1 not in set(codes)]
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in zip(starts, ends, strict=True))


def look(text: Column) -> Column:
    """``text`` with every character replaced by the one it looks like; its comparison needs the collation."""
    one, many = look_table()
    kept = {a: b for a, b in one.items() if b}
    gone = [a for a, b in one.items() if not b]
    beyond = "".join(f"\\x{{{low:X}}}-\\x{{{high:X}}}" for low, high in UNSEEN if low >= 0x10000)
    out = F.regexp_replace(text, rf"(?<={PICTOGRAPHS})\x{{200D}}(?={PICTOGRAPHS})", JOINER)
    out = F.translate(F.regexp_replace(out, f"[{beyond}]", ""), "".join([*kept, *gone]), "".join(kept.values()))
    # only few texts hold one of these; the test keeps the chain of replacements off the others
    chain = out
    for a, b in many.items():
        chain = F.replace(chain, F.lit(a), F.lit(b))
    return F.when(out.rlike("[" + "".join(many) + "]"), chain).otherwise(out)


def messages(records: DataFrame, once: bool = True) -> DataFrame:
    """One row per (record_id, turn, content): repeated deliveries count once, unless ``once`` is off, which saves moving the texts
    where a later step makes rows distinct; null content and null records drop out."""
    rows = (
        records.select("record_id", F.posexplode("conversation").alias("turn", "message"))
        .select("record_id", F.col("turn").cast("bigint").alias("turn"), F.col("message.content").alias("content"))
        .where(F.col("content").isNotNull() & F.col("record_id").isNotNull())
    )
    return rows.distinct() if once else rows


def mixed_classes(texts: DataFrame, text: str) -> DataFrame:
    """The staged rows (member, look, canonical) of the distinct non-null texts that another text is a look-alike of, or that hold
    a character which may look like another.

    Most texts hold no such character and are their own look: they are compared byte by byte with the looks of the others, and
    only those that equal one are mapped and grouped under the collation. Distinct texts are reduced first, so a text that a
    third of all rows share is one row here. The canonical member is the class's text with the fewest bytes beyond ASCII, then
    the shortest, then the least in code point order.
    """
    plain = ~F.col("member").rlike(f"[^{inert_characters()}]")
    distinct = texts.where(F.col(text).isNotNull()).select(F.col(text).alias("member")).distinct().withColumn("plain", plain)
    distinct = stage(distinct, "distinct_texts")

    @F.pandas_udf("string")
    def composed(values):
        return values.map(lambda v: unicodedata.normalize("NFC", v), na_action="ignore")

    active = distinct.where("not plain").select("member", look(F.col("member")).alias("look"))
    marked = F.when(F.col("look").rlike(r"\p{M}"), F.col("look"))
    active = stage(active.withColumn("look", F.coalesce(composed(marked), "look")), "active_texts")
    inert = distinct.where("plain").select("member").join(active.select(F.col("look").alias("member")), "member", "left_semi")
    mapped = active.unionByName(inert.select("member", F.col("member").alias("look"))).withColumn("look", F.collate("look", "UNICODE"))
    rank = F.struct((F.octet_length("member") - F.length("member")).alias("wide"), F.length("member").alias("long"), F.col("member"))
    best = mapped.groupBy("look").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("members")).select("look", F.col("best.member").alias("canonical"), "members")
    return stage(mapped.join(best, "look").select("member", "canonical", "members"), "classes")


def canonical(df: DataFrame, text: str, out: str = "canonical") -> DataFrame:
    """``df`` with ``out``: the canonical member of the class of texts that read the same as ``text``.

    Null for null. Rows, repeated ones too, and all other columns stay. A text in no mixed class is its own canonical member.
    """
    known = mixed_classes(df, text).where("members > 1")
    known = known.select(F.unhex(F.md5("member")).alias("__look_member"), F.col("canonical").alias("__look_canonical"))
    names = [F.col(f"__rows.`{c}`") for c in df.columns if c != out]
    digest = F.unhex(F.md5(F.col(f"__rows.`{text}`")))
    return df.alias("__rows").join(known, digest == F.col("__look_member"), "left").select(*names, F.coalesce("__look_canonical", F.col(f"__rows.`{text}`")).alias(out))


def _variants(items: DataFrame, ids: list[str], text: str) -> tuple[DataFrame, DataFrame]:
    """(key, exact) of the members of classes of two or more texts, and the items of these with their (key, exact), by digests."""
    known = mixed_classes(items, text).where("members > 1")
    members = stage(known.select(F.unhex(F.md5("canonical")).alias("key"), F.unhex(F.md5("member")).alias("exact")), "variants")
    held = items.where(F.col(text).isNotNull()).select(*[F.col(i).alias(f"id_{i}") for i in ids], F.unhex(F.md5(F.col(text))).alias("exact"))
    return members, stage(held.join(members, "exact").select(*[f"id_{i}" for i in ids], "key", "exact").distinct(), "looks")


def same_look_pairs(items: DataFrame, ids: list[str], text: str) -> DataFrame:
    """All pairs of items whose texts differ as strings but read the same, as columns ``{id}_a``, ``{id}_b``.

    ``ids`` identify an item; the smaller key is side a. The distinct texts of a class are paired first and the pairs then
    widened to their items, so copies of one popular text never meet each other.
    """
    members, held = _variants(items, ids, text)
    other = members.select("key", F.col("exact").alias("exact_b"))
    pairs = members.withColumnRenamed("exact", "exact_a").join(other, "key").where("exact_a < exact_b").select("exact_a", "exact_b")
    side = lambda name: held.select(F.col("exact").alias(f"exact_{name}"), F.struct(*[F.col(f"id_{i}").alias(i) for i in ids]).alias(name))
    met = pairs.join(side("a"), "exact_a").join(side("b"), "exact_b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return met.distinct().select(*[F.col(f"a.{i}").alias(f"{i}_a") for i in ids], *[F.col(f"b.{i}").alias(f"{i}_b") for i in ids])


def same_look_classes(items: DataFrame, ids: list[str], text: str) -> DataFrame:
    """(``ids``, class, links) of the items of mixed classes: the class's digest and how many items it links to, which are those
    of the class with another text. The form without pairs, for classes of any size."""
    _, held = _variants(items, ids, text)
    own = held.groupBy("key", "exact").agg(F.count(F.lit(1)).alias("n"))
    whole = own.groupBy("key").agg(F.sum("n").alias("total"))
    links = own.join(whole, "key").select("exact", F.lower(F.hex("key")).alias("class"), (F.col("total") - F.col("n")).alias("links"))
    return held.join(links, "exact").select(*[F.col(f"id_{i}").alias(i) for i in ids], "class", "links")


def unseen_characters() -> set[str]:
    """All characters that the mapping deletes."""
    return {chr(c) for low, high in UNSEEN for c in range(low, min(high, sys.maxunicode) + 1)}
