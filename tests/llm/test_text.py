"""Look-alikes, wrong decoding, repetition, defects and abuse: brute force, round trips and odd rows."""

import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.llm import abuse, defects, lookalike, mojibake, repetition, seeds

LONG = "lorem ipsum dolor sit amet " * 20_000


# 1. look-alikes
SAME = ["The quick fox", "Τhе quick fox", "Ｔｈｅ　ｑｕｉｃｋ ｆｏｘ", "The qu​ick fo­x", "the quick fox"[:0] + "Thе quісk fох"]
SAME += ["The quick fox\U000E0041", "Ꭲhe quick fox", "The q\U000E0101uick fox"]
OTHER = ["the quick fox", "The quick fóx", "The quick fox.", "The quick fox ²", "The quick fox 2", "The quick fox ①", "TM", "™", "½", "1/2"]


def test_classes(spark):
    rows = [(i, t) for i, t in enumerate([*SAME, *OTHER, "ёж", "ёж", "café ﬁn", "café fin", "a-b", "a‐b", "a–b", "", "​", None, SAME[0], LONG])]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("member", F.lit("clash"))
    found = {r.id: r.canonical for r in lookalike.canonical(df, "t").collect()}
    assert len(found) == len(rows)
    assert {found[i] for i in range(len(SAME))} == {SAME[0]}
    start = len(SAME)
    assert [found[start + i] for i in range(len(OTHER))] == OTHER
    at = start + len(OTHER)
    assert found[at] == found[at + 1] and found[at + 2] == found[at + 3] and found[at + 4] == found[at + 5] != found[at + 6]
    assert found[at + 7] == found[at + 8] == "" and found[at + 9] is None and found[at + 10] == SAME[0] and found[at + 11] == LONG
    assert lookalike.canonical(df.limit(0), "t").count() == 0


def test_pairs_against_brute_force(spark):
    rng = random.Random(3)
    one, many = lookalike.look_table()
    back = {}
    for c, look in one.items():
        if len(look) == 1 and look.isascii():
            back.setdefault(look, []).append(c)

    def vary(text):
        return "".join(rng.choice(back[c]) if c in back and rng.random() < 0.3 else c + ("​" if rng.random() < 0.05 else "") for c in text)

    texts = ["open the door", "ope the door", "Open the door", "x", "x"]
    rows = [(i // 3, i % 3, vary(rng.choice(texts))) for i in range(60)] + [(99, 0, None), (0, 0, None)]
    df = spark.createDataFrame(rows, "record_id bigint, turn bigint, content string").distinct()
    found = {tuple(r) for r in lookalike.same_look_pairs(df, ["record_id", "turn"], "content").collect()}
    links = Counter(key for a, b, c, e in found for key in ((a, b), (c, e)))
    assert {(r.record_id, r.turn): r.links for r in lookalike.same_look_classes(df, ["record_id", "turn"], "content").collect()} == links
    table = str.maketrans({**one, **many})
    key = lambda t: unicodedata.normalize("NFC", t.translate(table))
    items = [r for r in rows if r[2] is not None]
    expected = {(*a[:2], *b[:2]) for a in items for b in items if a[:2] < b[:2] and a[2] != b[2] and key(a[2]) == key(b[2])}
    assert found == expected and len(found) > 50


def test_messages(spark):
    schema = "record_id bigint, conversation array<struct<content string, do_train boolean, role string>>, content string"
    df = spark.createDataFrame([(1, [("a", None, "x"), (None, True, None)], "z"), (1, [("a", None, "x")], "y"), (None, [("b", None, "x")], None), (2, None, None), (3, [], None)], schema)
    assert [tuple(r) for r in lookalike.messages(df).collect()] == [(1, 0, "a")]


# 4. wrong decoding
PLAIN = ["The naïve façade isn’t mine – €5.", "Różowy żółw śpi nad rzeką.", "Тёплый хлеб меняет тонкий лёд возле окна.", "森の鳥は秘密の歌を教えてくれる。", "Crème brûlée à la carte, où l’on mange.", "morlirin/\n├── a.txt\n│   └── b", "TAMBÉM O VIOLÃO NÃO VÊ OS PÃES.", "½ of them © √9"]


def misread(text, name):
    return "".join(chr(b) if name == "cp1252" and bytes([b]).decode(name, "ignore") == "" else bytes([b]).decode(name) for b in text.encode("utf-8"))


def test_garbled(spark):
    broken = [misread(PLAIN[0], "cp1252"), misread(PLAIN[1], "cp1252"), misread(PLAIN[2], "latin-1"), misread(PLAIN[3], "latin-1"), misread(PLAIN[4], "mac_roman"),
              misread(misread(PLAIN[4], "cp1252"), "cp1252"), misread("Привет, мой сосед", "cp866"), misread("déjà vu à côté", "cp437")]
    true = [PLAIN[0], PLAIN[1], PLAIN[2], PLAIN[3], PLAIN[4], PLAIN[4], "Привет, мой сосед", "déjà vu à côté"]
    rows = [(i, t) for i, t in enumerate([*broken, *PLAIN, "lost �", "", None, LONG + "é" * 1000, PLAIN[0]])]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("restored", F.lit("clash"))
    found = {r.id: (r.garbled, r.restored) for r in mojibake.garbled(df, "t").collect()}
    assert [found[i] for i in range(len(broken))] == [(True, t) for t in true]
    at = len(broken)
    assert [found[at + i] for i in range(len(PLAIN))] == [(False, t) for t in PLAIN]
    at += len(PLAIN)
    assert found[at][0] and found[at + 1] == (False, "") and found[at + 2] == (False, None) and not found[at + 3][0] and not found[at + 4][0]
    assert mojibake.garbled(df.limit(0), "t").count() == 0


def test_exchanged_encodings(spark):
    clean = ["Ночной рынок скрывает сложный ответ на балконе.", "Старый дом заменяет сложный ответ за углом.", "Ночной поезд скрывает старый рынок."] * 400
    broken = "Старый рынок скрывает сложный дом.".encode("koi8_r").decode("cp1251")
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*clean, broken])], "id int, t string")
    hits = {r.id: r.restored for r in mojibake.garbled(df, "t").where("garbled").collect()}
    assert hits == {len(clean): "Старый рынок скрывает сложный дом."}


def test_exchanged_latin_encodings(spark):
    clean = ["Świeży chleb pamięta stół w kącie, żeby nikt się nie spóźnił.", "Zimowy płaszcz łączy późny gość, choć wiatr wyjaśnił świeży chleb.", "Où est le café? Là-bas, près du château."] * 400
    broken = "Późny gość łączy świeży stół."
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*clean, broken.encode("cp1250").decode("cp1252")])], "id int, t string")
    assert {r.id: r.restored for r in mojibake.garbled(df, "t").where("garbled").collect()} == {len(clean): broken}


# 5. repetition
def covered(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    grams = [tuple(words[i : i + 4]) for i in range(len(words) - 3)]
    hit = {j for i, g in enumerate(grams) if g in grams[:i] for j in range(i, i + 4)}
    return len(hit) / len(words) if words else 0.0


def test_repetition(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 60))) for _ in range(120)]
    texts += ["a b c d " * 2, "one two three four. One, two - three four!", LONG, "", " ", None, "x", "日本語。" * 9, texts[0]]
    df = spark.createDataFrame([(i, t, rng.choice(["en", "de", None, "xx"])) for i, t in enumerate(texts)], "id int, t string, lang string").withColumn("words", F.lit(1))
    found = {r.id: r.share for r in repetition.repetition(df, "id", "t", "lang").collect()}
    expected = {i: covered(t) if t is not LONG else repetition.repeated_share(t) for i, t in enumerate(texts)}
    assert found == pytest.approx(expected)
    assert {r.id for r in repetition.repetitive(df, "id", "t", "lang").collect()} == {i for i, s in expected.items() if s >= 0.3}
    assert repetition.repetitive(df.limit(0), "id", "t", "lang").count() == 0


def test_distance_floor():
    reference = np.zeros(repetition.WORD_BINS)
    reference[0], reference[-1] = 0.9, 0.1
    counts = np.zeros(repetition.WORD_BINS)
    counts[0], counts[-1] = 7, 3
    assert repetition.js_distance(counts, reference) == pytest.approx(repetition.floor_distance(0.3, reference))
    assert repetition.js_distance(counts * 0, reference) == 0 and repetition.js_distance(reference * 10, reference) == pytest.approx(0, abs=1e-6)


def test_distance_chooses_candidates(spark):
    """Ordinary texts are set aside by their distance, before any passage is sought; repetitive ones never are."""
    rng = random.Random(3)
    plain = [" ".join(rng.choice("the of lamp road river stone green small old walks sees takes".split()) + str(rng.randrange(9)) for _ in range(60)) for _ in range(60)]
    again = [t + " " + " ".join(t.split()[5:40]) for t in plain[:20]]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(plain + again)], "id int, t string, lang string")
    rows = {r.id: r for r in repetition.repetition(df, "id", "t", "lang", 0.3).collect()}
    assert all(rows[60 + i].candidate and rows[60 + i].share >= 0.3 for i in range(20))
    assert sum(rows[i].candidate for i in range(60)) < 10
    assert min(rows[60 + i].word_distance for i in range(20)) > max(rows[i].word_distance for i in range(60)) - 0.2


# 6. defects
def test_defects(spark):
    sorry = [(f"Question number {w} about {w}?", f"I'm sorry, but I can't help with that {w}.") for w in ("ships", "trees", "maps", "songs")]
    rows = [
        ("What is it?", None, "empty"), ("What is it?", " ​\n", "empty"), ("What is it?", "N/A", "empty"), ("What is it?", "…", "empty"), ("What is it?", "[no answer]", "empty"),
        ("How do I sort a map?", "> how do I sort a map", "copied"), ("How do I sort a map?", "You asked: How do I sort a map?", "copied"), (None, "Fine answer, all of it.", None),
        ("How do I sort a map?", "To sort the map you should first look at the old harbour and", "truncated"), ("How do I sort a map?", "First,", "truncated"),
        ("How do I sort a map?", "Here it is:\n- red map\n- blue map", None), ("How do I sort a map?", "Turn it over twice.\n\nCheers, Anna", None), ("How do I sort a map?", "42", None),
        ("How do I sort the map that is in the house?", "Die alte Karte liegt in der Küche und ist nicht für mich.", "other_language"),
        ("Please say it in German: the map is in the house.", "Die alte Karte liegt in der Küche und ist nicht für mich.", None),
        ("Wie kann ich die Karte in der Küche sortieren?", "その地図は台所にあります。", "other_language"), ("", "Some words that end well.", None),
        ("Where?", "I can't recommend the old harbour enough for this.", None), ("Why?", LONG + ".", None), *[(a, b, "refusal") for a, b in sorry],
    ]
    df = spark.createDataFrame([(i, a, b, "x") for i, (a, b, _) in enumerate(rows)] + [(0, "What is it?", None, "x")], "id int, q string, a string, label string")
    found = {r.id: r.defect for r in defects.defects(df, "id", "q", "a").collect()}
    assert found == {i: d for i, (_, _, d) in enumerate(rows) if d}
    assert defects.defects(df.limit(0), "id", "q", "a").count() == 0


# 3. abuse
def test_abuse(spark):
    labels = [(f"You stupid cunt number {i}, shut up. The lamp is green.", 1) for i in range(6)] + [(f"The lamp number {i} is green and the road is long.", 0) for i in range(12)]
    labelled = spark.createDataFrame([*labels, (None, 1), ("x", None)], "text string, is_abusive int")
    ordinary = spark.createDataFrame([("Der Tisch und der Stuhl gehören zusammen. Das Fenster und die Tür gehören dem Nachbarn.",), (LONG,), (None,)], "text string")
    model = abuse.train(abuse.labelled_rows(labelled, "text", "is_abusive"), abuse.background_rows(ordinary, "text"))
    bad = ["You stupid cunt!", "The road is long. You s t u p i d c.u.n.t number three, shut up. The lamp is green.", "Halt die Fresse, du dummes Arschloch aus Rom.", "Fuuuuck you, you w.h.o.r.e."]
    good = ["The lamp is green.", "The road is long and the lamp is green today.", "Die Küche und das Öl gehören zusammen.", "", None, "a", LONG]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*bad, *good, bad[0]])], "id int, t string").withColumn("score", F.lit("clash"))
    scored = abuse.score(df, "t", model)
    found = {r.id: r.abusive for r in scored.collect()}
    assert [found[i] for i in range(len(bad) + len(good) + 1)] == [True] * len(bad) + [False] * len(good) + [True]
    assert abuse.rates(scored.withColumn("s", F.lit(None).cast("string")), "s").first()["flagged"] == 5
    assert abuse.score(df.limit(0), "t", model).count() == 0


def test_abuse_held_out(spark):
    """Accuracy on the held-out half of the labelled texts."""
    import os

    path = "/root/testdata/sf0.001/abuse_label.parquet"
    if not os.path.exists(path):
        pytest.skip("no labelled table here")
    rows = [(r.text, r.is_abusive) for r in spark.read.parquet(path).orderBy("label_id").collect()]
    ordinary = abuse.background_rows(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "text")
    weights, bias = abuse.train(rows[::2], ordinary)
    right = [(max(abuse.project(abuse.sentences(t), weights)[0]) + bias > abuse.THRESHOLD) == bool(y) for t, y in rows[1::2]]
    assert sum(right) / len(right) > 0.95


def test_seeds_stand_in_no_scored_text(spark):
    """No labelled sentence of four or more words is a sentence of the scored table."""
    import os

    path = "/root/testdata/sf0.1/dataset.parquet"
    if not os.path.exists(path):
        pytest.skip("no table here")
    known = {abuse.plain(s).strip(" .!?。！？") for s, _ in seeds.labelled_sentences()}
    scored = {s.strip(" .!?。！？") for r in spark.read.parquet(path).select("response").collect() for s in abuse.sentences(r[0])}
    assert not {s for s in known & scored if len(s.split()) >= 4}


def test_kernel_is_collapsed_exactly():
    texts = ["shut up you fool", "the lamp is green", "you foolish lamp"]
    owner, feature, value = abuse.sparse_features(texts)
    kernel = abuse.landmark_kernel(owner, feature, value, 3, np.arange(3), step=64)
    weights = np.bincount(feature[owner == 0], value[owner == 0], 1 << abuse.BITS)
    assert abuse.project(texts, weights)[0] == pytest.approx(kernel[:, 0], rel=1e-5)
    assert kernel == pytest.approx(kernel.T, rel=1e-5)
    # a window's value is that of the window as a text of its own, and the best one is reported
    long = ["the road to the harbour is long and wet, shut up you fool, and the night is as long as the road was"]
    best, window = abuse.project(long, weights)
    assert best == pytest.approx(abuse.project(window, weights)[0], rel=1e-5) and "shut up" in window[0]


def test_opening_clusters(spark, monkeypatch):
    """Similar openings share a cluster, compared with all pairs; also where every bucket is larger than what is compared at once."""
    rng = random.Random(9)
    words = "i cannot help you with this request my rules do not allow answers sorry must decline unable discuss topic".split()
    openings = sorted({" ".join(rng.sample(words, 6)) for _ in range(40)} | {f"i cannot help you with {w}" for w in words} | {f"{w} must decline to discuss the" for w in words})
    similar = {(a, b) for i, a in enumerate(openings) for b in openings[i + 1 :] if len(defects._grams(a) & defects._grams(b)) >= defects.SIMILAR * len(defects._grams(a) | defects._grams(b))}
    df = spark.createDataFrame([(o,) for o in openings], "opening string")
    for most in (defects.SMALL_BUCKET, 4):
        monkeypatch.setattr(defects, "SMALL_BUCKET", most)
        of = {r.opening: r.cluster for r in defects.opening_clusters(df).collect()}
        assert len(of) == len(openings) and sum(of[a] == of[b] for a, b in similar) >= 0.95 * len(similar) > 20


def test_large_buckets_are_compared_whole(spark, monkeypatch):
    """Buckets cut into blocks give the clusters of buckets compared at once, also where an opening is like another but unlike the least."""
    rng = random.Random(31)
    # a common beginning brings openings together that are unlike each other but for pairs
    endings = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(150)]
    openings = sorted({f"i must say that {e}" for e in endings} | {f"i must say that {e[:-1]}0" for e in endings})
    df = spark.createDataFrame([(o,) for o in openings], "opening string")
    found = []
    for most in (10_000, 3, 1):
        monkeypatch.setattr(defects, "SMALL_BUCKET", most)
        found.append({r.opening: r.cluster for r in defects.opening_clusters(df).collect()})
    assert found[0] == found[1] == found[2] and 1 < len(set(found[0].values())) < len(openings)
    # the links join exactly what all pairs would
    grams = {o: defects._grams(o) for o in openings}
    similar = {(a, b) for i, a in enumerate(openings) for b in openings[i + 1 :] if len(grams[a] & grams[b]) >= defects.SIMILAR * len(grams[a] | grams[b])}

    def parts(links):
        of = {o: o for o in openings}
        for _ in openings:
            before = dict(of)
            for a, b in links:
                of[a] = of[b] = min(of[a], of[b])
            if of == before:
                break
        return of

    half = openings[::2], openings[1::2]
    across = [p for side in half for p in defects.linked(side)] + defects.linked(*half)
    assert parts(similar) == parts(defects.linked(openings)) == parts(across)


def test_refusals_by_template(spark):
    """A template before unrelated prompts reveals refusals of any length; where an answer follows there is none."""
    topics = "harbours violins tomatoes glaciers railways lanterns beehives".split()
    polite = " I was made to be safe and polite. " * 30
    rows = [(i, f"Tell me about {t} please", f"The rule book is against my answering questions about {t}." + polite) for i, t in enumerate(topics)]
    rows += [(20 + i, f"Tell me about {t} please", f"The rule book is against my taste, but {t} are fine. {t.title()} come in {i} sizes. They need {i + 2} weeks of care {t}.") for i, t in enumerate(topics)]
    df = spark.createDataFrame(rows, "id int, q string, a string")
    found = {r.id: r.defect for r in defects.defects(df, "id", "q", "a").collect()}
    assert found == dict.fromkeys(range(len(topics)), "refusal")
