"""Encoding, packing, cutting, mixing and near-duplicates: exact round trips and brute force."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.llm import mixing, nearpairs, packing, splitting, tokens
from chatloom.session import table

ODD = [None, "", " ", "\n\n", "a", "a  b", "x  y", "x  y", "tab\t\ttab", "don't I'll", "<|endoftext|>", "def f():\n    return 1\n\n\nx", "日本語のテキスト。次の文。", "é" * 50, "a" * 3000, "end  ", "  start", "\r\n mixed\r\n\r\n", "🏳️‍🌈 ok", "1234567890" * 40, "word " * 3000]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, ODD[5]])], "doc_id bigint, text string").withColumn("word", F.lit("clash"))


def test_encode(spark, odd):
    bpe = tokens.encoding(tokens.tokenizer_dir(), tokens.TOKENIZER)
    expected = {i: bpe.encode_ordinary(t or "") for i, t in enumerate([*ODD, ODD[5]])}
    assert {r.doc_id: r.ids for r in tokens.encode(odd, "doc_id", "text").collect()} == expected
    # with no word, some words and all words held in memory
    bounds = (0, 200, 2000)
    for most in bounds:
        assert {r.doc_id: r.ids for r in tokens.encode(odd, "doc_id", "text", word_table_bytes=most).collect()} == expected
        assert {r.doc_id: r.tokens for r in tokens.sizes(odd, "doc_id", "text", word_table_bytes=most).collect()} == {i: len(x) for i, x in expected.items()}
    assert {tokens.frequent_and_rare(tokens.word_table(odd, "text"), most)[1] is None for most in (*bounds, 1 << 30)} == {False, True}
    assert {r.doc_id: r.tokens for r in tokens.sizes(odd, "doc_id", "text").collect()} == {i: len(x) for i, x in expected.items()}
    decoded = {r.doc_id: r.text for r in tokens.decode(tokens.encode(odd, "doc_id", "text"), "doc_id", "ids").collect()}
    assert decoded == {i: t or "" for i, t in enumerate([*ODD, ODD[5]])}
    twice = tokens.encode(odd.unionByName(odd), "doc_id", "text")
    assert twice.count() == 2 * len(expected)
    assert tokens.encode(odd.limit(0), "doc_id", "text").count() == 0


def test_encode_like_the_other_library(odd):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{tokens.tokenizer_dir()}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    bpe = tokens.encoding(tokens.tokenizer_dir(), tokens.TOKENIZER)
    for t in ODD:
        assert bpe.encode_ordinary(t or "") == other.encode(t or "", add_special_tokens=False).ids


def test_open_bins():
    rng = random.Random(1)
    bins, filled = packing.OpenBins(100, 4), Counter()
    for _ in range(3000):
        for _, taken, number in bins.place(rng.randrange(0, 260)):
            filled[number] += taken
    assert max(filled.values()) <= 100 and len(filled) <= bins.opened
    assert sum(filled.values()) / (100 * bins.opened) > 0.93
    small = packing.OpenBins(10, 2)
    assert [small.put(s) for s in (6, 7, 3, 4, 8, 0)] == [0, 1, 1, 0, 2, 1]


def test_pack(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 5, 40, 99, 100, 101, 350, None])) for i in range(700)] + [(None, 7), (3, 40)]
    df = spark.createDataFrame(rows, "id bigint, size bigint").withColumn("task", F.lit("clash"))
    found = packing.pack(df, "id", "size", 100, open_bins=8, containers_per_task=60).collect()
    filled, parts = Counter(), Counter()
    for r in found:
        filled[r.container] += r.tokens
        parts[r.id] += r.tokens
    assert max(filled.values()) <= 100
    expected = Counter()
    for i, s in rows:
        expected[i] += s or 0
    assert parts == expected
    assert all(s <= 100 for s in (r.tokens for r in found))
    assert len([r for r in found if r.id == 3]) >= 2
    assert packing.pack(df.limit(0), "id", "size", 100).count() == 0


@pytest.mark.parametrize("limit,overlap", [(64, 8), (32, 0), (1024, 64)])
def test_cut(spark, odd, limit, overlap):
    bpe = tokens.encoding(tokens.tokenizer_dir(), tokens.TOKENIZER)
    texts = dict(enumerate([*ODD, ODD[5]]))
    rows = splitting.split(odd, "doc_id", "text", limit, overlap).orderBy("doc_id", "piece").collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {i for i, t in texts.items() if len(bpe.encode_ordinary(t or "")) > limit}
    for i, pieces in by.items():
        text, end = texts[i], 0
        for k, p in enumerate(pieces):
            assert p.piece == k and p.text == text[p.first_char : p.last_char] and p.first_char <= end < p.last_char
            assert p.tokens == len(bpe.encode_ordinary(p.text)) <= limit
            assert len(bpe.encode_ordinary(text[p.first_char : end])) <= overlap
            end = p.last_char
        assert end == len(text)
    for most in (300, 3000):
        assert splitting.split(odd, "doc_id", "text", limit, overlap, word_table_bytes=most).orderBy("doc_id", "piece").collect() == rows
    again = splitting.split(odd, "doc_id", "text", limit, overlap, word_table_bytes=0).orderBy("doc_id", "piece").collect()
    assert again == rows


def test_cut_takes_the_natural_boundary(spark):
    text = "\n\n".join(" ".join(f"word{i}" for i in range(20)) + "." for _ in range(4))
    df = spark.createDataFrame([(1, text)], "id int, text string")
    pieces = splitting.split(df, "id", "text", 120, 0).orderBy("piece").collect()
    assert all(p.text.endswith(".") for p in pieces)
    assert all(p.text.startswith("\n\n") for p in pieces[1:])


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "A ", "a/"]), 10 + rng.randrange(20)) for i in range(3000)]
    rows += [(5000 + i, "b", 10 + rng.randrange(20)) for i in range(200)] + [(7000 + i, s, 15) for i, s in enumerate(["c", None, "c"])] + [(0, "a", 12), (5000, "b", None)]
    df = spark.createDataFrame(rows, "id bigint, source string, size bigint").withColumn("block", F.lit("clash")).repartition(6)
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("gone", 0.1, 9)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(df, "id", "source", F.col("size"), targets)
    found = mixed.collect()
    total = Counter()
    for r in found:
        total[r.source] += r.size
    assert set(total) == {"a", "b"}
    share = total["b"] / sum(total.values())
    assert share == pytest.approx(0.4 / 0.9, abs=0.02)
    uses = Counter((r.source, r.id) for r in found)
    assert max(n for (s, _), n in uses.items() if s == "a") == 1 and max(n for (s, _), n in uses.items() if s == "b") <= 3
    assert {(r.slot, r.id, r.repeat) for r in mixed.collect()} == {(r.slot, r.id, r.repeat) for r in found}
    report = {r.source: r for r in mixing.report(mixed, targets, "id", df).collect()}
    assert report["gone"].actual_share == 0 and report["c"].target_share == 0 and sum(r.actual_share for r in report.values()) == pytest.approx(1)
    assert mixing.mix(df.limit(0), "id", "source", F.col("size"), targets).count() == 0
    assert mixing.mix(df, "id", "source", F.col("size"), targets.limit(0)).count() == 0


def near(rows, threshold, least):
    import re

    bags = {}
    for i, a, b in rows:
        words = re.findall(r"[^\W_]+", f"{a or ''}\n{b or ''}".lower())
        if i is not None and len(words) >= least:
            bags[i] = Counter(words)
    keys = sorted(bags)
    return {(x, y) for k, x in enumerate(keys) for y in keys[k + 1 :] if (bags[x] & bags[y]).total() >= threshold * (bags[x] | bags[y]).total()}


def edited(rng, words, share):
    out = [rng.choice([None, rng.choice(words), f"new{rng.randrange(900)}"]) if rng.random() < share else w for w in words]
    if rng.random() < 0.3:
        rng.shuffle(out)
    return [w for w in out if w]


def records(seed, groups, words_each):
    rng = random.Random(seed)
    rows, common = [], [f"common{i}" for i in range(30)]
    for _ in range(groups):
        base = [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(4000)}" for _ in range(words_each)]
        for _ in range(rng.randrange(1, 5)):
            words = edited(rng, base, rng.choice([0.0, 0.03, 0.1]))
            rows.append((len(rows), " ".join(words[:10]), " ".join(words[10:])))
    return rows


@pytest.mark.parametrize("words_each", [80, 700])
def test_near_pairs(spark, words_each):
    rows = records(words_each, 60, words_each)
    rows += [(9000, None, None), (9001, "short", "one"), (9002, *rows[0][1:]), (9003, *rows[0][1:]), (None, *rows[1][1:]), rows[2]]
    df = spark.createDataFrame(rows, "id bigint, a string, b string").withColumn("digest", F.lit("clash")).repartition(5)
    linked, members = nearpairs.links(df, "id", ["a", "b"])
    found = {tuple(r) for r in nearpairs.all_pairs(linked, members, "id").collect()}
    expected = near(rows, 0.7, 60)
    assert found <= expected
    assert len(found) >= 0.99 * len(expected) and len(expected) > 60
    empty = nearpairs.links(df.limit(0), "id", ["a", "b"])
    assert nearpairs.all_pairs(*empty, "id").count() == 0


def test_both_ways_of_the_join(spark):
    """Scanning inverted lists finds at least what enumerating subsets finds."""
    df = spark.createDataFrame(records(8, 60, 90), "id bigint, a string, b string")
    found = nearpairs.bags(df, "id", ["a", "b"], 60)
    signed = nearpairs.signatures(found, nearpairs.count_table(found))
    enumerated = {tuple(r) for r in nearpairs.candidates(signed, most=99).collect()}
    scanned = {tuple(r) for r in nearpairs.candidates(signed, most=0).collect()}
    assert enumerated and enumerated <= scanned  # both also hold what meets by the first elements of the shufflings
    # each side of the join by itself, without the shufflings
    alone = signed.withColumns({c: F.array().cast("array<bigint>") for c in ("firsts", "whole")})
    expected = near([(r[0], r[1], r[2]) for r in df.collect()], 0.7, 60)
    reps = {r.rep for r in signed.collect()}
    expected = {p for p in expected if p[0] in reps and p[1] in reps}
    for most in (99, 0):
        side = {tuple(r) for r in nearpairs.candidates(alone, most=most).collect()}
        assert len(side & expected) >= 0.9 * len(expected)
    assert nearpairs.boundary(signed) >= nearpairs.LEAST_REPRESENTATIVES


def test_groups(spark):
    df = spark.createDataFrame(records(9, 20, 80), "id bigint, a string, b string")
    linked, members = nearpairs.links(df, "id", ["a", "b"])
    groups = {r.id: (r.group, r.links) for r in nearpairs.groups(linked, members, "id").collect()}
    pairs = nearpairs.all_pairs(linked, members, "id").collect()
    assert all(groups[r.id_a][0] == groups[r.id_b][0] for r in pairs)
    degree = Counter(x for r in pairs for x in (r.id_a, r.id_b))
    assert {i: n for i, (_, n) in groups.items()} == {i: degree[i] for i in groups}


def test_whole_tables(spark):
    import os

    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        pytest.skip("no tables here")
    rows = [(r.pair_id, r.instruction, r.response) for r in table(spark, d, "dataset").dropDuplicates(["pair_id"]).collect()]
    linked, members = nearpairs.links(table(spark, d, "dataset"), "pair_id", ["instruction", "response"])
    assert {tuple(r) for r in nearpairs.all_pairs(linked, members, "pair_id").collect()} == near(rows, 0.7, 60)


def test_a_third_of_the_rows(spark):
    """Edited versions of one text, whose common words are all heavy: edits are words that other records have, too."""
    rng = random.Random(12)
    base = [f"base{i}" for i in range(120)]
    rows = []
    for i in range(600):
        words = list(base) if i % 3 == 0 else [f"w{rng.randrange(3000)}" for _ in range(120)]
        for spot in rng.sample(range(120), rng.choice([6, 10])):
            words[spot] = f"w{rng.randrange(3000)}"
        rows.append((i, " ".join(words[:60]), " ".join(words[60:])))
    df = spark.createDataFrame(rows, "id bigint, a string, b string").repartition(4)
    linked, members = nearpairs.links(df, "id", ["a", "b"])
    found = {tuple(r) for r in nearpairs.all_pairs(linked, members, "id").collect()}
    expected = near(rows, 0.7, 60)
    assert len(expected) > 19_000 and found <= expected and len(found) >= 0.99 * len(expected)


def test_pairs_of_rare_words_at_any_size(spark, monkeypatch):
    """Two records whose words no other record has, also where there are many more elements than counters."""
    rows = records(14, 40, 90)
    for i in range(20):
        words = [f"rare{i}x{k}" for k in range(90)]
        rows += [(5000 + 2 * i, " ".join(words), None), (5001 + 2 * i, " ".join(words[5:]), None)]
    df = spark.createDataFrame(rows, "id bigint, a string, b string").repartition(4)
    found = []
    for n in (nearpairs.COUNTERS, 256):
        monkeypatch.setattr(nearpairs, "COUNTERS", n)
        found.append({tuple(r) for r in nearpairs.all_pairs(*nearpairs.links(df, "id", ["a", "b"]), "id").collect()})
    expected = near([(r[0], r[1], r[2]) for r in rows], 0.7, 60)
    assert {(5000 + 2 * i, 5001 + 2 * i) for i in range(20)} <= found[0] & found[1]
    assert all(f <= expected and len(f) >= 0.99 * len(expected) for f in found)


def test_pairs_whose_rare_words_are_edits(spark):
    """Records of frequent words only; the edits near the threshold bring in words that are rarer than all that a pair shares."""
    rng = random.Random(21)
    common, rows = [f"common{i}" for i in range(300)], []
    for i in range(150):
        base = rng.sample(common, 100)
        for k in (0, 1):
            words = list(base)
            for spot in rng.sample(range(100), 8):
                words[spot] = f"rare{rng.randrange(400)}"
            rows.append((2 * i + k, " ".join(words), None))
    df = spark.createDataFrame(rows, "id bigint, a string, b string").repartition(4)
    found = {tuple(r) for r in nearpairs.all_pairs(*nearpairs.links(df, "id", ["a", "b"]), "id").collect()}
    expected = near(rows, 0.7, 60)
    assert len(expected) > 100 and found == expected


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.9, 1.0])
def test_parts_leave_no_pair_out(threshold):
    """Sets that agree just to the threshold, of equal and of different sizes, meet in a part."""
    rng = np.random.default_rng(int(threshold * 10))
    sets = []
    for _ in range(300):
        base = rng.choice(2000, rng.integers(20, 200), replace=False)
        for share in rng.uniform(0, 1.2 * (1 - threshold), 2):
            kept = base[rng.random(len(base)) >= share * rng.random()]
            added = rng.choice(np.arange(2000, 4000), int(share * len(base) * rng.random() * 0.7), replace=False)
            sets.append(np.concatenate([kept, added]).astype(np.int32))
    n = np.array([len(s) for s in sets])
    found = set()
    for number, kind in enumerate(nearpairs.size_classes(int(n.max()), threshold)):
        some = np.flatnonzero((n >= kind[0]) & (n <= kind[2]))
        if len(some):
            for _, ranks, counts, parities, elements in nearpairs.dealt(np.concatenate([sets[i] for i in some]), n[some], number, kind, np.arange(kind[3])):
                for pairs in nearpairs.met(some, n[some], ranks, counts, parities.view(np.uint64), elements, kind[1], threshold):
                    found |= {tuple(sorted(p)) for p in pairs.tolist()}
    known = [set(s.tolist()) for s in sets]
    expected = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if len(known[a] & known[b]) >= threshold * len(known[a] | known[b])}
    assert expected <= found and len(expected) >= (1 if threshold == 1 else 30)


def test_disk_is_bounded_by_passes(spark, monkeypatch):
    """What a pass moves is bounded by the bags at any size, passes find what one finds, and no shuffle files stay."""
    from pathlib import Path

    def bags_of(times):
        return {n: 1000 * times for n in range(60, 400)}

    for times in (1, 1000):
        sizes = bags_of(times)
        kinds, places, passes, tasks = nearpairs._planned(sizes, 0.7, 6)
        moved = np.zeros(passes)
        for number, where in places.items():
            low, _, partner, count, words = kinds[number]
            each = sum(c * (20 + 8 * words + 4 * n / count) for n, c in sizes.items() if low <= n <= partner)
            np.add.at(moved, where // tasks, each)
        assert moved.max() <= 1.1 * max(nearpairs.PASS_LEAST, nearpairs.PASS_SHARE * 4 * sum(n * c for n, c in sizes.items()))
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: {p for d in manager.localDirs() for p in Path(d.getPath()).rglob("shuffle_*.data")}
    df = spark.createDataFrame(records(23, 40, 90), "id bigint, a string, b string").repartition(4)
    before = kept()
    nearpairs._staged(df.repartition(3, "id"), "moved")
    for _ in range(50):
        if kept() <= before:
            break
        time.sleep(0.1)
    assert kept() <= before
    found = []
    for least in (nearpairs.PASS_LEAST, 100_000):
        monkeypatch.setattr(nearpairs, "PASS_LEAST", least)
        found.append({tuple(r) for r in nearpairs.links(df, "id", ["a", "b"])[0].collect()})
    assert found[0] == found[1] and len(found[0]) > 10
