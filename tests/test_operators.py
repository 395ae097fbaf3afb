"""Conversations, near-duplicates, components, sampling and relational operators."""

import random

import pytest
from pyspark.sql import functions as F

from chatloom.functions import cleaners, filters
from chatloom.operators import conversation, edits, minhash, relational, sampling
from chatloom.operators.components import connected_components
from chatloom.plans import pipeline, registry
from chatloom.sources import files

SCHEMA = "record_id bigint, conversation array<struct<content string, do_train boolean, role string>>, source string"
ROWS = [
    (1, [("sys", False, "System"), (" hi ", False, "User"), ("yo", True, "Assistant"), ("more", True, "Assistant")], "a"),
    (2, [("first", True, "Assistant")], None),
    (3, [("q", False, "User"), (None, None, "Assistant")], "a"),
    (4, [], "a"),
    (5, None, "a"),
    (6, [(None, False, "User"), (None, True, "Assistant")], "b"),
]


def test_conversations(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = conversation.add_content_columns(conversation.to_input_output(df, keep=("record_id",)))
    found = {(r.record_id, r.turn): (len(r.input), r.instruction, r.response, r.source) for r in rows.collect()}
    assert found == {(1, 2): (2, "hi", "yo", "a"), (1, 3): (3, "yo", "more", "a"), (2, 0): (0, "", "first", None), (6, 1): (1, None, None, "b")}
    rebuilt = {(r.record_id, r.turn): [tuple(m) for m in r.conversation] for r in conversation.rebuild(rows, keep=("record_id", "turn")).collect()}
    assert rebuilt[1, 3] == [("sys", False, "System"), (" hi ", False, "User"), ("yo", False, "Assistant"), ("more", True, "Assistant")]
    texts = {r.record_id: r.text for r in conversation.training_text(df).collect()}
    assert texts == {1: "yo\n\nmore", 2: "first", 3: "", 4: "", 5: None, 6: ""}
    assert conversation.to_input_output(df.limit(0)).count() == 0


def test_edits(spark):
    df = spark.createDataFrame([("in", " out\n2 ", 7, "r", "x"), ("in", None, None, "r", "y")], "model_input string, edited_response string, user_id int, response string, extra string")
    prepared = edits.prepare_edits(df)
    assert prepared.columns == ["input_text", "output_text", "user_id", "response"]
    assert [r.pair for r in edits.add_concatenated_column(prepared, "pair", "|").collect()] == ["r| out\n2 ", None]
    assert [r.output_text for r in edits.post_process_output_text(prepared).collect()] == [" out2\n", None]
    assert edits.rename_dry_run_columns(prepared.withColumn("a__b", F.lit(1)), "x").columns == ["input_text", "output_text", "user_id", "x__response", "a__b"]
    assert edits.remove_unused_columns(prepared).columns == ["user_id", "input_text", "output_text"]


def test_pinned_minhash():
    a, b = minhash.permutations(256)
    assert a[:3].tolist() == [2297359619001564596, 1973689801170867272, 572192888165898362]
    assert b[:3].tolist() == [1396682528897996046, 1819927849474927636, 571748048327668950]
    assert (int(a[255]), int(b[255])) == (2092141031243851673, 797693216700694537)
    assert minhash.permutations(256, 256)[0][:3].tolist() == [1064902540256928542, 834137264395293701, 26994250752258422]
    assert [minhash.optimal_bands(t, n) for t, n in ((0.7, 256), (0.7, 128), (0.8, 256), (0.5, 256), (0.9, 256))] == [(25, 10), (14, 9), (17, 15), (42, 6), (9, 28)]


def test_signatures(spark):
    texts = ["a b c d e", "The quick brown fox jumps over the lazy dog.", "", "a b c d", "a, b c", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = {r.id: r.signature[:4] for r in minhash.signatures(df, "id", "t").collect()}
    assert found[0] == [1325523712, 3176138254, 1937760049, 3728888456]
    assert found[1] == [644089754, 59101012, 343111293, 301791095]
    assert all(found[i] == [4294967295] * 4 for i in (2, 3, 4, 5))


def test_deduplicate(spark):
    base = " ".join(f"w{i}" for i in range(80))
    texts = [base, base + " x", "short", "tiny", None, "quite another text of seven words here", base]
    df = spark.createDataFrame([(i + 10, t, i) for i, t in enumerate(texts)], "id int, t string, band int").repartition(4)
    assert sorted(r.id for r in minhash.deduplicate(df, "id", "t").collect()) == [10, 12, 15]
    assert sorted(r.id for r in minhash.deduplicate(df, "id", "t", intended=True).collect()) == [10, 12, 13, 14, 15]
    kept = minhash.deduplicate(df, "id", "t").drop("__cluster__")
    assert minhash.deduplicate(kept, "id", "t").count() == 3
    assert minhash.deduplicate(df.limit(0), "id", "t").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 400)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {x: find(x) for x in parent}


def test_sampling(spark):
    rows = [(u, f"{u}-{i}", i) for u, n in ((1, 4), (2, 5), (3, 7), (None, 9), (4, 900)) for i in range(n)]
    df = spark.createDataFrame(rows, "user_id int, key string, __part int").repartition(5)
    drawn = sampling.sample_by_group(df, 0.5, F.col("key"))
    assert drawn.columns == df.columns
    sizes = {r.user_id: r["count"] for r in drawn.groupBy("user_id").count().collect()}
    assert sizes == {1: 4, 2: 2, 3: 3, 4: 450}
    again = {r.key for r in sampling.sample_by_group(df.repartition(2), 0.5, F.col("key")).collect()}
    assert again == {r.key for r in drawn.collect()}
    mixed = sampling.sample_datasets([df.where("user_id = 4"), df.where("user_id < 4")], [0.9, 0.1], 1e9, "key")
    assert mixed.groupBy().count().first()[0] > 100
    assert sorted(r.key for r in sampling.shuffled(df, "key").collect()) == sorted(k for _, k, _ in rows)
    assert sampling.sample_by_group(df.limit(0), 0.5, F.col("key")).count() == 0


def test_relational(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (1, "a")], "id int, t string")
    assert relational.subtract(df, df.where("id = 1"), "id").count() == 2
    kept, dropped = relational.split_by(df, F.col("t") == "a")
    assert (kept.count(), dropped.count()) == (2, 2)
    both = relational.combine({"x": df, "y": df.withColumn("source", F.lit("own"))})
    assert {r.source for r in both.select("source").distinct().collect()} == {"x", "own"}
    row = relational.describe(df, "id").first()
    assert (row["count"], row["q50"], row["max"]) == (3, 1.0, 2.0)
    assert relational.describe(df.limit(0), "id").first()["count"] == 0


def test_pipeline(spark):
    config = {
        "response_config": {"cleaners": {"fix_utf8_encoding": True, "clean_new_lines": False}, "filters": {"check_word_number": {"args": {"min_word_threshold": 1, "max_word_threshold": 9}}, "check_ethics": None}, "deduplication": {"do_deduplication": True}},
        "instruction_config": {"cleaners": None, "filters": None},
    }
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = pipeline.run_conversations(df, config, "record_id")
    assert out.columns == ["conversation", "source"]
    assert out.count() == 1  # short answers fall into one cluster
    assert pipeline.run_conversations(df, config, "record_id", intended=True).count() == 3
    assert pipeline.run_conversations(df.limit(0), config, "record_id").count() == 0
    with pytest.raises(ValueError):
        registry.filter_of("__import__")
    dry = pipeline.apply_filters(spark.createDataFrame([("a b",), (None,)], "t string"), "t", registry.output_filters(True), dry_run=True)
    assert "t_check_nsfw_words_criteria" in dry.columns and dry.count() == 2
    job = pipeline.Pipeline([{"dataset": spark.createDataFrame([("a",), ("b c",)], "t string"), "columns": ["t"], "filters": [registry.python_filter(lambda t: len(t) > 1)], "cleaners": [registry.python_cleaner(str.upper)]}])
    job.run()
    assert [r.t for r in job.datasources[0]["dataset"].collect()] == ["B C"]
    one = pipeline.Preprocessor(spark.createDataFrame([("a b c d e f",), ("x",)], "t string"), "t", filters=[registry.filter_of("check_word_number")])
    assert one.run().count() == 1
    assert [o.get["rows"] for _, o in one.counts] == [2, 1]
    with pytest.raises(ValueError):
        pipeline.Preprocessor(df, "source", deduplication={"do_deduplication": True}).run()


def test_files(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("t")).repartition(3)
    files.write(df, str(tmp_path / "p"))
    files.write(df, str(tmp_path / "j.json"), "json")
    both = files.load_all(spark, [str(tmp_path / "p"), str(tmp_path / "j.json")], "row_id")
    assert both.count() == 20 and both.select("source").distinct().count() == 2
    numbered = files.number(files.load(spark, str(tmp_path / "p")), "n")
    assert sorted(r.n for r in numbered.collect()) == list(range(10))


def test_job_on_several_data_sets(spark, tmp_path):
    """Equal ids of different data sets, null ids and repeated deliveries: only equal rows of an equal id count once."""
    from chatloom.plans import config

    schema = "record_id bigint, conversation array<struct<content: string, do_train: boolean, role: string>>, source string"

    def talk(i, name, n):
        return (i, [("Question " + name, False, "user"), (f"Answer {n} of {name}", True, "bot")], "web")

    sets = {
        "a": spark.createDataFrame([talk(i, "a", i) for i in range(6)] + [talk(0, "a", 0)], schema),
        "b": spark.createDataFrame([talk(i, "b", i) for i in range(6)] + [talk(None, "b", 90), talk(None, "b", 91), talk(None, "b", 91)], schema),
        "c": spark.createDataFrame([talk(0, "c", i) for i in range(5)], schema).drop("record_id"),
        "d": spark.createDataFrame([talk(0, "c", i) for i in range(5)], schema).drop("record_id"),
    }
    for name, df in sets.items():
        files.write(df.coalesce(1), str(tmp_path / name))
    ids = files.load_all(spark, [str(tmp_path / x) for x in "acd"], "record_id").where("conversation[0].content = 'Question c'")
    assert sorted(r.record_id for r in ids.collect()) == list(range(6, 16))
    job = {"datasets": [{"dataset_path": str(tmp_path / x)} for x in sets], "output_dataset_path": str(tmp_path / "out"), "instruction_config": {}, "response_config": {}}
    config.run(spark, job)
    found = sorted(r.conversation[-1].content for r in spark.read.parquet(str(tmp_path / "out")).collect())
    b = [f"Answer {n} of b" for n in (0, 1, 2, 3, 4, 5, 90, 91, 91)]
    assert found == sorted([f"Answer {i} of a" for i in range(6)] + b + 2 * [f"Answer {i} of c" for i in range(5)])


def test_stream(spark, tmp_path):
    from chatloom.streaming import rows

    spark.createDataFrame([(1, "one two three four five six"), (2, "x"), (3, None)], "id int, t string").write.parquet(str(tmp_path / "in"))
    stream = rows.prepare(rows.read(spark, str(tmp_path / "in"), "id int, t string"), "t", registry.input_cleaners(True), [registry.filter_of("check_word_number")])
    query = rows.write_deduplicated(stream, "id", "t", str(tmp_path / "out"), str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]


def test_logs_samples_and_wrappers(spark, tmp_path):
    from chatloom.operators.relational import describe_values
    from chatloom.plans.pipeline import Preprocessor, dropped_examples, filter_log, run_cleaner, run_filter
    from chatloom.sources import files

    rows = [(f"id{i}", "one two three four five six." if i % 2 else "one") for i in range(10)] + [("null", None)]
    df = spark.createDataFrame(rows, "key string, text string")
    some = [filters.check_word_number(), filters.check_completion()]
    assert [tuple(r) for r in filter_log(df, "text", some).orderBy("step").collect()] == [(0, "check_word_number", 11, 5, 54.55), (1, "check_completion", 5, 5, 0.0)]
    assert [r.rows_in for r in filter_log(df.limit(0), "text", some).collect()] == [0, 0]
    dropped = dropped_examples(df, "text", some[0], "key", 3).collect()
    assert len(dropped) == 3 and all(r.text in ("one", None) for r in dropped)
    assert run_filter(df, "text", some[0]).count() == 5 and "text_check_word_number_criteria" in run_filter(df, "text", some[0], dry_run=True).columns
    assert {r.text for r in run_cleaner(df, "text", [cleaners.clean_new_lines]).collect()} == {r[1] for r in rows}
    job = Preprocessor(df, "text", filters=some, key="key", verbose=True)
    assert job.run().count() == 5 and job.report()[0].endswith("54.55% = 6 samples reduced, 5 rows left")
    assert tuple(describe_values(df.select((df.text == "one").alias("s")), "s").first()) == (10, 2, "false", 5)
    assert describe_values(df.limit(0).select((df.text == "one").alias("s")), "s").first()["count"] == 0
    # a split by folder and by file name; text ids
    edits_rows = spark.createDataFrame([(1, "in", "out", "old")], "user_id int, model_input string, edited_response string, response string")
    edits_rows.write.parquet(f"{tmp_path}/a/train")
    edits_rows.write.parquet(f"{tmp_path}/a/test")
    edits_rows.write.parquet(f"{tmp_path}/b/data/train-0.parquet")
    for folder in "ab":
        assert [r.output_text for r in files.load_edits(spark, f"{tmp_path}/{folder}").collect()] == ["out"]
    with pytest.raises(ValueError):
        files.load_edits(spark, f"{tmp_path}/b", "validation")
