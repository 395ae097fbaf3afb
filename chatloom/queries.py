"""Queries of the core operators over their whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import cleaners, filters, lexicons, lm
from chatloom.operators import conversation, edits, minhash, relational, sampling
from chatloom.operators.components import connected_components
from chatloom.plans import registry
from chatloom.plans.pipeline import apply_cleaners, dropped_examples, filter_log, run_conversations, statistics
from chatloom.session import spread, table

Query = Callable[[SparkSession, str], DataFrame]

#: The configuration of the small example: answers of ten words and more without policy phrases, both sides deduplicated.
EXAMPLE = {
    "instruction_config": {"filters": {"check_word_number": {"args": {"min_word_threshold": 2, "max_word_threshold": 9999999}}}, "deduplication": {"do_deduplication": True}},
    "response_config": {
        "cleaners": {"fix_utf8_encoding": True},
        "filters": {"check_word_number": {"args": {"min_word_threshold": 10, "max_word_threshold": 9999999}}, "check_ethics": None},
        "deduplication": {"do_deduplication": True},
    },
}


def conversation_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """The whole job of the small example."""
    return run_conversations(table(spark, d, "chat_record"), EXAMPLE, "record_id", shuffle=False)


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def _score(make: Callable[[], filters.Filter]) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        one = make()
        return _documents(spark, d).select("doc_id", one.score(F.col("text")).alias("score"), one.keeps(F.col("text")).alias("keep"))

    return query


def _clean(clean: registry.Cleaner) -> Query:
    return lambda spark, d: _documents(spark, d).select("doc_id", clean(F.col("text")).alias("text"))


def _input_output(spark: SparkSession, d: str) -> DataFrame:
    return conversation.add_content_columns(conversation.to_input_output(table(spark, d, "chat_record"), keep=("record_id",)))


def _explode(spark: SparkSession, d: str) -> DataFrame:
    rows = _input_output(spark, d)
    return rows.select("record_id", "turn", F.size("input").cast("bigint").alias("n_input"), "instruction", "response", F.col("output.role").alias("role"), "source")


def _as_text(column: str) -> F.Column:
    parts = F.transform(column, lambda m: F.concat_ws("|", m["role"], m["do_train"].cast("string"), m["content"]))
    return F.array_join(parts, "\n")


def _rebuild(spark: SparkSession, d: str) -> DataFrame:
    rebuilt = conversation.rebuild(_input_output(spark, d), keep=("record_id", "turn"))
    return rebuilt.select("record_id", "turn", _as_text("conversation").alias("conversation"), "source")


def _training_text(spark: SparkSession, d: str) -> DataFrame:
    return conversation.training_text(table(spark, d, "chat_record")).select("record_id", "text")


def _prepared(spark: SparkSession, d: str) -> DataFrame:
    return edits.prepare_edits(table(spark, d, "edit_row"))


def _edit_pairs(spark: SparkSession, d: str, token: str) -> DataFrame:
    renamed = table(spark, d, "edit_row").select("edit_id", "response", F.col("edited_response").alias("output_text"))
    return edits.add_concatenated_column(renamed, "pair", token)


def _truncation(spark: SparkSession, d: str) -> DataFrame:
    one = filters.check_truncation()
    return _edit_pairs(spark, d, "<|truncation_splitter|>").select("edit_id", one.keeps(F.col("pair")).alias("keep"))


def _gender(spark: SparkSession, d: str) -> DataFrame:
    one = filters.check_gender()
    return _edit_pairs(spark, d, "<|gender_splitter|>").select("edit_id", one.keeps(F.col("pair")).alias("keep"))


def _post_processed(spark: SparkSession, d: str) -> DataFrame:
    return edits.post_process_output_text(table(spark, d, "edit_row").select("edit_id", F.col("edited_response").alias("output_text")))


def _renamed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "edit_row").select("user_id", F.length("response").cast("bigint").alias("n_chars"), F.col("edit_id").alias("ready__edit_id"))
    return edits.rename_dry_run_columns(rows, "length")


def _split(kept: bool) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        keep, drop = relational.split_by(_documents(spark, d), filters.check_word_number(20, 200).keeps(F.col("text")))
        return (keep if kept else drop).select("doc_id")

    return query


def _subtract(spark: SparkSession, d: str) -> DataFrame:
    return relational.subtract(table(spark, d, "dataset").select("pair_id", "lang"), table(spark, d, "edit_row"), "pair_id")


def _union(spark: SparkSession, d: str) -> DataFrame:
    parts = {"documents": table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source"), "edits": table(spark, d, "edit_row").select(F.col("edit_id").alias("id"))}
    return relational.combine(parts).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def _describe(spark: SparkSession, d: str) -> DataFrame:
    scored = _documents(spark, d).withColumn("score", filters.check_word_number().score(F.col("text")))
    found = relational.describe(scored, "score")
    return found.select("count", *[F.round(c, 6).alias(c) for c in found.columns if c != "count"])


def _sample_sizes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dataset").select("pair_id", "user_id", "ingested_at")
    drawn = sampling.sample_by_group(rows, 0.3, F.concat_ws("|", F.col("pair_id").cast("string"), F.unix_micros(F.col("ingested_at").cast("timestamp")).cast("string")))
    return drawn.select("pair_id", "user_id")


def _sample_mixed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dataset").select("pair_id", "user_id", "lang")
    return sampling.sample_datasets([rows.where("lang = 'en'"), rows.where("lang <> 'en'")], [0.5, 0.5], 1e12, "pair_id")


def _shuffled(spark: SparkSession, d: str) -> DataFrame:
    return sampling.shuffled(_documents(spark, d), "doc_id")


def _signatures(spark: SparkSession, d: str) -> DataFrame:
    return minhash.signatures(_documents(spark, d), "doc_id", "text").select("doc_id", F.array_join("signature", ",").alias("signature"))


def _bands(spark: SparkSession, d: str) -> DataFrame:
    signed = minhash.signatures(_documents(spark, d), "doc_id", "text")
    return minhash.band_keys(signed, "doc_id", *minhash.optimal_bands(0.7, 256))


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    found = _documents(spark, d).select("doc_id", minhash.tokens(F.col("text")).alias("words"))
    runs = F.size(minhash.shingles(F.col("words"), 5, 5)).cast("bigint")
    return found.select("doc_id", F.size("words").cast("bigint").alias("tokens"), runs.alias("shingles"))


def _clusters(spark: SparkSession, d: str) -> DataFrame:
    return minhash.cluster(_documents(spark, d), "doc_id", "text", out="cluster").select("doc_id", "cluster")


def _dedup(spark: SparkSession, d: str) -> DataFrame:
    return minhash.deduplicate(_documents(spark, d), "doc_id", "text", out="cluster").select("doc_id")


def _components(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "edit_row").where("pair_id is not null and user_id is not null").select(F.col("pair_id").alias("a"), F.col("user_id").alias("b"))
    return connected_components(edges)


LOGGED = (filters.check_word_number(), filters.check_lowercase_ratio(), filters.check_completion())


def _filter_log(spark: SparkSession, d: str) -> DataFrame:
    return filter_log(_documents(spark, d), "text", list(LOGGED))


def _dropped(spark: SparkSession, d: str) -> DataFrame:
    """Ten of the documents that the word number drops."""
    return dropped_examples(_documents(spark, d), "text", filters.check_word_number(), "doc_id").select("doc_id", "text")


def _statistics(spark: SparkSession, d: str) -> DataFrame:
    return statistics(_documents(spark, d), "text", filters.check_empty())


def _pipeline_filters(spark: SparkSession, d: str) -> DataFrame:
    """The small example without deduplication."""
    config = {side: {k: v for k, v in value.items() if k == "filters"} for side, value in EXAMPLE.items()}
    found = run_conversations(table(spark, d, "chat_record"), config, "record_id", shuffle=False)
    return found.select(_as_text("conversation").alias("conversation"), "source")


def _presets(spark: SparkSession, d: str) -> DataFrame:
    """Which documents pass the preset of answers after its (intended) cleaners."""
    df = apply_cleaners(_documents(spark, d), "text", registry.output_cleaners(intended=True))
    for one in registry.output_filters(explicit_words=True):
        df = df.where(one.keeps(F.col("text")))
    return df.select("doc_id")


def queries() -> dict[str, Query]:
    return {
        "conversation_pipeline": conversation_pipeline,
        "pipeline_filters": _pipeline_filters,
        "preset_answers": _presets,
        "explode_conversations": _explode,
        "rebuild_conversations": _rebuild,
        "training_text": _training_text,
        "prepare_edits": _prepared,
        "edit_columns": lambda spark, d: edits.remove_unused_columns(_prepared(spark, d)),
        "rename_dry_run": _renamed,
        "post_process": _post_processed,
        "clean_utf8": _clean(cleaners.fix_utf8_encoding),
        "clean_whitespace": _clean(cleaners.normalize_whitespace),
        "clean_punctuation": _clean(cleaners.normalize_punctuation),
        "clean_empty_lines": _clean(cleaners.remove_empty_lines),
        "clean_empty_lines_intended": _clean(lambda c: cleaners.remove_empty_lines(c, intended=True)),
        "clean_new_lines": _clean(cleaners.clean_new_lines),
        "word_number": _score(filters.check_word_number),
        "nsfw_words": _score(filters.check_nsfw_words),
        "lowercase_ratio": _score(filters.check_lowercase_ratio),
        "char_repetition": _score(filters.check_char_repetition),
        "completion": _score(filters.check_completion),
        "empty": _score(filters.check_empty),
        "ethics": _score(filters.check_ethics),
        "ethics_harsh": _score(filters.check_ethics_harsh),
        "ethics_intended": _score(lambda: filters.check_ethics_harsh(intended=True)),
        "perplexity": _score(lambda: filters.check_perplexity(lm.LanguageModel(lm.SAMPLE_ARPA), 1, 100)),
        "truncation": _truncation,
        "gender": _gender,
        "split_kept": _split(True),
        "split_dropped": _split(False),
        "subtract": _subtract,
        "union_sources": _union,
        "describe_scores": _describe,
        "describe_flags": _statistics,
        "filter_log": _filter_log,
        "dropped_examples": _dropped,
        "sample_by_user": _sample_sizes,
        "sample_mixed": _sample_mixed,
        "shuffle": _shuffled,
        "minhash_tokens": _tokens,
        "minhash_signatures": _signatures,
        "lsh_bands": _bands,
        "near_duplicate_clusters": _clusters,
        "near_duplicates_removed": _dedup,
        "components": _components,
    }


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


def oracle_sql() -> dict[str, str]:
    from chatloom.functions.text import WHITESPACE

    white = "concat(" + ", ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"
    words = r"CAST(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS BIGINT)"
    strip = lambda x: f"trim({x}, {white})"
    line_end = r"\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
    scored = lambda score, keep: f"SELECT doc_id, score, coalesce({keep}, false) AS keep FROM (SELECT doc_id, {score} AS score FROM documents)"
    phrases = lambda found: scored(f"CASE WHEN text IS NULL THEN NULL ELSE len(list_filter({_list(found)}, lambda w: contains(lower(text), w))) = 0 END", "score")
    hits = f"CAST(list_sum(list_transform({_list(lexicons.EXPLICIT)}, lambda w: (length(lower(text)) - length(replace(lower(text), w, ''))) // length(w))) AS BIGINT)"
    spaces, marks = lexicons.SPACES, lexicons.PUNCTUATION
    chars = lambda s: "concat(" + ", ".join(f"chr({ord(c)})" for c in s) + ")"
    punctuation = "text"
    for mark, plain in marks.items():
        punctuation = f"replace({punctuation}, {_text(mark)}, {_text(plain)})"
    turns = "FROM (SELECT record_id, source, conversation, unnest(range(len(conversation))) AS turn FROM chat_record) WHERE conversation[turn + 1].do_train"
    instruction = f"CASE WHEN turn > 0 THEN {strip('conversation[turn].content')} ELSE '' END"
    response = strip("conversation[turn + 1].content")
    shown = lambda m, content, train: f"concat_ws('|', {m}.role, {train}, {content})"
    before = f"array_to_string(list_transform(conversation[1:turn], lambda m: {shown('m', 'm.content', _text('false'))}), chr(10))"
    answer = shown("conversation[turn + 1]", response, _text("true"))
    rebuilt = f"CASE WHEN turn > 0 THEN concat({before}, chr(10), {answer}) ELSE {answer} END"
    one_line = lambda x: f"replace({strip(x)}, chr(10), '')"
    count_words = lambda x: rf"len(regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+'))"
    clean = f"list_filter({_list(lexicons.policy_phrases())}, lambda w: contains(lower({response}), w))"
    passing = f"{count_words(response)} BETWEEN 10 AND 9999999 AND len({clean}) = 0 AND {count_words(instruction)} BETWEEN 2 AND 9999999"
    filled = "replace(replace(text, '...', ''), '…', '')"
    joined = strip("array_to_string(list_transform(list_filter(conversation, lambda m: m.do_train), lambda m: m.content), chr(10) || chr(10))")
    by_row, by_key = "concat_ws('|', pair_id, epoch_us(ingested_at))", "concat_ws('|', pair_id, 42)"
    drawn = lambda rows, order, size: f"""SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n_, row_number() OVER (PARTITION BY user_id ORDER BY md5({order})) AS r_
        FROM {rows} WHERE user_id IS NOT NULL) WHERE n_ < 5 OR r_ <= floor(n_ * {size})"""  # noqa: E731
    return {
        "pipeline_filters": f"SELECT conversation, source FROM (SELECT DISTINCT record_id, turn, {rebuilt} AS conversation, source {turns} AND {passing})",
        "explode_conversations": f"SELECT record_id, turn, turn AS n_input, {instruction} AS instruction, {response} AS response, conversation[turn + 1].role AS role, source {turns}",
        "rebuild_conversations": f"SELECT record_id, turn, {rebuilt} AS conversation, source {turns}",
        "training_text": f"SELECT record_id, CASE WHEN conversation IS NOT NULL THEN coalesce({joined}, '') END AS text FROM chat_record",
        "prepare_edits": "SELECT model_input AS input_text, edited_response AS output_text, user_id, response FROM edit_row",
        "edit_columns": "SELECT user_id, model_input AS input_text, edited_response AS output_text FROM edit_row",
        "rename_dry_run": "SELECT user_id, CAST(length(response) AS BIGINT) AS length__n_chars, edit_id AS ready__edit_id FROM edit_row",
        "post_process": f"SELECT edit_id, ' ' || {one_line('edited_response')} || chr(10) AS output_text FROM edit_row",
        "clean_whitespace": f"SELECT doc_id, translate(text, {chars(spaces)}, {_text(' ' * len(spaces))}) AS text FROM documents",
        "clean_punctuation": f"SELECT doc_id, {punctuation} AS text FROM documents",
        "clean_empty_lines": "SELECT doc_id, CASE WHEN text IS NOT NULL THEN '' END AS text FROM documents",
        "clean_empty_lines_intended": f"SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(list_filter(regexp_split_to_array(text, '{line_end}'), lambda x: {strip('x')} <> ''), chr(10)), '') END AS text FROM documents",
        "clean_new_lines": f"SELECT doc_id, {one_line('text')} AS text FROM documents",
        "word_number": scored(words, "score BETWEEN 5 AND 512"),
        "nsfw_words": scored(f"CASE WHEN {words} > 0 THEN {hits} / {words} WHEN text IS NOT NULL THEN 0.0 END", "score <= 0.025"),
        "lowercase_ratio": scored("CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^a-z]', '', 'g')) / length(text) WHEN text IS NOT NULL THEN 0.0 END", "score >= 0.75"),
        "completion": scored(f"CAST(list_contains({_list(lexicons.COMPLETED)}, right({strip('text')}, 1)) AS INT)", "score = 1"),
        "empty": scored(f"{strip(filled)} <> ''", "score"),
        "ethics": phrases(lexicons.policy_phrases()),
        "ethics_harsh": phrases(lexicons.harsh_phrases()),
        "ethics_intended": phrases(lexicons.harsh_phrases(True)),
        "truncation": "SELECT edit_id, coalesce(NOT contains(response, edited_response), false) AS keep FROM edit_row",
        "gender": f"""WITH w AS (SELECT edit_id, list_filter(regexp_split_to_array(lower(response), '[' || {white} || ']+'), lambda x: x <> '') AS a,
            list_filter(regexp_split_to_array(lower(edited_response), '[' || {white} || ']+'), lambda x: x <> '') AS b FROM edit_row)
            SELECT edit_id, coalesce(len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i] AND list_contains({_list(lexicons.GENDERED)}, a[i]) AND list_contains({_list(lexicons.GENDERED)}, b[i]))) > 0, false) AS keep FROM w""",
        "split_kept": f"SELECT doc_id FROM documents WHERE coalesce({words} BETWEEN 20 AND 200, false)",
        "split_dropped": f"SELECT doc_id FROM documents WHERE NOT coalesce({words} BETWEEN 20 AND 200, false)",
        "subtract": "SELECT pair_id, lang FROM dataset d WHERE NOT EXISTS (SELECT 1 FROM edit_row e WHERE e.pair_id = d.pair_id)",
        "union_sources": "SELECT source, count(*) AS n FROM (SELECT source FROM documents UNION ALL SELECT 'edits' FROM edit_row) GROUP BY source",
        "describe_scores": f"""SELECT count(s) AS count, round(avg(s), 6) AS mean, round(stddev_samp(s), 6) AS std, round(CAST(min(s) AS DOUBLE), 6) AS min,
            round(quantile_cont(s, 0.25), 6) AS q25, round(quantile_cont(s, 0.5), 6) AS q50, round(quantile_cont(s, 0.75), 6) AS q75,
            round(CAST(max(s) AS DOUBLE), 6) AS max FROM (SELECT {words} AS s FROM documents)""",
        "sample_by_user": f"SELECT pair_id, user_id FROM ({drawn('dataset', by_row, '0.3::DOUBLE')})",
        "sample_mixed": f"""WITH s AS (SELECT count(*) FILTER (lang = 'en') AS a, count(*) FILTER (lang <> 'en') AS b FROM dataset)
            SELECT pair_id, user_id, lang FROM ({drawn("(SELECT * FROM dataset WHERE lang = 'en')", by_key, "(SELECT least(1e12, a / 0.5, b / 0.5) * 0.5::DOUBLE / a FROM s)")})
            UNION ALL SELECT pair_id, user_id, lang FROM ({drawn("(SELECT * FROM dataset WHERE lang <> 'en')", by_key, "(SELECT least(1e12, a / 0.5, b / 0.5) * 0.5::DOUBLE / b FROM s)")})""",
        "describe_flags": f"""WITH c AS (SELECT ({strip(filled)} <> '')::VARCHAR AS value, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1)
            SELECT CAST(sum(n) AS BIGINT) AS count, count(*) AS unique, arg_min(value, struct_pack(n := -n, value := value)) AS top, max(n) AS freq FROM c""",
        "filter_log": f"""WITH d AS (SELECT coalesce({words} BETWEEN 5 AND 512, false) AS a,
                coalesce(CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^a-z]', '', 'g')) / length(text) WHEN text IS NOT NULL THEN 0.0 END >= 0.75, false) AS b,
                coalesce(list_contains({_list(lexicons.COMPLETED)}, right({strip('text')}, 1)), false) AS c FROM documents),
            s AS (SELECT 0 AS step, 'check_word_number' AS filter, count(*) AS rows_in, count(*) FILTER (a) AS rows_out FROM d
                UNION ALL SELECT 1, 'check_lowercase_ratio', count(*) FILTER (a), count(*) FILTER (a AND b) FROM d
                UNION ALL SELECT 2, 'check_completion', count(*) FILTER (a AND b), count(*) FILTER (a AND b AND c) FROM d)
            SELECT step, filter, rows_in, rows_out, CASE WHEN rows_in > 0 THEN round(100 * (rows_in - rows_out) / rows_in, 2) ELSE 0.0 END AS reduced_percent FROM s""",
        "dropped_examples": f"SELECT doc_id, text FROM documents WHERE NOT coalesce({words} BETWEEN 5 AND 512, false) ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 10",
        "shuffle": "SELECT doc_id, text FROM documents",
        "minhash_tokens": """WITH t AS (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '[^A-Za-z_0-9]') AS w FROM documents),
            s AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS tokens, list_distinct(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS r FROM t)
            SELECT doc_id, tokens, CAST(len(r) AS BIGINT) AS shingles FROM s""",
        "components": """WITH RECURSIVE e AS (SELECT DISTINCT pair_id AS a, user_id AS b FROM edit_row WHERE pair_id IS NOT NULL AND user_id IS NOT NULL),
            g AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
            r AS (SELECT a AS node, least(a, b) AS c FROM g UNION SELECT g.b, r.c FROM r JOIN g ON g.a = r.node WHERE r.c < g.b)
            SELECT node, least(min(c), node) AS component FROM r GROUP BY node""",
    }
