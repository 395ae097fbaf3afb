"""Queries of the training-data operators over their whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _p1_found(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import lookalike

    return lookalike.same_look_pairs(lookalike.messages(table(spark, d, "chat_record"), once=False), ["record_id", "turn"], "content")


def _p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """The same without pairs: the class of each such message and the number of its links."""
    from chatloom.llm import lookalike

    return lookalike.same_look_classes(lookalike.messages(table(spark, d, "chat_record"), once=False), ["record_id", "turn"], "content")


def _p1_canonical(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import lookalike

    return lookalike.canonical(lookalike.messages(table(spark, d, "chat_record")), "content").select("record_id", "turn", "canonical")


def _size() -> Column:
    return F.length(F.coalesce("instruction", F.lit(""))) + F.length(F.coalesce("response", F.lit("")))


def _p2_mixture(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import mixing

    return mixing.mix(table(spark, d, "dataset"), "pair_id", "source", _size(), table(spark, d, "mix_target"))


def _p2_report(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import mixing

    return mixing.report(_p2_mixture(spark, d), table(spark, d, "mix_target"), "pair_id", table(spark, d, "dataset"))


def _p3_scored(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import abuse

    labelled = abuse.labelled_rows(table(spark, d, "abuse_label"), "text", "is_abusive")
    model = abuse.train(labelled, abuse.background_rows(table(spark, d, "documents"), "text"))
    return abuse.score(table(spark, d, "dataset").select("pair_id", "source", "response"), "response", model).drop("response")


def _p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _p3_scored(spark, d).where("abusive").select("pair_id").distinct()


def _p3_score(spark: SparkSession, d: str) -> DataFrame:
    return _p3_scored(spark, d).groupBy("pair_id").agg(F.max("score").alias("score"))


def _p3_rates(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import abuse, mixing

    scored = _p3_scored(spark, d).withColumn("source", mixing.source_name(F.col("source")))
    return abuse.rates(scored.groupBy("pair_id").agg(F.min("source").alias("source"), F.max("abusive").alias("abusive")), "source")


def _p4_restored(spark: SparkSession, d: str) -> DataFrame:
    """The affected messages and their content as it was written, as far as it can be told."""
    from chatloom.llm import lookalike, mojibake

    return mojibake.garbled(lookalike.messages(table(spark, d, "chat_record")), "content").where("garbled").select("record_id", "turn", "restored")


def _p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _p4_restored(spark, d).select("record_id", "turn").distinct()


def _p5_found(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import repetition

    return repetition.repetitive(table(spark, d, "dataset"), "pair_id", "response", "lang")


def _p5_share(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import repetition

    return repetition.repetition(table(spark, d, "dataset"), "pair_id", "response", "lang").drop("candidate").distinct()


def _p6_found(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import defects

    return defects.defects(table(spark, d, "dataset"), "pair_id", "instruction", "response")


def _p7_links(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    from chatloom.llm import nearpairs

    return nearpairs.links(table(spark, d, "dataset"), "pair_id", ["instruction", "response"])


def _p7_found(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import nearpairs

    return nearpairs.all_pairs(*_p7_links(spark, d), "pair_id")


def _p7_groups(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import nearpairs

    return nearpairs.groups(*_p7_links(spark, d), "pair_id")


def _p8_ids(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import tokens

    return tokens.encode(table(spark, d, "documents"), "doc_id", "text")


def _p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The texts again, from their ids."""
    from chatloom.llm import tokens

    return tokens.decode(_p8_ids(spark, d), "doc_id", "ids")


def _p9_containers(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import packing, tokens

    return packing.pack(tokens.sizes(table(spark, d, "documents"), "doc_id", "text"), "doc_id", "tokens", 2048)


def _p10_found(spark: SparkSession, d: str) -> DataFrame:
    """The documents that the cutting of oversized texts has pieces of."""
    return _p10_pieces(spark, d).where("piece = 0").select("doc_id").distinct()


def _p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    from chatloom.llm import splitting

    return splitting.split(table(spark, d, "documents"), "doc_id", "text")


def queries() -> dict[str, Query]:
    return {
        "p1_found": _p1_found,
        "p1_classes": _p1_classes,
        "p1_canonical": _p1_canonical,
        "p2_mixture": _p2_mixture,
        "p2_report": _p2_report,
        "p3_found": _p3_found,
        "p3_score": _p3_score,
        "p3_rates": _p3_rates,
        "p4_found": _p4_found,
        "p4_restored": _p4_restored,
        "p5_found": _p5_found,
        "p5_share": _p5_share,
        "p6_found": _p6_found,
        "p7_found": _p7_found,
        "p7_groups": _p7_groups,
        "p8_ids": _p8_ids,
        "p8_decoded": _p8_decoded,
        "p9_containers": _p9_containers,
        "p10_found": _p10_found,
        "p10_pieces": _p10_pieces,
    }


#: The links of records of 60 and more words whose bags agree to 70 %, by comparing all pairs that share a word.
_NEAR = r"""once AS (SELECT DISTINCT pair_id, lower(coalesce(instruction, '') || chr(10) || coalesce(response, '')) AS text FROM dataset WHERE pair_id IS NOT NULL),
    words AS (SELECT pair_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS word FROM once),
    bags AS (SELECT pair_id, word, count(*) AS n FROM words GROUP BY ALL),
    sizes AS (SELECT pair_id, sum(n) AS size FROM bags GROUP BY ALL HAVING size >= 60),
    held AS (SELECT pair_id, word, n FROM bags SEMI JOIN sizes USING (pair_id)),
    shared AS (SELECT a.pair_id AS a, b.pair_id AS b, sum(least(a.n, b.n)) AS met FROM held a JOIN held b ON a.word = b.word AND a.pair_id < b.pair_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN sizes x ON x.pair_id = a JOIN sizes y ON y.pair_id = b WHERE met >= 0.7 * (x.size + y.size - met) - 1e-9)"""


def oracle_sql() -> dict[str, str]:
    return {
        # what was encoded comes back
        "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
        "p5_found": r"""WITH t AS (SELECT row_number() OVER () AS id, pair_id, regexp_extract_all(lower(response), '[\p{L}\p{N}]+') AS w FROM dataset),
            p AS (SELECT id, pair_id, len(w) AS n, unnest(range(1, len(w) + 1)) AS i, w FROM t),
            g AS (SELECT id, pair_id, n, i, CASE WHEN i + 3 <= n THEN array_to_string(w[i:i + 3], ' ') END AS gram FROM p),
            f AS (SELECT id, pair_id, n, i, gram IS NOT NULL AND row_number() OVER (PARTITION BY id, gram ORDER BY i) > 1 AS again FROM g),
            c AS (SELECT id, pair_id, n, max(again::INT) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS covered FROM f)
            SELECT DISTINCT pair_id FROM (SELECT id, pair_id, sum(covered) / max(n) AS share FROM c GROUP BY ALL) WHERE share >= 0.3""",
        "p7_found": f"WITH {_NEAR} SELECT a AS pair_id_a, b AS pair_id_b FROM links",
        "p7_groups": f"""WITH RECURSIVE {_NEAR}, ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
            reached AS (SELECT pair_id AS node, pair_id AS least FROM sizes UNION SELECT w.b, r.least FROM reached r JOIN ways w ON w.a = r.node WHERE r.least < w.b)
            SELECT pair_id, min(least) AS "group", (SELECT count(*) FROM ways w WHERE w.a = pair_id) AS links FROM sizes JOIN reached ON node = pair_id GROUP BY pair_id""",
    }
