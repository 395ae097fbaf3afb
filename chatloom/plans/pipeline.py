"""The pipeline: cleaners, filters and near-deduplication of a text column, and the whole job over conversations."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chatloom.functions.filters import Filter
from chatloom.operators import conversation, minhash
from chatloom.operators.relational import describe, describe_values
from chatloom.operators.sampling import shuffled
from chatloom.plans import registry
from chatloom.session import stage

log = logging.getLogger("chatloom")


def apply_cleaners(df: DataFrame, column: str, cleaners: list[registry.Cleaner]) -> DataFrame:
    for clean in cleaners:
        df = df.withColumn(column, clean(F.col(column)))
    return df


def criteria_column(column: str, one: Filter) -> str:
    return f"{column}_{one.name}_criteria"


def apply_filters(df: DataFrame, column: str, filters: list[Filter], dry_run: bool = False) -> DataFrame:
    """The rows that all filters keep; in a dry run all rows, with a score column per filter."""
    if dry_run:
        return df.withColumns({criteria_column(column, f): f.score(F.col(column)) for f in filters})
    for one in filters:
        df = df.where(one.keeps(F.col(column)))
    return df


def run_filter(df: DataFrame, column: str, one: Filter, dry_run: bool = False) -> DataFrame:
    """One filter over one column: the rows it keeps, or in a dry run all rows and its score."""
    job = Pipeline([{"dataset": df, "columns": [column], "filters": [one]}])
    job.run(dry_run)
    return job.datasources[0]["dataset"]


def run_cleaner(df: DataFrame, column: str, cleaners: list[registry.Cleaner]) -> DataFrame:
    """Cleaners over one column."""
    job = Pipeline([{"dataset": df, "columns": [column], "cleaners": cleaners}])
    job.run(dry_run=True)
    return job.datasources[0]["dataset"]


def statistics(df: DataFrame, column: str, one: Filter) -> DataFrame:
    """The statistics of a filter's scores: mean, deviation and quartiles of numbers, the most frequent value of others."""
    scored = df.select(one.score(F.col(column)).alias("score"))
    return describe_values(scored, "score") if scored.schema["score"].dataType.simpleString() == "boolean" else describe(scored, "score")


def filter_log(df: DataFrame, column: str, filters: list[Filter]) -> DataFrame:
    """(step, filter, rows_in, rows_out, reduced_percent) of filters run one after the other, counted in one pass over ``df``."""
    reached, sums = F.lit(True), []
    for one in filters:
        kept = reached & one.keeps(F.col(column))
        sums += [F.coalesce(F.sum(x.cast("bigint")), F.lit(0)) for x in (reached, kept)]
        reached = kept
    totals = df.agg(*[s.alias(f"n{i}") for i, s in enumerate(sums)])
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(one.name).alias("filter"), F.col(f"n{2 * i}").alias("rows_in"), F.col(f"n{2 * i + 1}").alias("rows_out")) for i, one in enumerate(filters)])
    found = totals.select(F.explode(rows).alias("row")).select("row.*")
    reduced = F.when(F.col("rows_in") > 0, F.round(100 * (F.col("rows_in") - F.col("rows_out")) / F.col("rows_in"), 2)).otherwise(0.0)
    return found.withColumn("reduced_percent", reduced)


def dropped_examples(df: DataFrame, column: str, one: Filter, key: str, samples: int = 10) -> DataFrame:
    """A sample of the rows that a filter drops: the ``samples`` first ones in the order of a hash of ``key``."""
    return df.where(~one.keeps(F.col(column))).orderBy(F.md5(F.col(key).cast("string")), key).limit(samples)


@dataclass
class Pipeline:
    """Sources as mappings with dataset, columns (the first is used), cleaners and filters; ``run`` replaces dataset."""

    datasources: list[dict]

    def run(self, dry_run: bool = False) -> None:
        for source in self.datasources:
            column = source["columns"][0]
            cleaned = apply_cleaners(source["dataset"], column, source.get("cleaners") or [])
            source["dataset"] = apply_filters(cleaned, column, source.get("filters") or [], dry_run)


@dataclass
class Preprocessor:
    """Cleans, filters and, where its configuration says so, deduplicates one column of a data set.

    ``key`` is a stable, unique row id and needed for deduplication. ``skip`` counts the hash functions drawn by earlier
    deduplications of the same job. Counts of each filter are observed in the job that reads the result, without one of
    their own, and found in ``counts`` afterwards.
    """

    dataset: DataFrame
    column_name: str
    cleaners: list[registry.Cleaner] = field(default_factory=list)
    filters: list[Filter] = field(default_factory=list)
    deduplication: dict = field(default_factory=dict)
    key: str | None = None
    dry_run: bool = False
    intended: bool = False
    skip: int = 0
    counts: list[tuple[str, Observation]] = field(default_factory=list)
    #: With ``verbose`` every filter logs the statistics of its scores and, where a key is known, a sample of what it drops.
    verbose: bool = False

    def options(self) -> dict:
        found = self.deduplication.get("args")
        other = self.deduplication.get("minhash_config")
        if other and not self.intended:
            log.warning("deduplication settings under minhash_config have no effect; use args")
        return dict(found or (other if self.intended else None) or {})

    def run(self) -> DataFrame:
        df = apply_cleaners(self.dataset, self.column_name, self.cleaners)
        for one in self.filters:
            if self.verbose:
                log.info("%s on %s:\n%s", one.name, self.column_name, statistics(df, self.column_name, one).first())
                for row in dropped_examples(df, self.column_name, one, self.key).collect() if self.key else ():
                    log.info("dropped: %s", row)
            before, after = Observation(), Observation()
            df = df.observe(before, F.count(F.lit(1)).alias("rows"))
            df = apply_filters(df, self.column_name, [one], self.dry_run).observe(after, F.count(F.lit(1)).alias("rows"))
            self.counts += [(f"{one.name} in", before), (f"{one.name} out", after)]
        if self.deduplication.get("do_deduplication"):
            if self.key is None:
                raise ValueError("deduplication needs a stable row id: set key")
            kept = stage(df, "filtered")  # read for the signatures and again for the rows
            df = minhash.deduplicate(kept, self.key, self.column_name, skip=self.skip, intended=self.intended, **self.options())
        return df

    def report(self) -> list[str]:
        """A line for each filter that has run: how many rows it dropped, and the rest. To be read after the result."""
        lines = []
        for (name, before), (_, after) in zip(self.counts[::2], self.counts[1::2], strict=True):
            rows, left = before.get["rows"], after.get["rows"]
            lines.append(f"{name.removesuffix(' in')} on {self.column_name}: {100 * (rows - left) / rows if rows else 0:.2f}% = {rows - left:,} samples reduced, {left:,} rows left")
        return lines

    def drawn(self) -> int:
        """Hash functions drawn by this and earlier deduplications."""
        return self.skip + (self.options().get("num_perm", 256) if self.deduplication.get("do_deduplication") else 0)


def delivered(rows: DataFrame, id_column: str) -> DataFrame:
    """Every answer once, with row_id: a struct that keeps the order of records and turns and tells different contents apart."""
    content = ["input", "output", "instruction", "response", "source"]
    # as they are rebuilt: training marks and the white space about the answer make no other content
    plain = F.transform("input", lambda m: F.struct(m["content"].alias("content"), F.lit(False).alias("do_train"), m["role"].alias("role")))
    answer = F.struct(F.col("response").alias("content"), F.lit(True).alias("do_train"), F.col("output.role").alias("role"))
    once = rows.withColumns({"input": plain, "output": answer}).groupBy(id_column, "turn", *content).agg(F.count(F.lit(1)).alias("__copies"))
    copies = F.when(F.col(id_column).isNull(), F.col("__copies")).otherwise(F.lit(1))
    once = once.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies.cast("bigint"))))
    row_id = F.struct(F.col(id_column).alias("record"), F.col("turn"), F.xxhash64(*content).alias("content"), F.col("__copy").alias("copy"))
    return once.withColumn("row_id", row_id).drop("__copies", "__copy")


def run_conversations(records: DataFrame, config: dict, id_column: str, intended: bool = False, shuffle: bool = True) -> DataFrame:
    """(conversation, source): explode, clean and filter answers, filter instructions, deduplicate both, rebuild, shuffle.

    ``id_column`` identifies a record; rows of an equal id, turn and content are one delivery and count once. Rows that
    differ in any of these are all kept, and so is every row without an id.
    """
    rows = delivered(conversation.add_content_columns(conversation.to_input_output(records, keep=(id_column,))), id_column)
    answers_config, questions_config = config.get("response_config") or {}, config.get("instruction_config") or {}
    answers = Preprocessor(rows, "response", registry.cleaners_from_config(answers_config, intended), registry.filters_from_config(answers_config, intended),
                           answers_config.get("deduplication") or {}, "row_id", intended=intended)
    kept = answers.run().drop("__cluster__")
    if (questions_config.get("cleaners") or {}) and any(questions_config["cleaners"].values()):
        log.warning("cleaners of instructions are not applied")
    questions = Preprocessor(kept, "instruction", [], registry.filters_from_config(questions_config, intended), questions_config.get("deduplication") or {},
                             "row_id", intended=intended, skip=answers.drawn())
    rebuilt = conversation.rebuild(questions.run(), keep=("row_id",))
    return (shuffled(rebuilt, "row_id") if shuffle else rebuilt).drop("row_id")
