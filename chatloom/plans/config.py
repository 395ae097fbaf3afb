"""The job's YAML configuration and its command line."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from chatloom.plans.pipeline import run_conversations
from chatloom.session import ship
from chatloom.sources.files import load_all, write


def load_yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(file)


def run(spark: SparkSession, config: dict, id_column: str = "record_id", intended: bool = False) -> None:
    """Reads all data sets of the configuration, prepares them and writes the result."""
    missing = [k for k in ("datasets", "output_dataset_path", "instruction_config", "response_config") if k not in config]
    if missing:
        raise ValueError(f"the configuration lacks {missing}")
    records = load_all(spark, [entry["dataset_path"] for entry in config["datasets"]], id_column)
    write(run_conversations(records, config, id_column, intended), config["output_dataset_path"])


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Prepare conversation data sets as a YAML configuration says.")
    parser.add_argument("--config_path", required=True)
    parser.add_argument("--id_column", default="record_id")
    parser.add_argument("--intended", action="store_true", help="repair the known oddities instead of reproducing them")
    options = parser.parse_args(argv)
    spark = SparkSession.builder.appName("chatloom").getOrCreate()
    ship(spark)
    run(spark, load_yaml(options.config_path), options.id_column, options.intended)


if __name__ == "__main__":
    main()
