"""Phases of a run from the command line, one at a time or in order, over stored tables (S39):

    spark-submit run.py, or python -m quillmine STORE --records P --hits P --edges P --passages P [--phases search,screen,...] [--depth N] [--client module:function] [--reports FOLDER]

STORE is the folder of the run's tables; the inputs are Parquet (see ``plans.phases.Inputs``). Without a client the extract phase is left out.
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession

from .plans import phases
from .shipping import ship
from .sources.tables import write_csv


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    """Run the phases; the rows of each report."""
    parser = argparse.ArgumentParser(prog="quillmine", description=__doc__.split("\n")[0])
    parser.add_argument("store")
    for name in ("records", "hits", "edges", "passages"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--phases", default=",".join(phases.PHASES))
    parser.add_argument("--depth", type=int, default=1)
    parser.add_argument("--client", help="module:function, (system, prompt) -> reply")
    parser.add_argument("--reports", help="folder for the reports as CSV")
    given = parser.parse_args(args)
    wanted = tuple(given.phases.split(","))
    if unknown := set(wanted) - set(phases.PHASES):
        parser.error(f"no such phase: {', '.join(sorted(unknown))}")
    spark = spark or SparkSession.builder.appName("quillmine").getOrCreate()
    ship(spark)
    inputs = phases.Inputs(*(spark.read.parquet(getattr(given, name)) for name in ("records", "hits", "edges", "passages")))
    client = None
    if given.client:
        module, _, function = given.client.partition(":")
        client = getattr(importlib.import_module(module), function)
    found = phases.run(spark, given.store, inputs, client, wanted, given.depth)
    counts = {}
    for name, rows in found.items():
        if given.reports:
            write_csv(rows, f"{given.reports}/{name}", rows.columns)
        counts[name] = rows.count()
    return counts


if __name__ == "__main__":
    print(json.dumps(main()))
