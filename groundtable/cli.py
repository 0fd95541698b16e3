"""Commands over a store: python -m groundtable.cli COMMAND STORE ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from groundtable.operators import export as leaving
from groundtable.operators import report, scoring
from groundtable.plans import batch
from groundtable.session import build_session
from groundtable.sources.gold import read_gold

COMMANDS = ["discover", "parse", "extract", "backfill", "run", "status", "failures", "evaluate", "export", "template"]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("store")
    parser.add_argument("--version", default="v1", help="of the prompt that landed output answers")
    parser.add_argument("--model", default="")
    parser.add_argument("--gold", help="CSV of labels")
    parser.add_argument("--landed", help="folder of landed hits, for discover")
    parser.add_argument("--out")
    parser.add_argument("--limit", type=int, default=0, help="rows a stage takes (discover: hits a slice); 0 for all")
    a = parser.parse_args(argv)
    spark = spark or build_session()
    if a.command == "discover":
        batch.run_discover(spark, a.store, a.landed or f"{a.store}/hits", a.limit)
    elif a.command == "parse":
        batch.run_parse(spark, a.store, a.limit)
    elif a.command == "extract":
        batch.run_extract(spark, a.store, a.version, a.model, a.limit)
    elif a.command == "run":
        batch.run(spark, a.store, a.version, a.model, a.limit, a.out)
    elif a.command == "backfill":
        batch.run_backfill(spark, a.store, a.limit).show(truncate=False)
    else:
        look(spark, a)


def look(spark: SparkSession, a: argparse.Namespace) -> None:
    """The commands that take no new input."""
    tables = {t: batch.load(spark, a.store, t) for t in batch.TABLES}
    if a.command == "status":
        report.status(*tables.values(), version=a.version, model=a.model or None).show(truncate=False)
        report.spending(tables["extractions"]).show()
    elif a.command == "failures":
        report.frequent_failures(tables["failures"]).show(30, truncate=False)
    elif a.command == "template":
        leaving.write_template(tables["records"], a.out)
    else:
        scores = None
        if a.gold:
            gold = read_gold(spark, a.gold)
            scores = scoring.score_fields(gold, tables["records"])
        if a.command == "export":
            leaving.export(tables["records"], scores, a.out)
        else:
            scoring.unmatched(gold, tables["records"]).show()
            print(scoring.to_markdown(scores))


if __name__ == "__main__":
    main()
