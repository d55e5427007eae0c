"""Command lines: a batch of files, a report on its results, accuracy against gold rows."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from docforge.operators import qa, reports
from docforge.plans.batch import Batch, process_batch
from docforge.sources import ingest
from docforge.sources.runs import Runs


def text_reader() -> object:
    """A loader for files that are text: pages end at form feeds."""
    return lambda content, most: content.decode("utf-8").split("\f")[:most]


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="docforge", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)
    batch = commands.add_parser("batch", help="files of a folder to rows, results, a manifest and a summary")
    batch.add_argument("folder")
    batch.add_argument("output")
    batch.add_argument("--suffix", default="txt")
    batch.add_argument("--limit", type=int)
    batch.add_argument("--sample", type=int)
    batch.add_argument("--most-pages", type=int, default=7)
    batch.add_argument("--force", action="store_true")
    batch.add_argument("--keep-reading", action="store_true", help="read on after the marker")
    report = commands.add_parser("report", help="counts over the results of all runs of a batch, never values")
    report.add_argument("output")
    score = commands.add_parser("score", help="accuracy of rows (CSV) against gold rows (CSV, JSON lines or JSON)")
    score.add_argument("rows")
    score.add_argument("gold")
    return out


def run(spark: SparkSession, arguments: list[str] | None = None) -> DataFrame:
    a = parser().parse_args(arguments)
    if a.command == "batch":
        options = Batch(suffix=a.suffix, limit=a.limit, sample=a.sample, most_pages=a.most_pages, force=a.force, stop_on_marker=not a.keep_reading)
        return process_batch(spark, a.folder, a.output, text_reader, options)
    if a.command == "report":
        partials = Runs(spark, a.output).table("report")
        if partials is None:
            raise SystemExit("no run yet")
        return reports.merged_report(partials).orderBy("section", "key")
    predicted = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(a.rows)
    gold = ingest.gold_rows(spark, a.gold)
    return qa.field_accuracy(gold, predicted, [c for c in gold.columns if c in predicted.columns and c not in ("source_file", "row_index")])


if __name__ == "__main__":
    session = SparkSession.builder.appName("docforge").getOrCreate()
    run(session).show(1000, truncate=False)
    session.stop()
