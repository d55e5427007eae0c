"""Where results go: rows, JSON, manifests, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.operators.rows import redact
from docforge.sources.runs import Runs


def write_rows(rows: DataFrame, path: str, single: bool = False) -> None:
    """Flat rows as CSV with a header, in the order of source and party; ``single`` asks for one file."""
    out = rows.orderBy("source_file", "row_index")
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, private: list[str] | None = None, include_sensitive: bool = False) -> None:
    redact(df, private or [], include_sensitive).write.mode("overwrite").json(path)


def write_texts(df: DataFrame, path: str, text: str = "text") -> None:
    """Texts only, one line each with line ends escaped; for looking into a run, so nothing writes them unless asked."""
    line = F.replace(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_texts(df: DataFrame, value: str = "value") -> DataFrame:
    """The texts of lines that ``write_texts`` wrote."""
    parts = F.transform(F.split(F.col(value), r"\\\\", -1), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return df.select(F.array_join(parts, "\\").alias("text"))


def write_ocr_cache(documents: DataFrame, path: str) -> None:
    """OCR documents (see ``ingest.OCR_DOCUMENT``) as JSON, one a line, in folders by the first letters of their keys."""
    documents.withColumn("shard", F.substring("cache_key", 1, 2)).write.mode("append").partitionBy("shard").json(path)


def append_ocr_cache(documents: DataFrame, folder: str) -> None:
    """OCR documents as one more run of a cache; a key that is there already has a newer document then.

    Of documents with one key in a run, that with most pages is kept. ``compact_ocr_cache`` leaves one of each key.
    """
    runs = Runs(documents.sparkSession, folder)
    run = runs.begin()
    columns = F.struct(*(F.col(c) for c in documents.columns))
    documents.groupBy("cache_key").agg(F.max_by(columns, "page_count").alias("_row")).select("_row.*").write.parquet(runs.part(run, "cache"))
    runs.commit(run, ["cache"])


def compact_ocr_cache(spark: SparkSession, folder: str, sweep: bool = False) -> None:
    """The newest document of each key, in place of all runs; ``sweep`` deletes the old parts, while no reader has begun."""
    runs = Runs(spark, folder)
    runs.compact({"cache": ["cache_key"]})
    if sweep:
        runs.sweep()


def write_summary(summary: DataFrame, results: DataFrame, path: str) -> None:
    """The counts of a batch beside its results: ``path``/summary and ``path``/results, both JSON."""
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    results.write.mode("overwrite").json(f"{path}/results")


def append_manifest(done: DataFrame, path: str) -> None:
    """File ids that went through; failed ones are left for the next run."""
    done.select("file_id", F.lit("done").alias("status")).write.mode("append").parquet(path)


def batch_summary(total: DataFrame, processed: DataFrame) -> DataFrame:
    """One row: total, success, failed, skipped; ``processed`` has an error column."""
    n = total.agg(F.count(F.lit(1)).alias("total"))
    p = processed.agg(F.count_if(F.col("error").isNull()).alias("success"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    return n.crossJoin(p).select("total", "success", "failed", (F.col("total") - F.col("success") - F.col("failed")).alias("skipped"))  # one row each


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """One row: total, success, failed, skipped of outcomes with a status."""
    by = lambda name: F.count_if(F.col("status") == name).alias({"done": "success"}.get(name, name))
    return outcomes.agg(F.count(F.lit(1)).alias("total"), by("done"), by("failed"), by("skipped"))


def first_failures(processed: DataFrame, order: str, n: int = 10, most: int = 220) -> DataFrame:
    """The first failures with errors on one line, cut to ``most`` characters."""
    text = F.trim(F.regexp_replace("error", r"\s+", " "))
    short = F.when(F.char_length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)
    return processed.where("error is not null").withColumn("error", short).orderBy(order).limit(n)
