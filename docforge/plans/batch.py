"""A folder of files to validated rows: scan, limits, skip what is done, read, stop early, extract, write."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.functions.adapters import apply_model
from docforge.operators import qa, reports, rows
from docforge.operators.sequence import early_stop, page_text
from docforge.plans.extract import Options, extract, headers
from docforge.session import scratch_folder
from docforge.sources import ingest, sinks
from docforge.sources.runs import Runs


class RequiredModelError(RuntimeError):
    """A model was required and gave no answer for a document."""


@dataclass(frozen=True)
class Batch:
    """Options of a run; ``check`` refuses values that make no sense before anything is read."""

    suffix: str = "pdf"
    limit: int | None = None
    sample: int | None = None
    debug_limit: int | None = None
    seed: str = "42"
    force: bool = False
    most_pages: int = 7
    dpi: int = 300
    dpi_choices: tuple[int, ...] = (200, 250, 300, 350, 400)
    stop_on_marker: bool = True
    full: bool = False
    require_model: bool = False
    include_sensitive: bool = False
    extraction: Options = field(default_factory=Options)

    def check(self) -> Batch:
        for name in ("limit", "sample", "debug_limit"):
            if getattr(self, name) is not None and getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if not 1 <= self.most_pages <= 50:
            raise ValueError("most_pages must be from 1 to 50")
        if self.dpi not in self.dpi_choices:
            raise ValueError(f"dpi must be one of {self.dpi_choices}")
        return self


def chosen(spark: SparkSession, folder: str, options: Batch) -> DataFrame:
    """Files by path, after the limits and the sample: path, length, content, file_id."""
    files = ingest.limited(ingest.binary_files(spark, folder, options.suffix), "path", options.limit, options.debug_limit)
    return ingest.hash_sample(files, F.col("path"), options.sample, options.seed) if options.sample else files


def read_pages(files: DataFrame, load: Callable[[], Callable], options: Batch) -> DataFrame:
    """(file_id, path, error, page_count, pages): a reader's answer for each file, an error in its own row.

    ``load`` gives a function from (content, most pages) to the pages' texts; the cache key holds all that decides them.
    """
    most = None if options.full else options.most_pages
    bound = lambda: (lambda read: lambda content: read(bytes(content), most))(load())
    read = apply_model(files, "content", bound, "array<string>", out="read", retries=0)
    return read.select("file_id", "path", F.coalesce("error", "read.error").alias("error"), F.size(F.coalesce("read.value", F.array().cast("array<string>"))).alias("page_count"), F.col("read.value").alias("pages"))


def until_marker(read: DataFrame, options: Batch, keep: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> DataFrame:
    """``read`` with text, pages_ocr and stop_reason: pages up to the first with the marker.

    ``keep`` stores what is used more than once: what a reader gave, and where pages have the marker.
    """
    read = keep(read, "pages")
    pages = read.where("error is null").select("file_id", F.posexplode("pages").alias("place", "text")).withColumn("page", F.col("place") + 1)
    marked = keep(headers(pages, options=options.extraction).select("file_id", "page", "text", F.col("marker.found").alias("hit")), "marked")
    stops = early_stop(marked, "file_id", "page", F.col("hit"), options.most_pages, options.stop_on_marker, options.full)
    kept = marked.join(stops.select("file_id", "pages_ocr"), "file_id").where("page <= pages_ocr")
    return read.drop("pages", "page_count").join(stops, "file_id", "left").join(page_text(kept, "file_id", "page", "text"), "file_id", "left")


#: Tables of a batch's output and what tells their rows apart.
KEYS = {"results": ["source_file"], "outcomes": ["path"]}
OUTCOMES = "file_id string, path string, status string, error string"


def done_files(spark: SparkSession, output: str) -> DataFrame:
    """(file_id) of what any committed run has done."""
    outcomes = Runs(spark, output).table("outcomes", OUTCOMES)
    return spark.createDataFrame([], "file_id string") if outcomes is None else outcomes.where("status = 'done'").select("file_id")


def all_results(spark: SparkSession, output: str) -> DataFrame | None:
    """The results of all runs, a file's latest one each; None before the first run."""
    return Runs(spark, output).latest("results", KEYS["results"])


def all_outcomes(spark: SparkSession, output: str) -> DataFrame | None:
    """(file_id, path, status, error): the latest attempt at each file; files that a run only skipped keep what they had."""
    outcomes = Runs(spark, output).table("outcomes", OUTCOMES)
    if outcomes is None:
        return None
    tried = F.struct((F.col("status") != "skipped").alias("tried"), F.col("run").alias("run"))
    last = outcomes.groupBy("path").agg(F.max_by(F.struct("file_id", "path", "status", "error"), tried).alias("_row"))
    return last.select("_row.*")


def all_rows(spark: SparkSession, output: str) -> DataFrame | None:
    """Flat rows of ``all_results``."""
    results = all_results(spark, output)
    return None if results is None else rows.flat_rows(results)


def process_files(spark: SparkSession, files: DataFrame, contents: DataFrame, output: str, load: Callable[[], Callable], options: Batch = Batch(), model: Callable[[DataFrame], Column] | None = None, source: str | None = None) -> DataFrame:  # noqa: B008
    """Extract ``files`` (file_id, path) as one run of the tables below ``output``; see process_batch.

    ``contents`` (path, length, content, file_id) has at least the files' contents; only those that are to be read go on.
    ``source`` names what the files came from; a run that was committed from it is not made again. Returns the run's
    outcomes (file_id, path, status, error), status being done, failed or skipped.
    """
    runs = Runs(spark, output)
    if source is not None and runs.has(source):
        return spark.createDataFrame([], OUTCOMES)
    run = runs.begin()
    with scratch_folder(spark, "batch") as scratch:
        files.select("file_id", "path").write.parquet(f"{scratch}/files")
        listed = spark.read.parquet(f"{scratch}/files")
        todo = ingest.not_processed(listed, done_files(spark, output), force=options.force)
        todo.select("path").write.parquet(f"{scratch}/todo")
        todo = spark.read.parquet(f"{scratch}/todo")
        content = ingest.checked(contents.join(todo, "path", "left_semi"))

        def keep(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{scratch}/{name}")
            return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

        read = keep(until_marker(read_pages(content, load, options), options, keep), "texts")
        answer = F.lit(None).cast("string") if model is None else model(read)
        if options.require_model:
            missing = F.lit(True) if model is None else answer.isNull()
            read = read.withColumn("error", F.coalesce("error", F.when(missing, f"{RequiredModelError.__name__}: no answer of the model")))
        good = read.where("error is null")
        extract(good, source="path", primary=None if model is None else answer, options=options.extraction).write.parquet(runs.part(run, "results"))
        results = spark.read.parquet(runs.part(run, "results"))
        tried = read.select("path", "error", F.when(F.col("error").isNull(), "done").otherwise("failed").alias("status"))
        outcomes = listed.join(tried, "path", "left").select("file_id", "path", F.coalesce("status", F.lit("skipped")).alias("status"), "error")
        outcomes.write.parquet(runs.part(run, "outcomes"))
        outcomes = spark.read.schema(OUTCOMES).parquet(runs.part(run, "outcomes"))
        sinks.write_rows(rows.flat_rows(results), runs.part(run, "rows"))
        sinks.write_json(read, runs.part(run, "documents"), ["text"], options.include_sensitive)
        qa.batch_report(results).coalesce(1).write.parquet(f"{scratch}/report")
        report, before = spark.read.parquet(f"{scratch}/report"), all_results(spark, output)
        sinks.write_summary(sinks.outcome_counts(outcomes), report, runs.part(run, "summary"))
        if before is not None:
            before.join(results.select("source_file"), "source_file", "left_semi").write.parquet(f"{scratch}/replaced")
            replaced = spark.read.parquet(f"{scratch}/replaced")
            report = report if replaced.isEmpty() else reports.without(report, replaced)
        report.coalesce(1).write.parquet(runs.part(run, "report"))
        reports.sketches(results).coalesce(1).write.parquet(runs.part(run, "sketches"))
        runs.commit(run, ["results", "outcomes", "rows", "documents", "summary", "report", "sketches"], source)
    return outcomes


def process_batch(spark: SparkSession, folder: str, output: str, load: Callable[[], Callable], options: Batch = Batch(), model: Callable[[DataFrame], Column] | None = None) -> DataFrame:  # noqa: B008
    """Run a batch over the files of a folder: (file_id, path, status, error) of each, done, failed or skipped.

    Results, rows, redacted documents, outcomes, a summary and a partial report are written as one run's parts of tables
    below ``output`` and committed together (see sources.runs): a later run keeps what earlier ones found, and a run that
    is killed leaves nothing that counts. ``all_results``, ``all_rows`` and ``all_outcomes`` read the latest of each file.
    Files that a run has done are skipped unless ``force``; of files with equal contents only the first counts. A file
    that can't be read or extracted is an error of its own and is tried again by the next run. ``model`` gives a model's
    output for the read documents (see functions.payload); with ``require_model`` a document without one is an error.
    """
    options.check()
    return process_files(spark, chosen(spark, folder, options).select("file_id", "path"), ingest.binary_files(spark, folder, options.suffix), output, load, options, model)


def batch_summary(spark: SparkSession, output: str) -> dict[str, DataFrame] | None:
    """The state after all runs: ``counts`` (one row), ``skipped`` (file_id) by the last run, ``failures`` (file_id, error)
    and redacted ``results``; tables, as any of them may be long."""
    runs, outcomes, results = Runs(spark, output), all_outcomes(spark, output), all_results(spark, output)
    if outcomes is None:
        return None
    last = spark.read.schema(OUTCOMES).parquet(f"{runs.folder}/outcomes/run={runs.commits()[-1]['name']}")
    return {
        "counts": sinks.outcome_counts(outcomes),
        "skipped": last.where("status = 'skipped'").select("file_id"),
        "failures": outcomes.where("status = 'failed'").select("file_id", "error"),
        "results": rows.redact_fields(results),
    }
