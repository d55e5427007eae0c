"""Registered queries of sources and sinks: what is written is read again and held against the table it came from."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.catalog import query, table
from docforge.functions.adapters import mock_ocr_lines
from docforge.operators import rows
from docforge.plans.batch import Batch, all_outcomes, all_results, all_rows, process_batch
from docforge.session import shared_folder
from docforge.sources import ingest, sinks, workbook
from docforge.streaming.incremental import process_new


def odd_text() -> Column:
    """Quotes, commas, backslashes and a line end."""
    return F.concat(F.lit('a "q", '), F.col("lang"), F.lit("\n\\\\ b\\\\n"))


ODD_SQL = "'a \"q\", ' || lang || chr(10) || '\\\\ b\\\\n'"


def labelled(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("source_file"), F.lit("0").alias("row_index"), F.when(F.col("doc_id") % 3 > 0, odd_text()).alias("value"))


LABELLED_SQL = f"SELECT doc_id::VARCHAR AS source_file, '0' AS row_index, CASE WHEN doc_id % 3 > 0 THEN {ODD_SQL} END AS value FROM documents"


@query(LABELLED_SQL)
def rows_as_csv(spark, d):
    """Flat rows as CSV with quotes, commas and line ends in values, read as gold rows."""
    folder = f"{shared_folder(spark, 'rows')}.csv"
    sinks.write_rows(labelled(spark, d), folder)
    return ingest.gold_rows(spark, folder)


@query(LABELLED_SQL)
def rows_as_json_lines(spark, d):
    folder = f"{shared_folder(spark, 'rows')}.jsonl"
    labelled(spark, d).write.json(folder)
    return ingest.gold_rows(spark, folder).select("source_file", "row_index", "value")


@query(LABELLED_SQL)
def rows_as_workbook(spark, d):
    """Rows as one sheet and back: the first row names the columns, empty cells are null."""
    path = f"{shared_folder(spark, 'sheet')}/rows.xlsx"
    workbook.write_workbook(labelled(spark, d), path, ["source_file"], ["source_file", "row_index", "value"])
    folder, _, name = path.rpartition("/")
    files = ingest.binary_files(spark, folder, "xlsx").where(F.endswith("path", F.lit(name)))
    return workbook.read_workbooks(files, ["source_file", "row_index", "value"]).select("source_file", "row_index", "value")


@query("SELECT doc_id, NULL::VARCHAR AS text, lang, true AS sensitive_text_redacted FROM documents")
def redacted_json(spark, d):
    """Results as JSON without their texts."""
    folder = shared_folder(spark, "json")
    sinks.write_json(table(spark, d, "documents").select("doc_id", "text", "lang"), folder, ["text"])
    return spark.read.schema("doc_id long, text string, lang string, sensitive_text_redacted boolean").json(folder)


@query("SELECT r_regionkey::BIGINT AS k, r_name AS name, CASE WHEN r_regionkey % 2 = 0 THEN 'r' || r_regionkey ELSE 'file' END AS source_file FROM region")
def prediction_folder(spark, d):
    """One JSON file for each prediction; a file without a source has its own name as one."""
    folder = shared_folder(spark, "predictions")
    k = F.col("r_regionkey")
    named = table(spark, d, "region").select(k.alias("k"), F.col("r_name").alias("name"), F.when(k % 2 == 0, F.concat(F.lit("r"), k.cast("string"))).alias("source_file"), k.alias("part"))
    named.write.partitionBy("part").json(folder)
    found = ingest.json_documents(spark, folder)
    return found.select("k", "name", F.when(F.startswith("source_file", F.lit("part-")), "file").otherwise(F.col("source_file")).alias("source_file"))


@query("SELECT doc_id::VARCHAR AS source_file, 1 AS page_number, t AS text FROM (SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''), chr(10)) AS t FROM documents) WHERE trim(t) <> ''")
def ocr_cache_pages(spark, d):
    """OCR documents with lines and boxes, cached by key and read again; a page's text is its non-blank lines."""
    folder = shared_folder(spark, "cache")
    docs = table(spark, d, "documents")
    page = F.struct(F.lit(1).alias("page_number"), F.lit(None).cast("string").alias("text"), mock_ocr_lines(F.col("text")).alias("lines"))
    sinks.write_ocr_cache(docs.select(F.col("doc_id").cast("string").alias("source_file"), F.sha2(F.col("text").cast("binary"), 256).alias("cache_key"), F.lit(1).alias("page_count"), F.array(page).alias("pages")), folder)
    return ingest.page_texts(ingest.ocr_documents(spark, folder))


@query("SELECT sha256(text) AS sha, count(*) AS n FROM documents GROUP BY ALL")
def texts_as_lines(spark, d):
    folder = shared_folder(spark, "texts")
    sinks.write_texts(table(spark, d, "documents"), folder)
    return sinks.read_texts(spark.read.text(folder)).groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("sha")).agg(F.count("*").alias("n"))


@query("SELECT r_name AS source_file, 'text ' || r_name || chr(10) || r_regionkey AS text FROM region")
def whole_text_files(spark, d):
    """Each file of a folder as one text, line ends and all."""
    folder = shared_folder(spark, "files")
    lines = table(spark, d, "region").select(F.col("r_name").alias("part"), F.concat(F.lit("text "), F.col("r_name"), F.lit("\n"), F.col("r_regionkey").cast("string")).alias("value"))
    lines.write.partitionBy("part").text(folder)
    found = ingest.text_files(spark, f"{folder}/*")
    return found.select(F.regexp_extract("text", r"^text (\S+(?: \S+)*)", 1).alias("source_file"), F.rtrim(F.regexp_replace("text", r"\n$", "")).alias("text"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0)) WHERE n = 1")
def manifest_of_two_runs(spark, d):
    """What a second run still has to do, after the first one put even ids into the manifest."""
    folder = shared_folder(spark, "manifest")
    docs = table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("file_id"))
    sinks.append_manifest(docs.where("doc_id % 4 = 0"), folder)
    sinks.append_manifest(docs.where("doc_id % 4 = 2"), folder)
    return ingest.not_processed(docs, spark.read.parquet(folder), order="doc_id").select("doc_id")


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def stream_of_new_files(spark, d):
    """Each new file is handed over once, over two runs of the stream with one state."""
    folder = shared_folder(spark, "stream")
    docs = table(spark, d, "documents").select("doc_id", "lang")
    for part in (0, 1):
        docs.where(F.col("doc_id") % 2 == part).write.mode("append").parquet(f"{folder}/in")
        process_new(spark, f"{folder}/in", "doc_id long, lang string", f"{folder}/state", lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")).awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("lang").agg(F.count("*").alias("n"))


def pdf(n: Column, pages: Column) -> Column:
    """Bytes with so many page objects; every seventh is no such file, every fifth is empty."""
    return F.when(n % 7 == 0, F.lit("plain text")).when(n % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("%PDF-1.4\n"), F.repeat(F.lit("<< /Type /Page >>\n"), pages), F.lit("<< /Type /Pages >>"))).cast("binary")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'unexpected content' WHEN c_custkey % 5 = 0 THEN 'empty file' WHEN c_custkey % 4 = 0 THEN 'no pages' END AS error, CASE WHEN c_custkey % 7 > 0 AND c_custkey % 5 > 0 THEN (c_custkey % 4)::INT END AS page_count FROM customer""")
def page_counts(spark, d):
    """Files with their pages, or the first error in order: empty, no such file, no pages."""
    k = F.col("c_custkey")
    files = table(spark, d, "customer").select("c_custkey", pdf(k, (k % 4).cast("int")).alias("content"))
    return ingest.page_counts(files.withColumn("length", F.octet_length("content").cast("long"))).select("c_custkey", "error", "page_count")


@query("""SELECT n_nationkey::VARCHAR AS path, CASE WHEN n_nationkey % 5 > 0 THEN 'IN.' || m END AS member, CASE WHEN n_nationkey % 5 > 0 THEN n_name END AS content, CASE WHEN n_nationkey % 5 = 0 THEN 'broken archive: BadZipFile' END AS error
FROM nation, unnest(['PDF', 'pdf']) AS u(m) WHERE n_nationkey % 5 > 0 OR m = 'pdf'""")
def archive_members(spark, d):
    """Members of archives by suffix in any case; a broken archive is an error of its own."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, name in zip(batch["n_nationkey"], batch["n_name"], strict=True):
                data = io.BytesIO()
                with zipfile.ZipFile(data, "w") as archive:
                    for member in ("IN.PDF", "IN.pdf", "other.txt"):
                        archive.writestr(member, name)
                out.append((str(k), data.getvalue() if k % 5 else b"broken"))
            yield pd.DataFrame(out, columns=["path", "content"])

    files = table(spark, d, "nation").mapInPandas(pack, "path string, content binary")
    return ingest.zip_members(files).select("path", "member", F.decode("content", "UTF-8").alias("content"), "error")


@query("""WITH f AS (SELECT n_nationkey AS k, n_nationkey % 5 = 0 AS bad FROM nation WHERE n_nationkey % 6 > 0), n AS (SELECT count(*) AS n, count(*) FILTER (bad) AS bad FROM f)
SELECT 'first' AS run, n AS tried, bad AS failed, 0 AS skipped FROM n UNION ALL SELECT 'second', bad, bad, n - bad FROM n UNION ALL SELECT 'results', n - bad, 0, 0 FROM n
UNION ALL SELECT 'rows', 2 * (n - bad), 0, 0 FROM n UNION ALL SELECT 'outcomes', n, bad, 0 FROM n""")
def batch_run(spark, d):
    """A folder processed twice: the second run only tries again what failed, and the first one's results stay."""
    folder, k = shared_folder(spark, "batch-run"), F.col("n_nationkey")
    text = F.concat(F.lit("%PDF "), k.cast("string"), F.lit("\nBị cáo: Trần Văn Bình, sinh năm 1990\nBị hại: Lê Thị Cúc\fNỘI DUNG VỤ ÁN\nBị cáo: Người Khác\fkhông đọc"))
    files = table(spark, d, "nation").where("n_nationkey % 6 > 0").select(F.when(k % 5 == 0, F.concat(F.lit("%PDF bad "), k.cast("string"))).otherwise(text).alias("value"), k.alias("part"))
    files.write.partitionBy("part").text(f"{folder}/in")

    def load():
        def read(content, most):
            text = content.decode()
            if "bad" in text:
                raise ValueError("no text")
            return text.split("\f")[:most]

        return read

    counts = lambda name, df: df.agg(F.lit(name).alias("run"), F.count_if(F.col("status") != "skipped").alias("tried"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped"))
    whole = lambda name, df: counts(name, df.select(F.lit("done").alias("status")))
    run = lambda: process_batch(spark, f"{folder}/in/*", f"{folder}/out", load, Batch(suffix="txt"))
    out = f"{folder}/out"
    runs = [counts("first", run()), counts("second", run())]
    return rows.concatenated(*runs, whole("results", all_results(spark, out)), whole("rows", all_rows(spark, out)), counts("outcomes", all_outcomes(spark, out)))
