"""Files and tables as documents: scans, manifests, limits, samples, caches."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docforge.functions.text import cache_key
from docforge.operators.sequence import keep_first
from docforge.operators.sift import key_map, sifted
from docforge.sources.runs import Runs


STREAM = re.compile(rb"/FlateDecode.{0,200}?stream\r?\n(.*?)endstream", re.DOTALL)
PAGE, PAGES = re.compile(rb"/Type\s*/Page(?![a-zA-Z])"), re.compile(rb"/Type\s*/Pages\b[^>]{0,200}?/Count\s+(\d+)")
LINE = "struct<text:string,page_number:int,bbox:array<double>,confidence:double>"
OCR_DOCUMENT = f"source_file string, file_id string, cache_key string, page_count int, pages array<struct<page_number:int,text:string,lines:array<{LINE}>>>, metadata map<string,string>"


def ocr_documents(spark: SparkSession, path: str) -> DataFrame:
    """Cached OCR documents: pages of lines with boxes, as ``sinks.write_ocr_cache`` writes them."""
    return spark.read.schema(OCR_DOCUMENT).json(path)


def cached_documents(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest document of each key in a cache that ``sinks.append_ocr_cache`` wrote; None of an empty cache."""
    return Runs(spark, folder).latest("cache", ["cache_key"])


def page_texts(documents: DataFrame) -> DataFrame:
    """(source_file, page_number, text): a page's own text, else its non-blank lines; blank pages are left out."""
    pages = documents.select("source_file", F.explode("pages").alias("p"))
    lines = F.array_join(F.filter(F.transform("p.lines", lambda x: x["text"]), lambda t: F.trim(t) != ""), "\n")
    text = F.coalesce(F.when(F.trim("p.text") != "", F.col("p.text")), lines)
    return pages.select("source_file", "p.page_number", text.alias("text")).where(F.trim("text") != "")


def batch_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The results of batch summaries: JSON files with a list ``results`` of ``schema``; items that are no objects go."""
    df = spark.read.schema(f"total long, success long, failed long, skipped long, results array<struct<{schema}>>").option("multiLine", True).json(path)
    return df.select(F.explode("results").alias("r")).where("r is not null").select("r.*")


def binary_files(spark: SparkSession, path: str, suffix: str = "pdf", empty: bool = True) -> DataFrame:
    """path, length, content and file_id (SHA-256 of the content) of the files with a suffix in a folder, not below it.

    ``path`` may be a pattern for several folders; folders named like partitions are folders like any other. Scans pass
    over files without a byte; with ``empty`` they are rows too, from a listing on the driver.
    """
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*.{suffix}")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    if any(f.isFile() and f.getLen() > 0 for f in found):
        files = spark.read.format("binaryFile").load(pattern.toString()).select("path", "length", "content")
    else:
        files = spark.createDataFrame([], "path string, length long, content binary")
    names = [f.getPath().toString() for f in found if f.getLen() == 0 and f.isFile()] if empty else []
    if names:
        nothing = spark.createDataFrame([(n,) for n in names], "path string").withColumns({"length": F.lit(0).cast("long"), "content": F.lit("").cast("binary")})
        files = files.unionByName(nothing)
    return files.withColumn("file_id", F.sha2("content", 256))


def checked(files: DataFrame, magic: bytes = b"%PDF") -> DataFrame:
    """With an error for empty files and for content that doesn't start as it should."""
    start = F.substring("content", 1, len(magic)) == F.lit(bytearray(magic))
    return files.withColumn("error", F.when(F.col("length") == 0, "empty file").when(~start, "unexpected content"))


def requested(paths: DataFrame, files: DataFrame) -> DataFrame:
    """``checked`` files for the paths (path) that were asked for; one that isn't there is a row with an error."""
    found = paths.select("path").distinct().join(checked(files), "path", "left")
    return found.withColumn("error", F.when(F.col("length").isNull(), "not found").otherwise(F.col("error")))


def page_counts(files: DataFrame) -> DataFrame:
    """``checked`` with page_count, from the page objects of the file or the largest count its page tree gives.

    Object streams are inflated. A file without a page has an error, as the last in the order of errors.
    """

    def count(content: bytes) -> int:
        plain = [content]
        for m in STREAM.finditer(content):
            try:
                plain.append(zlib.decompressobj().decompress(m.group(1), 1 << 24))
            except zlib.error:
                continue
        pages = sum(len(PAGE.findall(p)) for p in plain)
        return max([pages, *(int(n) for p in plain for n in PAGES.findall(p))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = [None if e is not None or c is None else count(c) for c, e in zip(batch["content"], batch["error"], strict=True)]
            yield batch.assign(page_count=pd.Series(known, index=batch.index, dtype="Int32"))

    files = checked(files)
    out = files.mapInPandas(run, T.StructType([*files.schema.fields, T.StructField("page_count", T.IntegerType())]))
    return out.withColumn("error", F.coalesce("error", F.when(F.col("page_count") < 1, "no pages")))


def zip_members(files: DataFrame, suffix: str = ".pdf") -> DataFrame:
    """(path, member, content, error) of the members of ZIP archives with a suffix in any case; a broken archive is one
    row with an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        for name in archive.namelist():
                            if name.lower().endswith(suffix):
                                yield pd.DataFrame({"path": [path], "member": [name], "content": [archive.read(name)], "error": [None]})
                except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError) as problem:
                    yield pd.DataFrame({"path": [path], "member": [None], "content": [None], "error": [f"broken archive: {type(problem).__name__}"]})

    return files.select("path", "content").mapInPandas(run, "path string, member string, content binary, error string")


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, text): each file whole."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("source_file"), F.col("value").alias("text"))


def gold_rows(spark: SparkSession, path: str) -> DataFrame:
    """Gold rows of CSV with a header, JSON lines, or JSON with a list (or ``rows``), by suffix; a byte order mark is fine."""
    if path.endswith(".csv"):
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    elif path.endswith(".jsonl"):
        df = spark.read.json(path)
    else:
        df = spark.read.option("multiLine", True).json(path)
        if "rows" in df.columns:
            df = df.select(F.explode("rows").alias("r")).select("r.*")
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def json_documents(spark: SparkSession, path: str, skip: str = "batch_summary.json") -> DataFrame:
    """JSON files of a folder but one, with the file's stem where there is no source_file."""
    df = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json").json(path).withColumn("_file", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))
    source = F.coalesce(F.col("source_file"), F.col("_file")) if "source_file" in df.columns else F.col("_file")
    return df.where(F.col("_file") != F.lit(skip.removesuffix(".json"))).withColumn("source_file", source).drop("_file")


def not_processed(files: DataFrame, manifest: DataFrame, key: str = "file_id", order: str = "path", force: bool = False) -> DataFrame:
    """Without files that the manifest has, and of equal contents only the first by path; with ``force`` all of them."""
    return files if force else keep_first(files.join(manifest.select(key).distinct(), key, "left_anti"), [key], [order])


def limited(files: DataFrame, order: str, *limits: int | None) -> DataFrame:
    """The first rows by ``order``, by each limit in turn; 0 and None are no limit."""
    least = min((n for n in limits if n), default=None)
    return files if least is None else files.orderBy(order).limit(least)


def hash_sample(df: DataFrame, key: Column, k: int, seed: str = "42") -> DataFrame:
    """Exactly ``k`` rows (or all), those whose hash of key and seed is smallest."""
    return df.orderBy(F.sha2(F.concat(key.cast("string"), F.lit(f":{seed}")), 256), key).limit(k)


def with_cache(df: DataFrame, cache: DataFrame, value: str, version: str | None = None, **options: Column) -> DataFrame:
    """``cache_key`` from the options, the cached ``value`` if there is one, and whether there was.

    A key that the cache has several times gives its value of the highest ``version``, or the largest value without one:
    a row of ``df`` stays one row. Misses are told by a map of the cache's keys and don't go through the join.
    """
    newest = F.max_by(value, version) if version else F.max(value)
    known = cache.groupBy("cache_key").agg(newest.alias(value), F.lit(True).alias("cache_hit"))
    keyed = df.withColumn("cache_key", cache_key(**options))
    some, rest = sifted(keyed, "cache_key", *key_map(cache.select("cache_key"), "cache_key"))
    found = some.join(known, "cache_key", "left").withColumn("cache_hit", F.coalesce("cache_hit", F.lit(False)))
    missed = rest.withColumns({value: F.lit(None).cast(cache.schema[value].dataType), "cache_hit": F.lit(False)})
    return found.unionByName(missed.select(found.columns))


def corrected_texts(raw: DataFrame, corrected: DataFrame, stem: str = "stem", text: str = "text") -> DataFrame:
    """(stem, ocr_raw, ocr_corrected): a corrected text by the suffixes _corrected, none, _normalized in this order."""
    names = {"_corrected": 0, "": 1, "_normalized": 2}
    rank = F.when(F.endswith(stem, F.lit("_corrected")), 0).when(F.endswith(stem, F.lit("_normalized")), 2).otherwise(names[""])
    best = corrected.select(F.regexp_replace(stem, "_(?:corrected|normalized)$", "").alias("_s"), F.struct(rank.alias("r"), F.col(text).alias("t")).alias("_c")).groupBy("_s").agg(F.min("_c").alias("_c"))
    return raw.join(best, F.col(stem) == F.col("_s"), "left").select(F.col(stem), F.coalesce(F.col(text), F.lit("")).alias("ocr_raw"), F.coalesce("_c.t", F.lit("")).alias("ocr_corrected"))
