"""From raw documents to a training mix: each stage works on all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.llm import decontam, langid, linededup, mixing, simhash
from docforge.llm.common import cut, ensure_checkpoint_dir, parted, sketch

#: Documents whose language is less sure than this are rejected.
LEAST_SCORE = 0.5
#: Near copies: 256-bit fingerprints of five-word shingles propose pairs, a Jaccard similarity of SIMILAR decides. At 0.8 the
#: shingle sets' cosine is 8/9, so that fingerprints differ in 39 bits with a standard deviation of 5.7: 57 bits take in
#: 99.9 % of such pairs, and blocks are chosen so that 98 % of them meet in one.
SHINGLE, LANES, DISTANCE, SIMILAR, RECALL = 5, 4, 57, 0.8, 0.98
#: Words of a benchmark window: a document with one is dropped, however long it is.
WINDOW = 13


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of no language (``und``: null, empty or without a letter) or of one that is unsure.

    Repeated rows go or stay together.
    """
    return langid.identify(docs, lang_out="_lang", score_out="_score", bits_out="_bits").where((F.col("_lang") != "und") & (F.col("_score") >= LEAST_SCORE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without repeated lines; documents of which nothing is left go, null texts stay (see dedupe_lines)."""
    out = linededup.dedupe_lines(docs).where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return out.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    Null and blank texts are copies of one another. Documents without an id all stay; rows that repeat an id are one
    document and go or stay together, less rows that repeat another in all columns. Only texts whose id is dropped or
    repeated, and the few that a sketch of these ids can't tell from them, are shuffled.
    """
    groups = cut(simhash.near_duplicates(docs.select("doc_id", "text"), words=SHINGLE, lanes=LANES, distance=DISTANCE, similarity=SIMILAR, recall=RECALL).select("doc_id", "component_id"))
    ids = groups.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), F.min("component_id").alias("first"))
    odd = cut(ids.where("rows > 1 or first <> doc_id").select(F.col("doc_id").alias("_id"), (F.col("first") == F.col("doc_id")).alias("_stays"), F.xxhash64("doc_id").alias("_key")))
    some, rest = parted(docs.withColumn("_k", F.xxhash64(F.col("doc_id").cast("long"))), "_k", *sketch(odd, "_key"))
    some = some.join(odd, F.col("doc_id") == F.col("_id"), "left")
    single = some.where("_id is null").select(*docs.columns)
    repeated = some.where("_stays").select(*docs.columns).dropDuplicates()
    return rest.select(*docs.columns).unionByName(single).unionByName(repeated)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a whole benchmark window of WINDOW words, or of which shorter items make a twentieth.

    A null or empty text has no words and stays; repeated rows go or stay together.
    """
    hit = F.col("_hit")
    out = decontam.scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=WINDOW, out="_hit")
    return out.where((hit["n_hit"] == 0) | ((hit["n_hit"] < WINDOW) & (20 * hit["n_hit"] < hit["n_words"]))).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample that meets the target shares of source, language and topic; texts without words, null ones too, go."""
    return mixing.mix(docs).where("sampled").drop("sampled")


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", clean_of_benchmark),
    ("mixing to target weights", mixture),
]

#: SQL expresses neither the byte models nor the fingerprints; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each result is written to the shared folder as Parquet and read by the next stage.

    A stage's result is deleted when the next one's is written; the last one's stays, as what is returned reads it.
    """
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            before = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
            before.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(before, True)
    return docs
