"""Registered queries of runs, streams, archives, services, caches and reports that are merged."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.catalog import query, spread, table
from docforge.catalog_rules import CASE_SQL, PARTY_SQL, judgments
from docforge.functions import text
from docforge.functions.adapters import TransportError, ocr_lines, served_by
from docforge.operators import reports, rows, sequence
from docforge.plans.batch import Batch, all_results
from docforge.plans.extract import above_marker, extract
from docforge.session import shared_folder, ship
from docforge.sources import archives, ingest, sinks
from docforge.sources.runs import Runs
from docforge.streaming.incremental import process_stream

REPORT_SQL = f"""WITH c AS ({CASE_SQL}), p AS ({PARTY_SQL}), f AS (SELECT unnest(['loai_an', 'so_thu_ly', 'ngay_thu_ly', 'quan_he_phap_luat', 'chu_toa']) AS f, unnest([loai_an, so_thu_ly, ngay_thu_ly, quan_he_phap_luat, chu_toa]) AS v FROM c),
g AS (SELECT unnest(['tu_cach_to_tung', 'ho_ten', 'nam_sinh', 'cccd', 'dia_chi']) AS f, unnest([tu_cach_to_tung, ho_ten, nam_sinh, cccd, dia_chi]) AS v FROM p)
SELECT 'batch' AS section, 'result_objects' AS key, count(*) AS n FROM c UNION ALL SELECT 'batch', 'participant_rows', count(*) FROM p
UNION ALL SELECT 'marker', unnest(['found', 'not_found']), unnest([count(*), 0]) FROM c UNION ALL SELECT 'review', unnest(['required', 'not_required']), unnest([count(*), 0]) FROM c
UNION ALL SELECT 'extractors', 'rule_support_no_local_llm', count(*) FROM c
UNION ALL SELECT 'case_fields', f || unnest(['.total', '.non_empty', '.empty']), unnest([count(*), count(v), count(*) - count(v)]) FROM f GROUP BY f
UNION ALL SELECT 'participant_fields', f || unnest(['.total', '.non_empty', '.empty']), unnest([count(*), count(v), count(*) - count(v)]) FROM g GROUP BY f
UNION ALL SELECT 'warnings', unnest(['local_llm', 'missing_case_fields', 'needs_review_or_low_confidence', 'missing_participant_fields']), unnest([count(*), count(*) FILTER (k % 3 = 2 OR k % 4 = 3), count(*) FILTER (k % 3 = 0), count(*)]) FROM c
UNION ALL SELECT 'suspicious_counts', unnest(['suspicious_name_like_phrase', 'invalid_birth_year', 'invalid_identity_number_length']), 0"""


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'again ' ELSE 'first ' END || o_orderpriority AS value FROM orders")
def latest_of_runs(spark, d):
    """A table of three runs: the second has some keys again, the third was killed before its commit; then compacted."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    runs = Runs(spark, shared_folder(spark, "runs"))

    def write(df: DataFrame, word: str, commit: bool = True) -> None:
        run = runs.begin()
        df.select("k", F.concat(F.lit(word), "o_orderpriority").alias("value")).write.parquet(runs.part(run, "values"))
        if commit:
            runs.commit(run, ["values"])

    write(orders, "first ")
    write(orders.where("k % 3 = 0"), "again ")
    write(orders, "never ", commit=False)
    runs.compact({"values": ["k"]})
    runs.sweep()
    return runs.latest("values", ["k"])


@query("""WITH k AS (SELECT DISTINCT c_custkey % 10 AS kind FROM customer) SELECT 'results' AS what, count(*) AS n FROM k UNION ALL SELECT 'rows', 2 * count(*) FROM k UNION ALL SELECT 'after a replay', count(*) FROM k""")
def stream_of_files(spark, d):
    """Files of text through the whole extraction as a stream: of equal contents in two batches one is a result, and a
    batch that is handed over again after its state was lost changes nothing."""
    folder = shared_folder(spark, "stream-files")
    k = F.col("c_custkey")
    value = F.concat(F.lit("%PDF "), (k % 10).cast("string"), F.lit("\nBị cáo: Trần Văn Bình, sinh năm 1990\nBị hại: Lê Thị Cúc\nNỘI DUNG VỤ ÁN"))
    files = table(spark, d, "customer").select((k % 20).alias("part"), value.alias("value")).groupBy("part").agg(F.min("value").alias("value"))

    def load():
        return lambda content, most: content.decode().split("\f")[:most]

    def run(state: str) -> None:
        process_stream(spark, f"{folder}/in/*", f"{folder}/out", load, f"{folder}/{state}", Batch(suffix="txt")).awaitTermination()

    for half in (files.where("part < 10"), files.where("part >= 10")):
        half.write.mode("append").partitionBy("part").text(f"{folder}/in")
        run("state")
    count = lambda name, df: df.agg(F.lit(name).alias("what"), F.count("*").alias("n"))
    out = [count("results", all_results(spark, f"{folder}/out")), count("rows", rows.flat_rows(all_results(spark, f"{folder}/out")))]
    run("other-state")
    return rows.concatenated(*out, count("after a replay", all_results(spark, f"{folder}/out")))


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 < 3 THEN 4 ELSE 5 END AS n_lines,
'Tòa' || chr(8203) || '  án ' || o_orderkey || chr(10) || 'ngày ' || (o_orderkey % 28 + 1) || chr(10) || ' tháng ' || (o_orderkey % 12 + 1) || chr(10) || CASE WHEN o_orderkey % 4 < 3 THEN 'xét  thấy ' || repeat('câu này ', (o_orderkey % 5)::INT + 8) || 'dài.' ELSE 'xét' || chr(10) || 'không có' END AS kept FROM orders""")
def lines_above_marker(spark, d):
    """Page lines above a marker that is found in normalised text: blanks, zero-width characters and carriage returns go
    and dates are joined before, yet the raw line is cut at the marker's first character. Every fourth page has none."""
    k = F.col("o_orderkey")
    zero = F.lit("​")
    marked = F.concat(F.lit("xét  thấy "), F.repeat(F.lit("câu này "), (k % 5 + 8).cast("int")), F.lit("dài.  NOI DUNG VU AN:​ và phần sau của câu dài này"))
    head = [F.concat(F.lit("Tòa"), zero, F.lit("  án "), k.cast("string")), F.concat(F.lit("ngày "), (k % 28 + 1).cast("string")), F.concat(F.lit(" tháng "), (k % 12 + 1).cast("string"))]
    texts = F.when(k % 4 < 3, F.array(*head, marked, F.lit("sau"))).otherwise(F.array(*head, F.lit("xét"), F.lit("không có")))
    lines = F.transform(texts, lambda t, i: F.struct(t.alias("text"), F.lit(1).alias("page_number"), F.array(F.lit(0.0), i.cast("double"), F.lit(1.0), i.cast("double")).alias("bbox")))
    pages = spread(table(spark, d, "orders").select("o_orderkey"), "o_orderkey").select(k.alias("k"), lines.alias("lines"))
    return above_marker(pages).select("k", F.size("lines").cast("long").alias("n_lines"), F.col("text").alias("kept"))


@query("""SELECT 'nation ' || c_nationkey AS archive, CASE WHEN c_custkey % 9 > 0 THEN 'c' || c_custkey || '.PDF' END AS member, CASE WHEN c_custkey % 9 > 0 AND c_custkey % 7 > 0 THEN repeat(c_name || ' ', 20) END AS content, CASE WHEN c_custkey % 7 = 0 THEN 'broken member: wrong size or checksum' END AS error FROM customer WHERE c_custkey % 9 > 0
UNION ALL SELECT 'no archive', NULL, NULL, 'broken archive: BadZipFile'""")
def archive_ranges(spark, d):
    """Members of archives read by ranges from many tasks: damaged ones are errors of their own, as is a broken archive."""
    ship(spark)
    folder = shared_folder(spark, "archives")
    system, place = archives.file_at(folder)
    system.create_dir(place)
    with system.open_output_stream(f"{place}/broken.zip") as out:
        out.write(b"PK no")

    def pack(batch: pd.DataFrame) -> pd.DataFrame:
        data, key = io.BytesIO(), int(batch["c_nationkey"].iloc[0])
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
            for k, name in sorted(zip(batch["c_custkey"], batch["c_name"], strict=True)):
                archive.writestr(f"c{k}.PDF" if k % 9 else f"c{k}.txt", f"{name} " * 20)
        raw = bytearray(data.getvalue())
        for entry in zipfile.ZipFile(data).infolist():
            if int(entry.filename[1:-4]) % 7 == 0:
                raw[entry.header_offset + 30 + len(entry.filename) + entry.compress_size // 2] ^= 255
        target, where = archives.file_at(folder)
        with target.open_output_stream(f"{where}/{key}.zip") as out:
            out.write(bytes(raw))
        return pd.DataFrame({"path": [f"{folder}/{key}.zip"], "archive": [f"nation {key}"]})

    made = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name").groupBy("c_nationkey").applyInPandas(pack, "path string, archive string")
    made.write.parquet(f"{folder}-index")
    index = spark.read.parquet(f"{folder}-index").unionByName(spark.createDataFrame([(f"{folder}/broken.zip", "no archive")], "path string, archive string"))
    members = archives.archive_members(index.select("path"), run_bytes=4096)
    text_of = F.when(F.col("content").isNotNull(), F.decode("content", "UTF-8"))
    return members.join(index, "path").select("archive", "member", text_of.alias("content"), F.when(F.startswith("error", F.lit("broken member")), "broken member: wrong size or checksum").otherwise(F.col("error")).alias("error"))


@query("""SELECT c_custkey::VARCHAR AS k, p::INT AS page_number, CASE WHEN p % 3 > 0 OR c_custkey % 5 > 0 THEN 'page ' || p END AS text, CASE WHEN p % 3 = 0 AND c_custkey % 5 = 0 THEN 'ValueError: unreadable' END AS error
FROM customer, unnest(range(1, 8)) AS u(p) WHERE p <= c_custkey % 9 AND (p <= c_custkey % 4 + 1 OR ((c_custkey % 4 + 1) % 3 = 0 AND c_custkey % 5 = 0))""")
def pages_by_table_function(spark, d):
    """Pages of a table function beside their documents: none after the marker's, an unreadable one is a row with an error."""
    files = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("k"), (F.col("c_custkey") % 9).cast("int").alias("n"))

    def read(name: str, pages: list[int]) -> list[str]:
        if any(p % 3 == 0 for p in pages) and int(name) % 5 == 0:
            raise ValueError("unreadable")
        return [f"page {p}" + ("!" if p == int(name) % 4 + 1 else "") for p in pages]

    made = sequence.page_table(read, lambda t: t.endswith("!"), at_once=2)
    return sequence.pages_until_marker(files, "k", "n", made).select("k", "page_number", F.regexp_replace("text", "!$", "").alias("text"), "error")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'second ' || c_custkey WHEN 1 THEN NULL ELSE 'first ' || c_custkey END AS value, CASE WHEN c_custkey % 4 = 1 THEN 'ValueError: no such page' END AS error FROM customer""")
def services_in_order(spark, d):
    """Calls in a window: another service is asked where the transport failed, not where the answer was an error."""

    def service(name: str, fails: int):
        def load():
            def ask(k):
                if k % 4 == fails:
                    raise TransportError("no connection")
                if k % 4 == 1:
                    raise ValueError("no such page")
                return f"{name} {k}"

            return ask

        return load

    asked = spread(table(spark, d, "customer").select("c_custkey"), "c_custkey")
    done = served_by(asked, "c_custkey", [service("first", 0), service("second", -1)], "string", in_flight=16, retries=0)
    return done.select("c_custkey", "answer.value", "answer.error")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'v' || (doc_id % 3 + 1) || ' of ' || doc_id END AS page, doc_id % 2 = 0 AS cache_hit FROM documents")
def cache_versions(spark, d):
    """A cache that has some keys several times: a document gets the newest value and stays one row."""
    docs = table(spark, d, "documents").select("doc_id")
    version = F.explode(F.sequence(F.lit(1), (F.col("doc_id") % 3 + 1).cast("int")))
    cache = docs.where("doc_id % 2 = 0").select("doc_id", version.alias("version")).select(text.cache_key(id=F.col("doc_id")).alias("cache_key"), "version", F.concat(F.lit("v"), F.col("version").cast("string"), F.lit(" of "), F.col("doc_id").cast("string")).alias("page"))
    return ingest.with_cache(docs, cache, "page", version="version", id=F.col("doc_id")).select("doc_id", "page", "cache_hit")


@query("SELECT doc_id::VARCHAR AS source_file, 1 AS page_number, CASE WHEN doc_id % 2 = 0 THEN 'new ' ELSE 'old ' END || lang AS text FROM documents")
def ocr_cache_runs(spark, d):
    """An OCR cache of two runs, of which the second has some documents again; compacted to the newest of each key."""
    folder = shared_folder(spark, "ocr-runs")
    docs = table(spark, d, "documents")

    def page(word: str) -> Column:
        line = F.array().cast(f"array<{ingest.LINE}>")
        return F.array(F.struct(F.lit(1).alias("page_number"), F.concat(F.lit(word), "lang").alias("text"), line.alias("lines")))

    for word, some in (("old ", docs), ("new ", docs.where("doc_id % 2 = 0"))):
        sinks.append_ocr_cache(some.select(F.col("doc_id").cast("string").alias("source_file"), text.cache_key(id=F.col("doc_id")).alias("cache_key"), F.lit(1).alias("page_count"), page(word).alias("pages")), folder)
    sinks.compact_ocr_cache(spark, folder, sweep=True)
    return ingest.page_texts(ingest.cached_documents(spark, folder))


@query(REPORT_SQL)
def report_of_runs(spark, d):
    """The report of three runs from their partial ones; the last run replaces some results of the first, whose counts it
    takes back."""
    folder = shared_folder(spark, "reports")
    results = extract(judgments(spark, d), source="k")
    results.write.parquet(f"{folder}/results")
    results = spark.read.parquet(f"{folder}/results")
    k = F.col("source_file").cast("long")
    wrong = results.where(k % 3 == 0).withColumns({"marker_found": F.lit(False), "participants": F.slice("participants", 1, 1)})
    parts = [reports.partial_report(wrong), reports.partial_report(results.where(k % 3 > 0)), reports.partial_report(results.where(k % 3 == 0), wrong)]
    return reports.merged_report(rows.concatenated(*parts))


@query("""SELECT count(DISTINCT c_name) AS names, true AS names_near, true AS median_near FROM customer""")
def sketched_names(spark, d):
    """Distinct names and the median birth year over four runs from merged sketches: within 3 % and 3 % of ranks."""
    k = F.col("c_custkey")
    person = F.struct(F.col("c_name").alias("ho_ten"), (1900 + k % 100).cast("string").alias("nam_sinh"))
    results = table(spark, d, "customer").select(k.alias("k"), F.struct(F.col("c_mktsegment").alias("so_thu_ly")).alias("case_info"), F.array(person).alias("participants"))
    merged = reports.merged_sketches(rows.concatenated(*(reports.sketches(results.where(k % 4 == n)) for n in range(4))))
    customers = table(spark, d, "customer")
    near = F.abs(F.col("names") - F.count_distinct("c_name")) <= 0.03 * F.count_distinct("c_name")
    year, median = 1900 + k % 100, F.get("birth_years", F.lit(1))
    ranks = (F.avg((year <= median).cast("int")) >= 0.47) & (F.avg((year < median).cast("int")) <= 0.53)
    both = customers.crossJoin(F.broadcast(merged))  # of one row
    return both.groupBy("names", "birth_years").agg(F.count_distinct("c_name").alias("n"), near.alias("names_near"), ranks.alias("median_near")).select(F.col("n").alias("names"), "names_near", "median_near")


SAFE_SCHEMA = "result struct<text_before_marker:string,metadata:struct<n:long,ocr_pages:array<int>>>, a array<struct<corrected_text:string,lang:string>>, m map<string,string>"


@query("""SELECT doc_id, '{"result":{"text_before_marker":null,"metadata":{"n":' || doc_id || ',"ocr_pages_redacted":true,"sensitive_text_redacted":true}},"a":[{"corrected_text":null,"lang":"' || lang || '"}],"m":{"corrected_text":null,"k":"v"}}' AS safe FROM documents""")
def redact_typed(spark, d):
    """Private texts out of JSON of a known schema at any depth, as an expression of columns."""
    raw = F.concat(F.lit('{"result": {"text_before_marker": "s", "metadata": {"n": '), F.col("doc_id").cast("string"), F.lit(', "ocr_pages": [1]}}, "a": [{"corrected_text": "é", "lang": "'), F.col("lang"), F.lit('"}], "m": {"corrected_text": "x", "ocr_pages": "y", "k": "v"}}'))
    return rows.redact_typed(table(spark, d, "documents").select("doc_id", raw.alias("safe")), "safe", SAFE_SCHEMA)


@query("""SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN 'a' || chr(10) || p_brand ELSE '' END AS text, CASE p_partkey % 4 WHEN 1 THEN 1.0 WHEN 0 THEN 0.0 END::DOUBLE AS x0, CASE p_partkey % 4 WHEN 0 THEN 0.5 END::DOUBLE AS confidence FROM part WHERE p_partkey % 4 < 3""")
def ocr_answers(spark, d):
    """Lines of engines' answers in each of their shapes: texts or HTML, boxes or polygons; an answer without items has none."""
    k, name = F.col("p_partkey"), lambda c: F.replace(F.col(c), F.lit('"'), F.lit(""))
    answer = (
        F.when(k % 4 == 0, F.concat(F.lit('{"blocks": [], "text_lines": [{"text": " '), name("p_name"), F.lit(' ", "bbox": [0, 1, 2, 3], "confidence": 0.5}]}')))
        .when(k % 4 == 1, F.concat(F.lit('{"blocks": [{"html": "<p>a</p>'), name("p_brand"), F.lit('", "polygon": [[4, 1], [1, 9], [2, 2]]}]}')))
        .when(k % 4 == 2, F.lit('{"lines": [{"text": null}]}')).otherwise("{}")
    )
    lines = table(spark, d, "part").select(k.alias("k"), F.explode(ocr_lines(answer, F.lit(1))).alias("l"))
    return lines.select("k", "l.text", F.get("l.bbox", F.lit(0)).alias("x0"), "l.confidence")


@query("""SELECT r_name AS source_file, r_regionkey % 2 = 0 AS marker_found FROM region""")
def summaries_read(spark, d):
    """Results out of summary files of batches; items that are no objects are left out."""
    folder = shared_folder(spark, "summaries")
    item = F.concat(F.lit('{"total": 1, "results": [{"source_file": "'), F.col("r_name"), F.lit('", "marker_found": '), (F.col("r_regionkey") % 2 == 0).cast("string"), F.lit("}, null]}"))
    table(spark, d, "region").select(item.alias("value"), F.col("r_regionkey").alias("part")).write.partitionBy("part").text(folder)
    return ingest.batch_results(spark, f"{folder}/*/*.txt", "source_file:string,marker_found:boolean")
