"""Registered queries of the rule, payload, merge and validation operators, over headers and payloads made from tables.

The texts are put together from columns of a table, so that SQL knows from the columns what the operators must find.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.catalog import query, spread, table
from docforge.functions import payload, rules, similarity, text, vision
from docforge.functions import vocab as V
from docforge.functions.adapters import apply_model, chosen_engine, labelled_boxes, mock_ocr_lines, polygon_box, read_with, with_entities, with_fallback
from docforge.operators import merge, qa, rows, sequence, validate
from docforge.plans.extract import Options, extract, headers
from docforge.sources import ingest

KINDS = ["hình sự", "dân sự", "hôn nhân gia đình", "kinh doanh thương mại", "lao động"]
KIND_NAMES = ["Hình sự", "Dân sự", "Hôn nhân gia đình", "Kinh doanh thương mại", "Lao động"]
CODES = ["TLST-HS", "TLST-DS", "TLST-HNGĐ", "TLST-KDTM", "TLST-LĐ"]
MARKERS = ["NỘI DUNG VỤ ÁN", "NOI DUNG VU AN:", "NỘI DỤNG VỤ ÁN", "NỘI DUNG CỦA VỤ ÁN"]


def pick(values: list[str], k: Column) -> Column:
    return F.get(F.array(*(F.lit(v) for v in values)), (k % len(values)).cast("int"))


def sql_pick(values: list[str], k: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][({k} % {len(values)})::INT + 1]"


def judgments(spark: SparkSession, d: str) -> DataFrame:
    """(k, text): the head of an invented judgment for each order, spread over all cores, as a text costs far more than a row."""
    k, day = F.col("o_orderkey"), lambda f: F.date_format("o_orderdate", f)
    number = F.concat((k % 99999 + 1).cast("string"), F.lit("/"), day("yyyy"), F.lit("/"), pick(CODES, k))
    date = F.when(k % 3 == 0, F.concat(F.lit(" ngày "), day("d"), F.lit(" tháng "), day("M"), F.lit(" năm "), day("yyyy"))).when(k % 3 == 1, F.concat(F.lit(" ngày "), day("dd/MM/yyyy"))).otherwise("")
    about = F.when(k % 4 == 0, ' về tội "Trộm cắp tài sản".').when(k % 4 == 1, F.concat(F.lit(".\nQuan hệ pháp luật: Tranh chấp số "), F.col("o_custkey").cast("string"), F.lit("."))).when(k % 4 == 2, " về việc: xin ly hôn.").otherwise(".")
    judge = F.when(k % 2 == 0, "Thẩm phán - Chủ tọa phiên tòa: Ông Nguyễn Văn An").otherwise("Chủ tọa phiên tòa: Bà Trần Thị Bích")
    year = (1950 + k % 50).cast("string")
    first = F.concat(F.lit("Bị cáo: Trần Văn Bình, sinh năm "), year, F.lit(", CCCD số "), F.lpad(k.cast("string"), 12, "0"), F.lit("; nơi cư trú: Xã A, huyện B; nghề nghiệp: nông dân"))
    others = (
        F.when(k % 3 == 1, F.concat(F.lit("\nBị hại: Lê Thị Cúc, sinh ngày 1/2/"), year, F.lit(", CMND "), F.lpad(k.cast("string"), 9, "1"), F.lit(", địa chỉ: phố D")))
        .when(k % 3 == 2, F.concat(F.lit("\nNgười làm chứng: 1. Phạm Văn Dũng, sinh năm "), year, F.lit("\n2. Hoàng Thị Em")))
        .otherwise("")
    )
    head = F.concat(F.lit("TÒA ÁN NHÂN DÂN TỈNH X\nVụ án "), pick(KINDS, k), F.lit(" thụ lý số: "), number, date, about, F.lit("\n"), judge, F.lit("\n"), first, others)
    orders = spread(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    return orders.select(k.alias("k"), F.concat(head, F.lit("\n"), pick(MARKERS, k), F.lit("\nBị cáo: Người Khác khai")).alias("text"))


CASE_SQL = f"""SELECT o_orderkey AS k, {sql_pick(KIND_NAMES, 'o_orderkey')} AS loai_an, (o_orderkey % 99999 + 1) || '/' || year(o_orderdate) || '/' || {sql_pick(CODES, 'o_orderkey')} AS so_thu_ly,
CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%d/%m/%Y') END AS ngay_thu_ly,
CASE o_orderkey % 4 WHEN 0 THEN 'Trộm cắp tài sản' WHEN 1 THEN 'Tranh chấp số ' || o_custkey WHEN 2 THEN 'xin ly hôn' END AS quan_he_phap_luat,
CASE WHEN o_orderkey % 2 = 0 THEN 'Nguyễn Văn An' ELSE 'Trần Thị Bích' END AS chu_toa FROM orders"""
PARTY_SQL = """SELECT o_orderkey AS k, 0 AS i, 'Bị cáo' AS tu_cach_to_tung, 'Trần Văn Bình' AS ho_ten, (1950 + o_orderkey % 50)::VARCHAR AS nam_sinh, lpad(o_orderkey::VARCHAR, 12, '0') AS cccd, 'Xã A, huyện B' AS dia_chi FROM orders
UNION ALL SELECT o_orderkey, 1, 'Bị hại', 'Lê Thị Cúc', (1950 + o_orderkey % 50)::VARCHAR, lpad(o_orderkey::VARCHAR, 9, '1'), 'phố D' FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, 1, 'Người làm chứng', 'Phạm Văn Dũng', (1950 + o_orderkey % 50)::VARCHAR, NULL, NULL FROM orders WHERE o_orderkey % 3 = 2
UNION ALL SELECT o_orderkey, 2, 'Người làm chứng', 'Hoàng Thị Em', NULL, NULL, NULL FROM orders WHERE o_orderkey % 3 = 2"""


@query(CASE_SQL)
def rule_case_fields(spark, d):
    """Case type, docket number and date, legal relationship and judge of each header before its marker."""
    docs = headers(judgments(spark, d))
    return text.once(docs, c=rules.case_info(F.col("text_before_marker"))).select("k", "c.*")


@query(PARTY_SQL)
def rule_parties(spark, d):
    """Role blocks, numbered people, names, years, identity numbers and addresses."""
    docs = headers(judgments(spark, d))
    found = docs.select("k", F.posexplode(rules.parties(F.col("text_before_marker"))).alias("i", "p"))
    return found.select("k", "i", *(f"p.{c}" for c in V.PARTY_FIELDS))


WARNING_SQL = """SELECT k, array_to_string(list_filter(['Local LLM not available; rules only.',
  CASE WHEN ngay_thu_ly IS NULL OR quan_he_phap_luat IS NULL THEN 'Thiếu thông tin chung: ' || array_to_string(list_filter([CASE WHEN ngay_thu_ly IS NULL THEN 'NGÀY THỤ LÝ' END, CASE WHEN quan_he_phap_luat IS NULL THEN 'QUAN HỆ PHÁP LUẬT' END], lambda x: x IS NOT NULL), ', ') END,
  CASE WHEN k % 3 = 0 THEN 'Cần review: evidence_text của field NGÀY THỤ LÝ không khớp OCR text.' END,
  'Cần review: có field confidence thấp hoặc thiếu căn cứ.'], lambda x: x IS NOT NULL), '; ') AS w FROM c"""
MISSING_SQL = """CASE WHEN nam_sinh IS NULL THEN 'Thiếu: NĂM SINH, ĐỊA CHỈ; ' WHEN dia_chi IS NULL THEN 'Thiếu: ĐỊA CHỈ; ' ELSE '' END"""


@query(f"""WITH c AS ({CASE_SQL}), p AS ({PARTY_SQL}), w AS ({WARNING_SQL})
SELECT k::VARCHAR AS source_file, i AS row_index, loai_an AS "LOẠI ÁN", so_thu_ly AS "SỐ THỤ LÝ", ngay_thu_ly AS "NGÀY THỤ LÝ (DD/MM/YYYY)", quan_he_phap_luat AS "QUAN HỆ PHÁP LUẬT", tu_cach_to_tung AS "TƯ CÁCH TỐ TỤNG",
       ho_ten AS "HỌ TÊN ĐƯƠNG SỰ", nam_sinh AS "NĂM SINH", cccd AS "CCCD", dia_chi AS "ĐỊA CHỈ", chu_toa AS "HỌ TÊN CHỦ TỌA", {MISSING_SQL} || w AS "GHI CHÚ" FROM p JOIN c USING (k) JOIN w USING (k)""")
def extract_headers(spark, d):
    """The whole plan over headers: normalised, split at the marker, extracted by rules, merged, validated, as flat rows."""
    return rows.flat_rows(extract(judgments(spark, d), source="k"))


@query(f"""WITH c AS ({CASE_SQL}), p AS ({PARTY_SQL}), f AS (SELECT unnest(['loai_an', 'so_thu_ly', 'ngay_thu_ly', 'quan_he_phap_luat', 'chu_toa']) AS f, unnest([loai_an, so_thu_ly, ngay_thu_ly, quan_he_phap_luat, chu_toa]) AS v FROM c),
g AS (SELECT unnest(['tu_cach_to_tung', 'ho_ten', 'nam_sinh', 'cccd', 'dia_chi']) AS f, unnest([tu_cach_to_tung, ho_ten, nam_sinh, cccd, dia_chi]) AS v FROM p)
SELECT 'batch' AS section, 'result_objects' AS key, count(*) AS n FROM c UNION ALL SELECT 'batch', 'participant_rows', count(*) FROM p
UNION ALL SELECT 'marker', unnest(['found', 'not_found']), unnest([count(*), 0]) FROM c UNION ALL SELECT 'review', unnest(['required', 'not_required']), unnest([count(*), 0]) FROM c
UNION ALL SELECT 'extractors', 'rule_support_no_local_llm', count(*) FROM c
UNION ALL SELECT 'case_fields', f || unnest(['.total', '.non_empty', '.empty']), unnest([count(*), count(v), count(*) - count(v)]) FROM f GROUP BY f
UNION ALL SELECT 'participant_fields', f || unnest(['.total', '.non_empty', '.empty']), unnest([count(*), count(v), count(*) - count(v)]) FROM g GROUP BY f
UNION ALL SELECT 'warnings', unnest(['local_llm', 'missing_case_fields', 'needs_review_or_low_confidence', 'missing_participant_fields']), unnest([count(*), count(*) FILTER (k % 3 = 2 OR k % 4 = 3), count(*) FILTER (k % 3 = 0), count(*)]) FROM c
UNION ALL SELECT 'suspicious_counts', unnest(['suspicious_name_like_phrase', 'invalid_birth_year', 'invalid_identity_number_length']), 0""")
def batch_report(spark, d):
    """Counts over the validated results: markers, reviews, fields, warnings, odd values."""
    return qa.batch_report(extract(judgments(spark, d), source="k"))


@query(f"""SELECT o_orderkey AS k, true AS found, [100.0, 100.0, 100.0, 87.5][(o_orderkey % 4)::INT + 1]::DOUBLE AS score FROM orders WHERE o_orderkey % 5 < 4
UNION ALL SELECT o_orderkey, false, NULL FROM orders WHERE o_orderkey % 5 = 4""")
def marker_variants(spark, d):
    """Markers with other accents, without accents, with a colon, with a word more, inside a line; none in every fifth."""
    k = F.col("k")
    line = F.when(k % 4 == 1, "Tòa án xét thấy rằng đây là một câu dài. NOI DUNG VU AN: và phần sau của câu dài này").otherwise(pick(MARKERS, k))
    docs = judgments(spark, d).select("k", F.concat(F.lit("Phần đầu của bản án này\n"), F.when(k % 5 == 4, "0000").otherwise(line), F.lit("\nPhần sau của bản án")).alias("t"))
    out = similarity.find_marker(docs, "t", "m")
    return out.select("k", "m.found", F.when(F.col("m.found"), F.col("m.score")).alias("score"))


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 < 4 THEN 'Phần đầu ' || o_orderkey ELSE '' END AS before_marker FROM orders""")
def without_marker_no_text(spark, d):
    """Text before the marker, and none where there is no marker and the option says so."""
    docs = spread(table(spark, d, "orders").select("o_orderkey"), "o_orderkey").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("Phần đầu "), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 5 < 4, "\nNỘI DUNG VỤ ÁN\nX").otherwise("")).alias("text"))
    return headers(docs, options=Options(extract_without_marker=False)).select("k", F.col("text_before_marker").alias("before_marker"))


GARBLED = [(clean.encode().decode("cp1252"), clean) for clean in ("Tòa án", "Bị cáo số", "Hội đồng")] + [("Ã© 漢", "Ã© 漢"), ("plain", "plain")]


@query(f"SELECT doc_id, {sql_pick([b for _, b in GARBLED], 'doc_id')} || doc_id AS repaired, {sql_pick([b for _, b in GARBLED[:3]] + ['Ã© 漢', 'plain'], 'doc_id')} || doc_id AS key_repaired FROM documents")
def mojibake_repair(spark, d):
    """UTF-8 read as Windows-1252 comes right; what can't have been that stays."""
    raw = F.concat(pick([a for a, _ in GARBLED], F.col("doc_id")), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select("doc_id", text.repair_text(raw).alias("repaired"), text.repair_text(raw, V.MOJIBAKE_KEY).alias("key_repaired"))


@query("SELECT doc_id, lang || ' " + unicodedata.normalize("NFC", "Tòa án é") + "' AS composed FROM documents")
def compose_accents(spark, d):
    return table(spark, d, "documents").select("doc_id", text.nfc(F.concat(F.col("lang"), F.lit(" " + unicodedata.normalize("NFD", "Tòa án é")))).alias("composed"))


@query("SELECT o_orderkey, 'x ngày ' || day(o_orderdate) || ' tháng ' || month(o_orderdate) || ' năm ' || year(o_orderdate) || ' y' AS joined FROM orders")
def split_dates(spark, d):
    day, k = lambda f: F.date_format("o_orderdate", f), F.col("o_orderkey")
    gap = lambda m: F.when(k % m == 0, " \n\n ").otherwise(" ")
    raw = F.concat(F.lit("x ngày "), day("d"), gap(2), F.lit("tháng "), day("M"), gap(3), F.lit("năm "), day("yyyy"), F.lit(" y"))
    return table(spark, d, "orders").select("o_orderkey", text.join_split_dates(raw).alias("joined"))


NAMES = ["Nguyễn Văn An", "An", "Lê 2 Hai", "Bị bắt tạm giam", "Có mặt tại phiên tòa", "Một Hai Ba Bốn Năm Sáu Bảy Tám Chín"]


@query(f"SELECT doc_id, [true, false, false, true, true, false][(doc_id % 6)::INT + 1] AS name, [true, false, false, false, false, false][(doc_id % 6)::INT + 1] AS strict_name, [false, false, false, true, true, false][(doc_id % 6)::INT + 1] AS suspicious FROM documents")
def name_predicates(spark, d):
    """What passes as a person's name, with and without the list of phrases; what a report finds suspicious."""
    n = pick(NAMES, F.col("doc_id"))
    return table(spark, d, "documents").select("doc_id", rules.looks_like_name(n).alias("name"), rules.looks_like_name(n, True).alias("strict_name"), F.rlike(text.ascii_key(n), F.lit(V.SUSPICIOUS_NAME)).alias("suspicious"))


@query("""SELECT count(*) FILTER (doc_id % 6 IN (3, 4)) AS suspicious_name_like_phrase, count(*) FILTER (doc_id % 5 = 1) AS invalid_birth_year, count(*) FILTER (doc_id % 4 = 2) AS invalid_identity_number_length FROM documents""")
def suspicious_counts(spark, d):
    k = F.col("doc_id")
    year = F.when(k % 5 == 0, None).when(k % 5 == 1, "85").otherwise(" 1985 ")
    digits = F.when(k % 4 == 0, None).when(k % 4 == 1, "012 345 678").when(k % 4 == 2, "12345").otherwise("012345678901")
    return table(spark, d, "documents").agg(*(c.alias(n) for n, c in qa.suspicious(pick(NAMES, k), year, digits).items()))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Cần review: field F thiếu evidence_text từ model.' WHEN 1 THEN NULL ELSE NULL END AS note, doc_id % 3 = 2 AS unsure FROM documents""")
def evidence_notes(spark, d):
    """A model's value without evidence is noted, a rule's or one with evidence isn't; confidence below a half."""
    k = F.col("doc_id")
    field = F.struct(F.lit("v").alias("value"), F.when(k % 3 == 2, 0.45).otherwise(0.5).alias("confidence"), F.when(k % 3 == 1, "ngôn ngữ").alias("evidence_text"), F.when(k % 3 == 2, "heuristic_support").otherwise("local_llm").alias("source_method"))
    return table(spark, d, "documents").select("doc_id", validate.evidence_note(field, "F", F.lit("Một ngôn, ngữ")).alias("note"), validate.low_confidence(field).alias("unsure"))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'cũ' ELSE 'cũ; Thiếu: ĐỊA CHỈ' END || CASE WHEN doc_id % 3 = 0 THEN '; Tư cách tố tụng cần kiểm tra: Luật sư' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN '; Năm sinh không phải 4 chữ số: 85' ELSE '' END ||
CASE WHEN doc_id % 7 = 0 THEN '; CCCD/CMND không phải 9 hoặc 12 số.' ELSE '' END AS note, CASE WHEN doc_id % 7 = 0 THEN '12 345' ELSE '012345678' END AS digits FROM documents""")
def party_notes(spark, d):
    k, none = F.col("doc_id"), F.lit(None).cast("string")
    number = F.when(k % 7 == 0, "12 345").otherwise("012 345 678")
    v = {"tu_cach_to_tung": F.when(k % 3 == 0, "Luật sư").otherwise("Bị cáo"), "ho_ten": F.lit("A B"), "nam_sinh": F.when(k % 5 == 0, "85").otherwise("1985"), "cccd": number, "dia_chi": F.when(k % 4 == 0, "x").otherwise(none)}
    return table(spark, d, "documents").select("doc_id", validate.party_notes(v, F.lit("cũ; ; cũ")).alias("note"), validate.identity_digits(number).alias("digits"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'a_' || lang || '_x.pdf' ELSE 'document' END AS stem, ['a', 'b ' || doc_id]::VARCHAR[]::VARCHAR AS notes FROM documents")
def stems_and_notes(spark, d):
    k = F.col("doc_id")
    name, notes = F.when(k % 2 == 0, F.concat(F.lit("  a&?"), F.col("lang"), F.lit("//x.pdf._"))).otherwise(" ?? "), text.split_notes(F.concat(F.lit("a;; b "), k.cast("string"), F.lit(" ;")))
    return table(spark, d, "documents").select("doc_id", text.safe_stem(name).alias("stem"), F.concat(F.lit("["), F.array_join(notes, ", "), F.lit("]")).alias("notes"))


@query("""SELECT doc_id, CASE WHEN n = 1 THEN stem ELSE stem || '_' || n END AS name, place FROM (SELECT doc_id, lang AS stem, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place FROM documents)""")
def unique_names(spark, d):
    """Files of equal names are numbered; rows have a place within their source."""
    named = sequence.unique_names(table(spark, d, "documents").select("doc_id", "lang", "source"), "lang", "doc_id")
    return qa.row_index(named, "source", "doc_id").select("doc_id", "name", F.col("row_index").cast("long").alias("place"))


@query("""SELECT 'TEN_' || upper(c) AS header, n AS blank FROM (SELECT unnest(['quality', 'toxic', 'source']) AS c, unnest([count(*) FILTER (quality IS NULL), count(*) FILTER (toxic IS NULL), count(*) FILTER (source IS NULL OR trim(source) = '')]) AS n FROM documents LEFT JOIN labels USING (doc_id))""")
def blanks_by_column(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return qa.blanks_by_column(docs.select(*(F.col(c).cast("string").alias(f"Tên {c}") for c in ("quality", "toxic", "source"))))


def payloads(spark: SparkSession, d: str) -> DataFrame:
    """(event_id, raw): payloads with public or internal keys, fenced, in arrays, and broken."""
    k, s = F.col("event_id"), F.col("event_id").cast("string")
    public = F.concat(
        F.lit('{"case_type": " Dân sự ", "docket_number": '), s, F.lit(', "legal_relationship": null, "presiding_judge": {"value": "X", "confidence": 3}, "parties": [{"full_name": "N'), s,
        F.lit('", "birth_year": 1990, "evidence_by_field": {"full_name": "e"}}, "no"], "confidence_by_field": {"case_type": 0.7, "full_name": "bad"}, "evidence_by_field": {"case_type": "ev"}, "warnings": ["w", " "], "reasoning_summary": "r"}'),
    )
    internal = F.concat(F.lit('{"case_info": {"loai_an": "Hình sự", "so_thu_ly": {"value": '), s, F.lit('}}, "participants": [{"ho_ten": {"value": "M", "confidence": -1}}, {"ho_ten": "K"}], "confidence_by_field": {"loai_an": 0.2, "ho_ten": 0.6}}'))
    raw = F.when(k % 5 == 0, public).when(k % 5 == 1, F.concat(F.lit("```json\n"), public, F.lit("\n``` "))).when(k % 5 == 2, internal).when(k % 5 == 3, F.concat(F.lit("["), s, F.lit("]"))).otherwise(F.concat(F.lit("{"), s))
    return spread(table(spark, d, "events").select("event_id"), "event_id").select("event_id", raw.alias("raw"))


@query("""SELECT event_id, e < 3 AS ok, CASE e WHEN 3 THEN 'not a JSON object' WHEN 4 THEN 'invalid JSON' END AS error, CASE WHEN e < 2 THEN 'Dân sự' WHEN e = 2 THEN 'Hình sự' END AS kind, CASE WHEN e < 2 THEN 0.7 WHEN e = 2 THEN 0.2 END::DOUBLE AS kind_confidence,
CASE WHEN e < 2 THEN 'ev' END AS kind_evidence, CASE WHEN e < 3 THEN event_id::VARCHAR END AS docket, CASE WHEN e < 2 THEN 1.0 WHEN e = 2 THEN 0.0 END::DOUBLE AS judge_confidence, CASE WHEN e < 2 THEN 'N' || event_id WHEN e = 2 THEN 'M|K' END AS names,
CASE WHEN e < 2 THEN '0.0' WHEN e = 2 THEN '0.0|0.6' END AS name_confidences, CASE WHEN e < 2 THEN 'e' WHEN e = 2 THEN '' END AS name_evidence, CASE WHEN e < 2 THEN 'w|r' WHEN e = 2 THEN '' END AS warnings, CASE WHEN e < 2 THEN 'r' END AS reasoning FROM (SELECT event_id, event_id % 5 AS e FROM events)""")
def payload_fields(spark, d):
    """Payloads parsed strictly, of either shape, as one shape of fields with confidences and evidence."""
    df = text.once(payloads(spark, d), p=payload.parse_object(F.col("raw")))
    df = text.once(df, o=F.when(F.col("p.ok"), payload.extractor_output(F.col("p.payload"), "local_llm")))
    c, people = F.col("o.case_fields"), F.col("o.participants")
    joined = lambda k: F.array_join(F.transform(people, lambda p: p["ho_ten"][k].cast("string")), "|")
    return df.select(
        "event_id", "p.ok", "p.error", c["loai_an"]["value"].alias("kind"), c["loai_an"]["confidence"].alias("kind_confidence"), c["loai_an"]["evidence_text"].alias("kind_evidence"), c["so_thu_ly"]["value"].alias("docket"),
        c["chu_toa"]["confidence"].alias("judge_confidence"), joined("value").alias("names"), joined("confidence").alias("name_confidences"), joined("evidence_text").alias("name_evidence"), F.array_join("o.warnings", "|").alias("warnings"),
        c["quan_he_phap_luat"]["reasoning_brief"].alias("reasoning"),
    )


@query("""WITH e AS (SELECT event_id AS k, 'A' || (event_id % 3) AS a, CASE WHEN event_id % 7 > 0 THEN 'a' || (event_id % 2) END AS b, event_id % 3 AS na, event_id % 2 + 1 AS nb FROM events)
SELECT k AS event_id, CASE WHEN b IS NOT NULL AND lower(a) <> b THEN b ELSE a END AS kind, greatest(na, nb) AS n_parties,
array_to_string(list_transform(range(greatest(na, nb)), lambda i: CASE WHEN i < na THEN 'P' || i ELSE 'S' || i END), '|') AS names,
(b IS NOT NULL AND lower(a) <> b)::INT + least(na, nb) AS n_conflicts, 'model' AS primary_extractor FROM e""")
def merge_two(spark, d):
    """Two outputs of one document: fields by confidence, parties by place, a note for each conflict."""
    k, none = F.col("event_id"), F.lit(None).cast("string")
    case = lambda v: F.struct(*((v if f == "loai_an" else none).alias(f) for f in V.CASE_FIELDS))
    people = lambda n, s: F.transform(F.filter(F.array(*(F.lit(i) for i in range(3))), lambda i: i < n), lambda i: F.struct(*((F.concat(F.lit(s), i.cast("string")) if f == "ho_ten" else none).alias(f) for f in V.PARTY_FIELDS)))
    docs = text.once(table(spark, d, "events").select("event_id"), a=case(F.concat(F.lit("A"), (k % 3).cast("string"))), b=case(F.when(k % 7 > 0, F.concat(F.lit("a"), (k % 2).cast("string")))), pa=people(k % 3, "P"), pb=people(k % 2 + 1, "S"))
    first, second = payload.rule_output(F.col("a"), F.col("pa"), "model"), payload.rule_output(F.col("b"), F.col("pb"), "support")
    surer = second.withField("case_fields.loai_an.confidence", F.lit(0.9))
    docs = text.once(docs, m=merge.merge_outputs(first, surer, F.array(F.lit("first"))))
    names = F.array_join(F.transform("m.participants", lambda p: p["ho_ten"]["value"]), "|")
    return docs.select("event_id", F.col("m.case_fields.loai_an.value").alias("kind"), F.size("m.participants").cast("long").alias("n_parties"), names.alias("names"), (F.size("m.warnings") - 1).cast("long").alias("n_conflicts"), "m.primary_extractor")


@query("""SELECT doc_id, '{"result": {"text_before_marker": null, "metadata": {"n": ' || doc_id || ', "ocr_pages_redacted": true, "sensitive_text_redacted": true}}, "a": [{"corrected_text": null, "lang": "' || lang || '"}]}' AS safe FROM documents""")
def redact_nested(spark, d):
    raw = F.concat(F.lit('{"result": {"text_before_marker": "s", "metadata": {"n": '), F.col("doc_id").cast("string"), F.lit(', "ocr_pages": [1]}}, "a": [{"corrected_text": "é", "lang": "'), F.col("lang"), F.lit('"}]}'))
    return rows.redact_json(table(spark, d, "documents").select("doc_id", raw.alias("safe")), "safe")


@query("SELECT doc_id, sha256('chars=' || (doc_id * 10 + 1) || '|lang=' || lang) AS cache_key, CASE WHEN doc_id % 2 = 0 THEN 'page ' || doc_id END AS page, doc_id % 2 = 0 AS cache_hit FROM documents")
def cache_lookup(spark, d):
    """Pages that a cache has under the key of all options, and those still to be read."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars").withColumn("n_chars", F.col("doc_id") * 10 + 1)
    return cached(docs)


def cached(docs: DataFrame) -> DataFrame:
    options = {"chars": F.col("n_chars"), "lang": F.col("lang")}
    cache = docs.where("doc_id % 2 = 0").select(text.cache_key(**options).alias("cache_key"), F.concat(F.lit("page "), F.col("doc_id").cast("string")).alias("page"))
    return ingest.with_cache(docs, cache, "page", **options).select("doc_id", "cache_key", "page", "cache_hit")


@query("""SELECT c_custkey::VARCHAR AS k, p::INT AS page_number, 'page ' || p AS text FROM customer, unnest(range(1, 8)) AS u(p) WHERE p <= c_custkey % 9 AND p <= c_custkey % 4 + 1""")
def lazy_pages(spark, d):
    """Pages read one by one until the marker's: later ones are never read."""
    files = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("k"), (F.col("c_custkey") % 9).alias("n"))
    return sequence.lazy_pages(files, "k", "n", lambda name, page: f"page {page}" + ("!" if page == int(name) % 4 + 1 else ""), lambda t: t.endswith("!")).withColumn("text", F.regexp_replace("text", "!$", ""))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'rule' ELSE 'model ' || c_custkey END AS value, CASE WHEN c_custkey % 3 = 0 THEN 'ValueError: no answer' END AS error FROM customer")
def model_or_rule(spark, d):
    """A model's answer where it went through, else the rule's; what failed is an error in its own row."""

    def load():
        def model(k):
            if k % 3 == 0:
                raise ValueError("no answer")
            return f"model {k}"

        return model

    df = apply_model(table(spark, d, "customer").select("c_custkey"), "c_custkey", load, "string", out="m", retries=0)
    df = df.withColumn("r", F.struct(F.lit(True).alias("ok"), F.lit("rule").alias("value")))
    return with_fallback(df, "m", "r").select("c_custkey", "value", F.col("m.error").alias("error"))


@query("SELECT c_custkey, least(c_custkey % 7, c_custkey % 5, 3)::DOUBLE AS x0, least(c_custkey % 3, 1, c_custkey % 11)::DOUBLE AS y0, greatest(c_custkey % 7, c_custkey % 5, 3)::DOUBLE AS x1, greatest(c_custkey % 3, 1, c_custkey % 11)::DOUBLE AS y1 FROM customer")
def polygon_boxes(spark, d):
    k = F.col("c_custkey")
    point = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    box = polygon_box(F.array(point(k % 7, k % 3), point(k % 5, F.lit(1)), point(F.lit(3), k % 11)))
    return text.once(table(spark, d, "customer").select("c_custkey"), b=box).select("c_custkey", *(F.get("b", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))


@query("""SELECT doc_id::VARCHAR AS source_file, 0 AS row_index, lang AS value FROM documents UNION ALL SELECT conv_id::VARCHAR, turn::INT, role FROM conversations""")
def results_in_one_table(spark, d):
    """Rows of several runs one below the other, whatever the order of their columns."""
    a = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source_file"), F.lit(0).alias("row_index"), F.col("lang").alias("value"))
    b = table(spark, d, "conversations").select(F.col("role").alias("value"), F.col("turn").cast("int").alias("row_index"), F.col("conv_id").cast("string").alias("source_file"))
    return rows.concatenated(a, b)


@query("""WITH p AS (SELECT p_partkey AS k, p_partkey * 37 % 256 AS r, p_partkey * 7 % 256 AS g, p_partkey * 13 % 256 AS b FROM part)
SELECT k, CASE WHEN r > 120 AND r > 1.25 * g AND r > 1.25 * b THEN 'FFFFFF' ELSE upper(printf('%02x%02x%02x', b, g, r)) END AS pixel FROM p""")
def red_pixels(spark, d):
    """Red pixels of images of one pixel made white, the others as they are."""
    k = F.col("p_partkey")
    data = F.unhex(F.concat(*(F.lpad(F.hex(k * n % 256), 2, "0") for n in (13, 7, 37))))
    images = table(spark, d, "part").select(k.alias("k"), F.struct(F.lit(1).alias("height"), F.lit(1).alias("width"), F.lit(3).alias("nChannels"), data.alias("data")).alias("image"))
    return vision.whiten_red(images).select("k", F.hex("data").alias("pixel"))


@query(f"""WITH c AS ({CASE_SQL}) SELECT k::VARCHAR AS source_file, 5 - (ngay_thu_ly IS NULL)::INT - (quan_he_phap_luat IS NULL)::INT AS n_case, 1 + (k % 3 > 0)::INT + (k % 3 = 2)::INT AS n_parties, k % 3 < 2 OR k % 4 < 3 AS ok FROM c""")
def smoke_counts(spark, d):
    """How much an extraction has in it, and whether that is enough."""
    return qa.smoke(extract(judgments(spark, d), source="k"), method="rule_support_no_local_llm", case_fields=4)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
b AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS label FROM l WHERE trim(line) <> '')
SELECT doc_id, label::INT AS label, 40.0::DOUBLE AS x0, (40 + 34 * i)::DOUBLE AS y0, 1200.0::DOUBLE AS x1, (68 + 34 * i)::DOUBLE AS y1 FROM b WHERE i % 3 > 0""")
def overlay_boxes(spark, d):
    """Boxes to draw over a page; lines without a whole box keep their number."""
    lines = F.transform(mock_ocr_lines(F.col("text")), lambda b: b.withField("bbox", F.when((F.get(b["bbox"], F.lit(1)) - 40) % 102 == 0, F.array(F.lit(1.0))).otherwise(b["bbox"])))
    docs = text.once(table(spark, d, "documents").select("doc_id", "text"), boxes=labelled_boxes(lines))
    return docs.select("doc_id", F.inline("boxes"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN 'PER:' || c_name ELSE '' END AS entities FROM customer""")
def entities_beside_fields(spark, d):
    """What a recogniser finds, of the labels asked for and sure enough; a failure gives none."""

    def load():
        def find(name):
            if int(name.rsplit("#", 1)[-1]) % 5 == 0:
                raise ValueError("no model")
            return [{"text": name, "label": "PER", "score": 0.35}, {"text": name, "label": "LOC", "score": 0.9}, {"text": "x", "label": "PER", "score": 0.34}]

        return find

    df = with_entities(spread(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey"), "c_name", load, ["PER", "ORG"])
    return df.select("c_custkey", F.array_join(F.transform("entities", lambda e: F.concat_ws(":", e["label"], e["text"])), ",").alias("entities"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'remote ' WHEN n_nationkey % 3 = 0 THEN 'local ' END || n_name AS page, n_nationkey % 2 = 0 OR n_nationkey % 3 = 0 AS ok FROM nation""")
def engines_in_order(spark, d):
    """A page by the remote engine, else by the local one; what neither reads is an error of its own."""

    def engine(name, every):
        def load():
            def read(value):
                if int(value.split("|")[0]) % every:
                    raise ValueError("unreadable")
                return f"{name} {value.split('|')[1]}"

            return read

        return load

    pages = table(spark, d, "nation").select("n_nationkey", F.concat_ws("|", F.col("n_nationkey").cast("string"), "n_name").alias("image"))
    out = read_with(pages, "image", chosen_engine(engine("remote", 2), engine("local", 3)), "string")
    return out.select("n_nationkey", F.col("page.value").alias("page"), F.col("page.ok").alias("ok"))
