"""Rules, marker search, merging, validation, reports and sources on small texts of our own."""

import json
import random
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from docforge.__main__ import run
from docforge.functions import chat, payload, rules, similarity, text
from docforge.functions import vocab as V
from docforge.functions.adapters import apply_model, polygon_box, with_fallback
from docforge.operators import evidence, merge, qa, rows, sequence, validate
from docforge.plans.batch import Batch, batch_summary, process_batch
from docforge.plans.extract import Options, extract, headers
from docforge.sources import ingest, options, sinks
from docforge.streaming.incremental import process_new

HEADER = """TÒA ÁN NHÂN DÂN TỈNH X
Vụ án hình sự thụ lý số: 12/2024/TLST-HS ngày 5 tháng 3 năm 2024 về tội "Trộm cắp tài sản".
Thẩm phán - Chủ tọa phiên tòa: Ông Nguyễn Văn An
Bị cáo: Trần Văn Bình, sinh năm 1990, CCCD số 012345678901; nơi cư trú: Xã A, huyện B; nghề nghiệp: nông dân
Bị hại: Lê Thị Cúc, sinh ngày 1/2/1985, CMND 123456789, địa chỉ: phố D
Người có quyền lợi, nghĩa vụ liên quan: Phạm Văn Dũng, sinh năm 1970
NỘI DỤNG VỤ ÁN
Bị cáo: Người Khác khai"""


def value(spark, column, **inputs):
    df = spark.createDataFrame([tuple(inputs.values())], ", ".join(f"{k} string" for k in inputs)) if inputs else spark.range(1)
    return df.select(column.alias("v")).first()[0]


@pytest.fixture(scope="module")
def judged(spark):
    df = spark.createDataFrame([("a", HEADER), ("b", "không có gì"), ("c", None), ("d", "")], "source_file string, text string")
    return extract(df).cache()


def test_extraction_of_a_header(judged):
    r = {x.source_file: x for x in judged.collect()}
    a = r["a"]
    assert a.marker_found and a.case_info.asDict() == {"loai_an": "Hình sự", "so_thu_ly": "12/2024/TLST-HS", "ngay_thu_ly": "05/03/2024", "quan_he_phap_luat": "Trộm cắp tài sản", "chu_toa": "Nguyễn Văn An"}
    assert [(p.tu_cach_to_tung, p.ho_ten, p.nam_sinh, p.cccd, p.dia_chi) for p in a.participants] == [
        ("Bị cáo", "Trần Văn Bình", "1990", "012345678901", "Xã A, huyện B"),
        ("Bị hại", "Lê Thị Cúc", "1985", "123456789", "phố D"),
        ("Người có quyền lợi, nghĩa vụ liên quan", "Phạm Văn Dũng", "1970", None, None),
    ]
    assert all(x.review_required for x in r.values())
    assert not r["c"].marker_found and r["c"].participants == [] and V.NO_PARTIES in r["c"].warnings


def test_flat_rows_and_report(judged):
    flat = rows.flat_rows(judged).collect()
    assert len(flat) == 6 and flat[0].asDict().keys() - {"source_file", "row_index"} == set(V.ROW_HEADERS)
    report = {(x.section, x.key): x.n for x in qa.batch_report(judged).collect()}
    assert report["batch", "participant_rows"] == 3 and report["marker", "found"] == 1 and report["participant_fields", "cccd.empty"] == 1


@pytest.mark.parametrize("line", ["NỘI DỤNG VỤ ÁN", "NOI DUNG VU AN:", "NỘI DUNG CỦA VỤ ÁN", "N0I DUNG VU AN"])
def test_marker_variants(spark, line):
    df = headers(spark.createDataFrame([(f"phần đầu\n{line}\nPhần sau",)], "text string"))
    r = df.first()
    assert r.marker.found and r.text_before_marker == "phần đầu"


def test_no_marker_can_mean_no_text(spark):
    df = headers(spark.createDataFrame([("chỉ có phần đầu",)], "text string"), options=Options(extract_without_marker=False))
    assert df.first().text_before_marker == ""


def test_scores(spark):
    score = lambda a, b: value(spark, similarity.indel_score(F.col("a"), F.col("b")), a=a, b=b)
    assert score("NOI DUNG CUA VU AN", "NOI DUNG VU AN") == pytest.approx(87.5)
    assert score("", "") == 100 and score("abc", "") == 0 and score("abc", "xbz") == pytest.approx(100 / 3)


def slow_best(text, marker, threshold, spark):
    keys = [value(spark, text_key(F.col("t")), t=t) for t in text.split("\n")]
    goal = value(spark, text_key(F.lit(marker)))
    lines, best = text.split("\n"), None
    for i in range(len(lines)):
        for n in (1, 2, 3):
            raw = " ".join(lines[i : i + n]).strip(" \t")
            key = " ".join(k for k in keys[i : i + n] if k)
            if raw and 200 * min(len(key), len(goal)) >= threshold * (len(key) + len(goal)):
                table = [[0] * (len(goal) + 1) for _ in range(len(key) + 1)]
                for a, x in enumerate(key, 1):
                    for b, y in enumerate(goal, 1):
                        table[a][b] = table[a - 1][b - 1] + 1 if x == y else max(table[a - 1][b], table[a][b - 1])
                score = 200 * table[-1][-1] / (len(key) + len(goal))
                if best is None or score > best[0]:
                    best = (score, raw)
    return best


text_key = text.match_key


def test_best_window_against_every_window(spark):
    rng = random.Random(4)
    cases = ["\n".join("".join(rng.choice("ND OIUGVẤAss ") for _ in range(rng.randrange(0, 14))) for _ in range(9)) for _ in range(12)] + ["", " ", "Nội\ndung\nvụ án", "x" * 50]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)] + [(99, None)], "i int, t string")
    got = {r.i: r.b for r in df.select("i", similarity.best_window(F.col("t"), threshold=30.0).alias("b")).collect()}
    for i, c in enumerate(cases):
        want = slow_best(c, V.MARKER, 30.0, spark)
        assert (got[i].score, got[i].text) == (want or (None, None)) if want is None else (got[i].score == pytest.approx(want[0]) and got[i].text == want[1]), c
    assert got[99].score is None


def test_evidence_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "The cat, sat on THE mat."), (2, "catsat"), (3, None), (4, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "cat sat"), (2, "the mat"), (3, "dog"), (4, " ?"), (5, None), (6, "c at")], "item_id int, text string")
    for part, group in ((1 << 20, 1 << 24), (7, 8)):
        monkeypatch.setattr(evidence, "PART", part)
        monkeypatch.setattr(evidence, "GROUP", group)
        assert sorted(map(tuple, evidence.holds(docs, items).collect())) == [(1, 1), (1, 2), (1, 6), (2, 1), (2, 6)]


def test_normalisation(spark):
    n = lambda t, **k: value(spark, text.normalise(F.col("t"), **k), t=t)
    assert n("a\r\n\r\n\r\n\r\nB​. \t x\r") == "a\n\nB. x"
    assert n("ngày 5\ntháng 3\nnăm 2024") == "ngày 5 tháng 3 năm 2024"
    assert n("dòng một\ntiếp theo\nBị cáo: x\ny") == "dòng một tiếp theo\nBị cáo: x y"
    assert n(None) == "" and n("") == ""
    assert n("BỊ CÁ0") == "BỊ CÁO"
    assert n("Hội đồng".encode().decode("cp1252")) == "Hội đồng" == n("H\u006f\u0323\u0302i đo\u0302\u0300ng") and n("Ã© 漢") == "Ã© 漢"
    assert n("Ã©", composed=False) == "Ã©" and n("ngày\n5\ntháng\n3\n\nnăm 2024") == "ngày 5 tháng 3 năm 2024"


def test_keys(spark):
    assert value(spark, text.match_key(F.col("t")), t="Nội dung: Đ 01") == "NOI DUNG OI"
    assert value(spark, text.compare_key(F.col("t")), t="  Tòa-án  ") == "toa an"
    assert value(spark, text.contains_evidence(F.col("a"), F.col("b")), a="Ông Nguyễn, Văn  An", b="nguyễn văn an")
    assert not value(spark, text.contains_evidence(F.col("a"), F.col("b")), a="x", b=" ")
    assert value(spark, text.safe_header(F.col("t")), t=" Năm sinh ") == "NAM_SINH"


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("số 1801/1995/TLST-LĐ", "18/01/1995", False), ("12409/2000", "24/09/2000", False), ("ngày 18 / 01/1995", "18/01/1995", True), ("18-01-1995", "18/01/1995", True), ("012 345.678", "012345678", True), ("Lê Văn", "Lê/Văn", True)],
)
def test_a_slash_parts_numbers_of_evidence(spark, a, b, want):
    assert value(spark, text.contains_evidence(F.col("a"), F.col("b")), a=a, b=b) is want


ODD_CASES = [
    "Hınh ſu", "HİNH SU", "hſſt", "tlpt-hs", "HÌNH\nSỰ", "Ds-ſt", "TLST-DS", "dân sự", "HNGĐ", "hôn  nhân", "\u212ainh doanh", "KDTM", "Kınh doanh", "LAO ĐỘNG", "lđ-ſt", "ſố thụ lý 8/2023/HſST ngày 1/2/2023",
    "THỤ LÝ SƠ THẨM SỐ: 9 / 2022 / KDTM-ST", "ngày 12 tháng 11 năm 2021", "v/V: tranh chấp", "V\\V ly hôn", "về việc kiện đòi", "QUAN HỆ PHÁP LUẬT: nợ", "tội danh: x", "Về Tội “Y”", "CHỦ TỌA PHIÊN TÒA: Bà Lê Thị Hoa",
    "THẨM PHÁN CHỦ TỌA: A B", "các BỊ CÁO: A B C", "NGƯỜI LÀM CHỨNG: D E", "Bị hại: F G", "NGƯỜI có quyền lợi, nghĩa vụ liên quan: H I", "nộı Dưng vụ án", "NOİ dung vu an :", "n0ı dung vu an", "plain", "", None,
]


def test_hints_lose_no_match(spark, monkeypatch):
    """What is sought only where a hint stands is what is found when every pattern is tried."""

    def found():
        df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_CASES)], "k int, t string")
        out = similarity.find_marker(df, "t").select("k", "marker", rules.case_info(F.col("t")).alias("case"), rules.parties(F.col("t")).alias("people"))
        return sorted((r.k, str(r)) for r in out.collect())

    hinted = found()
    monkeypatch.setattr(rules, "has_hint", lambda *_: F.lit(True))
    monkeypatch.setattr(similarity, "has_hint", lambda *_: F.lit(True))
    assert hinted == found()
    fields = {k: sum(k in r for _, r in hinted) for k in ("loai_an='", "chu_toa='", "found=True", "ho_ten='")}
    assert all(n > 0 for n in fields.values()), fields


def test_texts_without_hints_cost_less_than_the_patterns(spark):
    """A text in which no field can stand is passed over by plain searches: less work than the patterns of one field."""
    line = "He said that the weather in their part of the country had been fine, and nobody asked what came of it. "
    df = spark.range(15000).select(F.concat(F.lit(line * 30), F.col("id").cast("string")).alias("t")).repartition(4).cache()
    df.count()

    def seconds(c):
        took = []
        for _ in range(3):
            start = time.perf_counter()
            text.once(df, x=c).select("x").write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        return min(took)

    patterns = F.array(*(F.rlike("t", F.lit(text.IGNORE + p)) for p, _ in V.CASE_TYPES))
    assert seconds(F.struct(rules.case_info(F.col("t")), rules.parties(F.col("t")))) < seconds(patterns)


def test_a_text_stays_bound_beside_an_alias_of_its_name(spark):
    df = spark.createDataFrame([("TLST-DS ngày 12 tháng 11 năm 2021",)], "text string")
    r = df.select(F.lit("x").alias("text"), rules.case_info(F.col("text")).alias("case")).first()
    assert r.case.loai_an == "Dân sự" and r.case.ngay_thu_ly == "12/11/2021"


def test_few_passes_over_a_text(spark):
    """Long lines get no key, a text is sought once for its marker, and composition needs no scan by a pattern."""
    assert similarity.search(["x" * 50, "NỘI DUNG VỤ ÁN"], [None, "NOI DUNG VU AN"], "NOI DUNG VU AN", 82.0)[0] == 100
    lines = ["Tòa á́n 01", "ßﬁ ŉ Đ", "", "N.0.I  D-U"]
    keys = [r.k for r in spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, t string").orderBy("i").select(text.match_key(F.col("t")).alias("k")).collect()]
    assert keys == [similarity.line_key(x) for x in lines]
    assert all(similarity.letters(x) <= len(k) for x, k in zip(lines, keys, strict=True) if "." not in x)


def test_dates(spark):
    assert value(spark, rules.parse_date(F.col("t")), t="31/2/2024") == "31/02/2024"
    assert value(spark, rules.parse_date(F.col("t")), t="32/1/2024") is None
    assert not value(spark, rules.valid_date(F.col("t")), t="31/02/2024") and value(spark, rules.valid_date(F.col("t")), t="29/02/2024")


def field(v, c, m):
    return F.struct(F.lit(v).cast("string").alias("value"), F.lit(c).cast("double").alias("confidence"), F.lit(m).alias("source_method"))


@pytest.mark.parametrize(("p", "s", "want"), [(("A", 0.4), ("B", 0.9), "B"), (("A", 0.9), ("B", 0.9), "A"), (("Án", 0.1), ("an", 0.9), "Án"), ((None, 0.9), ("B", 0.1), "B"), (("", 0.9), (None, 0.1), "")])
def test_field_selection(spark, p, s, want):
    a, b = field(*p, "p"), field(*s, "s")
    assert value(spark, merge.select_field(a, b)["value"]) == want
    note = value(spark, merge.conflict_note(a, b, F.lit("f")))
    assert (note is not None) == (p[0] == "A")


def test_a_payload_is_parsed_once(spark):
    """What is costly is named once: the parse, a scalar's text, and each key of a map of members."""
    raw = F.col("raw")
    assert str(payload.parse_object(raw)).count("try_parse_json") == 1
    assert str(payload.scalar(raw)).count("raw") == 1
    assert str(payload.first_present(raw, "a", "b")).count("raw") == 2
    df = spark.createDataFrame([('{"a": null, "b": "{x}"}',), ("[1]",), (None,)], "raw string")
    top = text.once(df, m=payload.members(payload.parse_object(raw)["payload"]))
    out = top.select(payload.first_present(F.col("m"), "a", "b").isNull().alias("none"), payload.scalar(payload.first_present(F.col("m"), "a", "b")).alias("first"), payload.scalar(payload.first_present(F.col("m"), "z", "b")).alias("second"))
    assert [tuple(r) for r in out.collect()] == [(False, None, "{x}"), (True, None, None), (True, None, None)]


def test_payloads(spark):
    public = {"case_type": "Dân sự", "docket_number": 5, "presiding_judge": {"value": "X", "confidence": 3}, "parties": [{"full_name": "N", "evidence_by_field": {"full_name": "e"}}, "no"], "confidence_by_field": {"case_type": 0.7, "full_name": "bad"}, "warnings": ["w", " "], "reasoning_summary": "r"}
    internal = {"case_info": {"loai_an": "Hình sự"}, "participants": [{"ho_ten": {"value": "M"}}], "confidence_by_field": {"loai_an": 0.2}}
    raw = ["```json\n" + json.dumps(public) + "\n```", json.dumps(internal), "[1]", "{oops", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string")
    df = text.once(df, p=payload.parse_object(F.col("raw")))
    df = df.withColumn("o", F.when(F.col("p.ok"), payload.extractor_output(F.col("p.payload"), "local_llm")))
    r = df.select("i", "p.ok", "p.error", "o").orderBy("i").collect()
    assert [x.ok for x in r] == [True, True, False, False, False] and r[2].error == "not a JSON object"
    a, b = r[0].o, r[1].o
    assert (a.case_fields.loai_an.value, a.case_fields.loai_an.confidence, a.case_fields.so_thu_ly.value) == ("Dân sự", 0.7, "5")
    assert a.case_fields.chu_toa.confidence == 1.0 and a.warnings == ["w", "r"]
    assert [(p.ho_ten.value, p.ho_ten.evidence_text, p.ho_ten.confidence) for p in a.participants] == [("N", "e", 0.0)]
    assert (b.case_fields.loai_an.value, b.case_fields.loai_an.confidence, b.participants[0].ho_ten.value) == ("Hình sự", 0.2, "M")


def test_party_notes(spark):
    v = {"tu_cach_to_tung": F.lit("Luật sư"), "ho_ten": F.lit("A B"), "nam_sinh": F.lit("85"), "cccd": F.lit("12345"), "dia_chi": F.lit(None).cast("string")}
    note = value(spark, validate.party_notes(v, F.lit("cũ; cũ")))
    assert note == "cũ; Thiếu: ĐỊA CHỈ; Tư cách tố tụng cần kiểm tra: Luật sư; Năm sinh không phải 4 chữ số: 85; CCCD/CMND không phải 9 hoặc 12 số."
    assert value(spark, validate.identity_digits(F.lit("012 345 678"))) == "012345678"


def test_early_stop(spark):
    pages = spark.createDataFrame([("a", 1, "x"), ("a", 2, "M"), ("a", 3, "M"), ("b", 1, "x"), ("c", 1, "x"), ("c", 2, "x"), ("c", 3, "M")], "k string, p int, t string")
    run = lambda **o: {r.k: (r.pages_ocr, r.marker_page, r.stop_reason) for r in sequence.early_stop(pages, "k", "p", F.col("t") == "M", **o).collect()}
    assert run(most=2) == {"a": (2, 2, V.STOP_REASONS[0]), "b": (1, None, V.STOP_REASONS[2]), "c": (2, None, V.STOP_REASONS[3])}
    assert run(most=2, full=True)["a"] == (3, 3, V.STOP_REASONS[1])
    assert run(stop=False)["a"] == (3, 3, V.STOP_REASONS[2])


def test_lazy_pages_read_no_further(spark, tmp_path):
    seen = str(tmp_path)

    def read(name, page):
        open(f"{seen}/{name}-{page}", "w").close()
        return "M" if page == 2 else "x"

    files = spark.createDataFrame([("a", 10)], "k string, n int")
    assert sequence.lazy_pages(files, "k", "n", read, lambda t: t == "M").count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a-1", "a-2"]


def test_redaction(spark):
    raw = json.dumps({"result": {"text_before_marker": "s", "metadata": {"ocr_pages": [1]}}, "a": [{"corrected_text": "s"}]})
    out = json.loads(rows.redact_json(spark.createDataFrame([(raw,)], "j string"), "j").first().j)
    assert out == {"result": {"text_before_marker": None, "metadata": {"ocr_pages_redacted": True, "sensitive_text_redacted": True}}, "a": [{"corrected_text": None}]}


def test_accuracy_without_rows(spark):
    empty = spark.createDataFrame([], "source_file string, row_index string, f string")
    assert [tuple(r) for r in qa.field_accuracy(empty, empty, ["f"]).collect()] == [("f", 0, 0, 0.0)]


def test_models_fail_alone_and_fall_back(spark):
    def load():
        def model(v):
            if v == "bad":
                raise RuntimeError("no")
            return v.upper()

        return model

    df = spark.createDataFrame([("ok",), ("bad",)], "t string")
    out = apply_model(apply_model(df, "t", load, "string", out="m", retries=1), "t", lambda: lambda v: "rule", "string", out="r")
    assert {r.t: r.value for r in with_fallback(out, "m", "r").collect()} == {"ok": "OK", "bad": "rule"}
    box = F.array(F.array(F.lit(3.0), F.lit(1.0)), F.array(F.lit(1.0), F.lit(5.0)))
    assert value(spark, polygon_box(box)) == [1.0, 1.0, 3.0, 5.0]


def test_failures_of_a_batch_wait_together(spark):
    def load():
        calls = {}

        def model(v):
            calls[v] = calls.get(v, 0) + 1
            if v % 2 or v % 4 == 0 and calls[v] < 3:
                raise ValueError("no")
            return calls[v]

        return model

    start = time.monotonic()
    out = apply_model(spark.range(2000).coalesce(1), "id", load, "int", retries=2).select("id", "model.*").collect()
    assert time.monotonic() - start < 20  # one wait for each row that fails would be 45 s
    assert all((r.ok, r.value) == ((False, None) if r.id % 2 else (True, 3 if r.id % 4 == 0 else 1)) for r in out)


def test_files(spark, tmp_path):
    for name, content in (("b.pdf", b"%PDF 1"), ("a.pdf", b"%PDF 1"), ("c.pdf", b"no"), ("d.txt", b"x")):
        (tmp_path / name).write_bytes(content)
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        z.writestr("in.PDF", b"%PDF 2")
        z.writestr("no.txt", b"")
    (tmp_path / "bad.zip").write_bytes(b"no")
    files = ingest.binary_files(spark, str(tmp_path))
    assert files.count() == 3 and {r.error for r in ingest.checked(files).collect()} == {None, "unexpected content"}
    fresh = ingest.not_processed(files, files.where("length = 2").select("file_id"))
    assert [r.path.rsplit("/", 1)[1] for r in fresh.collect()] == ["a.pdf"]
    members = {r.member: r.error for r in ingest.zip_members(ingest.binary_files(spark, str(tmp_path), "zip")).collect()}
    assert members == {"in.PDF": None, None: "broken archive: BadZipFile"}
    (tmp_path / "gold.csv").write_text("﻿source_file,f\na,1\n", encoding="utf-8")
    assert ingest.gold_rows(spark, str(tmp_path / "gold.csv")).first().source_file == "a"
    (tmp_path / "gold.json").write_text('{"rows": [{"source_file": "b"}]}')
    assert ingest.gold_rows(spark, str(tmp_path / "gold.json")).first().source_file == "b"


def test_sinks_and_stream(spark, tmp_path, judged):
    sinks.write_rows(rows.flat_rows(judged), str(tmp_path / "rows"), single=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "rows")).count() == 6
    spark.range(5).write.parquet(str(tmp_path / "in"))
    seen = []
    for _ in range(2):
        process_new(spark, str(tmp_path / "in"), "id long", str(tmp_path / "state"), lambda df, n: seen.append(df.count())).awaitTermination()
    assert sum(seen) == 5


def test_options_are_checked():
    for bad in ({"limit": 0}, {"sample": -1}, {"most_pages": 51}, {"dpi": 301}):
        with pytest.raises(ValueError, match="must be"):
            Batch(**bad).check()


def test_a_batch_with_a_limit_of_files_that_all_fail(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(12):
        (tmp_path / "in" / f"{i:02}.pdf").write_bytes(b"%PDF " + str(i).encode())

    def load():
        def read(content, most):
            raise RuntimeError("broken")

        return read

    done = process_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), load, Batch(limit=10))
    assert done.count() == 10 == done.where("error = 'RuntimeError: broken'").count()
    summary = spark.read.json(str(tmp_path / "out/summary/run=*/summary")).first()
    assert tuple(batch_summary(spark, str(tmp_path / "out"))["counts"].first()) == (10, 0, 10, 0)
    assert (summary.total, summary.success, summary.failed, summary.skipped) == (10, 0, 10, 0)
    required = process_batch(spark, str(tmp_path / "in"), str(tmp_path / "out2"), lambda: lambda c, m: ["text"], Batch(limit=2, require_model=True))
    assert {r.error for r in required.collect()} == {"RequiredModelError: no answer of the model"}


def test_environment(tmp_path):
    (tmp_path / ".env").write_text("# no\nA='x y'\nB=2\nC\nD=on\nE=bad\n")
    e = options.load_env(str(tmp_path / ".env"), {"B": "3"})
    assert e == {"A": "x y", "B": "3", "D": "on", "E": "bad"}
    assert options.flag(e, "Z", "D") and not options.flag(e, "A") and options.flag(e, "Z", default=True)
    assert options.number(e, "Z", "B", default=7) == 3 and options.number(e, "E", default=7) == 7 and options.number(e, "B", default=1.5) == 3.0
    assert options.listed("vi, en,") == ["vi", "en"] and options.prompt(str(tmp_path / "none"), "p") == "p"


def test_a_chat_model_mends_its_answer_once():
    sent = []

    def send(url, body, **_):
        sent.append(body["messages"][0]["content"])
        return {"choices": [{"message": {"content": answers.pop(0)}}]} if len(sent) % 2 else {"message": {"content": answers.pop(0)}}

    answers = ["{oops", '```json\n{"case_type": "x"}\n```']
    assert json.loads(chat.chat_model("u", "m", "Q {}", send=send)()("text")) == {"case_type": "x"} and sent[0] == "Q text" and "{oops" in sent[1]
    answers = ["[1]", "[2]"]
    with pytest.raises(chat.ModelError):
        chat.chat_model("u", "m", "Q {}", send=send)()("text")


def test_command_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("%PDF\n" + HEADER, encoding="utf-8")
    (tmp_path / "in" / "b.txt").write_text("", encoding="utf-8")
    out = str(tmp_path / "out")
    assert sorted((r.path.rsplit("/", 1)[1], r.error) for r in run(spark, ["batch", str(tmp_path / "in"), out]).collect()) == [("a.txt", None), ("b.txt", "empty file")]
    report = {(r.section, r.key): r.n for r in run(spark, ["report", out]).collect()}
    assert report["batch", "result_objects"] == 1 and report["batch", "participant_rows"] == 3
    spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/rows").coalesce(1).write.json(f"{tmp_path}/gold.jsonl")
    assert {r.accuracy for r in run(spark, ["score", f"{out}/rows", f"{tmp_path}/gold.jsonl"]).collect()} == {1.0}
