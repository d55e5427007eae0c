"""What an extraction must not do twice, or for every row."""

from pyspark.sql import functions as F

from docforge.functions import payload
from docforge.functions import vocab as V
from docforge.functions.text import evidence_keys
from docforge.operators import merge, validate
from docforge.plans.extract import extract

TEXT = "Bị cáo: Trần Văn Bình, thụ lý số 12/1995/TLST-HS ngày 5 tháng 3 năm 1995\nNỘI DUNG VỤ ÁN"


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def documents(spark):
    return spark.createDataFrame([("a", TEXT), ("b", "x"), ("c", None)], "source_file string, text string")


def test_rules_alone_are_not_weighed_against_themselves(spark):
    party = F.struct(*(F.col(f).alias(f) for f in V.PARTY_FIELDS))
    rows = spark.createDataFrame([("A", None, "", "x", " "), ("Á", "1", "2", None, "y")], list(V.PARTY_FIELDS))
    rows = rows.withColumn("case", F.struct(*(F.col(p).alias(c) for p, c in zip(V.PARTY_FIELDS, V.CASE_FIELDS, strict=True)))).withColumn("people", F.array(party, party))
    one, other = (payload.rule_output(F.col("case"), F.col("people"), m) for m in ("m", "s"))
    notes = F.array(F.lit("w"), F.lit("w"), F.lit(""))
    got = rows.select(merge.merge_outputs(one, other, notes).alias("a"), merge.unopposed(one, notes, "s").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert "heuristic_support" not in plan(extract(documents(spark))).split("_valid")[0]


def test_evidence_that_stands_in_the_text_is_no_claim(spark):
    field = lambda v: F.struct(F.lit("v").alias("value"), F.lit(0.9).alias("confidence"), F.lit(v).alias("evidence_text"), F.lit("llm").alias("source_method"))
    texts = spark.createDataFrame([(TEXT,)], "t string")
    words = ["Trần Văn", "05/03/1995", ":", None, "ΣΑΣ"]
    row = texts.select(*(validate.claim(field(w), "F", F.col("t")).isNull().alias(str(i)) for i, w in enumerate(words))).first()
    assert list(row) == [True, False, False, False, False]
    notes = texts.select(*(validate.evidence_note(field(w), "F", F.col("t")).alias(str(i)) for i, w in enumerate([*words, "TRẦN văn", "12 1995"]))).first()
    wrong, none = V.WRONG_EVIDENCE.format("F"), V.NO_EVIDENCE.format("F")
    assert list(notes) == [None, wrong, wrong, none, wrong, None, None]


def test_keys_of_a_text_with_slashes_are_those_without(spark):
    texts = spark.createDataFrame([("Số 1 / 2, a/b 3/4",), ("ᐅ 1/2",), ("a b",)], "t string")
    got = [tuple(r.k) for r in texts.select(evidence_keys(F.col("t")).alias("k")).collect()]
    assert got == [("số 1 2 a b 3 4", "số12ab34", "số1ᐅ2ab3ᐅ4"), ("ᐅ 1 2", "ᐅ12", "ᐅ1ᐅ2"), ("a b", "ab", None)]


def test_warnings_are_made_once(spark):
    case = F.struct(*(F.struct(F.lit("v").alias("value"), F.lit(0.9).alias("confidence"), F.lit("v").alias("evidence_text"), F.lit("llm").alias("source_method")).alias(k) for k in V.CASE_FIELDS))
    people = F.array().cast("array<struct<" + ",".join(f"{k}:struct<value:string,confidence:double,evidence_text:string,source_method:string>" for k in V.PARTY_FIELDS) + ">>")
    out = spark.range(1).select(validate.validate(case, people, F.lit(True), F.lit("v"), F.array(F.lit("w"))).alias("v"))
    assert plan(out).count(V.NO_PARTIES) == 1
    assert out.first().v.warnings == ["w", f"{V.BAD_DATE}v", V.NO_PARTIES] and out.first().v.review_required
