"""Reports that count and never quote: fill rates, histograms, accuracy against gold rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docforge.functions import vocab as V
from docforge.functions.text import ascii_key, eval_key, is_blank, let, once, safe_header


def fill_rates(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(by, field, total, non_empty, empty), in one pass: sums for each column first, rows for columns after."""
    by = by or []
    sums = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *(F.count_if(~is_blank(F.col(c).cast("string"))).alias(f"n{i}") for i, c in enumerate(columns)))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"n{i}").alias("non_empty")) for i, c in enumerate(columns)))).alias("p")
    return sums.select(*by, "total", pairs).select(*by, "p.field", "total", "p.non_empty", (F.col("total") - F.col("p.non_empty")).alias("empty"))


def histogram(df: DataFrame, value: Column, out: str) -> DataFrame:
    return df.groupBy(F.coalesce(value, F.lit("unknown")).alias(out)).agg(F.count(F.lit(1)).alias("n"))


def warning_group(c: Column) -> Column:
    """The first group whose phrase stands in the unaccented warning; those of warnings without a variable part are known."""

    def group(key: Column) -> Column:
        out = F.when(F.lit(False), "")
        for phrase, name in V.WARNING_GROUPS:
            out = out.when(F.rlike(key, F.lit(phrase)), name)
        return out.otherwise("other")

    known = F.when(F.lit(False), "")
    for warning in (V.RULES_ONLY, V.LOW_CONFIDENCE_WARNING, V.NO_MARKER, V.NO_PARTIES):
        known = known.when(c == warning, group(ascii_key(F.lit(warning))))  # folded to a constant
    return known.otherwise(let(ascii_key(c), group))


def suspicious_flags(name: Column, year: Column, identity: Column) -> dict[str, Column]:
    digits, y = F.regexp_replace(F.coalesce(identity, F.lit("")), r"\D", ""), F.trim(F.coalesce(year, F.lit("")))
    return {
        "suspicious_name_like_phrase": F.rlike(ascii_key(name), F.lit(V.SUSPICIOUS_NAME)),
        "invalid_birth_year": (y != "") & ~F.rlike(y, F.lit("^[0-9]{4}$")),
        "invalid_identity_number_length": (digits != "") & ~F.char_length(digits).isin(9, 12),
    }


def suspicious(name: Column, year: Column, identity: Column) -> dict[str, Column]:
    return {k: F.count_if(c) for k, c in suspicious_flags(name, year, identity).items()}


def sections(frames: dict[str, DataFrame]) -> DataFrame:
    """One (section, key, n) table of one-row tables (their columns) and of two-column tables (key, n)."""
    out = []
    for name, df in frames.items():
        if df.columns[-1] == "n" and len(df.columns) == 2:
            out.append(df.select(F.lit(name).alias("section"), F.col(df.columns[0]).cast("string").alias("key"), F.col("n").cast("long").alias("n")))
        else:
            pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast("long").alias("n")) for c in df.columns))).alias("p")
            out.append(df.select(F.lit(name).alias("section"), pairs).select("section", "p.key", "p.n"))
    return reduce(DataFrame.unionByName, out)


def batch_report(results: DataFrame) -> DataFrame:
    """(section, key, n) over validated results: batch, marker, review, extractors, fields, warnings, suspicious.

    One pass: counts are sums over the results of an extractor, with map-side combine, and become rows only then; counts of
    nothing are 0, but groups of warnings and extractors that no result has are left out.
    """
    sums: dict[tuple[str, str], Column] = {}

    def stats(section: str, field: str, total: Column, filled: Column) -> None:
        sums.update({(section, f"{field}.{m}"): n for m, n in (("total", total), ("non_empty", filled), ("empty", total - filled))})

    def count_if(items: str, test: Callable[[Column], Column]) -> Column:
        return F.coalesce(F.size(F.filter(items, lambda x: F.coalesce(test(x), F.lit(False)))), F.lit(0))

    odd = lambda p: suspicious_flags(p["ho_ten"], p["nam_sinh"], p["cccd"])
    flags = F.transform("participants", lambda p: F.struct(*((~is_blank(p[f])).alias(f) for f in V.PARTY_FIELDS), *(c.alias(k) for k, c in odd(p).items())))
    groups = F.transform("warnings", warning_group)
    counted = once(results.select("marker_found", "review_required", "case_info", "primary_extractor", "participants", "warnings"), participants=flags, warnings=groups)
    found, review = (F.coalesce(F.col(c), F.lit(False)).cast("int") for c in ("marker_found", "review_required"))
    many = F.coalesce(F.size("participants"), F.lit(0))
    sums |= {("batch", "result_objects"): F.lit(1), ("batch", "participant_rows"): many}
    sums |= {("marker", "found"): found, ("marker", "not_found"): 1 - found, ("review", "required"): review, ("review", "not_required"): 1 - review}
    for f in V.CASE_FIELDS:
        stats("case_fields", f, F.lit(1), (~is_blank(F.col("case_info")[f])).cast("int"))
    for f in V.PARTY_FIELDS:
        stats("participant_fields", f, many, count_if("participants", lambda p: p[f]))  # noqa: B023
    for k in suspicious_flags(F.lit(""), F.lit(""), F.lit("")):
        sums["suspicious_counts", k] = count_if("participants", lambda p: p[k])  # noqa: B023
    varied = {("warnings", g): count_if("warnings", lambda w: w == g) for g in (*(g for _, g in V.WARNING_GROUPS), "other")}  # noqa: B023

    own = counted.groupBy(F.coalesce("primary_extractor", F.lit("unknown")).alias("name")).agg(F.count(F.lit(1)).alias("results"), *(F.sum(c.cast("long")).alias(f"n{i}") for i, c in enumerate((sums | varied).values())))
    entry = lambda section, key, n: F.struct(F.lit(section).alias("section"), key.alias("key"), n.alias("n"))
    entries = [entry(section, F.lit(key), F.col(f"n{i}")) for i, (section, key) in enumerate(sums | varied)]
    rows = own.select(F.inline(F.array(*entries, entry("extractors", F.col("name"), F.col("results"))))).where(~F.col("section").isin("warnings") | (F.col("n") > 0))
    zero = results.sparkSession.range(1).select(F.inline(F.array(*(entry(section, F.lit(key), F.lit(0).cast("long")) for section, key in sums))))
    return rows.unionByName(zero).groupBy("section", "key").agg(F.sum("n").alias("n"))


def blanks_by_column(df: DataFrame) -> DataFrame:
    """(header, blank) over a table read as text; columns without a name are left out."""
    return fill_rates(df, [c for c in df.columns if c.strip()]).select(safe_header(F.col("field")).alias("header"), F.col("empty").alias("blank"))


def field_accuracy(gold: DataFrame, predicted: DataFrame, fields: list[str], key: str = "source_file", index: str = "row_index") -> DataFrame:
    """(field, correct, total, accuracy): each gold row against the prediction of its source at its place.

    A missing prediction is empty, so that an empty gold field is right; predictions that no gold row asks for don't
    count. Texts agree in lower case with white space collapsed. No gold rows: accuracy 0.
    """
    left = gold.select(F.col(key).alias("_k"), F.coalesce(F.col(index).try_cast("int"), F.lit(0)).alias("_i"), *(F.col(f).alias(f"g{n}") for n, f in enumerate(fields)))
    right = predicted.select(F.col(key).alias("_k"), F.col(index).cast("int").alias("_i"), *(F.col(f).alias(f"p{n}") for n, f in enumerate(fields)))
    sums = left.join(right, ["_k", "_i"], "left").agg(F.count(F.lit(1)).alias("total"), *(F.count_if(eval_key(F.col(f"g{n}")) == eval_key(F.col(f"p{n}"))).alias(f"c{n}") for n in range(len(fields))))
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"c{n}").alias("correct")) for n, f in enumerate(fields)))).alias("p")
    return sums.select("total", pairs).select("p.field", "p.correct", "total", F.coalesce(F.try_divide("p.correct", "total"), F.lit(0.0)).alias("accuracy"))


def row_index(df: DataFrame, key: str, order: str) -> DataFrame:
    """A place within each source, from 0."""
    return df.withColumn("row_index", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)


def smoke(results: DataFrame, method: str = "local_llm", case_fields: int = 3, parties: int = 1) -> DataFrame:
    """(source_file, n_case, n_parties, ok): whether an extraction comes from ``method`` and has enough in it."""
    filled = F.size(F.filter(F.array(*(F.col("case_info")[k] for k in V.CASE_FIELDS)), lambda v: ~is_blank(v)))
    many = F.coalesce(F.size("participants"), F.lit(0))
    ok = (F.coalesce("primary_extractor", F.lit("")) == method) & (filled >= case_fields) & (many >= parties)
    return results.select("source_file", filled.cast("long").alias("n_case"), many.cast("long").alias("n_parties"), ok.alias("ok"))
