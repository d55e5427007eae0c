"""Two extractions of one document as one: fields by confidence, parties by position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docforge.functions import vocab as V
from docforge.functions.text import compare_key, let


def filled(field: Column) -> Column:
    return F.coalesce(field["value"] != "", F.lit(False))


def conflict(primary: Column, support: Column) -> Column:
    """Both have values, and their comparison keys are there and differ; equal values need no keys."""
    differ = lambda a: (a != "") & let(compare_key(support["value"]), lambda b: (b != "") & (a != b))
    return filled(primary) & filled(support) & (primary["value"] != support["value"]) & let(compare_key(primary["value"]), differ)


def higher(primary: Column, support: Column) -> Column:
    """The side of higher confidence, the primary one of equals; null counts as 0."""
    zero = F.lit(0.0)
    return F.when(F.coalesce(support["confidence"], zero) > F.coalesce(primary["confidence"], zero), support).otherwise(primary)


def select_field(primary: Column, support: Column) -> Column:
    return F.when(conflict(primary, support), higher(primary, support)).when(filled(primary), primary).when(filled(support), support).otherwise(F.coalesce(primary, support))


def conflict_note(primary: Column, support: Column, name: Column) -> Column:
    """A warning that names the field and the method taken, never a value."""
    before, between, after = V.CONFLICT.split("{}")
    method = F.coalesce(higher(primary, support)["source_method"], F.lit("unknown"))
    return F.when(conflict(primary, support), F.concat(F.lit(before), name, F.lit(between), method, F.lit(after)))


def ordered_distinct(*groups: Column) -> Column:
    """First occurrences in order, without nulls and empty texts."""
    kept = F.filter(F.concat(*(F.coalesce(g, F.array().cast("array<string>")) for g in groups)), lambda x: x.isNotNull() & (x != ""))
    return F.array_distinct(kept)


def unopposed(output: Column, warnings: Column, support: str) -> Column:
    """``merge_outputs`` of an output and one with the same values by the method ``support``: there is nothing to weigh."""
    return F.struct(
        output["case_fields"].alias("case_fields"), output["participants"].alias("participants"), ordered_distinct(warnings, output["warnings"]).alias("warnings"),
        output["method"].alias("primary_extractor"), F.lit(support).alias("support_extractor"),
    )


def merge_outputs(primary: Column, support: Column, warnings: Column) -> Column:
    """(case_fields, participants, warnings, primary_extractor, support_extractor) of two extractor outputs."""
    a, b = primary["case_fields"], support["case_fields"]
    case = F.struct(*(select_field(a[k], b[k]).alias(k) for k in V.CASE_FIELDS))
    notes = F.array(*(conflict_note(a[k], b[k], F.lit(k)) for k in V.CASE_FIELDS))
    left, right = (F.coalesce(x["participants"], F.array()) for x in (primary, support))
    people = F.zip_with(left, right, lambda p, q: F.struct(*(select_field(p[k], q[k]).alias(k) for k in V.PARTY_FIELDS)))
    name = lambda i, k: F.concat(F.lit("participants["), i.cast("string"), F.lit(f"].{k}"))
    pairs = F.zip_with(left, right, lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    party_notes = F.flatten(F.transform(pairs, lambda x, i: F.array(*(conflict_note(x["p"][k], x["q"][k], name(i, k)) for k in V.PARTY_FIELDS))))
    return F.struct(
        case.alias("case_fields"), people.alias("participants"), ordered_distinct(warnings, notes, party_notes, primary["warnings"], support["warnings"]).alias("warnings"),
        primary["method"].alias("primary_extractor"), support["method"].alias("support_extractor"),
    )
