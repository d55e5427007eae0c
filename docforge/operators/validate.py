"""Explainable warnings and notes on an extraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docforge.functions import vocab as V
from docforge.functions.rules import valid_date
from docforge.functions.text import evidence_keys, has_any, holds_evidence, is_blank, let, split_notes, stands_in
from docforge.operators.merge import ordered_distinct


def empty(c: Column) -> Column:
    return c.isNull() | (c == "")


def missing(fields: dict[str, Column]) -> Column:
    """Labels of the fields that are empty, in the given order, as one text; null if there are none."""
    labels = F.filter(F.array(*(F.when(empty(v), k) for k, v in fields.items())), lambda x: x.isNotNull())
    return F.when(F.size(labels) > 0, F.array_join(labels, ", "))


def evidence_note(field: Column, label: str, text: Column) -> Column:
    """For a model's value: evidence is missing, or doesn't stand in the text."""
    return F.get(claim_notes(F.filter(F.array(claim(field, label, text)), lambda c: c.isNotNull()), text), F.lit(0))


def claim(field: Column, label: str, text: Column) -> Column:
    """(label, evidence) of a model's value of which the evidence doesn't stand in the text as it is; else null."""
    evidence = field["evidence_text"]
    model = has_any(F.lower(F.coalesce(field["source_method"], F.lit(""))), "llm", "remote", "model")
    return F.when(~empty(field["value"]) & ~stands_in(text, evidence) & model, F.struct(F.lit(label).alias("label"), evidence.alias("evidence")))


def claim_note(c: Column, keys: Column) -> Column:
    """The note on a ``claim`` by a text's ``evidence_keys``, if there is one."""
    said = lambda words: F.concat(F.lit(words.split("{}")[0]), c["label"], F.lit(words.split("{}")[1]))
    return F.when(empty(c["evidence"]), said(V.NO_EVIDENCE)).when(~holds_evidence(keys, c["evidence"]), said(V.WRONG_EVIDENCE))


def claim_notes(claims: Column, text: Column) -> Column:
    """Notes on ``claims``: those that hold in lower case are left out before the text's keys are made, which few need."""
    unheld = lambda cs: let(F.lower(text), lambda low: F.filter(cs, lambda c: ~let(F.lower(c["evidence"]), lambda e: stands_in(low, e))))
    noted = lambda cs: F.when(F.size(cs) > 0, let(evidence_keys(text), lambda keys: F.transform(cs, lambda c: claim_note(c, keys))))
    return let(claims, lambda cs: F.when(F.size(cs) > 0, let(unheld(cs), noted)))


def low_confidence(field: Column) -> Column:
    return F.coalesce(~empty(field["value"]) & (field["confidence"] < V.LOW_CONFIDENCE), F.lit(False))


def party_notes(values: dict[str, Column], notes: Column) -> Column:
    """Notes of one party: those it has, missing fields (the identity number may be), an unknown role, odd numbers."""
    role, year, digits = values["tu_cach_to_tung"], values["nam_sinh"], F.regexp_replace(values["cccd"], r"\D", "")
    found = F.array(
        F.concat(F.lit(V.MISSING_PARTY), missing({label: values[k] for k, label in V.PARTY_FIELDS.items() if k != "cccd"})),
        F.when(~empty(role) & ~role.isin(V.VALID_ROLES), F.concat(F.lit(V.ODD_ROLE), role)),
        F.when(~empty(year) & ~F.rlike(year, F.lit("^[0-9]{4}$")), F.concat(F.lit(V.ODD_YEAR), year)),
        F.when(~empty(values["cccd"]) & ~F.char_length(digits).isin(9, 12), V.ODD_IDENTITY),
    )
    text = F.array_join(ordered_distinct(split_notes(notes), found), "; ")
    return F.when(text != "", text)


def identity_digits(c: Column) -> Column:
    digits = F.regexp_replace(c, r"\D", "")
    return F.when(F.char_length(digits).isin(9, 12), digits).otherwise(c)


def validate(case: Column, participants: Column, found: Column, text: Column, warnings: Column) -> Column:
    """(warnings, participants with ghi_chu, review_required); any warning asks for review, notes alone don't."""
    date = case["ngay_thu_ly"]["value"]
    checked = ~is_blank(F.coalesce(text, F.lit("")))
    case_claims = F.array(*(claim(case[k], label, text) for k, label in V.CASE_FIELDS.items() if k != "quan_he_phap_luat"))
    party_claims = F.flatten(F.transform(participants, lambda p: F.array(*(claim(p[k], label, text) for k, label in V.PARTY_FIELDS.items()))))
    proof = F.when(checked, claim_notes(F.filter(F.concat(case_claims, party_claims), lambda c: c.isNotNull()), text))
    unsure = reduce(lambda a, b: a | b, (low_confidence(case[k]) for k in V.CASE_FIELDS)) | F.exists(participants, lambda p: reduce(lambda a, b: a | b, (low_confidence(p[k]) for k in V.PARTY_FIELDS)))
    all_warnings = ordered_distinct(
        warnings,
        F.array(
            F.when(~found, V.NO_MARKER),
            F.concat(F.lit(V.MISSING_CASE), missing({label: case[k]["value"] for k, label in V.CASE_FIELDS.items()})),
            F.when(~empty(date) & ~valid_date(date), F.concat(F.lit(V.BAD_DATE), date)),
        ),
        proof,
        F.array(F.when(F.size(participants) == 0, V.NO_PARTIES), F.when(unsure, V.LOW_CONFIDENCE_WARNING)),
    )

    def noted(p: Column) -> Column:
        values = {k: p[k]["value"] for k in V.PARTY_FIELDS}
        return F.struct(*((identity_digits(v) if k == "cccd" else v).alias(k) for k, v in values.items()), party_notes(values, F.lit(None).cast("string")).alias("ghi_chu"))

    return let(all_warnings, lambda w: F.struct(w.alias("warnings"), F.transform(participants, noted).alias("participants"), (F.size(w) > 0).alias("review_required")))
