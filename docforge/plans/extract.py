"""From a document's text to a validated extraction, in narrow steps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.functions import rules
from docforge.functions import vocab as V
from docforge.functions.offsets import normalise_mapped, raw_offset
from docforge.functions.payload import rule_output
from docforge.functions.similarity import find_marker, split_before
from docforge.functions.text import normalise, once
from docforge.operators.merge import merge_outputs, unopposed
from docforge.operators.sequence import trim_page_lines
from docforge.operators.validate import validate

#: The method of the rules beside a primary extractor.
SUPPORT = "heuristic_support"


@dataclass(frozen=True)
class Options:
    """marker and threshold of the search; whether to extract without a marker; whether mojibake is
    repaired and accents are composed, in Python for the texts that need it."""

    marker: str = V.MARKER
    threshold: float = V.THRESHOLD
    extract_without_marker: bool = True
    compose: bool = True
    strict_names: bool = False


def headers(df: DataFrame, text: str = "text", options: Options = Options()) -> DataFrame:  # noqa: B008  frozen
    """With normalised, marker (struct) and text_before_marker; without a marker the text, or nothing if so asked."""
    out = once(df, normalised=normalise(F.col(text), options.compose))
    out = find_marker(out, "normalised", "marker", options.marker, options.threshold)
    before, _ = split_before(F.col("normalised"), F.col("marker"))
    if not options.extract_without_marker:
        before = F.when(F.col("marker")["found"], before).otherwise("")
    return once(out, text_before_marker=before)


def above_marker(df: DataFrame, lines: str = "lines", options: Options = Options()) -> DataFrame:  # noqa: B008
    """Pages with ``lines`` (structs with text) cut to those above the marker, and marker and text (the lines that are left).

    The marker is sought in the normalised text of the page; its place is taken back to the raw lines by the map that
    normalisation keeps, so that a raw line is cut at the right character whatever was removed, repaired or joined before.
    """
    raw = F.array_join(F.transform(lines, lambda x: F.coalesce(x["text"], F.lit(""))), "\n")
    out = once(df, _map=normalise_mapped(raw, options.compose))
    out = find_marker(once(out, _text=F.col("_map.text")), "_text", "marker", options.marker, options.threshold)
    start = F.when(F.col("marker.found"), raw_offset(F.col("_map.runs"), F.col("marker.start")))
    out = once(out, **{lines: trim_page_lines(F.col(lines), start)})
    text = F.array_join(F.filter(F.transform(lines, lambda x: x["text"]), lambda t: F.trim(t) != ""), "\n")
    return out.withColumn("text", text).drop("_map", "_text")


def extract(df: DataFrame, text: str = "text", source: str = "source_file", primary: Column | None = None, options: Options = Options()) -> DataFrame:  # noqa: B008
    """Validated results: source_file, marker_found, case_info, participants, warnings, review_required, primary_extractor.

    ``primary`` is a model's output in the shape of ``functions.payload``; where it is null, or none is given, the rules
    are the primary extractor and a warning says so. The rules are always the support.
    """
    out = headers(df, text, options)
    out = once(out, _case=rules.case_info(F.col("text_before_marker")), _people=rules.parties(F.col("text_before_marker"), options.strict_names))
    alone = rule_output(F.col("_case"), F.col("_people"), "rule_support_no_local_llm")
    warning = F.array(F.lit(V.RULES_ONLY))
    if primary is None:
        out = once(out, _merged=unopposed(alone, warning, SUPPORT))
    else:
        notes = F.when(primary.isNull(), warning).otherwise(F.array().cast("array<string>"))
        out = once(out, _model=F.coalesce(primary, alone), _support=rule_output(F.col("_case"), F.col("_people"), SUPPORT), _notes=notes)
        out = once(out, _merged=merge_outputs(F.col("_model"), F.col("_support"), F.col("_notes")))
    m = F.col("_merged")
    out = once(out, _valid=validate(m["case_fields"], m["participants"], F.col("marker")["found"], F.col("text_before_marker"), m["warnings"]))
    return out.select(
        F.col(source).cast("string").alias("source_file"), F.col("marker")["found"].alias("marker_found"), F.struct(*(m["case_fields"][k]["value"].alias(k) for k in V.CASE_FIELDS)).alias("case_info"),
        F.col("_valid.participants").alias("participants"), F.col("_valid.warnings").alias("warnings"), F.col("_valid.review_required").alias("review_required"), m["primary_extractor"].alias("primary_extractor"),
    )
