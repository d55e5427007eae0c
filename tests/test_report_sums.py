"""A report is made of sums, not of a row for each count of a result."""

from docforge.operators import qa, reports
from docforge.plans.extract import extract
from tests.test_once_only import documents, plan


def test_a_result_is_one_row_of_its_report(spark):
    results = extract(documents(spark))
    report = qa.batch_report(results)
    assert plan(report).count("Aggregate [") == 2  # sums first, then their rows
    got = {(r.section, r.key): r.n for r in report.collect()}
    assert got["batch", "result_objects"] == 3 and got["participant_fields", "ho_ten.non_empty"] == 1 and got["marker", "not_found"] == 2
    assert got["extractors", "rule_support_no_local_llm"] == 3 and got["warnings", "missing_marker"] == 2 and got["warnings", "other"] == 2 and ("warnings", "") not in got


def test_replaced_results_are_one_row_too(spark):
    results = extract(documents(spark))
    report = reports.partial_report(results, results)
    assert plan(report).count("Aggregate [") == 5  # of two reports, and their difference
    assert {r.n for r in report.collect()} == {0}
