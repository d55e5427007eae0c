"""Reports that runs add up: counts that later runs correct, sketches that are merged, so that no run reads earlier results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.functions.text import eval_key, is_blank
from docforge.operators.qa import batch_report

#: log2 of the buckets of a distinct count: its standard error is 1.04 / sqrt(2 ** HLL_BITS), 0.8 %.
HLL_BITS = 14
#: Size of a quantile sketch: ranks are off by 1.33 % at most, with a probability of 99 %.
KLL_SIZE = 200


def partial_report(results: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """(section, key, n): ``batch_report`` of a run's results, less that of the earlier results that these replace."""
    return batch_report(results) if replaced is None else without(batch_report(results), replaced)


def without(report: DataFrame, replaced: DataFrame) -> DataFrame:
    """A report less that of replaced results."""
    old = batch_report(replaced).withColumn("n", -F.col("n"))
    return report.unionByName(old).groupBy("section", "key").agg(F.sum("n").alias("n"))


def merged_report(partials: DataFrame) -> DataFrame:
    """The report of all runs from their partial ones; counts that came to nothing are left out but for those that a
    report always has."""
    fixed = ~F.col("section").isin("warnings", "extractors")
    return partials.groupBy("section", "key").agg(F.sum("n").alias("n")).where(fixed | (F.col("n") != 0))


def _names(c: Column) -> Column:
    return F.when(~is_blank(c), eval_key(c))


def sketches(results: DataFrame) -> DataFrame:
    """One row of sketches: distinct names and docket numbers; birth years and parties of a document as distributions."""
    people = results.select(F.explode("participants").alias("p"))
    by_person = people.agg(F.hll_sketch_agg(_names(F.col("p.ho_ten")), HLL_BITS).alias("names"), F.kll_sketch_agg_double(F.col("p.nam_sinh").try_cast("double"), KLL_SIZE).alias("birth_years"))
    by_result = results.agg(
        F.hll_sketch_agg(_names(F.col("case_info.so_thu_ly")), HLL_BITS).alias("dockets"), F.kll_sketch_agg_double(F.coalesce(F.size("participants"), F.lit(0)).cast("double"), KLL_SIZE).alias("parties")
    )
    return by_person.crossJoin(by_result)  # one row each


def merged_sketches(parts: DataFrame) -> DataFrame:
    """One row of estimates over any number of runs: names, dockets, and the quartiles of birth_years and parties.

    Results that a later run replaced are still in the distinct counts and distributions, until runs are compacted.
    """
    whole = parts.agg(
        F.hll_union_agg("names").alias("names"), F.hll_union_agg("dockets").alias("dockets"), F.kll_merge_agg_double("birth_years").alias("birth_years"), F.kll_merge_agg_double("parties").alias("parties")
    )
    ranks = F.array(*(F.lit(r) for r in (0.25, 0.5, 0.75)))
    quartiles = lambda c: F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, ranks)).alias(c)
    return whole.select(F.hll_sketch_estimate("names").alias("names"), F.hll_sketch_estimate("dockets").alias("dockets"), quartiles("birth_years"), quartiles("parties"))
