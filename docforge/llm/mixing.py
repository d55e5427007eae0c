"""Mixing documents to target shares by iterative proportional fitting, on DataFrame functions only."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docforge.llm.common import cut, spread_join

#: Topic rules in order: name and a substring of the text; texts that none fits are general.
TOPICS = [("licence", "icense"), ("contact", "@"), ("tabular", " | "), ("reference", "http")]
DIMENSIONS = ("source", "lang", "topic")
#: Where no target is given: share of a value by its share of the tokens to this power, made to sum to one.
TEMPERATURES = {"source": 0.5, "lang": 0.5, "topic": 0.7}
#: Raking ends when every value's tokens are within this share of all tokens of the target, or no round helps any more.
TOLERANCE = 1e-11
#: Rounds at most, rounds to a checkpoint, steps for the rate.
ROUNDS, STEP, BUDGET_ROUNDS = 300, 3, 40
#: Tables of up to so many cells are raked in one task and sent to all executors; larger ones stay spread out.
FEW_CELLS = 100_000


def topic_of(text: Column) -> Column:
    out = F.when(F.lit(False), "")
    for name, part in TOPICS:
        out = out.when(F.contains(text, F.lit(part)), name)
    return out.otherwise("general")


def token_count(text: Column) -> Column:
    """Words: runs without space or 09-0D; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed only."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def shares(cells: DataFrame, name: str, power: float, given: dict[str, float] | None = None) -> DataFrame:
    """(value, target tokens) of one dimension: ``given`` shares of values, made to sum to one over those that have
    tokens, or each value's own tokens to ``power``."""
    own = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("_own")).where("_own > 0")
    raw = F.pow(F.col("_own"), F.lit(power))
    if given is not None:
        raw = F.coalesce(*(F.when(F.col(name) == k, float(v)) for k, v in given.items()), F.lit(0.0))
    own = own.withColumn("_raw", raw)
    total = own.agg(F.sum("_own").alias("_all"), F.sum("_raw").alias("_sum"))
    return own.crossJoin(F.broadcast(total)).select(name, F.coalesce(F.try_divide(F.col("_raw") * F.col("_all"), F.col("_sum")), F.lit(0.0)).alias("_target"))  # one row


def rake(cells: DataFrame, targets: dict[str, DataFrame], few: bool = False, tolerance: float = TOLERANCE) -> tuple[DataFrame, float]:
    """``cells`` (the dimensions, tokens) with a factor by which tokens * factor meets every target, and the residual.

    Each step scales the cells of each value of one dimension to the value's target, by sums over windows on the table
    of cells, which has a row for each combination of values, never one for a document; ``few`` cells are in one
    partition, so that no window shuffles. Every STEP rounds are checkpointed. The residual is the largest difference
    between a value's tokens and its target, as a share of all. Values without a target get 0. Where no factors meet all
    targets, the last dimension's are met and the residual says how far the others are off.
    """
    now = cells.withColumn("factor", F.lit(1.0))
    for name, target in targets.items():
        now = now.join(target.select(name, F.col("_target").alias(f"_to{name}")), name, "left").fillna(0.0, [f"_to{name}"])
    now = cut(now.coalesce(1) if few else now)
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    residual, before = 0.0, float("inf")
    for k in range(ROUNDS if total else 0):
        for name in targets:
            own = F.sum(F.col("tokens") * F.col("factor")).over(Window.partitionBy(name))
            now = now.withColumn("factor", F.when(own > 0, F.col("factor") * F.col(f"_to{name}") / own).otherwise(0.0))
        if (k + 1) % STEP == 0:
            now = cut(now)
            off = [F.max(F.abs(F.col(f"_s{i}") - F.col(f"_to{name}"))) for i, name in enumerate(targets)]
            sums = now.select(*(f"_to{name}" for name in targets), *(F.sum(F.col("tokens") * F.col("factor")).over(Window.partitionBy(name)).alias(f"_s{i}") for i, name in enumerate(targets)))
            residual = float(sums.agg(F.greatest(*off) if len(off) > 1 else off[0]).first()[0] or 0) / total
            if residual <= tolerance or residual > 0.99 * before:
                break
            before = residual
    return now.select(*cells.columns, "factor"), residual


def mix(
    df: DataFrame, share: float = 0.5, seed: int = 17, text: str = "text", doc_id: str = "doc_id", targets: dict[str, dict[str, float]] | None = None, temperatures: dict[str, float] | None = None, topic: Column | None = None
) -> DataFrame:
    """``df`` with topic, tokens, weight, probability and sampled.

    Tokens of all documents are summed into cells of source, language and topic (null: ``unknown``); the cells are raked
    to the target shares of each dimension: ``targets`` gives them by value, for the other dimensions they are the
    tempered shares of the tokens. A cell's weight is its factor; its probability is min(1, rate * weight), with the
    rate at which the expected tokens are ``share`` of all. A document is sampled if a number in [0, 1) made from its id
    and the seed is below its cell's probability; so repeated rows go or stay together. Documents without tokens (null,
    empty and blank texts) weigh 0 and are not sampled. ``topic`` is the topic's expression (else TOPICS). A column of
    ``df`` with the name of a new one is replaced. A warning says by how much targets are missed that no weights meet.
    """
    temperatures, targets = {**TEMPERATURES, **(temperatures or {})}, targets or {}
    new = ("topic", "tokens", "weight", "probability", "sampled")
    base = df.drop(*new)
    rows = base.withColumn("topic", topic_of(F.col(text)) if topic is None else topic).withColumn("tokens", token_count(F.col(text)))
    keyed = rows.withColumns({f"_{d}": F.coalesce(F.col(d).cast("string"), F.lit("unknown")) for d in DIMENSIONS})
    dims = [f"_{d}" for d in DIMENSIONS]
    cells = cut(keyed.where("tokens > 0").groupBy(*dims).agg(F.sum("tokens").alias("tokens")))
    few = cells.count() <= FEW_CELLS
    fitted, residual = rake(cells, {f"_{d}": cut(shares(cells, f"_{d}", temperatures[d], targets.get(d))) for d in DIMENSIONS}, few)
    if residual > 1e-3:
        warnings.warn(f"the targets can't all be met: a value is off by {residual:.4f} of all tokens", stacklevel=2)
    budget, rate = share * float(cells.agg(F.sum("tokens")).first()[0] or 0), share
    for _ in range(BUDGET_ROUNDS):  # Newton's steps on a concave, piecewise linear function: a few reach its exact root
        sure = F.lit(rate) * F.col("factor") >= 1
        fixed, slope = fitted.agg(F.sum(F.when(sure, F.col("tokens"))), F.sum(F.when(~sure, F.col("tokens") * F.col("factor")))).first()
        before, rate = rate, (budget - float(fixed or 0)) / slope if slope else rate
        if abs(rate - before) <= 1e-12 * rate:
            break
    chances = fitted.select(*dims, F.col("factor").alias("weight"), F.least(F.lit(1.0), F.lit(rate) * F.col("factor")).alias("probability"))
    drawn = keyed.join(F.broadcast(chances), dims, "left") if few else spread_join(keyed, chances, dims, "left")
    some = F.col("tokens") > 0
    return drawn.select(
        *base.columns, "topic", "tokens",
        F.when(some, F.col("weight")).otherwise(0.0).alias("weight"), F.when(some, F.col("probability")).otherwise(0.0).alias("probability"),
        (some & (unit(F.col(doc_id), seed) < F.coalesce("probability", F.lit(0.0)))).alias("sampled"),
    )
