"""URL filters by host-suffix and path-prefix expressions, hash-prefix joins and full digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import spread_join

#: Rules up to this number are sent to all executors; more are joined by a shuffle.
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is no ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Every host suffix of one of ``labels`` labels, followed by every path prefix of one of ``lengths`` characters."""
    own = F.char_length(host) - F.char_length(F.replace(host, F.lit("."), F.lit(""))) + 1
    suffixes = F.filter(F.array(*(F.when(own >= n, F.substring_index(host, ".", -n)) for n in labels)), lambda s: s.isNotNull())
    fit = F.filter(F.array(*(F.lit(n) for n in lengths)), lambda n: n <= F.char_length(path))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(fit, lambda n: F.struct(s.alias("h"), F.substring(path, F.lit(1), n).alias("p")))))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and every subdomain if the path of the
    url starts with the rule's; of several the longest rule (host and path together) wins, and of equal rules block.
    Without a rule the verdict is ``default``. Null urls and urls without ``://`` have an empty host and path and fit no
    rule. Rules with a null or empty host fit nothing. Rows are kept as they are, repeated rows too; columns of
    ``pages`` named host, path, rule or verdict are replaced.

    Each distinct url is expanded once, into suffixes and prefixes of the sizes that rules have, so that work is linear in
    its length; its expressions meet the rules by the first 32 bits of their SHA-256, and a pair counts if the whole
    digests agree. The rules are broadcast after a count shows that they are few. Urls and expressions of any frequency
    are dealt over salted copies of what they meet.
    """
    clean = rules.where("host is not null and host <> ''").select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), F.col("verdict").alias("rule_verdict")
    )
    clean = clean.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    digest = lambda h, p: F.sha2(F.concat(h, F.lit("\n"), p), 256)
    clean = clean.withColumn("rule_digest", digest(F.col("rule_host"), F.col("rule_path"))).withColumn("prefix", F.substring("rule_digest", 1, 8))
    lengths = [r[0] for r in clean.select(F.char_length("rule_path")).distinct().collect()]
    labels = [r[0] for r in clean.select(F.size(F.split("rule_host", r"\.", -1))).distinct().collect()]
    few = clean.count() <= BROADCAST_RULES
    urls = pages.select(F.col(url).alias("_page_url")).where("_page_url is not null").distinct()
    urls = urls.select("_page_url", url_host(F.col("_page_url")).alias("h0"), url_path(F.col("_page_url")).alias("p0")).where("h0 <> ''")
    cells = urls.select("_page_url", F.explode(expressions(F.col("h0"), F.col("p0"), labels, lengths) if lengths else F.expr("cast(array() as array<struct<h:string,p:string>>)")).alias("e"))
    cells = cells.withColumn("digest", digest(F.col("e.h"), F.col("e.p"))).select("_page_url", "digest", F.substring("digest", 1, 8).alias("prefix"))
    hits = (cells.join(F.broadcast(clean), "prefix") if few else spread_join(cells, clean, ["prefix"])).where("digest = rule_digest")
    size = F.char_length("rule_host") + F.char_length("rule_path")
    best = hits.groupBy("_page_url").agg(F.max(F.struct(size.alias("size"), "rule_verdict", "rule_host", "rule_path")).alias("best"))
    best = best.select("_page_url", F.concat("best.rule_host", "best.rule_path").alias("_best_rule"), F.col("best.rule_verdict").alias("_best_verdict"))
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*keep, F.col(url).alias("_page_url"))
    out = spread_join(rows.where("_page_url is not null"), best, ["_page_url"], "left")
    none = F.lit(None).cast("string")
    out = out.unionByName(rows.where("_page_url is null").withColumns({"_best_rule": none, "_best_verdict": none}))
    return out.select(*keep, url_host(F.col("_page_url")).alias("host"), url_path(F.col("_page_url")).alias("path"), F.col("_best_rule").alias("rule"), F.coalesce("_best_verdict", F.lit(default)).alias("verdict"))
