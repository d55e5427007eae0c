"""Lines within one edit of an earlier line, by a deletion-neighbourhood join on DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.functions.text import let
from docforge.llm.common import cut, maybe_in, parted, sketch, spread_join, written

#: Shortest line, in characters, that takes part; shorter ones (list marks, "Home") are kept.
MIN_CHARS = 20
#: Lines whose lengths fall in one class of STEP characters are cut at the same places.
STEP = 16
#: Times that what lines differ in is cut again before variants are made: down to some tens of characters.
REFINEMENTS = 3


def rough_blocks(line: Column) -> list[Column]:
    """(key, left, right) for blocks of a line: a hash of all bytes but the block's, and how many are before and after.

    Lines within one edit share a key at least. A line of n bytes is cut at quarters of its class m, the multiple of
    STEP below n. One edit changes up to four bytes in a row, so blocks reach three bytes over the next cut and a line
    less than four bytes above m also counts to the class below (else it has nulls there). Plain slices of bytes in
    compiled code, so that every line costs little.
    """
    raw, n = line.cast("binary"), F.octet_length(line)
    own = F.floor(n / STEP).cast("int") * STEP
    out = []
    for m in (own, F.when((n - own < 4) & (own > STEP), own - STEP)):
        for q in range(4):
            left = F.floor(m * q / 4).cast("int")
            right = F.greatest(F.lit(0), m - F.floor(m * (q + 1) / 4).cast("int") - 3)
            key = F.xxhash64(F.lit(q), m, F.substring(raw, F.lit(1), left), F.substring(raw, n - right + 1, right))
            out.append(F.when(m.isNotNull(), F.struct(key.alias("key"), left.alias("left"), right.alias("right"))))
    return out


def middle_of(line: Column, left: Column, right: Column) -> Column:
    """The characters of a line that are not whole in its first ``left`` or last ``right`` bytes."""
    raw, n = line.cast("binary"), F.octet_length(line)
    count = lambda size: F.char_length(F.substring(raw, F.lit(1), size).cast("string"))  # noqa: E731  a cut character counts
    start = count(left) - (F.octet_length(F.substring(line, F.lit(1), count(left))) > left).cast("int")
    return F.substring(line, start + 1, count(n - right) - start)


def parts(length: Column) -> Column:
    """Blocks of a text of class ``length``: 4, or the cube root of a long one, so that work stays far below its square."""
    return F.greatest(F.lit(4), F.ceil(F.cbrt(length))).cast("int")


def cuts(text: Column) -> Column:
    """Array of (m, q, left, right): for each block q of the text's class m, the characters before and after the block.

    Two texts within one edit agree, under a class that both have, in all that is before and after one of the blocks. A
    text at the lower end of its class also counts to the class below. Below 2 * STEP characters all is one block.
    """
    n = F.char_length(text)
    base = F.floor(n / STEP).cast("int") * STEP
    classes = F.array_distinct(F.transform(F.when(n == base, F.array(base - STEP, base)).otherwise(F.array(base)), lambda m: F.when(m < 2 * STEP, 0).otherwise(m)))

    def block(m: Column, q: Column) -> Column:
        left = F.floor(q * m / parts(m)).cast("int")
        right = m - F.floor((q + 1) * m / parts(m)).cast("int")
        return F.struct(m.alias("m"), q.alias("q"), left.alias("left"), right.alias("right"))

    return F.flatten(F.transform(classes, lambda m: F.transform(F.sequence(F.lit(0), F.when(m > 0, parts(m) - 1).otherwise(0)), lambda q: block(m, q))))


def refined(blocks: DataFrame) -> DataFrame:
    """Blocks of blocks (key, h1, h2, at, middle) that another line shares in all but the new, smaller middle."""
    new = blocks.select("key", "h1", "h2", "at", "middle", F.explode(cuts(F.col("middle"))).alias("c"))
    n, left, right = F.char_length("middle"), F.col("c.left"), F.col("c.right")
    key = F.xxhash64("key", "c.m", "c.q", F.substring("middle", F.lit(1), left), F.substring("middle", n - right + 1, right))
    new = cut(new.select(key.alias("key"), "h1", "h2", "at", F.substring("middle", left + 1, n - left - right).alias("middle")))
    shared = new.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("key")
    return new.join(shared, "key")


def lines_of(df: DataFrame, min_chars: int) -> DataFrame:
    """Rows (doc_id, print, pos, line) of the lines that take part."""
    split = df.where("doc_id is not null and text is not null").select("doc_id", F.crc32(F.col("text").cast("binary")).alias("print"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return split.where((F.octet_length("line") >= 4 * min_chars) | (F.char_length("line") >= min_chars))


def later_lines(df: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows (doc_id, print, pos) of lines with an earlier line, by (doc_id, pos), within one edit of them.

    ``df`` has doc_id and text. Equal lines meet by two 64-bit hashes. For one edit, lines are first sifted by rough keys:
    those that share none with another line are done. The rest, found again through a sketch of bounded size, are cut
    into finer and finer blocks, and where two lines agree in all but one block they emit the variants of that block
    with one character deleted, and the block itself. Lines that share a variant at one place differ by a substitution;
    a block that equals another's variant is an insertion. In each group of equal variants the members are only held
    against the earliest one, and Levenshtein's distance is verified on these links. A line that is the earliest of any
    number of others is dealt over salted copies.
    """
    at = F.struct("doc_id", "pos")
    lines = lines_of(df, min_chars).withColumn("h1", F.xxhash64("line"))
    second = F.xxhash64(F.lit(1), "line").alias("h2")
    rough = rough_blocks(F.col("line"))
    plain = written(lines.select("doc_id", "print", "pos", "h1", second, *(b["key"].alias(f"k{i}") for i, b in enumerate(rough))))
    keys = plain.select(F.explode(F.array(*(f"k{i}" for i in range(len(rough))))).alias("key"), "h1").where("key is not null")
    shared = cut(keys.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("key"))
    in_shared = sketch(shared, "key")
    near = cut(maybe_in(keys, "key", *in_shared).select("h1").distinct())
    rest = maybe_in(lines, "h1", *sketch(near, "h1")).select("doc_id", "pos", "line", "h1", second, F.explode(F.array(*rough)).alias("b"))
    rest = maybe_in(rest.where("b is not null").select("doc_id", "pos", "line", "h1", "h2", "b.key", "b.left", "b.right"), "key", *in_shared)
    blocks = rest.select("key", "h1", "h2", at.alias("at"), middle_of(F.col("line"), F.col("left"), F.col("right")).alias("middle"))
    blocks = blocks.groupBy("key", "h1", "h2").agg(F.min("at").alias("at"), F.min("middle").alias("middle"))
    for _ in range(REFINEMENTS):
        blocks = refined(blocks)
    blocks = cut(blocks)
    places = F.sequence(F.lit(1), F.char_length("middle"))
    gone = lambda i: F.concat(F.substring("middle", F.lit(1), i - 1), F.substring("middle", i + 1, F.char_length("middle")))
    variants = F.flatten(F.array(
        F.array(F.struct(F.xxhash64("key", "middle").alias("v"), F.lit(0).alias("kind"))),
        F.array_distinct(F.transform(places, lambda i: F.struct(F.xxhash64(F.col("key"), gone(i)).alias("v"), F.lit(1).alias("kind")))),
        F.transform(places, lambda i: F.struct(F.xxhash64(F.col("key"), i, gone(i)).alias("v"), F.lit(2).alias("kind"))),
    ))
    emitted = blocks.select("key", "at", F.explode(F.when(F.char_length("middle") > 0, variants).otherwise(F.slice(variants, 1, 1))).alias("e")).select("key", "at", "e.v", "e.kind")
    # kind 2 meets kind 2; kind 0 meets kind 1 and the other way round
    first = emitted.groupBy("v").agg(
        *(F.min(F.when(F.col("kind") == k, F.col("at"))).alias(f"low{k}") for k in (0, 1, 2)), F.min("at").alias("low"), F.max("at").alias("high")
    ).where("low <> high").drop("low", "high")
    other = F.when(F.col("kind") == 2, F.col("low2")).when(F.col("kind") == 0, F.col("low1")).otherwise(F.col("low0"))
    links = emitted.join(first, "v").select("key", "at", other.alias("other")).where("other < at").distinct()
    theirs = blocks.select("key", F.col("at").alias("other"), F.col("middle").alias("theirs"))
    both = cut(links.join(blocks, ["key", "at"]))
    near = spread_join(both, theirs, ["key", "other"]).where(F.levenshtein("middle", "theirs", 1) >= 0)
    near = near.groupBy("h1", "h2").agg(F.min("other").alias("near"))
    equal = plain.groupBy("h1", "h2").agg(F.min(at).alias("equal"), F.count("*").alias("many")).where("many > 1").select("h1", "h2", "equal")
    low = cut(equal.join(near, ["h1", "h2"], "full").select("h1", "h2", F.least("equal", "near").alias("low")))
    found = maybe_in(plain.select("doc_id", "print", "pos", "h1", "h2"), "h1", *sketch(low, "h1")).join(low, ["h1", "h2"])
    return found.where(F.struct("doc_id", "pos") > F.col("low")).select("doc_id", "print", "pos")


def dedupe_lines(df: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """``df`` with its text less the later lines, and n_lines and n_removed.

    Lines are what line feeds separate, compared as they are. A line of at least ``min_chars`` characters goes if an
    earlier one, by doc_id and then place, in the same or another document is within one edit (substitution, insertion
    or deletion of a character); lines are judged on the input, not on what is left. Null texts stay null with no lines;
    an empty text is one empty line. Rows with a null doc_id are kept whole and are never the earlier line; rows that
    repeat a doc_id are one document. Columns called n_lines and n_removed are replaced.
    """
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    gone = later_lines(source, min_chars).groupBy("doc_id", "print").agg(F.collect_set("pos").alias("_gone"))
    gone = written(gone.select(F.xxhash64("doc_id", "print").alias("_key"), F.col("doc_id").alias("_doc"), F.col("print").alias("_print"), "_gone"))
    base = df.drop("n_lines", "n_removed")
    printed = base.withColumn("_p", F.crc32(F.col(text).cast("binary"))).withColumn("_k", F.xxhash64(F.col(doc_id).cast("long"), "_p"))
    some, rest = parted(printed, "_k", *sketch(gone, "_key"))
    joined = some.join(gone.hint("shuffle_hash"), (F.col("_k") == F.col("_key")) & (F.col(doc_id).cast("long") == F.col("_doc")) & (F.col("_p") == F.col("_print")), "left")
    joined = joined.select(*base.columns, "_gone").unionByName(rest.select(*base.columns, F.lit(None).cast("array<int>").alias("_gone")))
    places = F.array_except(F.sequence(F.lit(0), F.size(F.split(F.col(text), "\n", -1)) - 1), F.col("_gone"))
    kept = let(F.split(F.col(text), "\n", -1), lambda lines: F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n"))
    kept_text = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept)
    return joined.select(
        *(kept_text.alias(c) if c == text else F.col(c) for c in base.columns),
        F.coalesce(F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("_gone").isNotNull(), F.size("_gone")), F.lit(0)).cast("long").alias("n_removed"),
    )
