"""Column functions on text: normalisation, comparison keys, cleaning, hashes."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.functions import vocab as V
from docforge.session import ship

IGNORE = "(?iu)"


@cache
def accent_map() -> tuple[str, str]:
    """Accented Latin letters and their bases, from Unicode's decompositions."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != chr(code):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once: a generated row is not merged into the projections that use it."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


@cache
def key_map() -> tuple[str, str]:
    """``accent_map`` with 0 as O, 1 as I and combining marks (that have no counterpart) left out, in one pass."""
    accents, bases = accent_map()
    return accents + "01" + "".join(map(chr, range(0x300, 0x370))), bases + "OI"


def has_any(c: Column, *parts: str) -> Column:
    """Whether one of the texts stands in ``c``: a plain search, far cheaper than a pattern or a replacement."""
    return reduce(lambda a, b: a | b, (F.contains(c, F.lit(p)) for p in parts))


def folded_case(c: Column) -> Column:
    """Lower case with one form of each letter that a pattern without regard to case takes as one: dotless i, long s."""
    return F.lower(F.when(has_any(c, "ı", "İ", "ſ"), F.translate(c, "ıİſ", "iis")).otherwise(c))


def folded(c: Column) -> Column:
    """(low, wide): a text in folded case, and the same again if it has characters beyond ASCII, else an empty text."""
    return let(folded_case(c), lambda low: F.struct(low.alias("low"), F.when(F.octet_length(low) > F.char_length(low), low).when(low.isNotNull(), "").alias("wide")))


def has_hint(low: Column, *parts: str) -> Column:
    """``has_any`` of a ``folded`` text: what is beyond ASCII is only looked for where something is."""
    return reduce(lambda a, b: a | b, (F.contains(low["low" if p.isascii() else "wide"], F.lit(p)) for p in parts))


def strip_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, *accent_map()), "[̀-ͯ]", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\t\n\x0B\f\r]\s*| \s+", " "))


def strip_chars(c: Column, chars: str) -> Column:
    return F.btrim(c, F.lit(chars))


def match_key(c: Column) -> Column:
    """Upper case without accents, 0 as O and 1 as I, runs of all but A-Z 0-9 as a space; Đ counts among these."""
    return F.trim(F.regexp_replace(F.translate(F.upper(c), *key_map()), "[^A-Z0-9]+", " "))


def compare_key(c: Column) -> Column:
    """Lower case without accents, runs of what is no word character as a space; null gives an empty key."""
    return F.trim(F.regexp_replace(strip_accents(F.lower(F.coalesce(c, F.lit("")))), r"(?U)\W+", " "))


def ascii_key(c: Column) -> Column:
    """Like ``compare_key``, for reports: white space collapses, other non-word characters are spaces."""
    return squeeze(F.regexp_replace(strip_accents(F.lower(F.coalesce(c, F.lit("")))), r"(?U)[^\w\s]", " "))


def evidence_key(c: Column) -> Column:
    """Lower case with accents, punctuation as spaces."""
    return squeeze(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[^a-zÀ-ỹ0-9 \s\w]", " "))  # ranges first: they are far cheaper to ask than \w


def safe_header(c: Column) -> Column:
    key = F.btrim(F.regexp_replace(F.upper(ascii_key(c)), "[^A-Z0-9]+", "_"), F.lit("_"))
    return F.when(key == "", "COLUMN").otherwise(key)


def eval_key(c: Column) -> Column:
    return squeeze(F.lower(F.coalesce(c, F.lit(""))))


SLASHED = r"(?<=\d)\s*/\s*(?=\d)"


def evidence_keys(text: Column) -> Column:
    """(key, spaceless, slashed): what a text's evidence is sought in, made once for all of it."""
    less = lambda t, c, new="": F.replace(t, F.lit(c), F.lit(new))
    keys = lambda key, slashed: F.struct(key.alias("key"), less(key, " ").alias("spaceless"), slashed.alias("slashed"))
    kept = lambda t: evidence_key(F.regexp_replace(t, SLASHED, "ᐅ"))
    plain = lambda t: let(evidence_key(t), lambda key: keys(key, F.when(F.contains(t, F.lit("/")), less(kept(t), " "))))
    both = lambda t: let(kept(t), lambda key: let(less(key, "ᐅ", " "), lambda apart: keys(apart, less(key, " "))))  # noqa: E731  one pass for all three
    return F.when(F.contains(text, F.lit("/")) & ~F.contains(text, F.lit("ᐅ")), both(text)).otherwise(plain(text))


def holds_evidence(keys: Column, evidence: Column) -> Column:
    """``contains_evidence`` for a text's ``evidence_keys``."""
    spaceless = lambda c: F.replace(evidence_key(c), F.lit(" "), F.lit(""))
    parted = F.rlike(evidence, F.lit(SLASHED))
    apart = F.when(parted, F.coalesce(F.contains(keys["slashed"], spaceless(F.regexp_replace(evidence, SLASHED, "ᐅ"))), F.lit(False))).otherwise(F.contains(keys["spaceless"], spaceless(evidence)))
    return let(evidence_key(evidence), lambda e: (e != "") & (F.contains(keys["key"], e) | apart))


def stands_in(text: Column, evidence: Column) -> Column:
    """Whether evidence stands in a text as it is, which is enough for ``holds_evidence`` and far cheaper: a text's key is made
    a character at a time, but for the small letter of Σ. A letter or digit says that the evidence's key isn't empty."""
    return F.coalesce(F.contains(text, evidence) & F.rlike(evidence, F.lit("[0-9A-Za-z]")) & ~F.contains(evidence, F.lit("Σ")), F.lit(False))


def contains_evidence(text: Column, evidence: Column) -> Column:
    """The evidence's key stands in the text's, with or without spaces; empty evidence doesn't.

    Without spaces a slash between digits stays, as it parts numbers: 1801/1995 is no evidence for 18/01/1995.
    """
    return let(evidence_keys(text), lambda keys: holds_evidence(keys, evidence))


def in_python(c: Column, change: Callable[[str], str]) -> Column:
    """``change`` of the texts that have characters beyond ASCII: these alone leave the JVM, in Arrow batches, and only
    what has changed comes back. A scan for the characters that ask for it by a pattern costs far more than the way there."""

    ship(SparkSession.getActiveSession())

    def changed(v: str | None) -> str | None:
        new = None if v is None else change(v)
        return None if new == v else new

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(changed)

    return F.coalesce(run(F.when(F.octet_length(c) > F.char_length(c), c)), c)


def compose(v: str) -> str:
    return unicodedata.normalize("NFC", v)


def repair(v: str, triggers: tuple[str, ...] = tuple(V.MOJIBAKE_TEXT)) -> str:
    """UTF-8 that was once read as Windows-1252; all of a value is repaired or none of it. Values without a trigger stay."""
    if not any(t in v for t in triggers):
        return v
    try:
        return v.encode("cp1252").decode("utf-8")
    except UnicodeError:
        return v


def nfc(c: Column) -> Column:
    """Canonical composition, for which Spark has no function."""
    return in_python(c, compose)


def repair_text(c: Column, triggers: list[str] = V.MOJIBAKE_TEXT) -> Column:
    return in_python(c, lambda v: repair(v, tuple(triggers)))


def repaired_and_composed(c: Column) -> Column:
    """``repair_text`` and then ``nfc``, in one way through Python."""
    return in_python(c, lambda v: compose(repair(v)))


def join_split_dates(c: Column) -> Column:
    """Dates of which the line breaks before the month or the year are taken out."""

    def joined(t: Column) -> Column:
        for label, number, then, last in V.DATE_BREAKS:
            t = F.regexp_replace(t, rf"{IGNORE}\b{label}\s+({number})\s*\n\s*{then}\s+({last})", f"{label} $1 {then} $2")
        return t

    return let(c, lambda t: F.when(F.rlike(t, F.lit(r"\d\s*\n\s*[tTnN]")), joined(t)).otherwise(t))  # few have a line end there


def collapse_lines(c: Column) -> Column:
    """Trimmed lines with single blanks inside; at most one empty line in a row, none at the start."""
    some = lambda pattern, new, *parts: lambda t: F.when(has_any(t, *parts), F.regexp_replace(t, pattern, new)).otherwise(t)
    c = let(let(c, some(r"[ \t]+", " ", "  ", "\t")), some(r" ?\n ?", "\n", " \n", "\n "))
    return let(let(F.btrim(c, F.lit(" ")), lambda t: F.ltrim(t, F.lit("\n"))), some(r"\n{3,}", "\n\n", "\n\n\n"))


def plain_lines(c: Column) -> Column:
    """Line ends as line feeds, without zero-width characters."""
    return correct(c, [("\r\n", "\n"), ("\r", "\n"), ("​", ""), ("‌", ""), ("﻿", "")])


def correct(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Each pair's first text replaced by its second, in turn; most texts hold none of them and stay as they are."""
    replaced = lambda t: reduce(lambda out, p: F.replace(out, F.lit(p[0]), F.lit(p[1])), pairs, t)
    plain, others = ([wrong for wrong, _ in pairs if wrong.isascii() is kind] for kind in (True, False))

    def held(t: Column) -> Column:
        beyond = (F.octet_length(t) > F.char_length(t)) & has_any(t, *others) if others else F.lit(False)
        return beyond | has_any(t, *plain) if plain else beyond

    return let(c, lambda t: F.when(held(t), replaced(t)).otherwise(t))


def should_join(previous: Column, current: Column) -> Column:
    """Whether a line goes on from the one before: the first rule that applies decides."""
    return (
        F.when(F.rlike(previous, F.lit(V.LINE_END)), False)
        .when(F.rlike(current, F.lit(IGNORE + V.NO_JOIN_HEAD)), False)
        .when(F.rlike(current, F.lit(V.LIST_LINE)), False)
        .when(F.rlike(current, F.lit(V.LOWER_START)), True)
        .otherwise(F.rlike(previous, F.lit(IGNORE + V.DANGLING)))
    )


def fold_lines(c: Column) -> Column:
    """Soft-wrapped lines joined, each held against the line as it has grown so far.

    Of a grown line only the end decides, and no phrase that asks for more has over two words: so each line is judged by
    the two before it, all at once, in time linear in the text.
    """

    def joins(lines: Column, i: Column) -> Column:
        line, last, second = F.get(lines, i), F.get(lines, i - 1), F.get(lines, i - 2)
        both = lambda a, b: F.coalesce((a != "") & (b != ""), F.lit(False))
        goes_on = lambda a, b: both(a, b) & F.coalesce(should_join(a, b), F.lit(False))
        # a last line of one word may be the end of a phrase that the line before began
        grown = F.when(~F.contains(last, F.lit(" ")) & goes_on(second, last), F.concat_ws(" ", second, last)).otherwise(last)
        return (i > 0) & both(last, line) & let(grown, lambda g: F.coalesce(should_join(g, line), F.lit(False)))

    def folded(lines: Column) -> Column:
        return F.array_join(F.transform(lines, lambda x, i: F.when(i == 0, x).when(joins(lines, i), F.concat(F.lit(" "), x)).otherwise(F.concat(F.lit("\n"), x))), "")

    return let(c, lambda t: F.when(F.rlike(t, F.lit(MAY_JOIN)), let(F.split(t, "\n", -1), folded)).otherwise(t))


#: A line end after which a line may go on: it begins with a small letter, or the last word asks for more.
MAY_JOIN = r"\n(?:\p{Ll}|(?<=(?iu:ngày|tháng|năm|sinh|trú|chỉ)[\r\u0085\u2028\u2029]?\n))"


def normalise(c: Column, composed: bool = True) -> Column:
    """Text as the extractors want it; ``composed`` says whether mojibake is repaired and accents are composed, for which
    the texts that need it go through Python."""
    c = F.coalesce(c, F.lit(""))
    if composed:
        c = repaired_and_composed(c)
    c = collapse_lines(join_split_dates(correct(plain_lines(c), V.CORRECTIONS)))
    return F.btrim(fold_lines(c), F.lit(" \n\t"))


def html_text(c: Column) -> Column:
    """Text of HTML: block ends as line feeds, other tags as spaces, common entities decoded, blanks collapsed."""
    c = F.regexp_replace(c, r"(?i)</(?:p|div|li|tr|br)\s*>", "\n")
    c = F.regexp_replace(c, "<[^>]+>", " ")
    for name, value in (("nbsp", " "), ("copy", "©"), ("middot", "·"), ("quot", '"'), ("#39", "'"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        c = F.replace(c, F.lit(f"&{name};"), F.lit(value))
    return F.btrim(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n[ \t]+", "\n"), F.lit(" \n\t"))


def safe_stem(c: Column) -> Column:
    stem = F.btrim(F.regexp_replace(c, r"[^0-9A-Za-zÀ-ỹ._-]+", "_"), F.lit("._-"))
    return F.when(is_blank(stem), "document").otherwise(stem)


def log_safe(c: Column, most: int = 240) -> Column:
    short = squeeze(c)
    return F.when(F.char_length(short) > most, F.concat(F.substring(short, 1, most), F.lit("... [truncated]"))).otherwise(short)


def cache_key(**items: Column) -> Column:
    return F.sha2(F.concat_ws("|", *(F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in sorted(items.items()))), 256)


def split_notes(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")


def clamp(c: Column, default: float = 0.0) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(c.try_cast("double"), F.lit(default))))
