"""Normalised text that knows where its characters stood: an interval map back to the raw text."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from docforge.functions import vocab as V
from docforge.functions.text import compose, let, repair
from docforge.session import ship

MAPPED = "struct<text:string,runs:array<struct<norm:int,raw:int>>>"
#: Halvings of a search among the runs of a text, whose length is below 2**31.
HALVINGS = 31
WORDS = re.compile(r"\s+|\S+")


class Mapped:
    """A text and the raw place of each of its characters, with the raw end as the last entry."""

    def __init__(self, text: str, places: np.ndarray | None = None) -> None:
        self.text = text
        self.places = np.arange(len(text) + 1, dtype=np.int64) if places is None else places

    def edited(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """With spans (start, end, new text) replaced. What a span and its new text have in common at both ends, in any
        case, keeps its places, as does all of a text of the same length; what is new between stands where the old began to
        differ."""
        if not edits:
            return self
        texts, places, last = [], [], 0
        for start, end, new in edits:
            old = self.text[start:end]
            most = min(len(old), len(new))
            head = next((k for k in range(most) if old[k].lower() != new[k].lower()), most)
            tail = next((k for k in range(most - head) if old[-1 - k].lower() != new[-1 - k].lower()), most - head)
            texts += [self.text[last:start], new]
            between = self.places[start + head : end - tail]
            if len(old) != len(new):
                between = np.full(len(new) - head - tail, self.places[start + head])
            places += [self.places[last : start + head], between, self.places[end - tail : end]]
            last = end
        texts.append(self.text[last:])
        places.append(self.places[last:])
        return Mapped("".join(texts), np.concatenate(places))

    def sub(self, pattern: re.Pattern[str], new: str) -> Mapped:
        """With matches replaced; word by word where a match and its new text have words and blanks in one order."""
        edits = []
        for m in pattern.finditer(self.text):
            if len(m.group()) == 1 and not new:  # a character taken out
                edits.append((m.start(), m.end(), ""))
                continue
            old, made = WORDS.findall(m.group()), WORDS.findall(m.expand(new))
            if len(old) != len(made) or [o.isspace() for o in old] != [n.isspace() for n in made]:
                old, made = [m.group()], [m.expand(new)]
            at = m.start()
            for o, n in zip(old, made, strict=True):
                if o != n:
                    edits.append((at, at + len(o), n))
                at += len(o)
        return self.edited(edits)

    def stripped(self, chars: str) -> Mapped:
        start = len(self.text) - len(self.text.lstrip(chars))
        end = max(start, len(self.text.rstrip(chars)))
        return Mapped(self.text[start:end], self.places[start : end + 1])

    def runs(self) -> list[dict]:
        """Where the distance between a character and its raw place changes: (norm, raw) of the first such character."""
        shift = self.places - np.arange(len(self.places))
        at = np.flatnonzero(np.concatenate([[True], np.diff(shift) != 0]))
        return [{"norm": int(a), "raw": int(r)} for a, r in zip(at, self.places[at], strict=True)]


def _repaired(m: Mapped) -> Mapped:
    new = repair(m.text)
    if new == m.text:
        return m
    sizes = [len(c.encode()) for c in new]  # each byte was one character
    return Mapped(new, m.places[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)])


def _composed(m: Mapped) -> Mapped:
    if unicodedata.is_normalized("NFC", m.text):
        return m
    starts = [i for i, c in enumerate(m.text) if not unicodedata.category(c).startswith("M") and not "ᅠ" <= c <= "ᇿ"]
    bounds = sorted({0, *starts, len(m.text)})
    pieces = [(a, b, compose(m.text[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    if "".join(p for _, _, p in pieces) != compose(m.text):
        pieces = [(0, len(m.text), compose(m.text))]
    return m.edited([(a, b, p) for a, b, p in pieces if p != m.text[a:b]])


def _python(pattern: str, flags: int = 0) -> re.Pattern[str]:
    """A pattern of ``vocab`` as Spark reads it: classes of ASCII, an end before a last line separator."""
    ascii_only = pattern.replace(r"\s", r"[ \t\n\x0b\f\r]").replace(r"\d", "[0-9]")
    return re.compile(re.sub(r"(?<!\\)\$$", r"(?=[\\u0085\\u2028\\u2029]?\\Z)", ascii_only), flags)


LINE_ENDS, UNSEEN, BLANKS, AROUND = re.compile(r"\r\n?"), re.compile("[​‌﻿]"), re.compile(r"[ \t]{2,}|\t"), re.compile(r" \n ?|\n ")
FIRST_LINES, EMPTY_LINES = re.compile(r"\A\n+"), re.compile(r"\n{3,}")
DATES = [(_python(rf"\b{a}\s+({n})\s*\n\s*{b}\s+({m})", re.IGNORECASE), rf"{a} \1 {b} \2") for a, n, b, m in V.DATE_BREAKS]
BROKEN_DATE = _python(r"\d\s*\n\s*[tTnN]")
ENDED, LISTED = _python(V.LINE_END), _python(V.LIST_LINE)
HEAD, DANGLING = _python(V.NO_JOIN_HEAD, re.IGNORECASE), _python(V.DANGLING, re.IGNORECASE)


def _joins(last: str, line: str) -> bool:
    if not last or not line or ENDED.search(last) or HEAD.search(line) or LISTED.search(line):
        return False
    return unicodedata.category(line[0]) == "Ll" or DANGLING.search(last) is not None


def _folded(m: Mapped) -> Mapped:
    """Line ends of soft-wrapped lines as spaces: no place changes."""
    lines = m.text.split("\n")
    out, grown = [lines[0]], lines[0]
    for line in lines[1:]:
        joined = _joins(grown, line)
        out += [" " if joined else "\n", line]
        grown = f"{grown[-40:]} {line}" if joined else line  # only the end of a grown line is looked at
    return Mapped("".join(out), m.places)


def normalise_mapped_text(text: str, composed: bool = True) -> Mapped:
    """What ``text.normalise`` makes of a text, step by step with the places."""
    m = Mapped(text)
    if composed:
        m = _composed(_repaired(m))
    m = m.sub(LINE_ENDS, "\n").sub(UNSEEN, "")
    for wrong, right in V.CORRECTIONS:
        if wrong in m.text:
            m = m.sub(re.compile(re.escape(wrong)), right.replace("\\", r"\\"))
    if BROKEN_DATE.search(m.text):
        for pattern, new in DATES:
            m = m.sub(pattern, new)
    m = m.sub(BLANKS, " ").sub(AROUND, "\n").stripped(" ").sub(FIRST_LINES, "").sub(EMPTY_LINES, "\n\n")
    return _folded(m).stripped(" \n\t")


def normalise_mapped(c: Column, composed: bool = True) -> Column:
    """(text, runs): the same text as ``text.normalise``, and runs (norm, raw) of characters that moved alike.

    In Arrow batches, one text at a time. A null is an empty text.
    """
    ship(SparkSession.getActiveSession())

    @F.pandas_udf(MAPPED)
    def run(values: pd.Series) -> pd.DataFrame:
        made = [normalise_mapped_text(v or "", composed) for v in values]
        return pd.DataFrame({"text": [m.text for m in made], "runs": [m.runs() for m in made]})

    return run(c)


def raw_offset(runs: Column, place: Column) -> Column:
    """The raw place of a character of the normalised text (for an end: of the last character, plus one), by halving."""

    def halve(range_: Column, _: Column) -> Column:
        middle = F.floor((range_["low"] + range_["high"] + 1) / 2).cast("int")
        right = F.get(runs, middle)["norm"] <= place
        narrower = F.struct(F.when(right, middle).otherwise(range_["low"]).alias("low"), F.when(right, range_["high"]).otherwise(middle - 1).alias("high"))
        return F.when(range_["low"] < range_["high"], narrower).otherwise(range_)

    whole = F.struct(F.lit(0).alias("low"), (F.size(runs) - 1).alias("high"))
    halvings = F.greatest(F.lit(1), F.least(F.lit(HALVINGS), F.ceil(F.log2(F.size(runs).cast("double") + 1)).cast("int") + 1))
    found = F.aggregate(F.sequence(F.lit(1), halvings), whole, halve)["low"]
    return let(F.get(runs, found), lambda r: F.when(place.isNotNull(), r["raw"] + place - r["norm"]))
