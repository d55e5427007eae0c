"""Fuzzy comparison and the search for the section marker."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.functions import vocab as V
from docforge.functions.text import folded, has_hint, key_map, let, match_key, once
from docforge.session import ship


def lcs(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: a fold over the characters of ``a`` that builds each row from the last."""
    chars = lambda c: F.filter(F.split(c, "", -1), lambda x: x != "")

    def folded(right: Column) -> Column:
        def row(last: Column, x: Column) -> Column:
            def cell(out: Column, y: Column) -> Column:
                j = F.size(out)
                return F.concat(out, F.array(F.when(y == x, F.get(last, j - 1) + 1).otherwise(F.greatest(F.get(out, j - 1), F.get(last, j)))))

            return F.aggregate(right, F.array(F.lit(0)), cell)

        start = F.array_repeat(F.lit(0), F.size(right) + 1)
        return F.get(F.aggregate(chars(a), start, row), F.size(right))

    return let(chars(b), folded)


def indel_score(a: Column, b: Column) -> Column:
    """0 to 100: twice the longest common subsequence over both lengths; two empty texts are alike."""
    total = F.char_length(a) + F.char_length(b)
    return F.when(total == 0, 100.0).otherwise(200.0 * lcs(a, b) / F.greatest(total, F.lit(1)))


def running(values: Column, piece: int = 256) -> Column:
    """Sums of the integers before each place of an array, and of all at the end: pieces add up on their own, then pieces'
    totals, so that no fold appends to an array longer than a piece or than the number of pieces."""

    def sums(part: Column) -> Column:
        grow = lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x)
        return F.aggregate(part, F.array(F.lit(0)), grow)

    def over(parts: Column) -> Column:
        offsets = sums(F.transform(parts, lambda p: F.element_at(p, -1)))
        inner = F.transform(parts, lambda p, k: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: x + F.get(offsets, k)))
        return F.array_append(F.flatten(inner), F.element_at(offsets, -1))

    pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(values) / piece).cast("int") - 1))
    return let(F.transform(pieces, lambda k: sums(F.slice(values, k * piece + 1, piece))), over)


def line_spans(c: Column) -> Column:
    """Array of (line, start, end): offsets of each line in characters."""

    def spans(lines: Column) -> Column:
        def placed(starts: Column) -> Column:
            return F.transform(lines, lambda x, i: F.struct(x.alias("line"), F.get(starts, i).alias("start"), (F.get(starts, i) + F.char_length(x)).alias("end")))

        return let(running(F.transform(lines, lambda x: F.char_length(x) + 1)), placed)

    return let(F.split(c, "\n", -1), spans)


def common_length(a: str, masks: dict[str, int], size: int) -> int:
    """Longest common subsequence with the text of ``size`` characters whose places ``masks`` gives: a row of the table
    is one integer, of which an addition carries every step at once."""
    row = full = (1 << size) - 1
    for c in a:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


WINDOW = "struct<score:double,rank:int,start:int,end:int,text:string>"


def best_window(c: Column, marker: str = V.MARKER, threshold: float = V.THRESHOLD) -> Column:
    """(score, rank, start, end, text) of the best window of one to three lines in a row, the earliest of equals.

    Only windows count whose lengths allow the threshold. They are compared in Arrow batches, and only those whose counts
    of letters could still beat the best so far; a line with more letters and digits than any window gets no key.
    """
    ship(SparkSession.getActiveSession())
    goal = line_key(marker)
    longest = len(goal)
    while 200.0 * len(goal) >= threshold * (longest + 1 + len(goal)) and longest < LONGEST:
        longest += 1

    @F.pandas_udf(WINDOW)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = []
        for value in texts:
            if value is None:
                found.append((None,) * 5)
                continue
            lines = value.split("\n")
            found.append(search(lines, [None if len(x) > longest and letters(x) > longest else line_key(x) for x in lines], goal, threshold))
        return pd.DataFrame(found, columns=["score", "rank", "start", "end", "text"]).astype({"score": "Float64", "rank": "Int32", "start": "Int32", "end": "Int32"})

    return run(c)


LONGEST = 1 << 20
KEY_MAP = {ord(a): (key_map()[1] + " " * len(key_map()[0]))[i].strip() or None for i, a in enumerate(key_map()[0])}
NOT_KEYED = re.compile("[^A-Z0-9]+")
NOT_COUNTED = bytes(c for c in range(128) if not chr(c).isalnum())


def line_key(line: str) -> str:
    """``text.match_key`` of one line."""
    upper = line.upper()
    return NOT_KEYED.sub(" ", upper.translate(KEY_MAP) if not upper.isascii() or "0" in upper or "1" in upper else upper).strip(" ")


def letters(line: str) -> int:
    """ASCII letters and digits of a line: its key has at least as many characters."""
    return len(line.encode("ascii", "ignore").translate(None, NOT_COUNTED))


def search(lines: list[str], keys: list[str | None], goal: str, threshold: float) -> tuple:
    """A key that is None is longer than those of all windows that the threshold allows."""
    masks, counts, size = {}, Counter(goal), len(goal)
    for i, x in enumerate(goal):
        masks[x] = masks.get(x, 0) | 1 << i
    best, at = (None,) * 5, 0
    for i, line in enumerate(lines):
        key, stop = "", at - 1
        for n in range(min(3, len(lines) - i)):
            stop += len(lines[i + n]) + 1
            if keys[i + n] is None:
                break
            key = f"{key} {keys[i + n]}".strip()
            total = len(key) + size
            if 200.0 * min(len(key), size) < threshold * total:
                if len(key) > size:
                    break  # longer windows are further off
                continue
            if best[0] is not None:
                shared = sum(min(k, counts[x]) for x, k in Counter(key).items())
                if 200.0 * shared / total <= best[0]:
                    continue
            raw = " ".join(lines[i : i + n + 1]).strip(" \t")
            score = 200.0 * common_length(key, masks, size) / total if total else 100.0
            if raw and (best[0] is None or score > best[0]):
                best = (score, 3 * i + n + 1, at, stop, raw)
        at += len(line) + 1
    return best


MATCH = "struct<found:boolean,start:int,end:int,text:string,score:double>"


def find_marker(df: DataFrame, column: str, out: str = "marker", marker: str = V.MARKER, threshold: float = V.THRESHOLD) -> DataFrame:
    """``out``: (found, start, end, text, score) of the best window of normalised text, the earliest of equals; an inline
    marker that scores as high wins unless a window is perfect. Windows too long or short for the threshold aren't scored."""
    c, key = F.col(column), match_key(F.lit(marker))

    def result(found: Column, start: Column, end: Column, text: Column, score: Column) -> Column:
        return F.struct(found.alias("found"), start.alias("start"), end.alias("end"), text.alias("text"), score.alias("score"))

    def hit(pattern: str, score: Column) -> Column:
        raw, at = F.regexp_extract(c, "(?iu)" + pattern, 0), F.regexp_instr(c, F.lit("(?iu)" + pattern)) - 1
        return let(score, lambda s: result(s >= threshold, at, at + F.char_length(raw), raw, s))

    def inline() -> Column:
        out = F.lit(None).cast(MATCH)
        for k, pattern in reversed(list(enumerate(V.INLINE_MARKERS))):
            raw = F.regexp_extract(c, "(?iu)" + pattern, 0)
            score = indel_score(match_key(raw), key)
            out = F.when(raw != "", hit(pattern, F.when(F.contains(match_key(c), key), 100.0).otherwise(score) if k == 0 else score)).otherwise(out)
        return out

    best, found = F.col("_best"), F.col("_inline")
    zero, none = F.lit(0.0), F.lit(None)
    perfect = F.coalesce(best["score"] >= 100, F.lit(False))
    df = once(df, _best=best_window(c, marker, threshold))
    may = let(folded(c), lambda low: reduce(lambda a, b: a & b, (has_hint(low, *some) for some in V.INLINE_HINTS)))
    df = once(df, _inline=F.when((~perfect | (best["score"] < threshold)) & may, inline()))  # a perfect window wins anyway
    inline_wins = ~perfect & F.coalesce(found["found"] & (found["score"] >= F.coalesce(best["score"], zero)), F.lit(False))
    missing = result(F.lit(False), none.cast("int"), none.cast("int"), F.coalesce(best["text"], found["text"]), F.greatest(F.coalesce(best["score"], zero), F.coalesce(found["score"], zero)))
    by_window = F.when(best["score"] >= threshold, result(F.lit(True), best["start"], best["end"], best["text"], best["score"]))
    return once(df, **{out: F.when(inline_wins, found).otherwise(F.coalesce(by_window, missing))}).drop("_best", "_inline")


def split_before(c: Column, found: Column) -> tuple[Column, Column]:
    """(text before the marker, text after it); without a marker all of it and nothing."""
    before = F.when(found["found"], F.btrim(F.substring(c, F.lit(1), found["start"]), F.lit(" \n\t"))).otherwise(c)
    after = F.when(found["found"], F.btrim(F.substring(c, found["end"] + 1, F.char_length(c)), F.lit(" \n\t"))).otherwise(F.lit(""))
    return before, after
