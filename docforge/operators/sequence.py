"""Ordered pages, lines and turns: stop early, trim, concatenate, number."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docforge.functions import vocab as V
from docforge.functions.similarity import running
from docforge.functions.text import let
from docforge.session import ship


def early_stop(pages: DataFrame, key: str, page: str, hit: Column, most: int = 7, stop: bool = True, full: bool = False) -> DataFrame:
    """One row for each document: pages_ocr, marker_page, stop_reason, page_count.

    Pages count in order up to the least of ``most`` and their number (all with ``full``). With ``stop`` and without
    ``full`` the first page with ``hit`` ends the document; otherwise the last page with a hit is the marker's. One
    aggregation with map-side combine: a document's pages are never gathered.
    """
    rows = pages.select(F.col(key), F.col(page).alias("_p"), F.coalesce(hit, F.lit(False)).alias("_h"))
    count = rows.groupBy(key).agg(F.count(F.lit(1)).alias("page_count"), F.min(F.when(F.col("_h") & ((F.lit(full)) | (F.col("_p") <= most)), F.col("_p"))).alias("_first"), F.max(F.when(F.col("_h") & ((F.lit(full)) | (F.col("_p") <= most)), F.col("_p"))).alias("_last"))
    limit = F.col("page_count") if full else F.least(F.lit(most), F.col("page_count"))
    stops = F.col("_first").isNotNull() & F.lit(stop and not full)
    reason = F.when(stops, V.STOP_REASONS[0]).when(F.lit(full), V.STOP_REASONS[1]).when(limit >= F.col("page_count"), V.STOP_REASONS[2]).otherwise(V.STOP_REASONS[3])
    return count.select(
        key, F.when(stops, F.col("_first")).otherwise(limit).cast("long").alias("pages_ocr"), (F.col("_first") if stop and not full else F.col("_last")).cast("long").alias("marker_page"),
        reason.alias("stop_reason"), F.col("page_count").cast("long").alias("page_count"),
    )


def lazy_pages(files: DataFrame, key: str, count: str, read: Callable[[str, int], str], is_marker: Callable[[str], bool], most: int = 7) -> DataFrame:
    """(key, page_number, text) of the pages read until a marker or ``most``; later pages are never read.

    ``read`` and ``is_marker`` run on executors, one document at a time, so that an OCR call is saved for each page
    after the marker.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, n in zip(batch[key], batch[count], strict=True):
                for page in range(1, min(int(n or 0), most) + 1):
                    text = read(name, page)
                    out.append((name, page, text))
                    if is_marker(text):
                        break
            yield pd.DataFrame(out, columns=[key, "page_number", "text"])

    return files.select(key, count).mapInPandas(run, f"{key} string, page_number int, text string")


def page_table(read: Callable[[str, list[int]], list[str]], is_marker: Callable[[str], bool], most: int = 7, at_once: int = 1, full: bool = False) -> Callable[..., DataFrame]:
    """A table function (key, page count) -> (page_number, text, error) that stops at a document's marker.

    ``read`` gives the texts of some pages of a document, ``at_once`` of them a call; where such a call fails its pages are
    read one by one, and a page that can't be read is a row with an error. Rows after the marker's page are not made, nor
    are their pages read beyond the call that has it; ``full`` reads on to the last page.
    """

    class Pages:
        def eval(self, key: str, count: int) -> Iterator[tuple[int, str | None, str | None]]:
            last = int(count or 0) if full else min(int(count or 0), most)
            for first in range(1, last + 1, at_once):
                for page, text, error in self.some(key, list(range(first, min(first + at_once, last + 1)))):
                    yield page, text, error
                    if error is None and not full and is_marker(text):
                        return

        def some(self, key: str, pages: list[int]) -> list[tuple[int, str | None, str | None]]:
            try:
                return [(p, t, None) for p, t in zip(pages, read(key, pages), strict=True)]
            except Exception as problem:  # noqa: BLE001  a reader may raise anything
                if len(pages) == 1:
                    return [(pages[0], None, f"{type(problem).__name__}: {problem}")]
                return [row for p in pages for row in self.some(key, [p])]

    return F.udtf(Pages, returnType="page_number int, text string, error string")


def pages_until_marker(files: DataFrame, key: str, count: str, table: Callable[..., DataFrame]) -> DataFrame:
    """``files`` with the rows of ``page_table`` beside each, as a lateral join; a document without a page has no row."""
    ship(files.sparkSession)
    return files.lateralJoin(table(F.col(key).outer(), F.col(count).outer()))


def page_text(pages: DataFrame, key: str, page: str, text: str, between: str = "\n\n") -> DataFrame:
    """(key, text): non-blank pages in order; pages of equal number by their text."""
    rows = pages.where(F.trim(text) != "").groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t")))).alias("a"))
    return rows.select(key, F.array_join(F.transform("a", lambda x: x["t"]), between).alias("text"))


def trim_lines(spans: Column, start: Column) -> Column:
    """Lines of (line, start, end) that end before ``start``; the line that holds it keeps its part before, if any."""
    cut = F.transform(F.filter(spans, lambda s: s["start"] < start), lambda s: F.when(s["end"] <= start, s["line"]).otherwise(F.btrim(F.substring(s["line"], F.lit(1), start - s["start"]), F.lit(" \t"))))
    return F.filter(cut, lambda x: x != "")


def trim_page_lines(lines: Column, start: Column) -> Column:
    """Page lines (structs with text, and a box or what else) before a place in their texts joined by line feeds.

    The line that holds the place keeps its trimmed part before, with its own box, unless nothing is left of it; an
    unknown place keeps all lines.
    """
    size = F.transform(lines, lambda x: F.char_length(F.coalesce(x["text"], F.lit(""))) + 1)

    def trimmed(starts: Column) -> Column:
        def cut(line: Column, i: Column) -> Column:
            left = start - F.get(starts, i)
            text = F.btrim(F.substring(line["text"], F.lit(1), left), F.lit(" \t\r\n"))
            return F.when(F.get(starts, i + 1) - 1 <= start, line).when((left > 0) & (text != ""), line.withField("text", text))

        return F.filter(F.transform(lines, cut), lambda x: x.isNotNull())

    return F.when(start.isNull(), lines).otherwise(let(running(size), trimmed))


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key: a minimum with map-side combine and an equi-join, for keys of any number of rows."""
    first = df.groupBy(*key).agg(F.min(F.struct(*order)).alias("_first"))
    joined = df.withColumn("_own", F.struct(*order)).join(first.select(*key, F.col("_first").alias("_own")), [*key, "_own"])
    return joined.select(*df.columns)


def unique_names(df: DataFrame, stem: str, order: str, out: str = "name") -> DataFrame:
    """The first of equal names keeps it, the others get _2, _3, ..."""
    n = F.row_number().over(Window.partitionBy(stem).orderBy(order))
    return df.withColumn(out, F.when(n == 1, F.col(stem)).otherwise(F.concat_ws("_", stem, n.cast("string"))))
