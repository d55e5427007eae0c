"""Models behind one shape: extractors, OCR and entity recognisers that run once loaded per task."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.functions.text import html_text, let
from docforge.session import ship


def apply_model(df: DataFrame, column: str, load: Callable[[], Callable[[Any], Any]], kind: str, out: str = "model", retries: int = 2, longest_wait: float = 5.0) -> DataFrame:
    """``out`` as a struct (ok, error, value: ``kind``) of a model's answer for ``column``.

    ``load`` runs once for each task; what failed of a batch is tried again, all of it after one wait, with doubled waits,
    and what still fails is an error in its own row, so that one document never ends a batch nor holds it up for long.
    """
    ship(df.sparkSession)
    at = df.columns.index(column)
    name = df.columns[at]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def asked(value: Any) -> dict:
            try:
                return {"ok": True, "error": None, "value": model(value)}
            except Exception as problem:  # noqa: BLE001  a model may raise anything
                return {"ok": False, "error": f"{type(problem).__name__}: {problem}", "value": None}

        for batch in batches:
            values = list(batch[name])
            answers = [asked(value) for value in values]
            for n in range(retries):
                failed = [i for i, answer in enumerate(answers) if not answer["ok"]]
                if not failed:
                    break
                time.sleep(min(2.0**n * 0.01, longest_wait))
                for i in failed:
                    answers[i] = asked(values[i])
            yield batch.assign(**{out: pd.Series(answers, index=batch.index)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` struct<ok:boolean,error:string,value:{kind}>"
    return df.mapInPandas(run, schema)


class TransportError(RuntimeError):
    """A service could not be reached, or what came back was no answer: worth another try, or another service."""


class Call:
    """A call under way in a thread of its own: tried again after transport errors, with waits of 1, 2, 4, ... seconds."""

    def __init__(self, service: Callable[[Any], Any], value: Any, retries: int, longest_wait: float) -> None:
        self.done, self.left = threading.Event(), threading.Event()
        self.answer = (None, "", False)
        self.began = time.monotonic()
        threading.Thread(target=self._run, args=(service, value, retries, longest_wait), daemon=True).start()

    def _run(self, service: Callable[[Any], Any], value: Any, retries: int, longest_wait: float) -> None:
        for n in range(retries + 1):
            try:
                self.answer = (service(value), None, False)
                break
            except (TransportError, OSError) as problem:
                self.answer = (None, f"{type(problem).__name__}: {problem}", True)
                if n == retries or self.left.wait(min(2.0**n, longest_wait)):
                    break
            except Exception as problem:  # noqa: BLE001  a service may raise anything
                self.answer = (None, f"{type(problem).__name__}: {problem}", False)
                break
        self.done.set()

    def result(self, deadline: float) -> tuple[Any, str | None, bool]:
        """(value, error, whether it was the transport); past the deadline the thread is left to itself."""
        if self.done.wait(max(0.0, self.began + deadline - time.monotonic())):
            return self.answer
        self.left.set()
        return None, f"TimeoutError: no answer in {deadline:g} s", True


def in_window(values: Iterable[Any], begin: Callable[[Any], Call], in_flight: int, deadline: float) -> Iterator[tuple[Any, str | None, bool]]:
    """Answers in the order of ``values``, with at most ``in_flight`` calls under way."""
    window: deque[Call] = deque()
    for value in values:
        if len(window) == in_flight:
            yield window.popleft().result(deadline)
        window.append(begin(value))
    while window:
        yield window.popleft().result(deadline)


def call_service(
    df: DataFrame, column: str, load: Callable[[], Callable[[Any], Any]], kind: str, out: str = "answer", in_flight: int = 8, deadline: float = 180.0, retries: int = 2, longest_wait: float = 5.0, only: str | None = None
) -> DataFrame:
    """``out`` as a struct (ok, error, transport, value: ``kind``) of a remote service's answer for ``column``.

    Each task has up to ``in_flight`` calls under way, so that a slow call holds up its window and not the task; rows keep
    their order. Transport errors (TransportError, OSError) are tried again with doubled waits up to ``longest_wait``; any
    other error is an answer. A call may take ``deadline`` seconds with all its tries. A null is not sent, nor is
    a row whose boolean column ``only`` isn't true: ok with no value.
    """
    ship(df.sparkSession)
    name = df.columns[df.columns.index(column)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = load()
        begin = lambda value: Call(lambda v: None if v is None else service(v), value, retries, longest_wait)
        for batch in batches:
            wanted = batch[only] if only else [True] * len(batch)
            asked = (value if w and not pd.api.types.is_scalar(value) or w and pd.notna(value) else None for value, w in zip(batch[name], wanted, strict=True))
            answers = [{"ok": e is None, "error": e, "transport": t, "value": v} for v, e, t in in_window(asked, begin, in_flight, deadline)]
            yield batch.assign(**{out: pd.Series(answers, index=batch.index, dtype=object)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` struct<ok:boolean,error:string,transport:boolean,value:{kind}>"
    return df.mapInPandas(run, schema)


def served_by(df: DataFrame, column: str, services: list[Callable[[], Callable[[Any], Any]]], kind: str, out: str = "answer", **options: Any) -> DataFrame:
    """``call_service`` by the first service, and by each next one for those rows alone whose transport failed; an error
    that a service answers with stays, as another would answer it too."""
    df = call_service(df, column, services[0], kind, out, **options)
    for load in services[1:]:
        left = df.withColumn("_again", F.col(out)["transport"])
        tried = call_service(left, column, load, kind, "_next", only="_again", **options)
        df = tried.withColumn(out, F.when(F.col("_again"), F.col("_next")).otherwise(F.col(out))).drop("_again", "_next")
    return df


def with_fallback(df: DataFrame, first: str, second: str, out: str = "value") -> DataFrame:
    """The first model's value where it went through, else the second's."""
    return df.withColumn(out, F.when(F.col(first)["ok"], F.col(first)["value"]).otherwise(F.col(second)["value"]))


def mock_ocr_lines(text: str | Column) -> Column:
    """Array of (text, page_number, bbox, confidence) of the non-blank lines, 34 apart from 40 on; blank lines count."""
    lines = F.split(text, "\n", -1)
    boxes = F.transform(lines, lambda x, i: F.struct(x.alias("text"), F.lit(1).alias("page_number"), F.array(F.lit(40.0), (40 + 34 * i).cast("double"), F.lit(1200.0), (68 + 34 * i).cast("double")).alias("bbox"), F.lit(0.99).alias("confidence")))
    return F.filter(boxes, lambda b: F.trim(b["text"]) != "")


def polygon_box(polygon: Column) -> Column:
    """[least x, least y, largest x, largest y] of an array of points."""
    side = lambda k, f: f(F.transform(polygon, lambda p: F.get(p, F.lit(k))))
    return F.array(side(0, F.array_min), side(1, F.array_min), side(0, F.array_max), side(1, F.array_max))


OCR_ITEM = "struct<text:string,html:string,confidence:double,bbox:array<double>,polygon:array<array<double>>>"
OCR_ANSWER = f"blocks array<{OCR_ITEM}>, text_lines array<{OCR_ITEM}>, lines array<{OCR_ITEM}>"


def ocr_lines(answer: Column, page: Column) -> Column:
    """Array of (text, page_number, bbox, confidence) from an engine's JSON answer for a page.

    Items are the first list that has any of ``blocks``, ``text_lines`` and ``lines``. An item's text is its own, else that
    of its HTML; its box is its own, else that around its polygon, else empty. Answers without items give no lines.
    """

    def line(item: Column) -> Column:
        own, html = F.trim(F.coalesce(item["text"], F.lit(""))), F.coalesce(item["html"], F.lit(""))
        text = F.when(own != "", own).when(html != "", html_text(html)).otherwise("")
        around = F.when(F.size(item["polygon"]) > 0, polygon_box(item["polygon"]))
        box = F.coalesce(item["bbox"], around, F.array().cast("array<double>"))
        return F.struct(text.alias("text"), page.cast("int").alias("page_number"), box.alias("bbox"), item["confidence"].alias("confidence"))

    some = lambda items: F.when(F.size(items) > 0, items)
    items = let(F.from_json(answer, OCR_ANSWER), lambda a: F.coalesce(some(a["blocks"]), some(a["text_lines"]), some(a["lines"]), F.array().cast(f"array<{OCR_ITEM}>")))
    return F.transform(items, line)


def chosen_engine(remote: Callable | None = None, local: Callable | None = None, mock: Callable | None = None, fall_back: bool = True) -> list[Callable]:
    """Loaders in the order in which a page tries them: a remote engine, then the mock one if it is on, else the local."""
    here = mock or local
    order = [remote, here if fall_back or remote is None else None]
    found = [load for load in order if load is not None]
    if not found:
        raise ValueError("no engine is set up")
    return found


def read_with(df: DataFrame, column: str, engines: list[Callable], kind: str, out: str = "page") -> DataFrame:
    """``out`` as (ok, error, value) of the first engine that reads ``column``; the others are only asked for what failed."""
    df = apply_model(df, column, engines[0], kind, out=out)
    for load in engines[1:]:
        left = df.withColumn("_rest", F.when(~F.col(out)["ok"], F.col(column)))

        def only_rest(load: Callable = load) -> Callable:
            model = load()
            return lambda value: None if value is None else model(value)

        tried = apply_model(left, "_rest", only_rest, kind, out="_next")
        df = tried.withColumn(out, F.when(F.col(out)["ok"], F.col(out)).otherwise(F.col("_next"))).drop("_rest", "_next")
    return df


ENTITIES = "array<struct<text:string,label:string,start:int,end:int,score:double>>"


def with_entities(df: DataFrame, column: str, load: Callable[[], Callable[[str], list[dict]]], labels: list[str], threshold: float = 0.35, out: str = "entities") -> DataFrame:
    """``out``: entities (text, label, start, end, score) of a recogniser with one of ``labels`` and at least ``threshold``;
    none where it failed. They stand beside an extraction's fields and are never merged into them."""
    df = apply_model(df, column, load, ENTITIES, out="_found")
    known = F.filter(F.coalesce(F.col("_found")["value"], F.array().cast(ENTITIES)), lambda e: e["label"].isin(labels) & (e["score"] >= threshold))
    return df.withColumn(out, known).drop("_found")


def labelled_boxes(lines: Column) -> Column:
    """Array of (label, x0, y0, x1, y1) to draw: lines without four numbers are left out but counted by the labels."""
    numbered = F.transform(lines, lambda line, i: F.struct((i + 1).alias("label"), line["bbox"].alias("b")))
    return F.transform(F.filter(numbered, lambda x: F.size(x["b"]) == 4), lambda x: F.struct(x["label"].alias("label"), *(F.get(x["b"], F.lit(k)).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1")))))
