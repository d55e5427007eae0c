"""Spreadsheets (.xlsx) of one sheet of texts, written and read without an office library."""

from __future__ import annotations

import io
import re
import tempfile
import zipfile
from collections.abc import Iterator
from itertools import chain
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a sheet of this format can hold, the header's too.
MOST_ROWS = 1 << 20
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
UNSAFE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def letters(n: int) -> str:
    """The name of column ``n``, from 0: A to Z, AA and so on."""
    out = ""
    while n >= 0:
        n, out = n // 26 - 1, chr(65 + n % 26) + out
    return out


def _row(number: int, values: list) -> str:
    cells = (f'<c r="{letters(i)}{number}" t="inlineStr"><is><t xml:space="preserve">{escape(UNSAFE.sub("", str(v)))}</t></is></c>' for i, v in enumerate(values) if v is not None)
    return f'<row r="{number}">{"".join(cells)}</row>'


def write_workbook(rows: DataFrame, path: str, order: list[str], columns: list[str], sheet: str = "Trich xuat") -> None:
    """A header and the rows in ``order`` as one sheet: a single file by nature, streamed row by row through the driver and
    then copied to ``path``, in any file system that Spark knows.

    Nulls are empty cells. More rows than a sheet holds are refused; write_rows takes any number.
    """
    if rows.count() >= MOST_ROWS:
        raise ValueError(f"a sheet holds {MOST_ROWS} rows at most")
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{TYPE}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{TYPE}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{OFFICE}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    }
    local = f"{tempfile.mkdtemp(prefix='docforge-')}/sheet.xlsx"
    with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in parts.items():
            archive.writestr(name, f'<?xml version="1.0" encoding="UTF-8"?>{content}')
        with archive.open("xl/worksheets/sheet1.xml", "w") as out:
            out.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{MAIN}"><sheetData>'.encode())
            for number, row in enumerate(chain([columns], rows.orderBy(*order).select(*(F.col(f"`{c}`").cast("string") for c in columns)).toLocalIterator()), 1):
                out.write(_row(number, list(row)).encode())
            out.write(b"</sheetData></worksheet>")
    jvm, conf = rows.sparkSession._jvm, rows.sparkSession.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).copyFromLocalFile(True, True, jvm.org.apache.hadoop.fs.Path(f"file://{local}"), target)


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """The values of the first sheet, row by row; shared and inline texts and plain values."""
    name = lambda tag: f"{{{MAIN}}}{tag}"
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        shared = []
        if "xl/sharedStrings.xml" in archive.namelist():
            shared = ["".join(t.text or "" for t in item.iter(name("t"))) for item in ElementTree.fromstring(archive.read("xl/sharedStrings.xml")).iter(name("si"))]
        first = sorted(n for n in archive.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]
        with archive.open(first) as source:
            for _, row in ElementTree.iterparse(source):
                if row.tag != name("row"):
                    continue
                values: list[str | None] = []
                for cell in row.iter(name("c")):
                    at = 0
                    for c in re.match("[A-Z]*", cell.get("r", "")).group():
                        at = at * 26 + ord(c) - 64
                    values += [None] * (max(at - 1, len(values)) - len(values))
                    text = cell.findtext(name("v"))
                    if cell.get("t") == "s":
                        text = shared[int(text)]
                    elif cell.get("t") == "inlineStr":
                        text = "".join(t.text or "" for t in cell.iter(name("t")))
                    values.append(text)
                yield values
                row.clear()


def read_workbooks(files: DataFrame, columns: list[str]) -> DataFrame:
    """(path, row, error, the columns) of the first sheets of files (path, content), by the names in their first rows.

    A column that a file lacks is null; a file that is no workbook is one row with an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                out: list[tuple] = []
                try:
                    header = None
                    for n, values in enumerate(sheet_rows(content)):
                        if header is None:
                            header = {h: i for i, h in enumerate(values) if h}
                        else:
                            out.append((path, n - 1, None, *(values[header[c]] if c in header and header[c] < len(values) else None for c in columns)))
                except (zipfile.BadZipFile, ElementTree.ParseError, IndexError, KeyError) as problem:
                    out = [(path, None, f"no workbook: {type(problem).__name__}", *(None for _ in columns))]
                yield pd.DataFrame(out, columns=["path", "row", "error", *columns]).astype({"row": "Int64"})

    return files.select("path", "content").mapInPandas(run, "path string, row long, error string, " + ", ".join(f"`{c}` string" for c in columns))
