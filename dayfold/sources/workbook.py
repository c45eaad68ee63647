"""Workbook (.xlsx) drops: one named sheet, header row, columns bound by position.

``binaryFile`` lists the workbooks; ``mapInPandas`` decodes each one inside a task with the standard
library (an .xlsx is a zip of XML parts), one task per file — a workbook is not splittable, and many
workbooks are decoded in parallel. The decoded cells are text and are typed by the declared schema
with the same rules as the delimited drops.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from itertools import islice
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType

from dayfold.sources.delimited import parse_text_columns

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
_REL_NS = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def _col_index(ref: str | None, after: int) -> int:
    """Column of a cell; one without a reference follows the cell before it."""
    if not ref:
        return after + 1
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _sheet_path(z: zipfile.ZipFile, sheet: str) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels.iter(f"{_REL_NS}Relationship")}
    for s in wb.iterfind("m:sheets/m:sheet", _NS):
        if s.get("name") == sheet:
            target = targets[s.get(f"{{{_NS['r']}}}id")].lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    raise KeyError(f"sheet {sheet!r} not found")


def _text(node) -> str:
    """Text of a string node without its phonetic runs."""
    skip = {t for r in node.iter(f"{{{_NS['m']}}}rPh") for t in r.iter(f"{{{_NS['m']}}}t")}
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t") if t not in skip)


def decode_sheet(content: bytes, sheet: str) -> Iterator[list[tuple[str | None, dt.datetime | None]]]:
    """Rows of a sheet: each cell's text, and the base date if it is a number (days since then)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS):
                shared.append(_text(si))
        pr = ET.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", _NS)
        late = pr is not None and pr.get("date1904") in ("1", "true")
        base = dt.datetime(1904, 1, 1) if late else dt.datetime(1899, 12, 30)
        root = ET.fromstring(z.read(_sheet_path(z, sheet)))
    for row in root.iterfind("m:sheetData/m:row", _NS):
        cells: dict[int, tuple[str | None, dt.datetime | None]] = {}
        at = -1
        for c in row.iterfind("m:c", _NS):
            kind, v = c.get("t"), c.find("m:v", _NS)
            at = _col_index(c.get("r"), at)
            if kind == "s" and v is not None:
                cells[at] = shared[int(v.text)], None
            elif kind == "inlineStr":
                cells[at] = _text(c), None
            else:
                cells[at] = (v.text if v is not None else None), base if kind in (None, "n") else None
        yield [cells.get(i, (None, None)) for i in range(max(cells) + 1 if cells else 0)]


def _date_text(value: str | None, base: dt.datetime | None, kind) -> str | None:
    """Date cells stored as serial numbers become ISO text, to the second, before typing."""
    if value is None or base is None:
        return value
    ts = base + dt.timedelta(seconds=round(float(value) * 86400))
    return ts.strftime("%Y-%m-%d") if isinstance(kind, DateType) else ts.strftime("%Y-%m-%d %H:%M:%S")


#: Rows that a task holds decoded at a time.
CHUNK_ROWS = 10_000


def read_workbook_drop(spark: SparkSession, path: str, sheet: str, schema: StructType, header: bool = True,
                       with_file: bool = True) -> DataFrame:
    """Read the ``sheet`` of every workbook matching ``path`` into ``schema`` (positional columns)."""
    names = [f.name for f in schema.fields]
    kinds = [f.dataType for f in schema.fields]
    text = StructType([StructField(n, StringType(), True) for n in names] +
                      [StructField("source_file", StringType(), True)])

    def decode(batches):
        for pdf in batches:
            for content, file_path in zip(pdf["content"], pdf["path"]):
                rows = decode_sheet(bytes(content), sheet)
                if header:
                    next(rows, None)
                file_name = file_path.rsplit("/", 1)[-1]
                while chunk := list(islice(rows, CHUNK_ROWS)):
                    out = []
                    for r in chunk:
                        r = (r + [(None, None)] * len(names))[: len(names)]
                        out.append([_date_text(v, base, k) if isinstance(k, (DateType, TimestampNTZType)) else v
                                    for (v, base), k in zip(r, kinds)] + [file_name])
                    yield pd.DataFrame(out, columns=names + ["source_file"], dtype=object)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    raw = files.mapInPandas(decode, text)
    return parse_text_columns(raw, schema, decimal_comma=True, keep=["source_file"] if with_file else [])
