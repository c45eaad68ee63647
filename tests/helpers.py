"""Test helpers: order-insensitive row comparison and tiny workbook/CSV writers for drop files."""

from __future__ import annotations

import datetime as dt
import decimal
import zipfile
from xml.sax.saxutils import escape


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


def spark_rows(df):
    return canon([tuple(r) for r in df.collect()], df.columns)


def _cell_ref(col: int, row: int) -> str:
    s, n = "", col + 1
    while n:
        n, r = divmod(n - 1, 26)
        s = chr(65 + r) + s
    return f"{s}{row + 1}"


def write_xlsx(path: str, sheet: str, rows: list[list]) -> None:
    """Minimal .xlsx (inline strings, numbers as numbers) — enough for the workbook reader."""
    body = []
    for i, row in enumerate(rows):
        cells = []
        for j, v in enumerate(row):
            ref = _cell_ref(j, i)
            if v is None:
                continue
            if isinstance(v, (int, float)) and not isinstance(v, bool):
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
            else:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
        body.append(f'<row r="{i + 1}">{"".join(cells)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    files = {
        "[Content_Types].xml": '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        '</Types>',
        "_rels/.rels": '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
        '</Relationships>',
        "xl/workbook.xml": f'<?xml version="1.0"?><workbook {ns} {rns}><sheets>'
        f'<sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
        '</Relationships>',
        "xl/worksheets/sheet1.xml": f'<?xml version="1.0"?><worksheet {ns}><sheetData>{"".join(body)}</sheetData></worksheet>',
    }
    with zipfile.ZipFile(path, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)


def write_drop(path: str, header: list[str], rows: list[list]) -> None:
    """A ';'-separated drop with a decimal comma, as the source systems write it."""
    def fmt(v):
        if v is None:
            return ""
        if isinstance(v, decimal.Decimal):
            return str(v).replace(".", ",")
        return str(v)

    with open(path, "w") as f:
        f.write(";".join(header) + "\n")
        for r in rows:
            f.write(";".join(fmt(v) for v in r) + "\n")
