"""Workbooks made from the driver's tables, for checking that they read back unchanged."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame

PACKAGE = "http://schemas.openxmlformats.org/package/2006"
DOCUMENT = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def _letters(index: int) -> str:
    name = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(65 + rest) + name
    return name


def _cell(reference: str, value) -> str:
    if value is None or value != value:
        return ""
    if isinstance(value, str):
        return f'<c r="{reference}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    return f'<c r="{reference}"><v>{value!r}</v></c>'


def _sheet(rows: Sequence[Sequence]) -> str:
    lines = []
    for number, row in enumerate(rows, 1):
        found = "".join(_cell(f"{_letters(i)}{number}", v) for i, v in enumerate(row))
        lines.append(f'<row r="{number}">{found}</row>')
    return f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def workbook_bytes(sheets: dict[str, Sequence[Sequence]]) -> bytes:
    """A minimal workbook: sheet name to rows, the header row first."""
    listed = "".join(
        f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="rId{i}"/>'
        for i, name in enumerate(sheets, 1)
    )
    links = "".join(
        f'<Relationship Id="rId{i}" Type="{DOCUMENT}/worksheet" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(sheets) + 1)
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{DOCUMENT}"><sheets>{listed}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE}/relationships">{links}</Relationships>',
        )
        for i, rows in enumerate(sheets.values(), 1):
            book.writestr(f"xl/worksheets/sheet{i}.xml", _sheet(rows))
    return out.getvalue()


def broken(content: bytes, part: str) -> bytes:
    """A workbook of which one sheet's XML ends in the middle."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            data = old.read(name)
            new.writestr(name, data[: len(data) // 2] if name == part else data)
    return out.getvalue()


EMPTY, BROKEN = "Notes", "Broken sheet"


def table_workbooks(df: DataFrame, sheet: str, headers: list[str], faults: bool = False) -> DataFrame:
    """Path and bytes of workbooks that hold all of ``df``, one workbook per batch of rows.

    The second sheet of each lists the first column alone. With ``faults`` there is a third without
    any row and a fourth that is broken. How many workbooks there are depends on how Spark cuts the
    table, so results must not depend on their names.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch.astype(object).values.tolist()
            if not rows:
                continue
            content = workbook_bytes(
                {
                    sheet: [headers, *rows],
                    f"{sheet} keys": [headers[:1], *[row[:1] for row in rows]],
                }
                | ({EMPTY: [], BROKEN: [headers, *rows]} if faults else {})
            )
            if faults:
                content = broken(content, "xl/worksheets/sheet4.xml")
            yield pd.DataFrame({"path": [f"book-{rows[0][0]}.xlsx"], "content": [content]})

    return df.mapInPandas(write, "path string, content binary")
