"""Workbooks (.xlsx) as DataFrames.

A workbook is a zip of XML parts, which Spark has no reader for. Where a file's bytes are, its sheets
are only unpacked and cut between rows, which is quick; the pieces are then dealt out, each with what
the whole workbook shares, and decoded by many tasks, however few workbooks there are. Everything
after that is built-in DataFrame work.

A row of a sheet stays one row with an array of cells. Turning sheets into tables is then a
projection, without the shuffle a pivot of single cells would need. ``kinds`` holds a letter
per cell: (n)umber, (d)ate, (b)oolean, (s)tring, or a blank.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import partial
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.names import clean_headers
from tidemark.operators.conform import column_types, fitting

# XML names of the workbook format, the number formats that mean a date, and
# the days dates count from (1900 system with its leap-year slip, and 1904 system).
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
EPOCH_1900 = datetime(1899, 12, 30)
EPOCH_1904 = datetime(1904, 1, 1)

SHEET_DDL = "workbook string, position int, sheet string, error string"
ROW_DDL = (
    "workbook string, position int, sheet string, row_no int, cells array<string>, "
    "kinds string, error string"
)
NO_CELL = (" ", None)

# Texts that mean a missing value below the header, as spreadsheet readers in Python
# take them by default.
MISSING = frozenset(
    ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN"]
    + ["<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
)


def workbook_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and bytes of each workbook under a folder; a missing folder is an error."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xlsx")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "content")
    )


def _sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Names of the sheets in workbook order, with the part each is stored in."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    parts = {link.get("Id"): link.get("Target") for link in links}
    return [
        (sheet.get("name"), posixpath.normpath(posixpath.join("/xl", parts[sheet.get(RELATION)]))[1:])
        for sheet in root.iter(f"{MAIN}sheet")
    ]


def _shared_texts(part: bytes | None) -> list[str]:
    if part is None:
        return []
    root = ElementTree.fromstring(part)
    return [_plain_text(item) for item in root.iter(f"{MAIN}si")]


def _plain_text(item: ElementTree.Element) -> str:
    # Phonetic hints (rPh) are no part of the text.
    runs = [item, *item.findall(f"{MAIN}r")]
    return "".join(t.text or "" for run in runs for t in run.findall(f"{MAIN}t"))


def _date_styles(part: bytes | None) -> set[int]:
    """Cell styles whose number format shows a date."""
    if part is None:
        return set()
    root = ElementTree.fromstring(part)
    own = {}
    for fmt in root.iter(f"{MAIN}numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", ""))
        own[int(fmt.get("numFmtId"))] = bool(re.search("[dmyhs]", code, re.IGNORECASE))
    styles = root.find(f"{MAIN}cellXfs")
    ids = [] if styles is None else [int(xf.get("numFmtId", 0)) for xf in styles]
    return {i for i, n in enumerate(ids) if own.get(n, n in DATE_FORMATS)}


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - 64
    return index - 1


class _Decoder:
    """Cell values of one workbook as text; None for an empty cell or, below the header, a text of
    ``missing``. It is made of the parts that all sheets share."""

    def __init__(self, book: bytes, shared: bytes | None, styles: bytes | None, missing: frozenset[str] = MISSING):
        self.missing = missing
        self.texts = _shared_texts(shared)
        self.date_styles = _date_styles(styles)
        properties = ElementTree.fromstring(book).find(f"{MAIN}workbookPr")
        since_1904 = properties is not None and properties.get("date1904") in ("1", "true")
        self.epoch = EPOCH_1904 if since_1904 else EPOCH_1900

    def value(self, cell: ElementTree.Element) -> tuple[str, str | None]:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            item = cell.find(f"{MAIN}is")
            return NO_CELL if item is None else ("s", _plain_text(item))
        stored = cell.findtext(f"{MAIN}v")
        if stored is None or kind == "e":
            return NO_CELL
        if kind == "s":
            return "s", self.texts[int(stored)]
        if kind == "b":
            return "b", "true" if stored == "1" else "false"
        if kind == "n" and int(cell.get("s", 0)) in self.date_styles:
            moment = self.epoch + timedelta(seconds=round(float(stored) * 86400, 6))
            return "d", moment.isoformat(sep=" ")
        if kind == "d":
            return "d", datetime.fromisoformat(stored.removesuffix("Z")).isoformat(sep=" ")
        return ("n" if kind == "n" else "s"), stored

    def rows(self, xml: bytes, number: int, due: int) -> Iterator[tuple[int, list[str | None], str]]:
        """Numbered rows of a piece, up to its last one with a value; an empty row before it is kept.

        ``number`` is that of the row before the piece, ``due`` follows the last row with a value there.
        """
        for _, row in ElementTree.iterparse(io.BytesIO(xml)):
            if row.tag != f"{MAIN}row":
                continue
            number = int(row.get("r", number + 1))
            cells: list[tuple[str, str | None]] = []
            for cell in row.findall(f"{MAIN}c"):
                reference = cell.get("r")
                index = len(cells) if reference is None else _column_index(reference)
                cells += [NO_CELL] * (index + 1 - len(cells))
                cells[index] = self.value(cell)
            row.clear()
            while cells and cells[-1] == NO_CELL:
                cells.pop()
            if not cells:
                continue
            for empty in range(due, number):
                yield empty, [], ""
            if number > 1:
                # A row of nothing but such texts is still a row.
                cells = [NO_CELL if c[0] == "s" and c[1] in self.missing else c for c in cells]
            yield number, [text for _, text in cells], "".join(kind for kind, _ in cells)
            due = number + 1


def _list_sheets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in batches:
        for path, content in zip(files["path"], files["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    found = [(path, i, name, None) for i, (name, _) in enumerate(_sheet_parts(book), 1)]
            except Exception as error:
                found = [(path, None, None, f"{type(error).__name__}: {error}")]
            yield pd.DataFrame(found, columns=["workbook", "position", "sheet", "error"])


def sheets(files: DataFrame) -> DataFrame:
    """Sheets of each workbook in order. A file that cannot be opened gives an error row."""
    return files.mapInPandas(_list_sheets, SHEET_DDL)


# ---- cutting sheets into pieces ---------------------------------------------------------

#: Bytes of XML of a piece, and of the pieces that travel with one copy of what their workbook shares;
#: where that is larger, it sets the size, so the copies together are no larger than the pieces.
PIECE_BYTES, SLOT_BYTES = 4 << 20, 16 << 20

PIECE_DDL = (
    "workbook string, slot int, position int, sheet string, piece int, number int, due int, "
    "xml binary, shared binary, styles binary, error string"
)
_PIECE_NAMES = [column.split()[0] for column in PIECE_DDL.split(", ")]

_ENCODING = re.compile(rb"""^<\?xml[^>]*encoding=["']([\w.-]+)["']""")
_ROOT = re.compile(rb"<((?:[\w.-]+:)?worksheet)[\s>]")
_BEGIN = re.compile(rb"<((?:[\w.-]+:)?sheetData)(?:\s[^>]*)?(?<!/)>")
_NO_ROWS = re.compile(rb"<(?:[\w.-]+:)?sheetData(?:\s[^>]*)?/>")
_END = re.compile(rb"</(?:[\w.-]+:)?sheetData\s*>")
_ROW = re.compile(rb"<(?:[\w.-]+:)?row(?=[\s/>])[^>]*>")
_NUMBER = re.compile(rb"""\sr\s*=\s*["'](\d+)["']""")


def _unpacked(stream) -> Iterator[bytes]:
    """A part's XML in UTF-8, some of it at a time."""
    first = stream.read(1 << 20)
    named = _ENCODING.match(first)
    if first[:2] in (b"\xff\xfe", b"\xfe\xff"):
        encoding = "utf-16"
    else:
        encoding = named[1].decode().lower() if named else "utf-8"
    if encoding in ("utf-8", "utf8", "us-ascii", "ascii"):
        while first:
            yield first
            first = stream.read(1 << 20)
    else:
        text = (first + stream.read()).decode(encoding)
        yield re.sub(r"^\s*<\?xml.*?\?>", "", text.lstrip("\ufeff")).encode()


def _has_value(cell: ElementTree.Element) -> bool:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return cell.find(f"{MAIN}is") is not None
    return kind != "e" and cell.find(f"{MAIN}v") is not None


def _pieces(stream, size: int) -> Iterator[tuple[int, int, bytes]]:
    """A sheet as XML documents of whole rows, each with the number of the row before it and the number
    due after the last row with a value. After the last piece comes one without XML if no row had one.

    A sheet with comments or unparsed text in it, where ``<row`` may mean nothing, stays in one piece.
    """
    blocks = _unpacked(stream)
    held = b""
    begin = None
    for block in blocks:
        held += block
        begin = _BEGIN.search(held)
        if begin or _NO_ROWS.search(held):
            break
    if not begin:
        yield 0, 1, b""
        return
    root = _ROOT.search(held)
    head, tail = held[: begin.end()], b"</" + begin[1] + b"></" + (root[1] if root else b"worksheet") + b">"
    held, number, due, ended = held[begin.end() :], 0, 1, False

    def closed(rows: bytes) -> tuple[int, int]:
        """Number of the last row, and the number due, after some rows."""
        at, n = [], number
        if b"<!" in rows:
            following = due
            for row in ElementTree.fromstring(head + rows + tail).iter(f"{MAIN}row"):
                n = int(row.get("r", n + 1))
                if any(map(_has_value, row.findall(f"{MAIN}c"))):
                    following = n + 1
            return n, following
        for found in _ROW.finditer(rows):
            own = _NUMBER.search(found[0])
            n = int(own[1]) if own else n + 1
            at.append((found.start(), n))
        stop = len(rows)
        for start, nth in reversed(at):  # almost always the last row has a value
            row = ElementTree.fromstring(head + rows[start:stop] + tail).find(f".//{MAIN}row")
            if any(map(_has_value, row.findall(f"{MAIN}c"))):
                return n, nth + 1
            stop = start
        return n, due

    while not ended:
        end = _END.search(held)
        if end:
            held, ended = held[: end.start()], True
        else:
            block = next(blocks, None)
            if block is None:
                raise ValueError("the sheet ends in the middle of its rows")
            held += block
        cuts, at = [], 0
        if b"<!" not in held and len(held) >= size:
            for found in _ROW.finditer(held):
                if found.start() - at >= size:
                    at = found.start()
                    cuts.append(at)
        if ended:
            cuts.append(len(held))
        for low, high in zip([0, *cuts], cuts):
            if held[low:high].strip():
                yield number, due, head + held[low:high] + tail
                number, due = closed(held[low:high])
        held = held[cuts[-1] :] if cuts else held
    if due == 1:
        yield number, due, b""


def _cut(files: Iterator[pd.DataFrame], piece_bytes: int, slot_bytes: int) -> Iterator[pd.DataFrame]:
    """The pieces of each workbook. Where a slot begins comes a row with what its pieces share."""
    for batch in files:
        for path, content in zip(batch["path"], batch["content"]):
            for row in _workbook_pieces(path, content, piece_bytes, slot_bytes):
                yield pd.DataFrame([row], columns=_PIECE_NAMES)


def _workbook_pieces(path: str, content: bytes, piece_bytes: int, slot_bytes: int) -> Iterator[tuple]:
    try:
        book = zipfile.ZipFile(io.BytesIO(content))
        parts = _sheet_parts(book)
        optional = [book.read(n) if n in book.namelist() else None for n in ("xl/sharedStrings.xml", "xl/styles.xml")]
        whole = book.read("xl/workbook.xml")
        _Decoder(whole, None, optional[1])
    except Exception as error:
        yield path, 0, None, None, 0, None, None, None, None, None, f"{type(error).__name__}: {error}"
        return
    size = max(slot_bytes, len(optional[0] or b""))
    slot, filled = 0, size
    with book:
        for position, (sheet, part) in enumerate(parts, 1):
            try:
                with book.open(part) as stream:
                    for piece, (number, due, xml) in enumerate(_pieces(stream, piece_bytes)):
                        if filled >= size:
                            slot, filled = slot + 1, 0
                            yield path, slot, 0, None, 0, None, None, whole, *optional, None
                        filled += len(xml)
                        yield path, slot, position, sheet, piece, number, due, xml, None, None, None
            except Exception as error:
                # The other sheets go on; ``good_rows`` leaves this one out.
                yield path, slot, position, sheet, 0, None, None, None, None, None, f"{type(error).__name__}: {error}"


ROWS_PER_BATCH = 10_000
_ROW_NAMES = ["workbook", "position", "sheet", "row_no", "cells", "kinds", "error"]


def _decode(pieces: Iterator[pd.DataFrame], missing: frozenset[str]) -> Iterator[pd.DataFrame]:
    """Rows of pieces that come by workbook and slot, what a slot shares first; a workbook's shared parts
    are read once per task."""
    decoder, of = None, None
    held: list[tuple] = []
    for batch in pieces:
        for piece in batch.itertuples(index=False):
            if piece.position == 0:
                if piece.workbook != of:
                    of = piece.workbook
                    try:
                        decoder = _Decoder(piece.xml, piece.shared, piece.styles, missing)
                    except Exception as error:
                        decoder = error
                continue
            for row in _piece_rows(piece, decoder):
                held.append(row)
                if len(held) == ROWS_PER_BATCH:
                    yield pd.DataFrame(held, columns=_ROW_NAMES)
                    held = []
    if held:
        yield pd.DataFrame(held, columns=_ROW_NAMES)


def _piece_rows(piece, decoder) -> Iterator[tuple]:
    position = None if pd.isna(piece.position) else int(piece.position)
    try:
        if piece.error is not None:
            yield piece.workbook, position, piece.sheet, None, None, None, piece.error
        elif not piece.xml:
            yield piece.workbook, position, piece.sheet, None, None, None, None
        elif isinstance(decoder, Exception):
            raise decoder
        else:
            for number, cells, kinds in decoder.rows(piece.xml, int(piece.number), int(piece.due)):
                yield piece.workbook, position, piece.sheet, number, cells, kinds, None
    except Exception as error:
        yield piece.workbook, position, piece.sheet, None, None, None, f"{type(error).__name__}: {error}"


def sheet_pieces(files: DataFrame, piece_bytes: int = PIECE_BYTES, slot_bytes: int = SLOT_BYTES) -> DataFrame:
    """All sheets cut into pieces of whole rows and dealt out, by workbook and slot within a task.

    The number of tasks is that of the session's shuffle partitions: decoding costs far more than
    the size of the pieces tells, so they are not put together by size.
    """
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = files.select("path", "content").mapInPandas(partial(_cut, piece_bytes=piece_bytes, slot_bytes=slot_bytes), PIECE_DDL)
    return cut.repartition(tasks, "workbook", "slot").sortWithinPartitions("workbook", "slot", "position", "piece")


def sheet_rows(
    files: DataFrame, missing: frozenset[str] = MISSING, piece_bytes: int = PIECE_BYTES, slot_bytes: int = SLOT_BYTES
) -> DataFrame:
    """Rows of all sheets, the header row included, and a row with ``error`` per failure.

    A sheet without rows gives one row without ``row_no``. Texts of ``missing`` are NULL below the
    header.
    """
    pieces = sheet_pieces(files, piece_bytes, slot_bytes)
    return pieces.mapInPandas(partial(_decode, missing=missing), ROW_DDL)


def good_rows(rows: DataFrame) -> DataFrame:
    """Rows of the sheets that were read to their end."""
    failed = rows.where(F.col("error").isNotNull()).select("workbook", "sheet").distinct()
    return rows.where(F.col("error").isNull()).join(failed, ["workbook", "sheet"], "left_anti")


def cells(rows: DataFrame) -> DataFrame:
    """One row per filled cell below the header: row and column numbers count from 1."""
    return (
        rows.where(F.col("row_no") > 1)
        .select("workbook", "sheet", "row_no", F.posexplode("cells").alias("pos", "value"))
        .where(F.col("value").isNotNull())
        .select("workbook", "sheet", "row_no", (F.col("pos") + 1).alias("column_no"), "value")
    )


def manifest(rows: DataFrame) -> DataFrame:
    """Data rows, columns and headers of each sheet.

    Comes from the sheets themselves, so it also lists one that later fails to load, and one
    without rows.
    """
    none = F.array().cast("array<string>")
    return (
        rows.where(F.col("error").isNull())
        .groupBy("workbook", "sheet")
        .agg(
            F.coalesce(F.max("row_no") - 1, F.lit(0)).cast("bigint").alias("row_count"),
            F.coalesce(F.max(F.size("cells")), F.lit(0)).alias("column_count"),
            F.coalesce(F.max(F.when(F.col("row_no") == 1, F.col("cells"))), none).alias("columns"),
        )
    )


def _distinct_headers(header: list[str | None], width: int) -> list[str]:
    """Every column named: unnamed ones by position, a repeated name with a number."""
    names: list[str] = []
    for i in range(width):
        name = header[i] if i < len(header) and header[i] else f"Unnamed: {i}"
        candidate, repeat = name, 0
        while candidate in names:
            repeat += 1
            candidate = f"{name}.{repeat}"
        names.append(candidate)
    return names


def sheet_headers(rows: DataFrame, sheet: str) -> list[str]:
    """Headers of a sheet; every workbook that has it must agree on them."""
    of_sheet = rows.where((F.col("sheet") == sheet) & F.col("error").isNull())
    found = of_sheet.where(F.col("row_no") == 1).select("cells").distinct().take(2)
    if not found:
        raise ValueError(f"no sheet {sheet} with a header row")
    if len(found) > 1:
        raise ValueError(f"workbooks disagree on the headers of {sheet}")
    width = of_sheet.agg(F.max(F.size("cells"))).first()[0]
    return _distinct_headers(found[0].cells, width)


def _cell(i: int) -> Column:
    return F.get("cells", F.lit(i))


def _kind(i: int) -> Column:
    return F.when(_cell(i).isNotNull(), F.substring("kinds", i + 1, 1))


def _cell_types(i: int) -> Column:
    """What a cell can be read as, by its kind; NULL for an empty one."""
    number = _cell(i).try_cast("double")
    whole = number.isNull() | ((number == F.floor(number)) & (F.abs(number) < 2.0**63))
    return (
        F.when(_kind(i).isNull(), F.lit(None))
        .when((_kind(i) == "n") & whole, fitting("bigint", "double"))
        .when(_kind(i) == "n", fitting("double"))
        .when(_kind(i) == "d", fitting("timestamp_ntz"))
        .when(_kind(i) == "b", fitting("boolean"))
        .otherwise(fitting())
    )


def sheet_types(body: DataFrame, width: int) -> list[str]:
    """Type of each column from the kinds of its cells; mixed and empty columns are text."""
    found = column_types(body, [(str(i), _cell_types(i)) for i in range(width)]).collect()
    types = {r.column_name: r.inferred_type for r in found}
    return [types[str(i)] for i in range(width)]


def _typed(i: int, kind: str) -> Column:
    if kind == "bigint":
        # Also whole numbers stored with a fraction or an exponent.
        return F.coalesce(_cell(i).try_cast("bigint"), _cell(i).cast("double").cast("bigint"))
    return _cell(i).cast(kind)


def sheet_table(rows: DataFrame, sheet: str) -> DataFrame:
    """A sheet, from all workbooks that have it, as a typed table under cleaned headers.

    Reads the headers and one row of type facts to the driver. Where decoding is dear, pass
    rows that were written out before.
    """
    names = clean_headers(sheet_headers(rows, sheet))
    body = rows.where((F.col("sheet") == sheet) & (F.col("row_no") > 1))
    types = sheet_types(body, len(names))
    return body.select(*[_typed(i, kind).alias(n) for i, (n, kind) in enumerate(zip(names, types))])
