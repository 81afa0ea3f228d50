"""Reading workbooks: cell kinds, dates, shared texts, gaps, failures."""

import io
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.workbooks import DOCUMENT, MAIN, PACKAGE, workbook_bytes
from tidemark.sources import workbook

NS = f'xmlns="{MAIN}" xmlns:r="{DOCUMENT}"'


def office_bytes(sheet_data, shared="", styles="", properties=""):
    """A workbook as an office program stores it: shared texts and styles in parts."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {NS}>{properties}<sheets><sheet name="S" sheetId="7" r:id="rId9"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId9" Type="t" Target="/xl/worksheets/other.xml"/></Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f"<sst {NS}>{shared}</sst>")
        book.writestr("xl/styles.xml", f"<styleSheet {NS}>{styles}</styleSheet>")
        book.writestr("xl/worksheets/other.xml", f"<worksheet {NS}><sheetData>{sheet_data}</sheetData></worksheet>")
    return out.getvalue()


def files(spark, **books):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in books.items()], "path string, content binary")


def table(spark, content, sheet="S"):
    df = workbook.sheet_table(workbook.sheet_rows(files(spark, b=content)), sheet)
    return dict(df.dtypes), [tuple(r) for r in df.collect()]


SHARED = "<si><t>id</t></si><si><r><t>wh</t></r><r><t>en</t></r><rPh><t>no</t></rPh></si><si><t>x &amp; y</t></si>"
STYLES = (
    '<numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="0.00&quot;d&quot;"/></numFmts>'
    '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
)
HEAD = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="inlineStr"><is><t>note</t></is></c></row>'


def test_kinds_dates_and_gaps(spark):
    body = (
        '<row r="2"><c r="A2"><v>1</v></c><c r="B2" s="1"><v>45292</v></c><c r="C2" t="b"><v>1</v></c><c r="D2" t="s"><v>2</v></c></row>'
        '<row r="4"><c r="A4"><v>2.0</v></c><c r="B4" s="2"><v>45292.75</v></c><c r="D4" s="3"><v>5</v></c></row>'
        '<row r="5"><c r="A5" t="e"><v>#DIV/0!</v></c></row>'
        '<row r="9"><c r="A9" s="1"/></row>'
    )
    types, rows = table(spark, office_bytes(HEAD + body, SHARED, STYLES))
    assert types == {"id": "bigint", "when": "timestamp_ntz", "Unnamed:_2": "boolean", "note": "string"}
    assert rows == [
        (1, datetime(2024, 1, 1), True, "x & y"),
        (None, None, None, None),
        (2, datetime(2024, 1, 1, 18), None, "5"),
    ]


def test_1904_dates_and_fractions(spark):
    body = '<row r="2"><c r="A2"><v>1.5</v></c><c r="B2" s="1"><v>0</v></c></row><row><c><v>2</v></c></row>'
    content = office_bytes(HEAD + body, SHARED, STYLES, '<workbookPr date1904="1"/>')
    types, rows = table(spark, content)
    assert types["id"] == "double" and types["note"] == "string"
    assert [r[:2] for r in rows] == [(1.5, datetime(1904, 1, 1)), (2.0, None)]


def test_repeated_and_numeric_headers_and_text_digits(spark):
    content = workbook_bytes({"S": [["a", "a", 2024], ["007", 1, "x"], ["008", 2, 3]]})
    types, rows = table(spark, content)
    assert types == {"a": "string", "a_1": "bigint", "2024": "string"}
    assert rows == [("007", 1, "x"), ("008", 2, "3")]


def test_sheets_in_order_and_failures(spark):
    good = workbook_bytes({"Z 1": [["h"], [1]], "A": [["h"], [2]]})
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(good)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            data = old.read(name)
            new.writestr(name, data[: len(data) // 2] if name.endswith("sheet1.xml") else data)
    df = files(spark, good=good, half=out.getvalue(), none=b"")
    listed = workbook.sheets(df).orderBy("workbook", "position").collect()
    assert [(r.workbook, r.position, r.sheet) for r in listed if r.error is None] == [
        ("good", 1, "Z 1"), ("good", 2, "A"), ("half", 1, "Z 1"), ("half", 2, "A"),
    ]
    rows = workbook.sheet_rows(df)
    failed = {(r.workbook, r.sheet) for r in rows.where("error is not null").collect()}
    assert failed == {("half", "Z 1"), ("none", None)}
    kept = workbook.good_rows(rows)
    assert sorted({(r.workbook, r.sheet) for r in kept.collect()}) == [("good", "A"), ("good", "Z 1"), ("half", "A")]
    assert sorted(r.h for r in workbook.sheet_table(kept, "A").collect()) == [2, 2]
    found = {(r.workbook, r.sheet): (r.row_count, r.column_count, r.columns) for r in workbook.manifest(kept).collect()}
    assert found[("good", "A")] == (1, 1, ["h"])


def test_workbooks_must_agree_on_headers(spark):
    df = files(spark, a=workbook_bytes({"S": [["h"], [1]]}), b=workbook_bytes({"S": [["g"], [1]]}))
    with pytest.raises(ValueError, match="disagree"):
        workbook.sheet_table(workbook.sheet_rows(df), "S")
    with pytest.raises(ValueError, match="no sheet T"):
        workbook.sheet_table(workbook.sheet_rows(df), "T")


def test_folder_of_workbooks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xlsx").write_bytes(workbook_bytes({"S": [["h"], [1]]}))
    (tmp_path / "notes.txt").write_text("no")
    df = workbook.workbook_files(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[-1] for r in df.collect()] == ["a.xlsx"]


def test_empty_sheets_missing_texts_and_iso_dates(spark):
    body = (
        '<row r="1"><c r="A1" t="inlineStr"><is><t>NA</t></is></c><c r="B1" t="inlineStr"><is><t>day</t></is></c></row>'
        '<row r="2"><c r="A2"><v>1</v></c><c r="B2" t="d"><v>2024-01-05T10:00:00Z</v></c></row>'
        '<row r="3"><c r="A3" t="inlineStr"><is><t>n/a</t></is></c></row>'
    )
    df = workbook.sheet_table(workbook.sheet_rows(files(spark, b=office_bytes(body))), "S")
    assert df.dtypes == [("NA", "bigint"), ("day", "timestamp_ntz")]
    assert [tuple(map(str, r)) for r in df.collect()] == [("1", "2024-01-05 10:00:00"), ("None", "None")]
    found = workbook.sheet_rows(files(spark, b=workbook_bytes({"Full": [["h"], ["NA"]], "Empty": []})))
    listed = {r.sheet: (r.row_count, r.column_count, r.columns) for r in workbook.manifest(found).collect()}
    assert listed == {"Full": (1, 1, ["h"]), "Empty": (0, 0, [])}
    assert workbook.cells(found).count() == 0


def plain_rows(df):
    return sorted((r.workbook, r.position, r.sheet, r.row_no or 0, r.cells, r.kinds, r.error) for r in df.collect())


@pytest.mark.parametrize("piece", [1, 300, 4 << 20])
def test_pieces_of_any_size_give_the_same_rows(spark, piece):
    """Gaps, rows without a value and rows without a number, also where a piece ends."""
    rows = ["<row r=\"3\"><c r=\"B3\"><v>1</v></c></row>", "<row><c t=\"e\"><v>#N/A</v></c></row>", "<row/>", "<row><c><v>2</v></c></row>"]
    rows += ['<row r="12" spans="1:1"><c r="A12" s="1"/></row>', '<row r="20"><c r="A20" t="s"><v>1</v></c></row>', '<row r="21"/>']
    rows += [f'<row r="{30 + i}"><c r="A{30 + i}"><v>{i}</v></c></row>' for i in range(40)]
    books = {
        "a": office_bytes("".join(rows), SHARED, STYLES),
        "b": office_bytes("".join(rows[1:5]), SHARED, STYLES),
        "c": office_bytes("<row r=\"1\"/><row r=\"2\"><c r=\"A2\" t=\"e\"><v>x</v></c></row>"),
        "d": office_bytes('<row r="2"><c r="A2" t="inlineStr"><is><t><![CDATA[<row r="9">]]></t></is></c></row><!-- <row> -->' + "".join(rows[-5:])),
        "e": workbook_bytes({"S": [["h"], [1]], "Empty": [], "T": [["t"], *[[i] for i in range(50)]]}),
    }
    found = plain_rows(workbook.sheet_rows(files(spark, **books), piece_bytes=piece, slot_bytes=piece))
    numbers = {k: [r[3] for r in found if r[0] == k] for k in books}
    assert numbers["a"] == [*range(1, 7), *range(7, 21), *range(21, 70)]
    assert [r[3] for r in found if r[0] == "a" and r[4]] == [3, 6, 20, *range(30, 70)]
    assert numbers["b"] == [1, 2, 3] and [r[4] for r in found if r[0] == "b"] == [[], [], ["2"]]
    assert [r[3:] for r in found if r[0] == "c"] == [(0, None, None, None)]
    assert [r[4] for r in found if r[0] == "d" and r[4]] == [['<row r="9">'], *[[str(i)] for i in range(35, 40)]]
    assert [(r[2], r[3]) for r in found if r[0] == "e"] == [("S", 1), ("S", 2), ("Empty", 0), *[("T", i) for i in range(1, 52)]]


def test_one_workbook_is_decoded_by_several_tasks(spark):
    content = workbook_bytes({f"S{k}": [["h"], *[[i] for i in range(300)]] for k in range(3)})
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        pieces = workbook.sheet_pieces(files(spark, one=content), 2000, 4000)
        by_task = pieces.where("xml IS NOT NULL AND position > 0").groupBy(F.spark_partition_id().alias("task"), "sheet").agg(F.count(F.lit(1)).alias("n")).collect()
        assert len({r.task for r in by_task}) > 2
        assert max(sum(r.sheet == s for r in by_task) for s in ("S0", "S1", "S2")) > 1
        shared = pieces.where("position = 0").count()
        assert shared == pieces.select("slot").where("slot > 0").distinct().count() > 5
        rows = workbook.sheet_rows(files(spark, one=content), piece_bytes=2000, slot_bytes=4000).groupBy("sheet")
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.max("row_no").alias("last")).collect()
        assert sorted(map(tuple, found)) == [("S0", 301, 301), ("S1", 301, 301), ("S2", 301, 301)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_sheets_in_other_encodings_and_with_prefixes(spark):
    good = office_bytes('<row r="1"><c r="A1" t="inlineStr"><is><t>é</t></is></c></row><row r="2"><c r="A2"><v>5</v></c></row>')
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(good)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            data = old.read(name)
            if name.endswith("other.xml"):
                text = '<?xml version="1.0" encoding="utf-16"?>' + data.decode()
                data = text.replace("xmlns=", "xmlns:x=").replace("<", "<x:").replace("<x:/", "</x:").replace("<x:?", "<?").encode("utf-16")
            new.writestr(name, data)
    assert table(spark, out.getvalue()) == ({"é": "bigint"}, [(5,)])
