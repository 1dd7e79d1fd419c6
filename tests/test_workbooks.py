"""Workbooks to landed rows."""

from __future__ import annotations

import io
import tracemalloc
import zipfile

import pytest

from ridewell.sources import landing as L
from ridewell.sources import sample as D
from ridewell.sources import workbooks as W

MAPS = {"van": L.EraMap({"Id": "trip_id", "Start": "departure_raw", "Station": "departure_station_name", "Note": ""})}


def books(spark, **named):
    return spark.createDataFrame([(f"d/{k}.xlsx", bytearray(v)) for k, v in named.items()], "path string, content binary")


def listed(*names):
    return [L.SourceFile(f"d/{n}.xlsx", "van", "2016", "sha") for n in names]


def test_every_worksheet_lands(spark):
    """Two quarters in one workbook both land; numbers, truth values, gaps, blank rows, markup and long rows."""
    two = D.workbook({" Q3 ": [["Id", "Start", "Station"], [1, 42552.5, "A & <b>"], [None, None, None], [2, None, "  x "]], "Q4": [[None, None], ["Start", None, "Id"][::2] + ["Note"], ["2016", "9", True, "beyond"]], "none": []})
    one = D.workbook({"only": [["Id", *["Note"]], *[[i, "n"] for i in range(W.ROWS + 5)]]})
    landed = W.land(spark, books(spark, two=two, one=one), listed("two", "one", "gone"), MAPS)
    rows = {(r.source_file, r.trip_id): (r.departure_raw, r.departure_station_name) for r in landed.tables["trips"].collect()}
    assert rows["two.xlsx#Q3", "1"] == ("42552.5", "A & <b>") and rows["two.xlsx#Q3", "2"] == (None, "  x ") and rows["two.xlsx#Q4", "9"] == ("2016", None)
    assert len(rows) == 3 + W.ROWS + 5
    audit = {r.source_file: (r.source_records, r.rows_landed, r.rows_too_long, r.kind) for r in landed.audit.collect()}
    assert audit == {"two.xlsx#Q3": (2, 2, 0, "trips"), "two.xlsx#Q4": (1, 1, 1, "trips"), "two.xlsx#none": (0, 0, 0, "empty"), "one.xlsx": (W.ROWS + 5,) * 2 + (0, "trips"), "gone.xlsx": (0, 0, 0, "empty")}
    with pytest.raises(L.RowsUnaccounted):
        L.reconcile(landed.audit)


def test_worksheets_in_order(spark):
    book = D.workbook({"b": [["Id"], [1]], "a": [["Id"]], "c & d": []})
    assert [(r.sheet, r.place, r.sheets, r.records) for r in W.worksheets(books(spark, x=book)).orderBy("place").collect()] == [("b", 0, 3, 2), ("a", 1, 3, 1), ("c & d", 2, 3, 0)]


def test_what_is_no_workbook(spark):
    with pytest.raises(Exception, match="is no workbook"):
        W.worksheets(books(spark, x=b"Id,Start")).collect()
    with pytest.raises(L.UnknownColumns):
        W.land(spark, books(spark, x=D.workbook({"s": [["Id", "What"], [1, 2]]})), listed("x"), MAPS)
    with pytest.raises(L.LandingRefused, match="twice"):
        W.land(spark, books(spark, x=D.workbook({"s": [["Id"]]})), listed("x", "x"), MAPS)


def test_columns_beyond_z():
    row = [f"c{i}" for i in range(60)]
    assert list(W.Workbook(D.workbook({"s": [row]})).rows("s")) == [row]


def test_a_large_worksheet_is_a_stream():
    """Memory does not grow with the rows of a worksheet."""
    line = '<row><c t="inlineStr"><is><t>some text in a cell</t></is></c><c><v>42552.5</v></c></row>'
    out = io.BytesIO(D.workbook({"s": []}))
    with zipfile.ZipFile(out, "a", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/worksheets/large.xml", f"<worksheet><sheetData>{line * 120_000}</sheetData></worksheet>")
    book = W.Workbook(out.getvalue())
    book.sheets["large"] = "xl/worksheets/large.xml"
    tracemalloc.start()
    assert sum(1 for _ in book.rows("large")) == book.records("large") == 120_000
    assert tracemalloc.get_traced_memory()[1] < 20 << 20
    tracemalloc.stop()
