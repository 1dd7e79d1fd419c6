"""Excel workbooks to landed rows: every worksheet is read, as a stream, with what its cells hold as text."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from functools import reduce
from xml.etree.ElementTree import iterparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch
from .landing import AUDIT, KINDS, PROVENANCE, EraMap, Landed, LandingRefused, SourceFile

UNITS = "path string, sheet string, place int, sheets int, records long"
CELLS = "path string, place int, row long, cells array<string>"
_REFERENCE = re.compile(r"([A-Z]+)\d+$")
#: Bytes of a worksheet that are unpacked at once to count its rows, and rows that go on together.
CHUNK, ROWS = 1 << 20, 2000


def _plain(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _elements(stream, *tags: str):
    """Whole elements of those names in turn; what has been given is forgotten, so that no tree grows."""
    above = []
    for event, element in iterparse(stream, ("start", "end")):
        if event == "start":
            above.append(element)
            continue
        above.pop()
        if _plain(element.tag) in tags:
            yield element
            if above:
                above[-1].clear()


def _told(element) -> str:
    """Text of a shared or inline string, runs joined, readings of characters left out."""
    out = []
    for part in element:
        if _plain(part.tag) == "t":
            out.append(part.text or "")
        elif _plain(part.tag) == "r":
            out += [t.text or "" for t in part if _plain(t.tag) == "t"]
    return "".join(out)


class Workbook:
    """Worksheets of a workbook, which is a zip of XML files, in the order of their tabs."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        with self.zip.open("xl/_rels/workbook.xml.rels") as f:
            targets = {e.get("Id"): e.get("Target") for e in _elements(f, "Relationship")}
        with self.zip.open("xl/workbook.xml") as f:
            named = [(e.get("name"), next(v for k, v in e.attrib.items() if _plain(k) == "id")) for e in _elements(f, "sheet")]
        at = {name: posixpath.normpath(posixpath.join("xl", targets[i])) if not targets[i].startswith("/") else targets[i][1:] for name, i in named}
        # A chart has a tab, too, but is no worksheet.
        self.sheets = {name: path for name, path in at.items() if "worksheets/" in path}
        self._shared: list[str] | None = None

    def shared(self) -> list[str]:
        if self._shared is None:
            self._shared = []
            if "xl/sharedStrings.xml" in self.zip.namelist():
                with self.zip.open("xl/sharedStrings.xml") as f:
                    self._shared = [_told(e) for e in _elements(f, "si")]
        return self._shared

    def rows(self, sheet: str) -> Iterator[list[str | None]]:
        """Rows with a value in any cell: numbers and dates as they are stored, empty cells null."""
        with self.zip.open(self.sheets[sheet]) as f:
            for row in _elements(f, "row"):
                cells: list[str | None] = []
                for cell in row:
                    place = _REFERENCE.match(cell.get("r") or "")
                    at = reduce(lambda n, c: n * 26 + ord(c) - 64, place[1], 0) - 1 if place else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    cells[at] = self._value(cell)
                if any(c not in (None, "") for c in cells):
                    yield cells

    def _value(self, cell) -> str | None:
        kind = cell.get("t")
        for part in cell:
            if _plain(part.tag) == "is":
                return _told(part)
            if _plain(part.tag) == "v" and part.text is not None:
                if kind == "s":
                    return self.shared()[int(part.text)]
                return {"0": "FALSE", "1": "TRUE"}.get(part.text, part.text) if kind == "b" else part.text
        return None

    def records(self, sheet: str) -> int:
        """Rows with a value, counted in the bytes of the worksheet, apart from how rows() reads it."""
        n, rest = 0, b""
        with self.zip.open(self.sheets[sheet]) as f:
            while chunk := f.read(CHUNK):
                *whole, rest = (rest + chunk).split(b"</row>")
                n += sum(b"<v>" in x or b"<is>" in x for x in whole)
        return n


def _books(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Workbook]]:
    for batch in batches:
        for i in range(batch.num_rows):
            path = batch["path"][i].as_py()
            try:
                yield path, Workbook(batch["content"][i].as_buffer().to_pybytes())
            except (zipfile.BadZipFile, KeyError) as e:
                raise LandingRefused(f"{path} is no workbook: {e}") from e


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for path, book in _books(batches):
        rows = [(path, name, i, len(book.sheets), book.records(name)) for i, name in enumerate(book.sheets)]
        types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], [c.split()[0] for c in UNITS.split(", ")])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(path: str, place: int, first: int, held: list) -> pa.RecordBatch:
        n = len(held)
        return pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([place] * n, pa.int32()), pa.array(range(first, first + n), pa.int64()), pa.array(held, pa.list_(pa.string()))], ["path", "place", "row", "cells"])

    for path, book in _books(batches):
        for place, sheet in enumerate(book.sheets):
            held, first = [], 0
            for cells in book.rows(sheet):
                held.append(cells)
                if len(held) == ROWS:
                    yield made(path, place, first, held)
                    held, first = [], first + ROWS
            if held:
                yield made(path, place, first, held)


def worksheets(books: DataFrame) -> DataFrame:
    """path, sheet, place among its tabs, number of sheets and records (rows with a value, the header among them) of workbooks (path, content)."""
    return books.select("path", "content").mapInArrow(_units, UNITS)


def cells(books: DataFrame) -> DataFrame:
    """path, place, row and cells of every row with a value in every worksheet. A task reads one workbook at a time, and of that one row."""
    return books.select("path", "content").mapInArrow(_cells, CELLS)


def land(spark: SparkSession, books: DataFrame, files: list[SourceFile], maps: dict[str, EraMap]) -> Landed:
    """Landed rows and audit of every worksheet of the listed workbooks, as landing.land() makes them of CSV files.

    books has path and content, as Spark's binaryFile source gives them. A workbook's only worksheet
    bears the file's name, each of several that and its own. The first row with a value is the
    header; cells beyond it make a row too long. A worksheet without a row is `empty`, as is a listed
    workbook that is not there.
    """
    named = {f.path: f for f in files}
    if len(named) < len(files):
        raise LandingRefused("a workbook is listed twice")
    mine = books.join(spark.createDataFrame([(p,) for p in named], "path string"), "path", "left_semi")
    found = worksheets(mine).collect()  # a row for each worksheet
    at = scratch.new_path(spark, "worksheets")
    cells(mine).write.option("compression", "zstd").parquet(at)
    rows = spark.read.schema(CELLS).parquet(at)
    headers = {(r["path"], r["place"]): tuple(r["header"]) for r in rows.filter("row = 0").select("path", "place", F.transform("cells", lambda c: F.coalesce(c, F.lit(""))).alias("header")).collect()}
    units, eras = [], {}
    for r in found:
        f = named[r["path"]]
        label = f.name if r["sheets"] == 1 else f"{f.name}#{r['sheet'].strip()}"
        header = headers.get((r["path"], r["place"]), ())
        while header and not header[-1].strip():
            header = header[:-1]
        kind, targets = maps[f.system_id].targets(list(header), f"{f.system_id} {label}") if header else ("empty", [])
        units.append((r["path"], r["place"], f.system_id, f.period, label, f.sha256, max(0, r["records"] - 1), kind, len(header)))
        if header:
            eras.setdefault((kind, tuple(targets)), []).append((r["path"], r["place"]))
    units += [(p, 0, f.system_id, f.period, f.name, f.sha256, 0, "empty", 0) for p, f in named.items() if p not in {r["path"] for r in found}]
    listed = spark.createDataFrame(units, "path string, place int, system_id string, source_period string, source_file string, source_sha256 string, source_records long, kind string, width int")
    body = rows.filter("row > 0").join(listed, ["path", "place"])
    beyond = F.exists(F.slice("cells", F.col("width") + 1, F.greatest(F.lit(0), F.size("cells") - F.col("width"))), lambda c: F.coalesce(c != "", F.lit(False)))
    landed = body.groupBy("path", "place").agg(F.count("*").alias("rows_landed"), F.count_if(beyond).alias("rows_too_long"))
    audit = listed.join(landed, ["path", "place"], "left").fillna(0, ["rows_landed", "rows_too_long"]).withColumn("lines_repaired", F.lit(0).cast("long"))
    tables: dict[str, list[DataFrame]] = {k: [] for k in KINDS}
    for (kind, targets), own in eras.items():
        era = body.join(spark.createDataFrame(own, "path string, place int"), ["path", "place"], "left_semi")
        value = {c: F.nullif(F.get("cells", F.lit(i)), F.lit("")) for i, c in enumerate(targets) if c}
        tables[kind].append(era.select(*PROVENANCE, *[value.get(c, F.lit(None).cast("string")).alias(c) for c in KINDS[kind]]))
    none = lambda kind: spark.createDataFrame([], ", ".join(f"{c} string" for c in (*PROVENANCE, *KINDS[kind])))
    return Landed({k: reduce(DataFrame.unionByName, parts) if parts else none(k) for k, parts in tables.items()}, audit.select([c.split()[0] for c in AUDIT.split(", ")]))
