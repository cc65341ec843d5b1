"""Workbooks (.xlsx) as a DataFrame of grid rows, and a writer for fixtures.

``read_grids`` gets files through Spark's binaryFile reader, so any store that Spark reads will do, and a file is unpacked in the task that
reads it. ``read_sheets`` is a data source of its own with a task for each sheet and filters on book and sheet. Both stream a sheet's
rows with the standard library, whatever its length: shared and inline strings, cached values of formulas, number formats that mean
dates, both epochs, and merged ranges (the corner's value fills the range). Rows are padded to the sheet's width.
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property
from typing import IO
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

CELL = "struct<kind:string,s:string>"
_CELLS = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.string())]))
SCHEMA = f"book string, sheet_index int, sheet string, row_num int, cells array<{CELL}>"
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_KNOWN = re.compile(r"(?i)item_master|(purchases|sales|inventory|payroll)_")
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def column_number(ref: str) -> int:
    """``C7`` -> 2."""
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _is_date_format(code: str) -> bool:
    bare = re.sub(r'"[^"]*"|\\.|\[(?![hms]+\])[^\]]*\]', "", code.lower())
    return bool(re.search(r"[dmyhs]", bare)) and "general" not in bare


def number_text(x: float) -> str:
    """Plain digits, also for very small and very large numbers; what isn't finite stays a word."""
    return format(Decimal(repr(x)), "f") if x - x == 0 and x != int(x) else str(int(x)) if x - x == 0 else repr(x)


def _parts(stream: IO[bytes], *tags: str) -> Iterator[ET.Element]:
    """The elements of these tags as they end; what has been read is dropped, so memory holds one of them at a time."""
    inside: list[ET.Element] = []
    for event, e in ET.iterparse(stream, ("start", "end")):
        if event == "start":
            inside.append(e)
            continue
        inside.pop()
        if e.tag in tags:
            yield e
            e.clear()
            if inside:
                inside[-1].clear()


def _corners(ref: str) -> tuple[int, int, int, int]:
    """``B2:C4`` -> 1, 1, 3, 2: first row and column, last row and column."""
    a, b = (ref.split(":") * 2)[:2]
    row = lambda x: int(re.search(r"\d+", x)[0]) - 1
    return row(a), column_number(a), row(b), column_number(b)


Cell = tuple[str, str] | None


class Book:
    """An open workbook: its sheets' names, and each sheet's rows as a stream.

    Memory holds the shared strings, a sheet's merged ranges and one row; a sheet is read twice, first for its size and merged ranges (which stand
    behind the rows), then for the rows. A cell is (kind, text): t text, n number, d date and time, b truth value, e error.
    """

    def __init__(self, file: IO[bytes]):
        self.zip = zipfile.ZipFile(file)
        xml = lambda name: ET.fromstring(self.zip.read(name))
        book = xml("xl/workbook.xml")
        flags = book.find(f"{_MAIN}workbookPr")
        self.epoch = dt.datetime(1904, 1, 1) if flags is not None and flags.get("date1904") in ("1", "true") else dt.datetime(1899, 12, 30)
        targets = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}
        path = lambda t: t.lstrip("/") if t.startswith("/") else f"xl/{t}"
        self.sheets = [(s.get("name"), path(targets[s.get(_REL)])) for s in book.iter(f"{_MAIN}sheet")]

    @cached_property
    def shared(self) -> list[str]:
        if "xl/sharedStrings.xml" not in self.zip.namelist():
            return []
        with self.zip.open("xl/sharedStrings.xml") as f:
            return ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in _parts(f, f"{_MAIN}si")]

    @cached_property
    def dated(self) -> list[bool]:
        """For each style whether it shows numbers as dates."""
        if "xl/styles.xml" not in self.zip.namelist():
            return []
        styles = ET.fromstring(self.zip.read("xl/styles.xml"))
        own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{_MAIN}numFmt")}
        xfs = styles.find(f"{_MAIN}cellXfs")
        formats = [int(xf.get("numFmtId", 0)) for xf in (xfs if xfs is not None else ())]
        return [f in _DATE_FORMATS or _is_date_format(own.get(f, "")) for f in formats]

    def _value(self, cell: ET.Element) -> Cell:
        v, kind = cell.find(f"{_MAIN}v"), cell.get("t", "n")
        if kind == "inlineStr":
            return "t", "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
        if v is None or v.text is None:
            return None
        if kind == "s":
            return "t", self.shared[int(v.text)]
        if kind in ("str", "e"):
            return "t", v.text
        if kind == "b":
            return "b", "True" if v.text == "1" else "False"
        if kind == "d":
            return "d", v.text.replace("T", " ")
        style, number = int(cell.get("s", 0)), float(v.text)
        return ("d", str(self.epoch + dt.timedelta(days=number))) if style < len(self.dated) and self.dated[style] else ("n", number_text(number))

    def _stream(self, path: str) -> Iterator[tuple[int, list[ET.Element]] | str]:
        """(row, its cell elements) of every row, and the reference of every merged range."""
        with self.zip.open(path) as f:
            n = 0
            for e in _parts(f, f"{_MAIN}row", f"{_MAIN}mergeCell"):
                if e.tag == f"{_MAIN}mergeCell":
                    yield e.get("ref")
                else:
                    n += 1
                    yield int(e.get("r", n)) - 1, list(e.iter(f"{_MAIN}c"))

    def _cells(self, elements: list[ET.Element]) -> dict[int, tuple[str, str]]:
        values = ((column_number(e.get("r")) if e.get("r") else c, self._value(e)) for c, e in enumerate(elements))
        return {c: v for c, v in values if v is not None}

    def rows(self, index: int) -> Iterator[list[Cell]]:
        """The rows of a sheet from the first to the last that has a value, each as wide as the sheet, merged ranges filled with their corner's value."""
        path = self.sheets[index][1]
        height = width = 0
        last, ordered, merged = -1, True, []
        for part in self._stream(path):
            if isinstance(part, str):
                merged.append(_corners(part))
                continue
            at, elements = part
            ordered, last = ordered and at > last, at
            there = [column_number(e.get("r")) if e.get("r") else c for c, e in enumerate(elements) if e.get("t") == "inlineStr" or e.findtext(f"{_MAIN}v")]
            if there:
                height, width = max(height, at + 1), max(width, max(there) + 1)
        stream = ((part[0], self._cells(part[1])) for part in self._stream(path) if not isinstance(part, str))
        if not ordered:  # rows that stand in no order are put into one first
            whole: dict[int, dict[int, tuple[str, str]]] = {}
            for at, cells in stream:
                whole.setdefault(at, {}).update(cells)
            stream = iter(sorted(whole.items()))
        merged = sorted(enumerate(merged), key=lambda m: (m[1][0], m[0]))
        open_: list[tuple[int, tuple[int, int, int, int], Cell]] = []
        ahead = next(stream, None)
        for r in range(height):
            cells: dict[int, tuple[str, str]] = {}
            if ahead and ahead[0] == r:
                cells, ahead = ahead[1], next(stream, None)
            row: list[Cell] = [cells.get(c) for c in range(width)]
            open_ = [m for m in open_ if m[1][2] >= r]
            while merged and merged[0][1][0] <= r:
                n, range_ = merged.pop(0)
                open_.append((n, range_, row[range_[1]] if range_[1] < width else None))
            for _, (_, c1, _, c2), value in sorted(open_, key=lambda m: m[0]):
                for c in range(c1, min(c2, width - 1) + 1):
                    row[c] = value
            yield row


def _batches(book: Book, name: str, index: int) -> Iterator[pa.RecordBatch]:
    """A sheet's grid rows, some hundreds at a time; row 0 has no cells and stands for the sheet itself."""
    numbered = enumerate(itertools.chain([[]], book.rows(index)))
    sheet = book.sheets[index][0]
    while some := list(itertools.islice(numbered, 512)):
        cells = pa.array([[None if c is None else {"kind": c[0], "s": c[1]} for c in row] for _, row in some], _CELLS)
        n = len(some)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * n, pa.string()), pa.array([index] * n, pa.int32()), pa.array([sheet] * n, pa.string()), pa.array([i for i, _ in some], pa.int32()), cells],
            names=["book", "sheet_index", "sheet", "row_num", "cells"],
        )


def book_batches(path: str, raw: bytes) -> Iterator[pa.RecordBatch]:
    """Grid rows of all sheets. A file whose name stands for no domain isn't opened: it is one sheet ``*`` without rows."""
    name = path.rsplit("/", 1)[-1]
    if not _KNOWN.match(name):
        yield _stray(name)
        return
    book = Book(io.BytesIO(raw))
    for index in range(len(book.sheets)):
        yield from _batches(book, name, index)


def _stray(name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([0], pa.int32()), pa.array(["*"]), pa.array([0], pa.int32()), pa.array([[]], _CELLS)], names=["book", "sheet_index", "sheet", "row_num", "cells"])


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files (path, content) to grid rows."""
    for files in batches:
        for path, raw in zip(files["path"], files["content"], strict=True):
            yield from book_batches(path.as_py(), raw.as_py())


def read_grids(spark: SparkSession, books_dir: str) -> DataFrame:
    """book, sheet_index, sheet, row_num, cells of all ``*.xlsx`` in a folder of any store that Spark reads; a file is a task's."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(books_dir)
    return files.select("path", "content").mapInArrow(unpack, SCHEMA)


@dataclass
class SheetPart(InputPartition):
    """A sheet of a file; index -1 is a file that isn't opened."""

    path: str
    index: int


class WorkbookSource(DataSource):
    """``spark.read.format("workbook").load(folder)``: the same rows, with a partition for each sheet.

    Filters on ``book`` and ``sheet`` are applied before anything is opened: files of other names stay closed, and sheets of other names aren't
    read. The folder must be one that pyarrow opens (local, or by its URI); ``read_grids`` reads any other.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options["path"])


class WorkbookReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder
        self.only: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute in (("book",), ("sheet",)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                column = f.attribute[0]
                self.only[column] = self.only[column] & values if column in self.only else values
            else:
                yield f  # Spark's to apply

    def _files(self) -> tuple[fs.FileSystem, list[str]]:
        store, folder = fs.FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith("file:") else (fs.LocalFileSystem(), self.folder)
        names = [f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.is_file and f.base_name.endswith(".xlsx")]
        return store, sorted(p for p in names if self._takes("book", p.rsplit("/", 1)[-1]))

    def _takes(self, column: str, value: str) -> bool:
        return column not in self.only or value in self.only[column]

    def partitions(self) -> list[SheetPart]:
        """Of each file only the directory and the list of sheets are read here."""
        store, paths = self._files()
        out = []
        for path in paths:
            if not _KNOWN.match(path.rsplit("/", 1)[-1]):
                out += [SheetPart(path, -1)] if self._takes("sheet", "*") else []
                continue
            with store.open_input_file(path) as f:
                out += [SheetPart(path, i) for i, (sheet, _) in enumerate(Book(f).sheets) if self._takes("sheet", sheet)]
        return out or [SheetPart("", -2)]

    def read(self, part: SheetPart) -> Iterator[pa.RecordBatch]:
        name = part.path.rsplit("/", 1)[-1]
        if part.index == -1:
            yield _stray(name)
        elif part.index >= 0:
            store = fs.FileSystem.from_uri(self.folder)[0] if "://" in self.folder or self.folder.startswith("file:") else fs.LocalFileSystem()
            with store.open_input_file(part.path) as f:
                yield from _batches(Book(f), name, part.index)


def read_sheets(spark: SparkSession, books_dir: str) -> DataFrame:
    """The rows of ``read_grids`` by the data source: a task for each sheet, and filters on book and sheet keep other files closed."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WorkbookSource)
    return spark.read.format("workbook").load(books_dir)


def write_book(sheets: list[tuple[str, list[list], list[str]]]) -> bytes:
    """An .xlsx file of (name, rows, merged ranges) with text, numbers, truth values and dates."""
    out = io.BytesIO()
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    letters = lambda c: (letters(c // 26 - 1) if c >= 26 else "") + chr(65 + c % 26)

    def cell(r: int, c: int, v) -> str:
        ref = f"{letters(c)}{r}"
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, int | float):
            return f'<c r="{ref}"><v>{v!r}</v></c>'
        if isinstance(v, dt.date):
            v = v if isinstance(v, dt.datetime) else dt.datetime(v.year, v.month, v.day)
            return f'<c r="{ref}" s="1"><v>{(v - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)!r}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr(
            "[Content_Types].xml",
            '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{types}</Types>',
        )
        z.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="s{i}"/>' for i, (n, _, _) in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="s{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}<Relationship Id="y" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for i, (_, rows, merged) in enumerate(sheets, 1):
            body = "".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(row))}</row>' for r, row in enumerate(rows, 1))
            joined = f'<mergeCells count="{len(merged)}">{"".join(f"<mergeCell ref={chr(34)}{m}{chr(34)}/>" for m in merged)}</mergeCells>' if merged else ""
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}><sheetData>{body}</sheetData>{joined}</worksheet>")
    return out.getvalue()
