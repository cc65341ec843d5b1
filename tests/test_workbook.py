"""Workbooks as a source: streamed sheets, a partition for each, and filters that keep files closed."""

import datetime as dt
import io
import tracemalloc
import zipfile

import pytest

from tallybook.sources import workbook
from tallybook.sources.workbook import Book, read_grids, read_sheets, write_book


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("books")
    merged = [["Title", None, "x"], [None, None, None], ["a", 1, dt.date(2019, 1, 4)], [], ["b", True, 2.5], [None, "last", None]]
    (d / "sales_2019.xlsx").write_bytes(write_book([("One", merged, ["A1:B2", "A3:A5", "C6:C9"]), ("Two & three", [["t"]], []), ("Empty", [], [])]))
    (d / "sales_2020.xlsx").write_bytes(write_book([("One", [["n", 7]], [])]))
    (d / "notes.xlsx").write_bytes(b"no workbook at all")
    (d / "sales_2021.txt").write_bytes(b"not one either")
    return d


def plain(df):
    return sorted((r["book"], r["sheet_index"], r["sheet"], r["row_num"], [c and (c["kind"], c["s"]) for c in r["cells"]]) for r in df.collect())


def test_rows_merged_ranges_and_gaps(folder):
    rows = list(Book(io.BytesIO((folder / "sales_2019.xlsx").read_bytes())).rows(0))
    t = lambda s: ("t", s)
    assert rows == [
        [t("Title"), t("Title"), t("x")], [t("Title"), t("Title"), None], [t("a"), ("n", "1"), ("d", "2019-01-04 00:00:00")], [t("a"), None, None],
        [t("a"), ("b", "True"), ("n", "2.5")], [None, t("last"), None],
    ]


def test_both_readers_give_the_same_rows(spark, folder):
    rows = plain(read_grids(spark, str(folder)))
    assert plain(read_sheets(spark, str(folder))) == rows == plain(read_sheets(spark, f"file://{folder}"))
    assert [r[:4] for r in rows if r[0] == "notes.xlsx"] == [("notes.xlsx", 0, "*", 0)]
    assert [r[3] for r in rows if r[2] == "Empty"] == [0] and len([r for r in rows if r[2] == "One"]) == 9
    assert read_sheets(spark, str(folder)).rdd.getNumPartitions() == 5  # a sheet each


def test_filters_keep_other_files_closed(spark, folder, tmp_path):
    for f in folder.iterdir():
        (tmp_path / f.name).write_bytes(f.read_bytes())
    (tmp_path / "sales_2018.xlsx").write_bytes(b"broken: opening it fails")
    found = read_sheets(spark, str(tmp_path)).where("book = 'sales_2019.xlsx' AND sheet IN ('One', 'Empty') AND row_num > 0")
    assert found.rdd.getNumPartitions() == 2 and found.count() == 6
    assert read_sheets(spark, str(tmp_path)).where("book = 'none.xlsx'").count() == 0
    with pytest.raises(Exception, match="BadZipFile|zip file"):
        read_sheets(spark, str(tmp_path)).count()


def test_long_sheets_take_bounded_memory():
    def book(n):
        out = io.BytesIO(write_book([("Long", [], ["A1:B1"])]))
        with zipfile.ZipFile(out) as z:
            parts = {name: z.read(name) for name in z.namelist()}
        with zipfile.ZipFile(out := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
            for name, raw in parts.items():
                if not name.endswith("sheet1.xml"):
                    z.writestr(name, raw)
            with z.open("xl/worksheets/sheet1.xml", "w") as f:
                head, tail = parts["xl/worksheets/sheet1.xml"].split(b"</sheetData>")
                f.write(head)
                for r in range(1, n + 1):
                    f.write(b'<row r="%d"><c r="A%d"><v>%d</v></c><c r="C%d" t="inlineStr"><is><t>some text %d</t></is></c></row>' % (r, r, r, r, r))
                f.write(b"</sheetData>" + tail)
        return out

    peaks = []
    for n in (2_000, 40_000):
        file = book(n)
        tracemalloc.start()
        total = sum(b.num_rows for b in workbook._batches(Book(file), "sales_2019.xlsx", 0))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert total == n + 1
    assert peaks[1] < 1.5 * peaks[0] + 1_000_000


def test_rows_in_no_order(folder):
    raw = zipfile.ZipFile(io.BytesIO((folder / "sales_2020.xlsx").read_bytes()))
    with zipfile.ZipFile(out := io.BytesIO(), "w") as z:
        for name in raw.namelist():
            data = raw.read(name)
            if name.endswith("sheet1.xml"):
                data = data.replace(b"<sheetData>", b'<sheetData><row r="3"><c r="B3"><v>3</v></c></row><row r="2"><c><v>2</v></c></row>')
            z.writestr(name, data)
    assert list(Book(out).rows(0)) == [[("t", "n"), ("n", "7")], [("n", "2"), None], [None, ("n", "3")]]
