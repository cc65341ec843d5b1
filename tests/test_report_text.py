"""What of a report needs no load: the block of results in a text file, and the charts."""

from xml.etree import ElementTree as ET

from tallybook.plans import reports

NUMBERS = {
    "workbooks": 42, "sheets_read": 225, "sheets_skipped": 6, "rows_in": 21120, "rows_loaded": 18901, "rows_rejected": 325, "rows_skipped": 1364, "loaded_rows_missing": 0, "supplier_spellings": 192, "suppliers_found": 50,
    "last_run_inserted": 0, "last_run_updated": 0,
}
TRUTH = {
    "outcomes_checked": 21120, "outcomes_right": 21107, "suppliers_true": 30, "supplier_precision": 1.0, "supplier_recall": 0.7582, "false_merges": 0, "review_queue": 23, "review_right": 21, "dates_right": 5, "dates_checked": 5, "amounts_right": 0, "amounts_checked": 0,
}


def test_results_as_text():
    plain = reports.results_text(NUMBERS)
    assert "| Rows loaded / merged / rejected / skipped | 18,901 / 0 / 325 / 1,364 |" in plain and "truth" not in plain
    scored = reports.results_text(NUMBERS | TRUTH)
    assert "| Outcomes equal to the truth | 21,107 of 21,120 (99.94 %) |" in scored and "| Amounts right | 0 of 0 (0.00 %) |" in scored and scored.startswith(plain)


def test_block_in_a_text_file(tmp_path):
    path = tmp_path / "notes.md"
    begin, end = reports.BLOCK
    path.write_text(f"before\n{begin}\nold\n{end}\nafter\n")
    assert reports.update_text(str(path), NUMBERS) and not reports.update_text(str(path), NUMBERS)
    text = path.read_text()
    assert text == f"before\n{begin}\n{reports.results_text(NUMBERS)}\n{end}\nafter\n"
    for left_alone in ("no marks", f"{begin} only", f"{end} before {begin}"):
        path.write_text(left_alone)
        assert not reports.update_text(str(path), NUMBERS) and path.read_text() == left_alone


def test_charts_are_drawn():
    chart = ET.fromstring(reports.sweep_chart([(70, 0.9, 0.8), (80, 1.0, 0.7), (100, 1.0, 0.5)], 80))
    lines = [e for e in chart.iter() if e.tag.endswith("polyline")]
    assert len(lines) == 2 and all(len(e.get("points").split()) == 3 for e in lines)
    first, last = (float(lines[1].get("points").split()[i].split(",")[1]) for i in (0, 2))
    assert first < last  # recall falls, so its line goes down
    assert ET.fromstring(reports.sweep_chart([(88, 1.0, 1.0)], 88)) is not None
    bars = ET.fromstring(reports.bar_chart([("a < b", 3), ("none", 0)]))
    assert [float(e.get("width")) for e in bars.iter() if e.tag.endswith("rect")][1] == 0
