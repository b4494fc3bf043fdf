"""Extract files -> grid -> header detection, junk removal, resolution."""

import csv
import io
import re
import struct
import zipfile

import pytest

from snapweave.contracts import OPEN_PO
from snapweave.operators.header import detect_headers
from snapweave.operators.resolve import extract
from snapweave.plans.snapshot import transform
from snapweave.sources.grid import read_extracts, read_text_grid, read_xlsx_grid
from snapweave.sources.seeds import load_rates
from snapweave.sources.xlsx import decode_workbook
from weekfixtures.files import write_workbook

HEAD = ["PO Number", "PO Item", "Material", "Material Description", "Supplier", "Order Quantity",
        "Net Price", "Currency", "Delivery Date", "Plant", "Requisitioner"]
ALIAS = ["PO No", "Item", "Material Number", "Description", "Vendor", "Qty", "Price", "Curr",
         "Deliv. Date", "Plant", "Requester"]
ROWS = [
    ["4500000001", "10", "123", "Spare part 1", "ACME", "1 234,50", "10,00", "EUR", "2026-07-14", "P100", "Ann"],
    ["4500000001", "20", "124", "Spare part 2", "ACME", "5", "2.5", "USD", "2026-07-15", "P100", "Ann"],
    ["4500000001", "10", "123", "Spare part 1", "ACME", "7", "10,00", "EUR", "2026-07-14", "P100", "Ann"],
    ["4500000002", "", "125", "Spare part 3", "Bolt Co", "3", "1", "GBP", "2026-07-16", "P200", "Bo"],
    ["Total", "", "", "", "", "", "", "", "", "", ""],
    ["*** End of report ***"],
]


def write_csv(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n").writerows(rows)
    path.write_text(buf.getvalue())


@pytest.fixture
def landed(tmp_path):
    root = tmp_path / "raw"
    write_csv(root / "dataset=open_po/year=2026/week=29/open_po_W29.csv",
              [["Report Date: 2026-07-13"], HEAD, *ROWS])
    write_csv(root / "dataset=open_po/year=2026/week=30/open_po_W30.csv", [ALIAS, *ROWS[:2]])
    return root


def test_header_row_found_after_title_and_at_top(spark, landed):
    grid = read_text_grid(spark, str(landed))
    heads = {r.file.rsplit("/", 1)[-1]: r.header_idx for r in detect_headers(grid, OPEN_PO.header_texts).collect()}
    assert heads == {"open_po_W29.csv": 1, "open_po_W30.csv": 0}


def test_extract_resolves_aliases_and_drops_junk(spark, landed):
    ext = extract(read_text_grid(spark, str(landed)), OPEN_PO)
    rows = ext.collect()
    assert len(rows) == 6  # 4 + 2 data rows, junk and title gone
    assert not any(r.po_number in ("Total", "*** End of report ***") for r in rows)
    w30 = [r for r in rows if r.report_week == 30]
    assert {r.supplier for r in w30} == {"ACME"} and {r.order_quantity for r in w30} == {"1 234,50", "5"}
    assert {r.report_year for r in rows} == {2026}


def test_snapshot_from_files(spark, landed):
    snap = transform(extract(read_text_grid(spark, str(landed)), OPEN_PO), OPEN_PO, load_rates(spark))
    rows = {(r.report_week, r.key): r for r in snap.collect()}
    # the repeated key keeps the later row; the row without an item is dropped
    assert set(rows) == {(29, "4500000001|10"), (29, "4500000001|20"), (30, "4500000001|10"), (30, "4500000001|20")}
    r = rows[(29, "4500000001|10")]
    assert r.order_quantity == 7.0 and r.net_price == 10.0 and r.material == "00000123"
    assert r.report_date == "2026-07-13" and r.rate_to_eur == 1.0 and abs(r.line_value_eur - 70.0) < 1e-9
    assert rows[(30, "4500000001|10")].order_quantity == 1234.5
    assert rows[(29, "4500000001|20")].line_value_eur == pytest.approx(5 * 2.5 * 0.92)


def test_missing_required_column_fails_with_message(spark, tmp_path):
    write_csv(tmp_path / "dataset=open_po/year=2026/week=29/bad.csv", [["PO Number", "PO Item"], ["1", "10"], ["2", "20"]])
    with pytest.raises(Exception) as err:
        extract(read_text_grid(spark, str(tmp_path)), OPEN_PO).collect()
    msg = str(err.value)
    assert "no header for material" in msg and "bad.csv" in msg


def test_absent_optional_is_null_and_listed(spark, tmp_path):
    cols = ["PO Number", "PO Item", "Material", "Supplier", "Order Quantity", "Net Price"]
    write_csv(tmp_path / "dataset=open_po/year=2026/week=29/short.csv", [cols, ["1", "10", "5", "S", "1", "2"]])
    row = extract(read_text_grid(spark, str(tmp_path)), OPEN_PO).first()
    assert row.currency is None and "currency" in row._absent and row.po_number == "1"


def test_quoted_line_breaks_quotes_and_wide_rows(spark, tmp_path):
    d = tmp_path / "dataset=open_po/year=2026/week=29"
    d.mkdir(parents=True)
    wide = [f"c{i}" for i in range(1500)]
    write_csv(d / "a.csv", [HEAD, ["1", "10", "5", 'line one\nline "two", more', "S", "1", "2"], [], wide])
    grid = {r.row_idx: r.cells for r in read_text_grid(spark, str(tmp_path)).collect()}
    assert grid[1][3] == 'line one\nline "two", more' and grid[3] == wide and set(grid) == {0, 1, 3}
    (tmp_path / "dataset=open_po/year=2026/week=30").mkdir()
    (tmp_path / "dataset=open_po/year=2026/week=30/empty.csv").write_text("")
    assert read_text_grid(spark, str(tmp_path)).filter("report_week = 30").count() <= 1


def test_a_replay_opens_only_its_weeks(spark, landed):
    grid = read_text_grid(spark, str(landed), weeks=[30], year=2026)
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "30" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.report_week for r in grid.collect()} == {30}


def test_xlsx_grid(spark, tmp_path):
    rows = [["Report Date: 2026-07-13"], HEAD, [4500000001, 10, 123, "Spare part", "ACME", 2, 1234.5, "EUR",
                                                "2026-07-14", "P100", "Ann"], ["Total"]]
    d = tmp_path / "dataset=open_po/year=2026/week=29"
    d.mkdir(parents=True)
    (d / "open_po_W29.xlsx").write_bytes(write_workbook(rows))
    assert decode_workbook(write_workbook(rows))[2][:3] == ["4500000001", "10", "123"]
    grid = read_xlsx_grid(spark, str(tmp_path))
    assert grid.count() == 4
    ext = extract(grid, OPEN_PO).collect()
    assert len(ext) == 1 and ext[0].net_price == "1234.5" and ext[0].report_week == 29


def repacked(book, change=lambda name, data: data):
    buf = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book)) as old, zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            new.writestr(name, change(name, old.read(name)))
    return buf.getvalue()


def test_rows_and_cells_without_numbers_and_broken_workbooks(spark, tmp_path):
    rows = [["a", "b"], ["1", "2"], ["3", "4"]]
    book = write_workbook(rows)
    bare = repacked(book, lambda name, data: re.sub(rb' r="[A-Z]*[0-9]+"', b"", data) if "sheet1" in name else data)
    some = repacked(book, lambda name, data: data.replace(b'<row r="2">', b'<row r="5">').replace(b'<row r="3">', b"<row>")
                    if "sheet1" in name else data)
    assert decode_workbook(bare) == rows
    assert decode_workbook(some) == [rows[0], *[[None, None]] * 3, *rows[1:]]
    deflated = repacked(book)
    with zipfile.ZipFile(io.BytesIO(deflated)) as z:
        info = z.getinfo("xl/worksheets/sheet1.xml")
    at = info.header_offset + 30 + len(info.filename)
    entry = deflated.index(b"PK\x01\x02")  # the list of members
    member = deflated.rindex(b"PK\x01\x02")
    patched = lambda place, value: deflated[:place] + struct.pack("<H", value) + deflated[place + 2:]
    files = {"good": book, "bare": bare, "cut": deflated[:len(deflated) // 2], "words": b"no workbook",
             "stream": deflated[:at] + b"\xff" * 8 + deflated[at + 8:],  # damaged deflate stream
             "locked": patched(member + 8, 1), "method": patched(entry + 10, 99)}
    d = tmp_path / "dataset=open_po/year=2026/week=29"
    d.mkdir(parents=True)
    for name, data in files.items():
        (d / f"{name}.xlsx").write_bytes(data)
    got = read_extracts(spark, str(tmp_path)).collect()
    said = {r.file.rsplit("/", 1)[-1][:-5]: r.error for r in got if r.error}
    assert set(said) == {"cut", "words", "stream", "locked", "method"}
    assert [said[k].split(":")[0] for k in ("stream", "locked", "method")] == ["error", "RuntimeError", "NotImplementedError"]
    assert sum(r.error is None for r in got) == 6


def styled(book, codes, date1904=False):
    """A workbook whose cells with style 1, 2, ... have the given number formats."""
    styles = ('<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts>'
              + "".join(f'<numFmt numFmtId="{164 + i}" formatCode="{c}"/>' for i, c in enumerate(codes) if isinstance(c, str))
              + '</numFmts><cellXfs><xf numFmtId="0"/>'
              + "".join(f'<xf numFmtId="{164 + i if isinstance(c, str) else c}"/>' for i, c in enumerate(codes)) + "</cellXfs></styleSheet>")
    buf = io.BytesIO(repacked(book, lambda n, d: d.replace(b"<sheets>", b'<workbookPr date1904="1"/><sheets>')
                              if date1904 and n == "xl/workbook.xml" else d))
    with zipfile.ZipFile(buf, "a") as z:
        z.writestr("xl/styles.xml", styles)
    return buf.getvalue()


def test_dates_in_workbooks():
    from snapweave.sources.xlsx import shows_date

    codes = [14, "yyyy\\-mm\\-dd hh:mm", "0.00", "[Red]0.0&quot;days&quot;", "[h]:mm", 22, 1]
    cells = "".join(f'<c r="{chr(65 + i)}1" s="{i + 1}"><v>{v}</v></c>' for i, v in enumerate(
        (46216, 46216.354166666664, 46216.5, 3.5, 0.25, 46216, 46216)))
    book = styled(repacked(write_workbook([["x"]]), lambda n, d: re.sub(rb"<row.*</row>", f'<row r="1">{cells}<c r="H1" t="d">'
                  '<v>2026-07-13T00:00:00</v></c></row>'.encode(), d) if "sheet1" in n else d), codes)
    assert decode_workbook(book) == [["2026-07-13", "2026-07-13 08:30:00", "46216.5", "3.5", "06:00:00", "2026-07-13", "46216",
                                      "2026-07-13"]]
    old = repacked(write_workbook([[60, 59, 1, 44754, -1, 3000000]]),
                   lambda n, d: re.sub(rb'(<c r="[A-F]1")', rb'\1 s="1"', d) if "sheet1" in n else d)
    # day 60 is the 29 February 1900 that never was
    assert decode_workbook(styled(old, [14])) == [["1900-03-01", "1900-02-28", "1900-01-01", "2022-07-12", "-1", "3000000"]]
    assert decode_workbook(styled(old, [14], True))[0][3] == "2026-07-13"
    assert [shows_date(c) for c in ("General", "0.00E+00", '#,##0 "days"', "d/m/yy", "[$-409]mmm", "[Blue]0", "@", "[ss]")] == [
        False, False, False, True, True, False, False, True]


def test_a_stray_cell_far_out_costs_one_row(spark, tmp_path):
    import tracemalloc

    rows = [HEAD, ["4500000001", "10", "1", "x", "S", "1", "2", "EUR", "", "P100", "Z"]]
    far = repacked(write_workbook(rows), lambda n, d: d.replace(
        b"</sheetData>", b'<row r="1048576"><c r="XFD1048576"><v>1</v></c></row></sheetData>') if "sheet1" in n else d)
    d = tmp_path / "dataset=open_po/year=2026/week=29"
    d.mkdir(parents=True)
    (d / "far.xlsx").write_bytes(far)
    from snapweave.sources.xlsx import sheet_rows
    tracemalloc.start()
    assert [(r, len(c)) for r, c in sheet_rows(far)] == [(0, 11), (1, 11), (1048575, 16384)]
    assert tracemalloc.get_traced_memory()[1] < 20_000_000
    tracemalloc.stop()
    got = extract(read_extracts(spark, str(tmp_path), contract=OPEN_PO), OPEN_PO).collect()
    assert [(r.po_number, r.net_price) for r in got] == [("4500000001", "2")]


def test_the_parser_and_the_window_find_the_same_headers(spark, landed, tmp_path):
    write_csv(landed / "dataset=open_po/year=2026/week=31/repeat.csv", [["x"], [*HEAD, " Price ", "Net Price"], [*ROWS[0], "1", "2"]])
    write_csv(landed / "dataset=open_po/year=2026/week=32/late.csv", [*[["-", "-"]] * 14, HEAD, *ROWS])
    write_csv(landed / "dataset=open_po/year=2026/week=33/tie.csv", [["Plant", "Item"], ["Item", "Price"], *[["-", "-"]] * 14, HEAD, *ROWS])
    one = extract(read_extracts(spark, str(landed), contract=OPEN_PO), OPEN_PO, strict=False)
    two = extract(read_extracts(spark, str(landed)), OPEN_PO, strict=False)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())) and one.count() > 10
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and plan.count("Scan") == 1
    assert "Join" not in two._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="no header for"):
        extract(read_extracts(spark, str(landed), contract=OPEN_PO), OPEN_PO).collect()


PARSE_TWO_FILES = """
import pyarrow as pa
from snapweave.sources import grid

lines = "\\n".join(f"{i},x" for i in range(5000)).encode()
batch = pa.RecordBatch.from_arrays(
    [pa.array(["d", "d"]), pa.array([2026, 2026]), pa.array([1, 2]), pa.array(["a.csv", "b.csv"]),
     pa.array([None, None], pa.timestamp("us")), pa.array([lines, b"1,y"])], [*grid.FILE_COLS, "arrived", "content"])
places = []
for out in grid._file_parser(",", None, 15, grid.PARSED_SCHEMA.fieldNames())(iter([batch])):
    places += zip(out.column("file").to_pylist(), out.column("report_week").to_pylist(), out.column("row_idx").to_pylist())
assert places == [("a.csv", 1, i) for i in range(5000)] + [("b.csv", 2, 0)]
print(pa.default_memory_pool().max_memory() // len(lines))
"""


def test_a_files_bytes_are_not_repeated_with_its_rows():
    import subprocess
    import sys
    from pathlib import Path

    # in a process of its own: the peak is that of the whole process
    said = subprocess.run([sys.executable, "-c", PARSE_TWO_FILES], cwd=Path(__file__).parent.parent, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout) < 200  # 5,000 copies before, one a row


def test_bronze_is_read_by_the_session_it_is_meant_for(spark, tmp_path):
    from snapweave.sources.grid import read_extracts, write_bronze

    write_csv(tmp_path / "raw/dataset=open_po/year=2026/week=29/po.csv", [HEAD, *ROWS])
    other = spark.newSession()  # as a stream's batches have it
    other.conf.set("spark.sql.adaptive.enabled", "false")
    grid = read_extracts(other, str(tmp_path / "raw"))
    bronze = write_bronze(grid, str(tmp_path / "bronze"), spark=spark)
    assert bronze.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true" and bronze.count() == grid.count()


def test_missing_texts_are_null_in_cells_as_parsed(spark, tmp_path):
    from snapweave.sources.grid import read_text_grid

    write_csv(tmp_path / "dataset=open_po/year=2026/week=29/po.csv", [["a", "", "NA"], ["nan"], ["b", "null", "x ", "NAN"]])
    grid = read_text_grid(spark, str(tmp_path))
    cells = [r["cells"] for r in grid.orderBy("row_idx").collect()]
    assert cells == [["a", None, None], [None], ["b", None, "x ", "NAN"]]
    p = grid._jdf.queryExecution().executedPlan().toString()
    assert "transform(" not in p  # found by the parser, not cell by cell above it


def test_workbooks_are_deflated():
    import io
    import zipfile

    from snapweave.sources.xlsx import decode_workbook
    from weekfixtures.files import write_workbook

    rows = [["PO Number", "Item"]] + [[f"45{i:07d}", str(i % 9 * 10)] for i in range(500)]
    data = write_workbook(rows)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert all(i.compress_type == zipfile.ZIP_DEFLATED for i in z.infolist())
        assert len(data) < sum(i.file_size for i in z.infolist()) / 5
    assert decode_workbook(data) == rows
