"""Files with many different headers read by one scan, and what is wrong with a line."""

import pytest

from tillmark.schema import MANDATORY
from tillmark.sinks.quarantine import quarantine_rows, quarantined_rows
from tillmark.sources.any_header import (
    CELL_COUNT,
    FAULTS,
    file_layouts,
    parse_lines,
    raw_lines,
    stage_any_header,
    stage_files,
    with_faults,
)
from tillmark.sources.catalog import build_manifest, file_catalog, split_manifest
from tillmark.sources.sales_csv import STAGED_SCHEMA, malformed, stage_sales
from tillmark.storage import stored

HEADER = ",".join(MANDATORY)
BACKWARDS = ",".join(reversed(MANDATORY))

# Lines under HEADER, with what is wrong with them.
LINES = {
    "1,2,x,2024-01-02,3,1.005,4,5": [],
    ",,,,,,,": [],
    '1,2,"a,b",2024-01-02,3,"1,000.5",4,5': [],
    '1,2,"x""y",2024-01-02,+3,1e3,2,3': [],
    "1,2, x ,2024-01-02,3,1,2,3": [],
    '1,2,"",2024-01-02,3,1,2,3': [],
    "\u0001,2,x,2024-01-02,3,1,2,3": ["customer_id"],
    "1,2,x\u0001y,2024-01-02,3,1,2,3": [],
    " 1,2,x,2024-02-30,3,1,4,5": ["customer_id", "sales_date"],
    "1,2,x,2024-1-2,3,1,4.0,99999999999999999999": ["sales_date", "quantity", "total_cost"],
    "1,2,x,2024-01-02,3,1, 2,3": ["quantity"],
    HEADER: [c for c in MANDATORY if c != "product_name"],
    "1,2,3": [CELL_COUNT],
    "1,2,x,2024-01-02,3,1,2,3,4": [CELL_COUNT],
    "n/a,2,x": [CELL_COUNT],
    '1,2,"open,2024-01-02,3,1,2,3': [CELL_COUNT],
}


@pytest.fixture
def land(spark, tmp_path):
    def put(**files):
        folder = tmp_path / "landing"
        folder.mkdir()
        for name, text in files.items():
            (folder / f"{name}.csv").write_text(text)
        manifest = build_manifest(file_catalog(spark, str(folder)), str(folder))
        return split_manifest(stored(manifest, str(tmp_path / "manifest")))[0]
    return put


@pytest.fixture
def odd_files(land):
    return land(**{
        "plain": "\n".join([HEADER, *LINES]) + "\n", "blank lines+%41": f"\n \n{HEADER}\n\n{list(LINES)[0]}\n\n",
        "wide": f"e1,{BACKWARDS},e2,e.3\nq,1,2,3,4,2024-01-01,x,7,8,,r\n,1,2,3,4,2024-01-01,x,7,8,,\n"
                "q,1,2,3,4,nope,x,7,y,,r\nq,1,2,3,4,2024-01-01,x\n",
        "quoted": f'{HEADER},"a,b"\n{list(LINES)[0]},"k,l"\n', "no_rows": HEADER + "\n"})


def test_same_rows_as_one_scan_a_header(spark, odd_files, tmp_path, rows_of):
    want = stage_sales(spark, odd_files, str(tmp_path / "old"))
    for _ in range(2):  # a repeated run replaces what it wrote
        got = stage_any_header(spark, odd_files, str(tmp_path / "new"))
    assert got.columns == [*STAGED_SCHEMA.names, FAULTS]
    assert rows_of(got.drop(FAULTS)) == rows_of(want)
    assert got.where(f"(size({FAULTS}) > 0) != (malformed_line IS NOT NULL)").isEmpty()


def test_what_is_wrong_with_a_line(spark, odd_files, tmp_path, rows_of):
    bad = with_faults(malformed(stage_sales(spark, odd_files, str(tmp_path / "staged"))), odd_files)
    found = bad.where("source_file LIKE '%plain.csv'")
    assert rows_of(found, "malformed_line", FAULTS) == sorted(
        ((line, why) for line, why in LINES.items() if why), key=repr)
    assert rows_of(bad.where("source_file LIKE '%wide.csv'"), FAULTS) == [
        (["customer_id", "sales_date"],), (["number of cells"],)]
    quarantine_rows(bad, str(tmp_path / "q"), "7")
    quarantine_rows(bad.drop(FAULTS), str(tmp_path / "q"), "8")
    kept = quarantined_rows(spark, str(tmp_path / "q"))
    assert rows_of(kept.where("run_id = '7'"), "line", FAULTS) == rows_of(bad, "malformed_line", FAULTS)
    assert kept.where(f"run_id = '8' AND {FAULTS} IS NULL").count() == bad.count()


def test_five_thousand_headers_in_one_scan(spark, land, tmp_path):
    # Columns begin with another one from file to file, and each has a name of its own.
    def turned(cells, i):
        return ",".join(cells[i % 8:] + cells[:i % 8])

    cells = ["1", "2", "x", "2024-01-02", "3", "1", "2", "5"]
    accepted = land(**{f"f{i}": f"{turned(list(MANDATORY), i)},own{i}\n{turned(cells, i)},v{i}\n" for i in range(5000)})
    assert accepted.select("header").distinct().count() == 5000
    paths = [r["path"] for r in accepted.select("path").collect()]
    rows = parse_lines(raw_lines(spark, paths), file_layouts(accepted))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [line") == 1 and "Union" not in plan
    staged = stage_files(spark, accepted, str(tmp_path / "staged"))
    assert staged.columns == STAGED_SCHEMA.names
    assert staged.where("malformed_line IS NULL AND customer_id = 1 AND total_cost = 5").count() == 5000
    assert staged.select("additional_column").distinct().count() == 5000


def test_no_file(spark, land, tmp_path):
    accepted = land(a="wrong\n1\n")
    assert stage_any_header(spark, accepted, str(tmp_path / "a")).isEmpty()
    assert stage_files(spark, accepted, str(tmp_path / "b")).schema == STAGED_SCHEMA
    assert with_faults(malformed(stage_files(spark, accepted, str(tmp_path / "c"))), accepted).isEmpty()
