"""Landing files: catalogue, headers, verdicts, reading, quarantine."""

import gzip
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillmark.functions.columns import pack_extras_json
from tillmark.schema import CANONICAL, SALES_SCHEMA
from tillmark.sinks import quarantine
from tillmark.sinks.quarantine import (
    quarantine_files,
    quarantine_rows,
    quarantined_contents,
    quarantined_files,
    quarantined_lines,
    quarantined_rows,
)
from tillmark.sources.catalog import (
    NoInputFiles,
    build_manifest,
    discover_headers,
    file_catalog,
    parse_header,
    split_manifest,
)
from tillmark.sources.sales_csv import (
    STAGED_SCHEMA,
    empty_sales,
    malformed,
    read_sales_csv,
    stage_sales,
    well_formed,
)

HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"
LINE = "1,10,tea,2024-01-05,100,2.50,2,5.00"


@pytest.fixture
def land(tmp_path):
    def write(**files):
        for name, text in files.items():
            path = tmp_path / "in" / name.replace("__", "/")
            path = path.with_suffix(".csv") if "." not in path.name else path
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text)
        return str(tmp_path / "in")
    return write


def manifest_of(spark, landing, method="auto"):
    return build_manifest(file_catalog(spark, landing), landing, method)


def read(spark, landing):
    accepted, _ = split_manifest(manifest_of(spark, landing))
    return read_sales_csv(spark, accepted)


def test_catalog_lists_all_depths(spark, land):
    landing = land(a="x\n", **{"deep__er__b": "y\n", "odd name+%41": "z\n"})
    got = {(r["file_name"], r["length"]) for r in file_catalog(spark, landing).collect()}
    assert got == {("a.csv", 2), ("b.csv", 2), ("odd name+%41.csv", 2)}


@pytest.mark.parametrize("make", [True, False])
def test_nothing_to_process(spark, tmp_path, make):
    if make:
        (tmp_path / "in").mkdir()
    with pytest.raises(NoInputFiles):
        file_catalog(spark, str(tmp_path / "in"))


@pytest.mark.parametrize("line, names", [
    ("a,b", ["a", "b"]), ('"a,x",b', ["a,x", "b"]), ('"say ""hi""",b', ['say "hi"', "b"]),
    ("a,,b", ["a", "_c1", "b"]), ("p,q,P", ["p0", "q", "P2"]), (" a,b ", [" a", "b "]),
    ("", []), (None, []), ("  ", []),
])
def test_parse_header(line, names):
    assert parse_header(line) == names


def test_headers_are_named_as_spark_names_them(spark, land):
    text = 'a,"b,c",,d,D,"e ""x"""\n1,2,3,4,5,6\n'
    landing = land(a=text)
    spark_names = spark.read.option("header", True).option("escape", '"').csv(landing).columns
    assert parse_header(text.splitlines()[0]) == spark_names


@pytest.mark.parametrize("method", ["peek", "scan"])
def test_discover_headers(spark, land, method):
    landing = land(a="x,y\n1,2\n", b="\n \nq\n", empty="", blank="\n\n", win="x,y\r\n1,2\r\n",
                   bom="﻿x,y\n", no_newline="x,z", wide=",".join(f"c{i}" for i in range(20000)),
                   **{"odd name+%41": "odd\n"})
    files = file_catalog(spark, landing)
    got = {r["file_name"]: r["header"] for r in discover_headers(files, landing, method).collect()}
    assert len(got.pop("wide.csv")) == 20000
    assert got == {
        "a.csv": ["x", "y"], "b.csv": ["q"], "empty.csv": [], "blank.csv": [],
        "win.csv": ["x", "y"], "bom.csv": ["x", "y"], "no_newline.csv": ["x", "z"],
        "odd name+%41.csv": ["odd"]}


def test_manifest(spark, land):
    landing = land(
        good=HEADER, reordered=",".join(reversed(HEADER.split(","))),
        extra=HEADER + ",promo,payment_mode", lacking=HEADER.replace("store_id,", "") + ",promo",
        case=HEADER.replace("price", "Price"), empty="",
        **{"notes.txt": HEADER, "upper.CSV": HEADER})
    got = {r["file_name"]: (r["accepted"], r["missing"], r["extras"], r["reason"])
           for r in manifest_of(spark, landing).collect()}
    assert got == {
        "good.csv": (True, [], [], None),
        "reordered.csv": (True, [], [], None),
        "extra.csv": (True, [], ["promo", "payment_mode"], None),
        "lacking.csv": (False, ["store_id"], ["promo"], "missing columns: store_id"),
        "case.csv": (False, ["price"], ["Price"], "missing columns: price"),
        "empty.csv": (False, HEADER.split(","), [], f"missing columns: {HEADER}"),
        "notes.txt": (False, [], [], "not a .csv file"),
        "upper.CSV": (False, [], [], "not a .csv file"),
    }


def test_reordered_columns_land_under_their_names(spark, land, rows_of):
    names = list(reversed(HEADER.split(",")))
    cells = dict(zip(HEADER.split(","), LINE.split(",")))
    landing = land(a=f"{HEADER}\n{LINE}\n",
                   b=",".join(names) + "\n" + ",".join(cells[n] for n in names) + "\n")
    got = rows_of(well_formed(read(spark, landing)))
    assert len(got) == 2 and got[0] == got[1]
    assert got[0][0] == 1 and got[0][7] == D("5.00")


def test_extras_are_packed_in_header_order(spark, land, rows_of):
    landing = land(
        none=f"{HEADER}\n{LINE}\n", two=f"promo,{HEADER},payment_mode\np1,{LINE},\np2,{LINE},cash\n",
        blank=f"{HEADER},payment_mode\n{LINE},\n", dotted=f"{HEADER},a.b\n{LINE},v\n")
    got = read(spark, landing)
    assert got.columns[:9] == list(CANONICAL)
    assert rows_of(got, "additional_column") == [("",), ("p1",), ("p2,cash",), ("v",), (None,)]


def test_extras_as_json_keep_their_names(spark, land, rows_of):
    landing = land(a=f"{HEADER},promo,payment_mode\n{LINE},,cash\n")
    accepted, _ = split_manifest(manifest_of(spark, landing))
    got = read_sales_csv(spark, accepted, pack_extras_json)
    assert rows_of(got, "additional_column") == [('{"payment_mode":"cash"}',)]


def test_whole_number_and_noisy_amounts(spark, land, rows_of):
    landing = land(a=f"{HEADER}\n1,10,tea,2024-01-05,100,2,2,4\n"
                     "1,10,tea,2024-01-05,100,0.1,3,0.30000000000000004\n"
                     "1,10,tea,2024-01-05,100,1.005,1,1.005\n")
    assert rows_of(read(spark, landing), "price", "total_cost") == [
        (D("0.10"), D("0.30")), (D("1.01"), D("1.01")), (D("2.00"), D("4.00"))]


def test_malformed_rows_are_told_apart_and_kept(spark, land, tmp_path, rows_of):
    bad = ["1,10,tea,2024-01-05,100,2.50,abc,5.00", "1,10,tea,05/01/2024,100,2.50,2,5.00",
           "1,10,tea,2024-01-05,100,2.50,2", LINE + ",surplus"]
    nulls = ",,,,,,,"
    landing = land(**{"odd name+%41": "\n".join([HEADER, LINE, *bad, nulls]) + "\n"})
    accepted, _ = split_manifest(manifest_of(spark, landing))
    staged = stage_sales(spark, accepted, str(tmp_path / "staged"))
    assert well_formed(staged).count() == 2
    # Column pruning must not hide a fault in a column the query does not need.
    assert well_formed(staged).select("total_cost").count() == 2
    root = str(tmp_path / "q")
    quarantine_rows(malformed(staged), root, "7")
    assert rows_of(quarantined_rows(spark, root), "file_name", "line") == sorted(
        ("odd name+%41.csv", line) for line in bad)


def test_quarantine_keeps_files_apart(spark, land, tmp_path, rows_of):
    landing = land(x__a="wrong\n1\n2\n", y__a="wrong\n3\n", ok=f"{HEADER}\n{LINE}\n",
                   **{"notes.txt": "hello\n"})
    _, rejected = split_manifest(manifest_of(spark, landing))
    root = str(tmp_path / "q")
    for _ in range(2):  # a repeated run replaces what it wrote
        quarantine_files(rejected, root, "7")
    files = quarantined_files(spark, root)
    assert sorted(r["file_name"] for r in files.collect()) == ["a.csv", "a.csv", "notes.txt"]
    lines = quarantined_lines(spark, root).join(files, "file_id").selectExpr(
        "element_at(split(path, '/'), -2) folder", "value")
    assert rows_of(lines) == [("in", "hello"), ("x", "1"), ("x", "2"), ("x", "wrong"),
                              ("y", "3"), ("y", "wrong")]


def test_names_with_pattern_characters(spark, land, tmp_path, rows_of):
    landing = land(**{"a[1]": f"{HEADER}\n{LINE}\n", "a1": f"{HEADER}\n{LINE}\n",
                      "b{x,y}*?": f"{HEADER},promo\n{LINE},p\n", "q[2]": "wrong\n"})
    accepted, rejected = split_manifest(manifest_of(spark, landing))
    assert rows_of(read_sales_csv(spark, accepted), "additional_column") == [("p",), (None,), (None,)]
    quarantine_files(rejected, str(tmp_path / "q"), "7")
    assert rows_of(quarantined_lines(spark, str(tmp_path / "q")), "value") == [("wrong",)]


def test_many_headers_are_staged_in_several_jobs(spark, land, tmp_path, rows_of):
    landing = land(**{f"f{i}": f"{HEADER},x{i}\n{LINE},v{i}\n" for i in range(7)})
    accepted, _ = split_manifest(manifest_of(spark, landing))
    path = str(tmp_path / "staged")
    for _ in range(2):  # a repeated run replaces what it wrote
        got = stage_sales(spark, accepted, path, headers_per_job=3)
    assert rows_of(got, "additional_column") == [(f"v{i}",) for i in range(7)]


def test_one_scan_per_header(spark, land):
    files = {f"f{i}": f"{HEADER}\n{LINE}\n" for i in range(12)}
    files |= {f"g{i}": f"{HEADER},promo\n{LINE},p\n" for i in range(12)}
    df = read(spark, land(**files))
    plan = df._jdf.queryExecution().optimizedPlan()
    assert df.count() == 24
    assert plan.collectLeaves().size() == 2


def test_no_accepted_file_gives_an_empty_relation(spark, land):
    df = read(spark, land(a="wrong\n1\n"))
    assert df.schema == STAGED_SCHEMA and df.isEmpty()
    assert empty_sales(spark).schema == SALES_SCHEMA


# ---- odd files ---------------------------------------------------------------------------------


def odd_landing(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "good.csv").write_text(f"{HEADER}\n{LINE}\n")
    (folder / "_ok.csv").write_text(f"{HEADER}\n{LINE}\n")
    (folder / ".dot.csv").write_text(f"{HEADER}\n{LINE}\n")
    (folder / "_below").mkdir()
    (folder / "_below" / "deep.csv").write_text(f"{HEADER}\n{LINE}\n")
    (folder / "_SUCCESS").write_text("")
    (folder / ".good.csv.crc").write_text("crc")
    (folder / "tab.csv").write_text(f"\t\n{HEADER}\n{LINE}\n")
    (folder / "packed.csv.gz").write_bytes(gzip.compress(f"{HEADER}\n{LINE}\n".encode()))
    (folder / "damaged.gz").write_bytes(b"\x1f\x8bnot gzip at all\n\xff\x00")
    return str(folder)


@pytest.mark.parametrize("method", ["peek", "scan"])
def test_every_file_is_accounted_for(spark, tmp_path, method):
    manifest = manifest_of(spark, odd_landing(tmp_path), method).collect()
    hidden, extension = "name begins with _ or .", "not a .csv file"
    assert {r["file_name"]: r["reason"] for r in manifest} == {
        "good.csv": None, "tab.csv": None, "_ok.csv": hidden, ".dot.csv": hidden, "deep.csv": hidden,
        "packed.csv.gz": extension, "damaged.gz": extension}


def test_only_hidden_files_is_not_an_empty_landing(spark, tmp_path):
    (tmp_path / "_only.csv").write_text(HEADER)
    assert [r["file_name"] for r in file_catalog(spark, str(tmp_path)).collect()] == ["_only.csv"]


def test_unreadable_file_is_rejected_not_raised(spark, land):
    landing = land(a=f"{HEADER}\n{LINE}\n", b=f"{HEADER}\n{LINE}\n")
    files = file_catalog(spark, landing).withColumn(
        "path", F.expr("if(file_name = 'b.csv', concat(path, '.gone'), path)")).withColumn(
        "path", F.expr("if(file_name = 'b.csv', concat(path, '.csv'), path)"))
    got = {r["file_name"]: r["reason"] for r in build_manifest(files, landing, "peek").collect()}
    assert got == {"a.csv": None, "b.csv": "cannot be read: FileNotFoundError"}


def test_quarantine_keeps_bytes_as_they_are(spark, tmp_path):
    landing = odd_landing(tmp_path)
    _, rejected = split_manifest(manifest_of(spark, landing))
    root = str(tmp_path / "q")
    quarantine_files(rejected, root, "7")
    names = {r["file_id"]: r["path"].removeprefix("file:") for r in quarantined_files(spark, root).collect()}
    pieces = {}
    for r in quarantined_contents(spark, root).orderBy("piece").collect():
        assert r["error"] is None
        pieces[r["file_id"]] = pieces.get(r["file_id"], b"") + bytes(r["content"])
    assert len(pieces) == len(names) == 5
    for file_id, path in names.items():
        with open(path, "rb") as f:
            assert f.read() == pieces[file_id]


def test_copy_pieces_end_with_lines(tmp_path, monkeypatch):
    monkeypatch.setattr(quarantine, "PIECE_BYTES", 10)
    path = tmp_path / "f"
    content = b"".join(b"x" * n + b"\n" for n in (3, 9, 40, 0, 2)) + b"end"
    path.write_bytes(content)
    pieces = [p for _, p, _ in quarantine._pieces(str(path))]
    assert b"".join(pieces) == content and len(pieces) > 3
    assert list(quarantine._pieces(str(tmp_path / "none")))[0][2].startswith("FileNotFoundError")


def test_headers_of_many_files_are_found_by_many_tasks(spark):
    files = spark.range(2000).selectExpr("concat('file:/none/', id, '.csv') path")
    assert discover_headers(files, "file:/none", "peek").rdd.getNumPartitions() >= 16
