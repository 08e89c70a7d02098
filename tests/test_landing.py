"""The landing plan: archives to raw tables."""

import os
import zipfile
from datetime import date, datetime, timedelta

from millrace.names import FILE
from millrace.plans.landing import land_archives
from millrace.sinks.tables import TableStore
from millrace.sources import files as src
from millrace.sources.archives import records_of

AT = datetime(2025, 1, 15, 10, 30)
TABLES = {"site": ["code", "label"], "acts": ["id"]}


def pack(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as bundle:
        for name, text in members.items():
            bundle.writestr(name, text)


def test_archives_land_once_by_header_with_errors_logged(spark, tmp_path, monkeypatch):
    folder, store = tmp_path / "in", TableStore(spark, str(tmp_path / "store"))
    folder.mkdir()
    pack(folder / "one.zip", {
        "site_20250115_000000.csv": 'label,code\r\n"two\r\nlines",1\r\n"a ""b"", c",2\r\n',
        "site_20250114_000000.csv": "code\n3\n", "acts_20250115_000000.csv": "id\n7\n8\n\n9\n",
        "other_20250115_000000.csv": "x\n1\n", "site_20200101_000000.csv": "code,label\n9,old\n",
    })
    good = (folder / "one.zip").read_bytes()
    (folder / "cut.zip").write_bytes(good[: len(good) // 2])
    original = TableStore.append

    def fails(self, name, *args, **kwargs):
        original(self, name, *args, **kwargs)
        if name == "acts_raw":
            raise OSError("gone")

    monkeypatch.setattr(TableStore, "append", fails)
    try:
        land_archives(spark, str(folder), TABLES, store, AT, expected_date=date(2025, 1, 15), tolerance_days=3)
    except OSError:
        pass
    monkeypatch.undo()
    assert not store.exists("site_raw")
    log = land_archives(spark, str(folder), TABLES, store, AT, expected_date=date(2025, 1, 15), tolerance_days=3)
    got = {r.member: (r.status, r.row_count) for r in log.collect()}
    assert got == {
        "site_20250115_000000.csv": ("SUCCESS", 2), "site_20250114_000000.csv": ("SUCCESS", 1), "acts_20250115_000000.csv": ("SUCCESS", 3),
        "other_20250115_000000.csv": ("FAILED", 0), "site_20200101_000000.csv": ("REJECTED", 0),
    }
    rows = {(r.code, r.label, r._corrupt_record) for r in store.read("site_raw").collect()}
    assert rows == {("1", "two\nlines", None), ("2", 'a "b", c', None), ("3", None, None)}
    errors = {(os.path.basename(r.filename), r.column_name) for r in store.read("quality_errors").collect()}
    assert ("cut.zip", "filename") in errors and ("site_20250114_000000", "label") in errors and ("site_20200101_000000", "filename") in errors
    pack(folder / "two.zip", {"acts_20250116_000000.csv": "id\n10\n"})
    for hours in (1, 2):
        land_archives(spark, str(folder), TABLES, store, AT + timedelta(hours=hours))
    assert store.read("acts_raw").count() == 4 and store.read("landing_log").count() == 6
    assert {r[FILE] for r in store.read("acts_raw").collect()} == {"acts_20250115_000000", "acts_20250116_000000"}


def test_records_follow_quotes_and_nothing_else():
    text = 'a,b\n1,"two\nlines"\n2,5" pipe\n3,"x ""y""\nz"\n4,last\n'.splitlines(keepends=True)
    assert [*records_of(text)] == ["a,b", '1,"two\nlines"', '2,5" pipe', '3,"x ""y""\nz"', "4,last"]


def test_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text('b,a\nB1,A1\n"B\n2",A2\nonly\n')
    (tmp_path / "y.csv").write_text("A \nA3\n")
    found = src.read_csv_by_name(spark, f"{tmp_path}/*.csv", ["a", "b"])
    rows = {(os.path.basename(r.path), r.a, r.b) for r in found.filter("_corrupt_record is null").collect()}
    assert rows == {("x.csv", "A1", "B1"), ("x.csv", "A2", "B\n2"), ("y.csv", "A3", None)}
    assert found.filter("_corrupt_record is not null").count() == 1
    missing = src.missing_by_file(src.file_headers(spark, f"{tmp_path}/*.csv"), ["a", "b"])
    assert [(os.path.basename(r.path), r.column_name) for r in missing.collect()] == [("y.csv", "b")]
