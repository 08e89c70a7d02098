"""Content sent again, late files, and windows that pass."""

import os
import time
from datetime import datetime, timedelta

import pytest

from millrace.names import FILE
from millrace.streaming.repeated_files import load_once


@pytest.fixture
def landing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    clock = [1_700_000_000]

    def put(name, *values):
        (folder / f"{name}.csv").write_text("k,v\n" + "".join(f"{v},x\n" for v in values))
        clock[0] += 10
        os.utime(folder / f"{name}.csv", (clock[0], clock[0]))

    def go(**options):
        options = {"window": timedelta(days=30), "run_ts": datetime(2025, 1, 20)} | options
        seen = load_once(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "log"), str(tmp_path / "state"), ["k", "v"], **options)
        log = {r[FILE]: (r.status, r.first_file) for r in spark.read.parquet(str(tmp_path / "log")).collect()}
        files = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select(FILE, "k").collect()]
        return seen, log, sorted(files)

    return put, go


def test_the_same_content_is_taken_once(landing):
    put, go = landing
    put("b_20250101_000000", 1, 2)
    put("a_20250102_000000", 1, 2)
    put("c_20250103_000000", 3)
    rows = [("b_20250101_000000", "1"), ("b_20250101_000000", "2"), ("c_20250103_000000", "3")]
    first = {"b_20250101_000000.csv": ("NEW", None), "a_20250102_000000.csv": ("REPEATED", "b_20250101_000000.csv"), "c_20250103_000000.csv": ("NEW", None)}
    assert go() == (3, first, rows)
    put("d_20250104_000000", 3)
    put("e_20250105_000000", 4)
    later = first | {"d_20250104_000000.csv": ("REPEATED", "c_20250103_000000.csv"), "e_20250105_000000.csv": ("NEW", None)}
    assert go(files_per_batch=1) == (2, later, [*rows, ("e_20250105_000000", "4")])
    assert go() == (0, later, [*rows, ("e_20250105_000000", "4")])


def test_a_late_file_does_not_hide_the_same_content_in_time(landing):
    put, go = landing
    put("a_20240101_000000", 1)
    put("nodate", 1)
    put("a_20250119_000000", 1)
    put("b_20250118_000000", 1)
    _, log, rows = go(days=10)
    assert log == {
        "a_20240101_000000.csv": ("LATE", None), "nodate.csv": ("LATE", None), "a_20250119_000000.csv": ("NEW", None),
        "b_20250118_000000.csv": ("REPEATED", "a_20250119_000000.csv"),
    }
    assert rows == [("a_20250119_000000", "1")]


def test_after_the_window_content_is_new_again(landing):
    put, go = landing
    put("a_20250101_000000", 1)
    go(window=timedelta(seconds=1))
    time.sleep(2)
    put("b_20250102_000000", 1)
    assert go(window=timedelta(seconds=1))[1]["b_20250102_000000.csv"] == ("NEW", None)
