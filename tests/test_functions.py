from datetime import date, datetime

from pyspark.sql import functions as F

from millrace.functions import dates, filenames, messages, tolerances
from millrace.functions.casts import cast_text
from millrace.operators.arrivals import judge_file_dates, judge_registered_names



def test_arrival_names(one):
    rows = [
        ("site_20251115_173355.csv", True), ("activite_20251201_120000.csv", True), ("site_20251115_173355.zip", True),
        ("fichier_invalide.csv", False), ("site_2025_173355.csv", False), ("site_20251115.csv", False),
    ]
    got = one([(n,) for n, _ in rows], "name string", filenames.is_valid_arrival(F.col("name"), ("site", "activite")))
    assert [g for (g,) in got] == [ok for _, ok in rows]


def test_arrival_timestamp(one):
    got = one([("site_20251115_173355.csv",), ("site.csv",)], "name string", filenames.arrival_timestamp(F.col("name")))
    assert got == [(datetime(2025, 11, 15, 17, 33, 55),), (None,)]


def test_extensions(one):
    got = one([("data.csv",), ("data.xlsx",), ("data.JSON",), ("data",)], "name string", filenames.is_supported(F.col("name")))
    assert got == [(True,), (False,), (True,), (False,)]


def test_file_dates(one):
    rows = {
        "data_20251108": ("20251108", "", "", date(2025, 11, 8)),
        "data-20251108": ("20251108", "", "", date(2025, 11, 8)),
        "data20251108": ("20251108", "", "", date(2025, 11, 8)),
        "data_20251108_143022": ("20251108", "", "20251108", date(2025, 11, 8)),
        "data_20251108143022": ("20251108", "20251108", "", date(2025, 11, 8)),
        "data": ("", "", "", None),
        "id123456789012": ("12345678", "", "", None),
        "a_20251345": ("20251345", "", "", None),
    }
    columns = [*filenames.date_candidates(F.col("name")), filenames.extraction_date(F.col("name"))]
    assert one([(n,) for n in rows], "name string", *columns) == list(rows.values())


def test_received_name(one):
    got = one([("file:/a/b/data_20251108.csv",), ("/x/y.parquet",)], "name string",
              filenames.received_name(F.col("name")), filenames.received_name(F.col("name"), ("csv", "parquet")))
    assert got == [("data_20251108", "data_20251108"), ("", "y")]


def test_expected_file_date(spark):
    files = spark.createDataFrame([("a_20251108",), ("a_20251110",), ("a",)], "name string")
    expected = F.lit("2025-11-08").cast("date")
    exact = [tuple(r) for r in judge_file_dates(files, F.col("name"), expected).collect()]
    assert exact == [("a_20251108", "SUCCESS", None), ("a_20251110", "REJECTED", "000000004"), ("a", "REJECTED", "000000004")]
    close = [r.status for r in judge_file_dates(files, F.col("name"), expected, 10).collect()]
    assert close == ["SUCCESS", "SUCCESS", "REJECTED"]


def test_registered_names(spark):
    registry = spark.createDataFrame([("billing", "yyyyMMdd_HHmmss", True)], "fixed_part string, date_pattern string, validation_required boolean")
    files = spark.createDataFrame([("billing_20251108_101500.csv",), ("billing_20251108.csv",), ("other_x.csv",)], "name string")
    assert [r.status for r in judge_registered_names(files, "name", registry).collect()] == ["SUCCESS", "REJECTED", "SUCCESS"]


def test_tolerances(one):
    rows = [("10%", 1000), ("5%", 2000), ("0.5%", 10000), ("100%", 500)]
    text, total = F.col("t"), F.col("n")
    assert one(rows, "t string, n bigint", tolerances.tolerance_lines(text, total)) == [(100,), (100,), (50,), (500,)]
    assert one([("5", 1000), ("10", 5000), ("1", 100), ("10%", 7), ("abc%", 1000), ("", 5)], "t string, n bigint",
               tolerances.tolerance_ratio(text, total)) == [(0.005,), (0.002,), (0.01,), (0.1,), (None,), (None,)]
    assert [tolerances.is_tolerance_text(t) for t in ("10%", " 5 ", "abc%", "", "1.5 %")] == [True, True, False, False, True]


def test_threshold_boundaries(one):
    rows = [(10, 100), (9, 100), (0, 0), (1, 0)]
    bad, total = F.col("b"), F.col("n")
    assert one(rows, "b bigint, n bigint", tolerances.stops_ingestion(bad, total)) == [(True,), (False,), (False,), (True,)]
    assert one([(25, 1000), (26, 1000)], "b bigint, n bigint", tolerances.rejected_lines_ok(bad, total)) == [(True,), (False,)]
    assert one([(15, 10000), (16, 10000)], "b bigint, n bigint", tolerances.invalid_columns_ok(bad, total)) == [(True,), (False,)]
    assert one([(950, 1000), (800, 1000)], "b bigint, n bigint", tolerances.within_count(bad, total, 5)) == [(True,), (False,)]


def test_threshold_texts(one):
    got = one([("12.5%",), ("",), ("abc",), (None,), (" 3 ",)], "t string", tolerances.threshold_percent(F.col("t"), 2.5))
    assert got == [(12.5,), (2.5,), (2.5,), (2.5,), (3.0,)]


def test_dates(one):
    cases = [
        ("2025-11-15", "YYYY-MM-DD", True, None), ("15/11/2025", "DD/MM/YYYY", True, None), ("20251115", "YYYYMMDD", True, None),
        ("2025-13-45", "YYYY-MM-DD", False, "000000005"), ("20250230", "YYYYMMDD", False, "000000005"),
        ("2025-1-5", "YYYY-MM-DD", False, "000000004"),
    ]
    for text, pattern, valid, number in cases:
        known = dates.spark_pattern(pattern)
        parsed, failed = one([(text,)], "t string", dates.parse_strict(F.col("t"), known), dates.failure_number(F.col("t"), known))[0]
        assert (parsed is not None) == valid
        if valid:
            assert parsed == datetime(2025, 11, 15)
        else:
            assert failed == number
    assert one([("",), ("  ",), (None,)], "t string", dates.parse_strict(F.col("t"), "yyyy-MM-dd")) == [(None,)] * 3
    assert dates.spark_pattern(None) == "yyyy-MM-dd"


def test_shapes():
    assert dates.shape_of("yyyy-MM-dd") == r"^\d{4}\-\d{2}\-\d{2}$"
    assert dates.shape_of("d MMM yyyy'T'HH") == r"^\d{1,2}\ \p{L}+\ \d{4}T\d{2}$"


def test_integer_casts_equal_try_cast(one):
    texts = ["1", "-1", "+5", " 12 ", "\t7", "7\n", "12.5", "1e3", "", " ", "abc", "99999999999", "2147483648", "0x1F", "1_000",
             "٣", "1 2", "--1", "+", None]
    t = F.col("t")
    for sql_type in ("tinyint", "smallint", "int", "bigint"):
        rows = one([(x,) for x in texts], "t string", cast_text(t, sql_type), t.try_cast(sql_type))
        assert all(a == b for a, b in rows), [(x, r) for x, r in zip(texts, rows) if r[0] != r[1]]


def test_messages(one):
    got = one([("RLK", 1.0, 0.1, "c"), ("RLI", 0.5, 0.2, None)], "k string, a double, t double, c string",
              messages.tolerance_exceeded(F.col("k"), F.col("a"), F.col("t"), F.col("c")), messages.error_number(F.col("k")))
    assert got == [("Column 'c': RLK tolerance exceeded: 100.00% > 10.00%", "000000009"), ("RLI tolerance exceeded: 50.00% > 20.00%", "000000007")]
    assert one([("other",)], "k string", messages.error_number(F.col("k"))) == [("000000007",)]
