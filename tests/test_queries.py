"""Registered queries: coverage of the inventory, and a sample against SQL."""

import collections
import os

import duckdb
import pytest

from workload import catalog

FOLDER = "/root/testdata/sf0.001"
INVENTORY = {"A": 13, "B": 12, "C": 16, "D": 12, "E": 24, "F": 9, "G": 8, "H": 10, "J": 15}
RETIRED = {"G4"}
SAMPLE = [
    "file_verdict", "accepted_orders", "all_error_rows", "corrupt_line_check", "duplicate_line_tolerance", "file_metadata",
    "tolerance_ratios", "execution_log_rows", "merge_upsert", "keyed_row_statuses", "column_match_rates", "quarantined_rows",
    "ingest_again", "late_delivery", "headers_by_name", "landing_run", "merge_ingest", "sample_bad_values",
]


def test_every_inventory_id_has_a_query_with_sql():
    covered = {i for q in catalog.QUERIES.values() if q.sql for i in q.covers}
    wanted = {f"{group}{n}" for group, count in INVENTORY.items() for n in range(1, count + 1)} - RETIRED
    assert wanted - covered == set() and covered - wanted == set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: f"{v:.12g}" if isinstance(v, float) else str(v)
    return collections.Counter(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    q = catalog.QUERIES[name]
    result = q.run(spark, FOLDER)
    cursor = duck.execute(q.sql)
    names = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(names)
    assert bag(result.columns, result.collect()) == bag(names, cursor.fetchall())
