"""Renamed columns."""

import itertools
import random

import pytest

from millrace.operators import renames
from millrace.operators.renames import renamed_columns


def test_values_decide_and_types_may_change(spark):
    base = spark.range(3000).selectExpr("id", "id AS amount", "concat('c', id % 700) AS code", "cast(NULL AS string) AS void", "id % 2 AS flag")
    new = spark.range(3000).selectExpr(
        "id", "cast(id AS decimal(12,2)) AS total", "concat('c', id % 650) AS label", "cast(NULL AS string) AS nothing", "concat('z', id) AS other"
    )
    found = renamed_columns(new, base)
    assert [(m, e) for m, e, _ in found] == [("amount", "total"), ("code", "label")]
    assert found[0][2] == 1.0 and found[1][2] == pytest.approx(650 / 700)
    assert renamed_columns(base, base) == [] and renamed_columns(new.limit(0), base) == []
    assert renamed_columns(base.drop("code"), base) == []


def test_the_assignment_is_the_best_one(spark, monkeypatch):
    draw = random.Random(3)
    for size in [(2, 2), (3, 4), (4, 4), (5, 3)] * 5:
        left, right = [f"m{i}" for i in range(size[0])], [f"e{i}" for i in range(size[1])]
        rows = [(m, e, draw.choice([0.0, 0.4, 0.5, 0.6, 0.75, 0.9, 1.0])) for m in left for e in right]
        monkeypatch.setattr(renames, "similarities", lambda *_: type("T", (), {"collect": lambda self: rows})())
        value = {(m, e): s for m, e, s in rows if s >= 0.5}
        slots = [*right, *[None] * size[0]]
        best = max(sum(value.get(p, 0.0) for p in zip(left, order)) for order in set(itertools.permutations(slots, size[0])))
        found = renamed_columns(None, None)
        assert sum(s for _, _, s in found) == pytest.approx(best)
        assert len({m for m, _, _ in found}) == len({e for _, e, _ in found}) == len(found)
