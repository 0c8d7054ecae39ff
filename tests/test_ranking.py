"""Ranks and neighbours over range borders."""

import random

from conftest import plan_of
from stargrain.operators.ranking import previous_row, rank_rows


def test_ranks_with_ties_over_borders(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([None, 1, 1, 1, 2, 5, 9]), rng.choice(["x", None, "y"])) for k in range(900)]
    df = spark.createDataFrame(rows, "id int, a int, b string").repartition(7)
    out = rank_rows(df, ["-a", "b"], "r")
    key = lambda r: (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or "")
    ordered = sorted(map(key, rows))
    first = {k: n for n, k in reversed(list(enumerate(ordered, 1)))}
    assert {x.id: x.r for x in out.collect()} == {r[0]: first[key(r)] for r in rows}
    assert "SinglePartition" not in plan_of(out).split("Subquery")[0]


def test_the_row_before_lies_in_another_range(spark):
    df = spark.range(500).selectExpr("id * 3 AS day", "IF(id % 11 = 0, NULL, id) AS v").repartition(5)
    got = {r.day: r.w for r in previous_row(df, ["day"], "v", "w").collect()}
    assert got == {3 * k: None if k == 0 or (k - 1) % 11 == 0 else k - 1 for k in range(500)}
    down = {r.day: r.w for r in previous_row(df, ["-day"], "v", "w").collect()}
    assert down == {3 * k: None if k == 499 or (k + 1) % 11 == 0 else k + 1 for k in range(500)}


def test_no_rows(spark):
    none = spark.range(0).selectExpr("id AS a", "id AS v")
    assert rank_rows(none, ["a"], "r").count() == 0 and previous_row(none, ["a"], "v", "w").count() == 0
