"""Many checks from one scan, beside the single operators."""

import pytest

from conftest import plan_of
from stargrain.operators import marks, quality
from stargrain.operators.marks import Marks
from stargrain.operators.profiling import REPORT_ROWS, TableProfile, profile, profile_json, scalar_profile
from stargrain.operators.quality import Expectation
from stargrain.operators.rows import duplicate_groups, orphan_rows

SPECS = (
    TableProfile(
        "child", typed={"_n": "try_cast(n AS INT)"}, scalars={"baris": "count(*)", "n_maks": "max(_n)"}, examples={"contoh": "k"},
        distinct={"k_unik": "k", "n_unik": "n"}, duplicates={"k_ganda": ("k",), "kn_ganda": ("k", "n")}, frequencies={"k": ("k",), "kn": ("k", "n")},
        orphans={"yatim": ("k", "parent", "id"), "yatim2": ("k", "other", "id")}),
    TableProfile("parent", scalars={"induk": "count(*)"}, childless={"tanpa_anak": ("id", "child", "k")}),
)


@pytest.fixture()
def tables(spark):
    rows = [("a", "1"), ("a", "1"), ("a", "2"), ("b", "x"), (None, "3"), (None, None), ("c | 1", "2"), ("c", "1 | 2")]
    return {
        "child": spark.createDataFrame(rows, "k string, n string").repartition(3),
        "parent": spark.createDataFrame([("a",), ("z",), (None,), ("a",)], "id string"),
        "other": spark.createDataFrame([("b",)], "id string"),
    }


def values(df):
    return {(r.table, r.check, r.metric): r.value for r in df.collect()}


def test_profile_beside_single_checks(tables):
    got = values(profile(tables, SPECS))
    one = lambda df: str(df.first()[0])
    child, parent = tables["child"], tables["parent"]
    assert got["child", "scalars", "baris"] == "8" and got["child", "scalars", "n_maks"] == "3" and got["child", "scalars", "contoh"] == "a"
    assert (got["child", "scalars", "k_unik"], got["child", "scalars", "n_unik"]) == ("4", "5")
    assert got["child", "duplicates", "k_ganda"] == one(duplicate_groups(child, ["k"])) == "2"
    assert got["child", "duplicates", "kn_ganda"] == one(duplicate_groups(child, ["k", "n"])) == "1"
    assert got["child", "orphans", "yatim"] == one(orphan_rows(child, "k", parent, "id")) == "5"
    assert got["child", "orphans", "yatim2"] == one(orphan_rows(child, "k", tables["other"], "id")) == "7"
    assert got["parent", "childless", "tanpa_anak"] == one(orphan_rows(parent, "id", child, "k")) == "2"
    assert got["child", "frequency", "k: NULL"] == "2" and got["child", "frequency", "kn: a | 1"] == "2"
    listed = [(r.metric, r.value) for r in profile(tables, SPECS).collect() if r.metric == "kn: c | 1 | 2"]
    assert listed == [("kn: c | 1 | 2", "1")] * 2  # two different keys that read alike
    assert values(profile(tables, SPECS, approximate=True)) == got


def test_tables_without_rows(tables):
    none = {n: df.limit(0) for n, df in tables.items()}
    got = values(profile(none, SPECS))
    assert got.pop(("child", "scalars", "n_maks")) is None and got.pop(("child", "scalars", "contoh")) is None
    assert set(got.values()) == {"0"} and len(got) == 9
    row = scalar_profile(none["child"], SPECS[0]).first()
    assert (row.baris, row.n_maks, row.contoh, row.k_unik, row.n_unik) == (0, None, None, 0, 0)


def test_each_table_is_scanned_once(spark, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    read = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    plan = plan_of(profile(read, SPECS))
    assert plan.count("FileScan parquet") == 3 and "Expand" not in plan
    checks = [
        Expectation("unik", "t", "warning", "pass", "child", count=quality.unique("child", ["k"])),
        Expectation("induk", "t", "warning", "pass", "child", count=quality.references("child", "k", "parent", "id")),
        Expectation("isi", "t", "warning", "pass", "child", row_rule="n IS NULL"),
    ]
    found = quality.violation_counts(checks, read)
    assert plan_of(found).count("FileScan parquet") == 2
    assert {r.name: r.violations for r in found.collect()} == {"unik": 2, "induk": 5, "isi": 1}
    empty = {n: df.limit(0) for n, df in read.items()}
    assert {r.name: r.violations for r in quality.violation_counts(checks, empty).collect()} == {"unik": 0, "induk": 0, "isi": 0}


def test_row_rules_cost_no_round_of_their_own(spark, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    read = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    keyed = [
        Expectation("unik", "t", "warning", "pass", "child", count=quality.unique("child", ["k", "n"])),
        Expectation("induk", "t", "warning", "pass", "child", count=quality.references("child", "k", "parent", "id")),
    ]
    rules = [
        Expectation("isi", "t", "warning", "pass", "child", row_rule="n IS NULL"), Expectation("huruf", "t", "warning", "pass", "child", row_rule="k > 'b'"),
        Expectation("induk_isi", "t", "warning", "pass", "parent", row_rule="id IS NULL"), Expectation("tak_ada", "t", "warning", "pass", "parent", row_rule="id = '?'"),
    ]
    exchanges = lambda checks: plan_of(quality.violation_counts(checks, read)).count("Exchange hashpartitioning(_d")
    assert exchanges(keyed + rules) == exchanges(keyed) == 1
    got = {r.name: r.violations for r in quality.violation_counts(keyed + rules, read).collect()}
    assert got == {"unik": 1, "induk": 5, "isi": 1, "huruf": 2, "induk_isi": 1, "tak_ada": 0}


def test_zero_is_one_value(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2), (None, 2)], "x double, y int")
    row = scalar_profile(df, TableProfile("t", distinct={"x_unik": "x", "y_unik": "y"})).first()
    assert (row.x_unik, row.y_unik) == (1, 2)


def test_reports_on_the_driver_are_bounded(spark):
    many = spark.range(REPORT_ROWS + 1).selectExpr("'t' AS table", "'c' AS check", "CAST(id AS STRING) AS metric", "'1' AS value")
    with pytest.raises(ValueError, match="write_profile"):
        profile_json(many)


def test_columns_that_are_compared_are_marked_once(spark):
    """Sets that look at one column, and the parents of others, share that column's marks."""
    child = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), (None, None), ("b", "b")], "k string, n string")
    parent = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "id string")
    plan = {
        "child": Marks(sets={"k": ["k"], "k again": ["k"], "kn": ["k", "n"], "self": ["n"]}, parents={("id", 0): "k", ("self", 1): "k", ("kn", 0): "k"}),
        "parent": Marks(sets={"id": ["id"]}, parents={("k", 2): "id"}),
    }
    layout = marks._layout(plan)
    assert len(layout.places) == 4 and len(layout.widths) == 2
    got = {(r.set, *r.key): (r.n, r.refs) for r in marks.together({"child": child, "parent": parent}, plan).collect()}
    assert {k: v for k, v in got.items() if k[0] == "k"} == {("k", "a"): (2, 4), ("k", "b"): (2, 0), ("k", None): (1, 4), ("k", "z"): (0, 4)}
    assert {k: v for k, v in got.items() if k[0] == "id"} == {("id", "a"): (1, 1), ("id", "z"): (2, 0), ("id", None): (1, 1), ("id", "b"): (0, 1)}
    assert {k: v for k, v in got.items() if k[0] == "self"} == {("self", "1"): (2, 0), ("self", None): (2, 2), ("self", "b"): (1, 2), ("self", "a"): (0, 2)}
    assert got["kn", "b", None] == (1, 0) and got["kn", "b"] == (0, 1)  # a key of one column is no key of two
    assert {k[1:]: v[0] for k, v in got.items() if k[0] == "k again"} == {("a",): 2, ("b",): 2, (None,): 1}
