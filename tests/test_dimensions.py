import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan_of
from stargrain.operators import dimensions as D
from stargrain.operators import quality
from stargrain.operators.rows import first_per_key, literal_row

STAGE = "k string, a string, b int"
TRACKED = ("a", "b")


def stage(spark, *rows):
    return spark.createDataFrame(list(rows), STAGE)


def apply(dim, st, ts):
    return D.scd2_apply(dim, st, "k", TRACKED, ts, "sk")


def versions(dim, key):
    rows = dim.filter(F.col("k") == key).orderBy("valid_from").collect()
    return [(r.a, r.b, r.valid_from.isoformat()[:10], r.valid_to.isoformat()[:10], r.is_current) for r in rows]


def frozen(dim):
    """Materialise through the driver; test frames hold a handful of rows."""
    return dim.sparkSession.createDataFrame(dim.collect(), dim.schema)


def test_history_over_five_batches(spark):
    dim = D.empty_scd2(stage(spark), "k", TRACKED, "sk")
    b1 = stage(spark, ("x", "one", 1), ("y", "one", 1), ("z", None, 1))
    dim = frozen(apply(dim, b1, "2024-01-01 00:00:00"))
    assert versions(dim, "x") == [("one", 1, "1970-01-01", "9999-12-31", True)]
    assert sorted(r.sk for r in dim.collect()) == [1, 2, 3]

    b2 = stage(spark, ("x", "two", 1), ("z", None, 1), ("w", "new", 9))  # x changed, y gone, w new
    dim = frozen(apply(dim, b2, "2024-02-01 00:00:00"))
    assert versions(dim, "x") == [("one", 1, "1970-01-01", "2024-02-01", False), ("two", 1, "2024-02-01", "9999-12-31", True)]
    assert versions(dim, "y") == [("one", 1, "1970-01-01", "9999-12-31", True)]
    assert versions(dim, "w") == [("new", 9, "1970-01-01", "9999-12-31", True)]

    b3 = stage(spark, ("x", "one", 1), ("z", "", 1))  # back to the old value; NULL and '' hash alike
    dim = frozen(apply(dim, b3, "2024-03-01 00:00:00"))
    assert [v[0] for v in versions(dim, "x")] == ["one", "two", "one"]
    assert len(versions(dim, "z")) == 1

    again = frozen(apply(dim, b3, "2024-03-01 00:00:00"))
    assert sorted(again.collect()) == sorted(dim.collect())

    b4 = stage(spark, ("x", "three", 1))  # changed again at the same batch time: replaced in place
    dim = frozen(apply(dim, b4, "2024-03-01 00:00:00"))
    assert [v[0] for v in versions(dim, "x")] == ["one", "two", "three"]
    found = quality.scd2_invariants(dim, "k").first().asDict()
    assert set(found.values()) == {0}
    assert dim.select("sk").distinct().count() == dim.count()


def test_late_batch_is_refused(spark):
    dim = D.empty_scd2(stage(spark), "k", TRACKED, "sk")
    dim = frozen(apply(dim, stage(spark, ("x", "one", 1)), "2024-01-01 00:00:00"))
    dim = frozen(apply(dim, stage(spark, ("x", "two", 1)), "2024-03-01 00:00:00"))
    with pytest.raises(PySparkException, match="older than the current version"):
        apply(dim, stage(spark, ("x", "three", 1)), "2024-02-01 00:00:00").collect()


def test_key_with_closed_versions_only_reopens_at_batch_time(spark):
    dim = D.empty_scd2(stage(spark), "k", TRACKED, "sk")
    dim = frozen(apply(dim, stage(spark, ("x", "one", 1)), "2024-01-01 00:00:00"))
    ended = dim.withColumn("valid_to", F.lit("2024-02-01").cast("timestamp")).withColumn("is_current", F.lit(False))
    out = frozen(apply(frozen(ended), stage(spark, ("x", "one", 1)), "2024-05-01 00:00:00"))
    assert [v[2:] for v in versions(out, "x")] == [("1970-01-01", "2024-02-01", False), ("2024-05-01", "9999-12-31", True)]


def test_broken_history_is_found(spark):
    ts = lambda s: dt.datetime.fromisoformat(s)
    end = ts("9999-12-31")
    rows = [
        ("gap", ts("1970-01-01"), ts("2020-01-01"), False), ("gap", ts("2021-01-01"), end, True),
        ("overlap", ts("1970-01-01"), ts("2021-01-01"), False), ("overlap", ts("2020-01-01"), ts("2021-01-01"), False),
        ("overlap", ts("2021-01-01"), end, True),
        ("two", ts("1970-01-01"), end, True), ("two", ts("2020-01-01"), end, True),
        ("empty", ts("2020-01-01"), ts("2020-01-01"), False), ("empty", ts("2020-01-01"), end, True),
        ("open", ts("2020-01-01"), end, False),
    ]
    dim = spark.createDataFrame(rows, "k string, valid_from timestamp, valid_to timestamp, is_current boolean")
    assert quality.scd2_invariants(dim, "k").first().asDict() == {
        "empty_interval": 1, "current_not_open": 1, "not_one_current": 2, "repeated_start": 1, "repeated_end": 1, "gap_after_version": 2,
    }


def test_scd1(spark):
    schema = "sk bigint, k string, a string, updated_at timestamp"
    old, now = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    dim = spark.createDataFrame([(-1, "-", "?", old), (1, "x", "one", old), (2, "y", "one", old), (3, "z", "one", old)], schema)
    st = stage(spark, ("x", "b", 1), ("x", "a", 2), ("y", "one", 1), ("n", "new", 1), ("n", "newer", 1), ("z", None, 1), (None, "lost", 1))
    out = D.scd1_upsert(dim, st, "k", ["a"], F.lit(now), "sk")
    got = {r.k: (r.sk, r.a, r.updated_at) for r in out.collect()}
    assert got == {
        "-": (-1, "?", old), "x": (1, "a", now), "y": (2, "one", now), "z": (3, None, now), "n": (4, "new", now),
    }
    again = D.scd1_upsert(out, st, "k", ["a"], F.lit(now), "sk")
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_numbering_is_dense_and_in_hash_order(spark):
    df = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("k"))
    out = D.number_rows(df, "k", "sk", F.lit(10)).withColumn("h", F.md5("k")).orderBy("h").collect()
    assert [r.sk for r in out] == list(range(11, 20011))


def test_unknown_member_and_insert_if_absent(spark):
    dim = spark.createDataFrame([(1, "x")], "sk bigint, k string")
    once = D.add_unknown(dim, {"sk": -1, "k": "-"})
    twice = D.insert_if_absent(once, literal_row(spark, dim.schema, {"sk": -1, "k": "-"}), "sk")
    assert sorted(r.sk for r in twice.collect()) == [-1, 1]
    with pytest.raises(ValueError):
        literal_row(spark, dim.schema, {"nope": 1})


def test_hierarchy_keeps_orphans(spark):
    leaf = spark.createDataFrame([("1.1", "v1"), ("9.1", "v2")], "code string, name string")
    parents = spark.createDataFrame([("1", "p1")], "k string, parent string")
    out = D.flatten_hierarchy(leaf, [(parents, F.split_part("code", F.lit("."), F.lit(1)), "k")])
    assert {r.name: r.parent for r in out.collect()} == {"v1": "p1", "v2": None}


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = first_per_key(df, ["k"], [F.col("id").desc_nulls_last()])
    assert plan_of(out).count("WindowGroupLimit") == 2  # once in the map stage, once after it
    assert sorted(r.id for r in out.collect()) == [997, 998, 999]
