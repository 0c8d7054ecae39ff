import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from stargrain.operators import facts

DIM = "k string, valid_from timestamp, valid_to timestamp, sk bigint"
END = dt.datetime(9999, 12, 31)


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def versioned(spark):
    """Versions with gaps at the start, one key with many versions, and events of which a third
    belong to one key. Returns (dimension, events, expected keys by event)."""
    rng = random.Random(7)
    rows, sk = [], 0
    starts = {"hot": sorted(rng.sample(range(0, 900), 200)), "a": [0], "b": [10, 50], "late": [800]}
    for k, days in starts.items():
        for i, d in enumerate(days):
            sk += 1
            rows.append((k, day(d), day(days[i + 1]) if i + 1 < len(days) else END, sk))
    events = []
    for n in range(3000):
        k = "hot" if n % 3 == 0 else rng.choice(["a", "b", "late", "none", None])
        t = None if n % 97 == 0 else day(rng.randrange(0, 900)) if n % 2 else day(rng.choice(starts["hot"]))
        events.append((n, k, t))

    def expected(k, t):
        if k is None or t is None:
            return -1
        return next((r[3] for r in rows if r[0] == k and r[1] <= t < r[2]), -1)

    want = {n: expected(k, t) for n, k, t in events}
    return spark.createDataFrame(rows, DIM), spark.createDataFrame(events, "n int, key string, t timestamp"), want


@pytest.mark.parametrize("method", ["broadcast", "join", "sweep", None])
def test_asof_lookup_against_brute_force(versioned, method):
    dim, events, want = versioned
    out = facts.lookup_asof(events, dim, "key", "k", "t", "sk", "place_sk", method)
    rows = out.collect()
    assert {r.n: r.place_sk for r in rows} == want and len(rows) == len(want)
    assert set(out.columns) == {"n", "key", "t", "place_sk"}


@pytest.mark.parametrize("method", ["broadcast", "join", "sweep"])
def test_asof_types_and_null_keys_are_the_same_by_every_method(spark, method):
    dim = spark.createDataFrame([("a", day(0), END, 7), (None, day(0), END, 8)], DIM.replace("sk bigint", "sk int"))
    ev = spark.createDataFrame([(1, "a", day(3)), (2, None, day(3)), (3, "a", None), (4, "b", day(3))], "n int, key string, t timestamp")
    out = facts.lookup_asof(ev, dim, "key", "k", "t", "sk", "place_sk", method)
    assert out.schema["place_sk"].dataType.simpleString() == dim.schema["sk"].dataType.simpleString()
    assert {r.n: r.place_sk for r in out.collect()} == {1: 7, 2: -1, 3: -1, 4: -1}


def test_sweep_slices_follow_the_events_and_not_the_span(spark):
    """One event of 1970 and a key with a third of all events: no slice holds much more than its share."""
    third = spark.range(30_000).select(
        F.col("id").cast("int").alias("n"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        (F.lit(day(800)) + F.make_dt_interval(secs=F.col("id"))).alias("t"))
    events = third.union(spark.createDataFrame([(-1, "hot", dt.datetime(1970, 1, 1))], third.schema))
    dim = spark.createDataFrame([("hot", day(0), day(801), 1), ("hot", day(801), END, 2)], DIM)
    out = facts.lookup_asof(events, dim, "key", "k", "t", "sk", "place_sk", "sweep")
    got = {r.place_sk: r["count"] for r in out.groupBy("place_sk").count().collect()}
    assert got == {1: 10_000, -1: 20_001}
    cuts = events.agg(F.percentile_approx(F.unix_timestamp("t"), F.array(*[F.lit(k / 64) for k in range(1, 64)]), 10_000).alias("c")).first().c
    slices = events.select(facts._count_cuts(F.array(*map(F.lit, cuts)), F.unix_timestamp("t"), 64).alias("m")).groupBy("m").count()
    assert slices.agg(F.max("count")).first()[0] < 2 * 30_000 / 64


def test_sweep_copies_no_version(spark):
    """A version that is valid in every slice stands once, and is handed on to slices with events only."""
    events = spark.range(64 * 20).select((F.col("id") % 7).cast("string").alias("key"), (F.lit(day(0)) + F.make_dt_interval(hours=F.col("id"))).alias("t"))
    dim = spark.createDataFrame([(str(k), day(-900), END, k) for k in range(300)], DIM)
    out = facts.lookup_asof(events, dim, "key", "k", "t", "sk", method="sweep")
    assert {(r.key, r.sk) for r in out.collect()} == {(str(k), k) for k in range(7)}
    assert "Generate" not in plan_of(out)


def test_many_versions_of_a_key_are_swept_by_default(spark):
    many = spark.range(facts.JOIN_VERSIONS + 1).select(
        F.lit("a").alias("k"), (F.lit(day(0)) + F.make_dt_interval(days=F.col("id"))).alias("valid_from"),
        (F.lit(day(1)) + F.make_dt_interval(days=F.col("id"))).alias("valid_to"), F.col("id").alias("sk"))
    ev = spark.createDataFrame([("a", day(3)), ("a", day(99)), ("b", day(3))], "key string, t timestamp")
    for dim, swept in ((many, True), (many.filter("sk < 5"), False)):
        out = facts.lookup_asof(ev, dim, "key", "k", "t", "sk")
        assert ("Window" in plan_of(out)) == swept
        assert sorted((r.key, r.sk) for r in out.collect()) == [("a", -1), ("a", 3), ("b", -1)]


def test_range_is_half_open(spark):
    dim = spark.createDataFrame([("a", day(0), day(5), 1), ("a", day(5), END, 2)], DIM)
    ev = spark.createDataFrame([("a", day(5)), ("a", day(4)), ("a", day(-1))], "key string, t timestamp")
    for method in ("broadcast", "sweep"):
        got = {r.t: r.sk for r in facts.lookup_asof(ev, dim, "key", "k", "t", "sk", method=method).collect()}
        assert got == {day(5): 2, day(4): 1, day(-1): -1}


def test_fan_out_equals_the_wrong_join(versioned):
    dim, events, _ = versioned
    wrong = events.join(dim, events.key == dim.k, "left").count()
    got = facts.fan_out(events, dim, "key", "k").first()
    assert (got.fact_rows, got.joined_rows) == (3000, wrong)


def test_lookup_keeps_every_row(spark):
    dim = spark.createDataFrame([("a", 1)], "k string, sk bigint")
    fact = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    assert sorted(r.sk for r in facts.lookup(fact, dim, "key", "k", "sk").collect()) == [-1, -1, 1]


FACT = "k string, m int, v double, note string, dim_sk bigint"


def test_merge(spark):
    target = spark.createDataFrame([("a", 1, 1.0, "old", 5), ("b", 1, 2.0, "old", 5), ("c", 2, 3.0, "old", 5)], FACT)
    stage = spark.createDataFrame([("a", 1, 9.0, "new", 6), ("b", 1, None, "new", 6), ("a", 2, 4.0, "new", 6)], FACT)
    once = facts.merge_fact(target, stage, ["k", "m"], ["v", "dim_sk"], ["dim_sk"])
    want = {("a", 1): (9.0, "old", 6), ("b", 1): (None, "old", 6), ("c", 2): (3.0, "old", 5), ("a", 2): (4.0, "new", 6)}
    assert {(r.k, r.m): (r.v, r.note, r.dim_sk) for r in once.collect()} == want
    twice = facts.merge_fact(once, stage, ["k", "m"], ["v", "dim_sk"], ["dim_sk"])
    assert facts.fingerprint(once).first() == facts.fingerprint(twice).first()
    appended = facts.append_fact(facts.append_fact(target, stage), stage)
    assert appended.count() == 9


def test_merge_refuses_surrogate_keys(spark):
    t = spark.createDataFrame([], FACT)
    with pytest.raises(ValueError):
        facts.merge_fact(t, t, ["dim_sk"], ["v"], ["dim_sk"])


def test_merge_keeps_rows_with_null_keys_of_either_side(spark):
    target = spark.createDataFrame([(None, 1, 1.0, "keep", 5), ("a", 1, 2.0, "old", 5)], FACT)
    stage = spark.createDataFrame([(None, 2, 5.0, "new", 6), (None, 1, 6.0, "new", 6), ("a", 1, 7.0, "new", 6)], FACT)
    got = sorted(((r.k or "", r.m, r.v, r.note) for r in facts.merge_fact(target, stage, ["k", "m"], ["v"]).collect()))
    assert got == [("", 1, 1.0, "keep"), ("", 1, 6.0, "new"), ("", 2, 5.0, "new"), ("a", 1, 7.0, "old")]


def test_hot_key_is_split_when_the_lookup_is_shuffled(spark):
    """Half of all events belong to one key; the join task of that key must be split at run time."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.shuffle.partitions": "16",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 2 == 0, F.lit("k7")).otherwise(F.concat(F.lit("k"), F.col("id") % 1000))
        events = spark.range(0, 400_000, 1, 8).select(F.xxhash64("id").alias("v"), key.alias("key"), F.lit(day(3)).alias("t"))
        dim = spark.range(1000).select(
            F.concat(F.lit("k"), "id").alias("k"), F.lit(day(0)).alias("valid_from"), F.lit(END).alias("valid_to"), (F.col("id") + 1).alias("sk")
        )
        out = facts.lookup_asof(events, dim, "key", "k", "t", "sk", method="join")
        out = out.groupBy().agg(F.count_if(F.col("sk") == 8).alias("n"), F.max("v"))
        assert out.collect()[0].n == 200_000 + 400
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_latest_run_is_per_key(spark):
    rows = [("v1", 0, 1, "old"), ("v1", 0, 2, "new"), ("v1", 3, 2, "new"), ("v2", 0, 1, "only old"), ("v3", 0, None, "no run"), ("v3", 0, 1, "run")]
    fact = spark.createDataFrame(rows, "k string, slot int, run int, note string")
    got = sorted((r.k, r.slot, r.note) for r in facts.latest_run(fact, ["k", "slot"], ["run"]).collect())
    assert got == [("v1", 0, "new"), ("v1", 3, "new"), ("v2", 0, "only old"), ("v3", 0, "run")]
    only = spark.createDataFrame([("v1",)], "k string")
    assert facts.latest_run(fact, ["k", "slot"], ["run"], only, "k").count() == 2
    with pytest.raises(ValueError):
        facts.latest_run(fact, ["k", "slot"], ["run"], only, "run")


def test_replace_months(spark):
    t = spark.createDataFrame([(202401, "a"), (202402, "b")], "bulan int, x string")
    s = spark.createDataFrame([(202402, "c")], "bulan int, x string")
    assert sorted(r.x for r in facts.replace_months(t, s, "bulan").collect()) == ["a", "c"]


def test_fingerprint_ignores_order_and_audit(spark):
    a = spark.createDataFrame([(1, "x", "b1"), (2, "y", "b1")], "i int, s string, batch_id string")
    b = spark.createDataFrame([(2, "y", "b2"), (1, "x", "b2")], "i int, s string, batch_id string")
    assert facts.fingerprint(a, ["batch_id"]).first() == facts.fingerprint(b, ["batch_id"]).first()
    assert facts.fingerprint(a).first() != facts.fingerprint(b).first()


def test_fingerprint_sees_a_value_that_moves(spark):
    a = spark.createDataFrame([("x", None)], "s string, t string")
    b = spark.createDataFrame([(None, "x")], "s string, t string")
    assert facts.fingerprint(a).first() != facts.fingerprint(b).first()
