"""Fact tables: dimension lookups, idempotent merge, month partitions, newest run per slot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stargrain.functions import expressions as X
from stargrain.operators.rows import first_per_key


# --- lookups --------------------------------------------------------------------------------

def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str, out: str | None = None) -> DataFrame:
    """Surrogate key of a dimension with one row per natural key; no match gives -1, no row is lost.

    Spark broadcasts the dimension if its size at run time allows; otherwise it joins by key, and
    AQE splits the partitions of hot keys (the dimension side is unique, so no row pairs multiply).
    """
    keys = dim.select(F.col(dim_key).alias("_dk"), F.col(sk).alias("_sk"))
    return (
        fact.join(keys, F.col(fact_key) == F.col("_dk"), "left")
        .withColumn(out or sk, F.coalesce("_sk", F.lit(X.UNKNOWN_KEY).cast(dim.schema[sk].dataType)))
        .drop("_dk", "_sk")
    )


#: versions of a key up to which the join is the default way of an as-of lookup
JOIN_VERSIONS = 16


def lookup_asof(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    event_time: str,
    sk: str,
    out: str | None = None,
    method: str | None = None,
) -> DataFrame:
    """Surrogate key of the version valid at the event: valid_from <= t < valid_to (half open).

    Without a version, a key or a time it is -1, in the dimension's type. The versions of a key must
    not overlap (`quality.scd2_violations` counts those that do). Two ways with equal results:
      join   hash join on the key with the range as residual: every event meets all versions of its key, so
             it is the default where no key has more than JOIN_VERSIONS, counted on the dimension;
      sweep  the version begun last is carried on through time, linear whatever the number of versions (`_carry`).
    Spark broadcasts the versions of a join if their size at run time allows; "broadcast" is another name for it.
    """
    versions = dim.select(
        F.col(dim_key).alias("_dk"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), F.col(sk).alias("_sk")
    )
    out = out or sk
    unknown = F.lit(X.UNKNOWN_KEY).cast(dim.schema[sk].dataType)
    if method is None:
        most = versions.groupBy("_dk").count().agg(F.max("count")).first()[0]
        method = "join" if (most or 0) <= JOIN_VERSIONS else "sweep"
    if method == "sweep":
        return _carry(fact, versions, fact_key, event_time, out, unknown)
    if method not in ("join", "broadcast"):
        raise ValueError(f"unknown method {method}")
    t = F.col(event_time)
    valid = (F.col(fact_key) == F.col("_dk")) & (t >= F.col("_from")) & (t < F.col("_to"))
    return fact.join(versions, valid, "left").withColumn(out, F.coalesce("_sk", unknown)).drop("_dk", "_from", "_to", "_sk")


def _carry(fact: DataFrame, versions: DataFrame, fact_key: str, event_time: str, out: str, unknown: Column, slices: int = 64) -> DataFrame:
    """As-of lookup in linear time: order versions and events by time, carry the last version on.

    Work is cut by key and time slice. The slices hold equally many events of the whole fact
    (measured quantiles), so no key can have more than 1/slices of all events in one, wherever in
    time they lie. A version stands once, in the slice where it begins. What an earlier slice
    hands on is the last version begun there: one row per key and slice with versions is scanned forward to the slices in which
    the key has events, at most `slices` rows of a key on either side. So events, versions, and keys x busy slices are shuffled.
    """
    seconds = lambda c: F.unix_timestamp(c.cast("timestamp"))
    shares = F.array(*[F.lit(k / slices) for k in range(1, slices)])
    cuts = fact.agg(F.percentile_approx(seconds(F.col(event_time)), shares, 10_000)).scalar()
    slice_of = lambda c: _count_cuts(cuts, seconds(c), slices)

    begun = versions.select(
        F.col("_dk").alias("_k"), slice_of(F.col("_from")).alias("_m"), F.col("_from").cast("timestamp").alias("_t"),
        F.struct(F.col("_sk").alias("sk"), F.col("_to").cast("timestamp").alias("until")).alias("_v"),
    ).filter("_k IS NOT NULL AND _t IS NOT NULL")
    # an event without key or time has no version; keeping it out also keeps NULLs out of one group
    undated = F.col(fact_key).isNull() | F.col(event_time).isNull()
    unmatched = fact.filter(undated).withColumn(out, unknown)
    known = fact.filter(~undated)
    busy = known.select(F.col(fact_key).alias("_k"), slice_of(F.col(event_time)).alias("_m")).distinct()
    last = begun.groupBy("_k", "_m").agg(F.max_by("_v", "_t").alias("_v"))
    earlier = Window.partitionBy("_k").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    steps = busy.withColumn("_v", F.lit(None).cast(last.schema["_v"].dataType)).withColumn("_busy", F.lit(True)).unionByName(
        last.withColumn("_busy", F.lit(False)))
    merged = steps.groupBy("_k", "_m").agg(F.max("_v").alias("_v"), F.bool_or("_busy").alias("_busy"))
    handed = merged.withColumn("_v", F.last("_v", ignorenulls=True).over(earlier)).filter("_busy AND _v IS NOT NULL").select(
        "_k", "_m", F.lit(None).cast("timestamp").alias("_t"), "_v")

    events = known.select(
        F.col(fact_key).alias("_k"), slice_of(F.col(event_time)).alias("_m"), F.col(event_time).cast("timestamp").alias("_t"),
        F.lit(None).cast(last.schema["_v"].dataType).alias("_v"), F.lit(1).alias("_kind"), F.struct(*fact.columns).alias("_row"),
    )
    marks = begun.unionByName(handed).select("*", F.lit(0).alias("_kind"), F.lit(None).cast(events.schema["_row"].dataType).alias("_row"))
    # what was handed on has no time and comes first, then by time, versions before events
    w = Window.partitionBy("_k", "_m").orderBy(F.col("_t").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = events.unionByName(marks).withColumn("_v", F.last("_v", ignorenulls=True).over(w))
    found = F.when(F.col("_t") < F.col("_v.until"), F.col("_v.sk"))
    matched = carried.filter("_kind = 1").withColumn("_sk", F.coalesce(found, unknown)).select("_row.*", F.col("_sk").alias(out))
    return matched.unionByName(unmatched)


def _count_cuts(cuts: Column, t: Column, slices: int) -> Column:
    """How many of the slices - 1 ordered cuts lie at or before t; 0 without cuts."""
    parts = [F.coalesce((F.get(cuts, F.lit(k)) <= t).cast("int"), F.lit(0)) for k in range(slices - 1)]
    while len(parts) > 1:  # a balanced sum keeps the expression shallow
        parts = [parts[k] + parts[k + 1] if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


# --- merge ----------------------------------------------------------------------------------

def _no_surrogates(key: Sequence[str], surrogates: Sequence[str]) -> None:
    bad = [c for c in key if c in surrogates]
    if bad:
        raise ValueError(f"merge on natural keys: {bad} change when a dimension opens a new version")


def merge_fact(
    target: DataFrame,
    stage: DataFrame,
    key: Sequence[str],
    update_cols: Sequence[str],
    surrogates: Sequence[str] = (),
    unknown: Mapping[str, object] | None = None,
) -> DataFrame:
    """Insert staged rows with a new key; on a known key overwrite `update_cols` only.

    A staged NULL overwrites, but the value that `unknown` names for a column doesn't. Columns outside `update_cols` keep the value of the first load.
    The key must be unique on both sides. NULL in a key equals nothing: such rows of either side
    stay as rows of their own (`Warehouse.merge_months` refuses them in a batch).

    One full outer join; both sides carry a mark of presence, so no value of a column decides
    which side a row came from.
    """
    _no_surrogates(key, surrogates)
    cols = target.columns
    known = target.withColumn("_known", F.lit(True))
    staged = stage.select(*[F.col(c).alias("_s_" + c) for c in cols], F.lit(True).alias("_staged"))
    on = [F.col(c) == F.col("_s_" + c) for c in key]
    hit, old = F.col("_staged").isNotNull(), F.col("_known").isNotNull()

    def new(c: str) -> Column:
        value = F.col("_s_" + c)
        return F.when(value == F.lit(unknown[c]), F.coalesce(F.col(c), value)).otherwise(value) if c in (unknown or {}) else value

    return known.join(staged, on, "full_outer").select(
        *[
            (F.when(hit, new(c)).otherwise(F.col(c)) if c in update_cols
             else F.when(old, F.col(c)).otherwise(F.col("_s_" + c))).alias(c)
            for c in cols
        ]
    )


def append_fact(target: DataFrame, stage: DataFrame) -> DataFrame:
    """Plain append, the strategy that doubles rows when a load is repeated."""
    return target.unionByName(stage.select(*target.columns))


def replace_months(target: DataFrame, stage: DataFrame, month: str) -> DataFrame:
    """Drop the target months present in the stage, then append the stage.

    Loses other runs stored in those months, which is why the default load merges instead. The months are few and
    become a predicate on the target: no join, and months stored as partitions are pruned.
    """
    months = [r[0] for r in stage.select(month).distinct().collect()]  # one value per calendar month
    known = F.col(month).isin([m for m in months if m is not None])
    kept = target.filter(F.col(month).isNull() | ~known) if None not in months else target.filter(F.col(month).isNotNull() & ~known)
    return kept.unionByName(stage.select(*target.columns))


# --- newest run -----------------------------------------------------------------------------

def latest_run(
    fact: DataFrame,
    keys: Sequence[str],
    run: Sequence[str],
    only: DataFrame | None = None,
    only_key: str | None = None,
) -> DataFrame:
    """Newest run per key (older runs stay in the fact).

    Per key, never a global max(run): an entity whose newest run is old must stay visible.
    `only` restricts to a set of natural keys before the shuffle; that is safe because `only_key`
    is part of `keys`. Restricting by a surrogate key is refused, since two runs of one slot may
    carry different dimension versions.
    """
    if only is not None:
        if only_key not in keys:
            raise ValueError("prefilter only by a column of the run key")
        fact = fact.join(only.select(only_key), only_key, "left_semi")
    return first_per_key(fact, keys, [F.col(c).desc_nulls_last() for c in run])


def fan_out(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Rows that a lookup without the validity range would produce, against the rows there are.

    Counted as sum(events x versions) per key, so the wrong join itself is never run.
    """
    facts = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("_f"))
    versions = dim.groupBy(F.col(dim_key).alias("_dk")).agg(F.count(F.lit(1)).alias("_v"))
    return facts.join(versions, F.col("_k") == F.col("_dk"), "left").agg(
        F.sum("_f").cast("bigint").alias("fact_rows"),
        F.sum(F.col("_f") * F.greatest(F.coalesce("_v", F.lit(1)), F.lit(1))).cast("bigint").alias("joined_rows"),
    )


# --- proofs ---------------------------------------------------------------------------------

def fingerprint(df: DataFrame, exclude: Sequence[str] = (), by: Mapping[str, Column] | None = None) -> DataFrame:
    """(rows, checksum) that do not depend on row order, one row or one per value of `by`; audit columns are left out.

    The hash skips NULLs, so each column's presence is hashed beside it: a value that moves to
    another column changes the sum.
    """
    cols = sorted(c for c in df.columns if c not in exclude)
    h = F.xxhash64(*[part for c in cols for part in (F.col(c).isNull(), F.col(c))])
    return df.groupBy(*[c.alias(n) for n, c in (by or {}).items()]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("checksum"),
    )


def month_counts(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(X.month_of_key(key).alias("bulan")).agg(F.count(F.lit(1)).alias("n"))
