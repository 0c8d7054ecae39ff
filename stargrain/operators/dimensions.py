"""Dimension maintenance: hierarchy flattening, unknown members, overwrite and history-keeping loads.

Every function maps DataFrames to a DataFrame; publishing is a separate step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators.rows import first_per_key, literal_row, without_match
from stargrain.session import cut


# --- unknown members ------------------------------------------------------------------------

def add_unknown(dim: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Append the unknown member (fixed row) to a dimension that does not hold it yet."""
    return dim.unionByName(literal_row(dim.sparkSession, dim.schema, values))


def insert_if_absent(dim: DataFrame, rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Append only rows whose key is not in the dimension; repeated runs change nothing."""
    key = [key] if isinstance(key, str) else list(key)
    return dim.unionByName(rows.join(dim.select(*key), key, "left_anti"))


# --- surrogate keys -------------------------------------------------------------------------

def number_rows(df: DataFrame, key: str, name: str, start: Column | None = None) -> DataFrame:
    """Number rows start+1, start+2, ... in the order of md5(key). `key` must be unique in `df`.

    Same numbers as row_number() over (order by md5(key)), without its single task: rows are
    numbered inside 4,096 hash-prefix buckets and shifted by the size of the buckets before.
    The numbers depend on content only, so a retried task or a repeated run gives the same keys.
    """
    base = F.lit(0).cast("bigint") if start is None else start
    hashed = df.selectExpr("*", f"md5(CAST({key} AS STRING)) AS _h").selectExpr("*", "substring(_h, 1, 3) AS _b")
    sizes = hashed.groupBy("_b").count()  # at most 16**3 rows
    shift = sizes.selectExpr(
        "_b AS _sb", "coalesce(sum(count) OVER (ORDER BY _b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before"
    )
    return (
        hashed.selectExpr("*", "row_number() OVER (PARTITION BY _b ORDER BY _h) AS _r")
        .join(F.broadcast(shift), F.expr("_b = _sb"))
        .withColumn(name, base + F.expr("_before + _r"))
        .drop("_h", "_b", "_sb", "_r", "_before")
    )


def _with_new_keys(dim: DataFrame, new: DataFrame, key: str, sk: str) -> DataFrame:
    """Give rows of `new` the surrogate keys following the largest one in `dim`."""
    top = dim.agg(F.greatest(F.coalesce(F.max(sk), F.lit(0)), F.lit(0))).scalar()
    numbered = number_rows(new.drop(sk), key, sk, top)
    return numbered.selectExpr(*[f"CAST({c} AS {dim.schema[c].dataType.simpleString()}) AS {c}" for c in dim.columns])


# --- hierarchy ------------------------------------------------------------------------------

def flatten_hierarchy(leaf: DataFrame, levels: Sequence[tuple[DataFrame, Column, str]]) -> DataFrame:
    """Attach parent levels to a leaf table: (parent, child key expression, parent key column).

    Left joins keep leaves without a parent. Parents are keyed tables much smaller than the leaf;
    the join strategy is left to Spark, which knows their file size.
    """
    out = leaf
    for parent, child_key, parent_key in levels:
        out = out.withColumn("_k", child_key)
        out = out.join(parent.withColumnRenamed(parent_key, "_pk"), F.col("_k") == F.col("_pk"), "left").drop("_k", "_pk")
    return out


# --- SCD type 1 -----------------------------------------------------------------------------

def scd1_upsert(
    dim: DataFrame,
    stage: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts: Column,
    sk: str,
    order: Sequence[str] | None = None,
    updated_at: str = "updated_at",
) -> DataFrame:
    """Overwrite matching rows with the staged attributes, insert new keys, keep absent ones.

    A match refreshes `updated_at` even when nothing changed. Several staged rows per key are
    reduced to the first by `order` (default: the first attribute), NULL last. A staged NULL
    overwrites, so a match is told by key presence and not by coalescing attributes.
    """
    order = order or attrs[:1]
    fresh = first_per_key(
        stage.select(key, *attrs), [key], [F.col(c).asc_nulls_last() for c in [*order, *attrs]]
    ).filter(F.col(key).isNotNull())
    staged = fresh.select(F.col(key).alias("_key"), *[F.col(c).alias("_s_" + c) for c in attrs])
    hit = F.col("_key").isNotNull()

    def after(c: str) -> Column:
        if c in attrs:
            return F.when(hit, F.col("_s_" + c)).otherwise(F.col(c)).cast(dim.schema[c].dataType).alias(c)
        if c == updated_at:
            return F.when(hit, ts).otherwise(F.col(c)).cast(dim.schema[c].dataType).alias(c)
        return F.col(c)

    kept = dim.join(staged, F.col(key) == F.col("_key"), "left").select(*[after(c) for c in dim.columns])
    new = without_match(fresh, key, dim, key).withColumn(updated_at, ts)
    return kept.unionByName(_with_new_keys(dim, new, key, sk))


def load_plain(warehouse, table: str, raw: DataFrame, key: str, sk: str, ts: Column, batch_id: str, unknown: str = "TIDAK DIKETAHUI") -> DataFrame:
    """Load an overwriting dimension of all columns of an all-text source, with its unknown member, and publish it."""
    attrs = [c for c in raw.columns if c != key]
    stage = raw.select(*[F.trim(c).alias(c) for c in raw.columns])
    if warehouse.exists(table):
        dim = warehouse.read(table)
    else:
        none = raw.limit(0).select(F.lit(0).cast("bigint").alias(sk), *raw.columns, F.lit(None).cast("timestamp").alias("updated_at"))
        member = {sk: X.UNKNOWN_KEY, key: "-", **dict.fromkeys(attrs, unknown)}
        dim = none.unionByName(literal_row(raw.sparkSession, none.schema, member).withColumn("updated_at", ts))
    return warehouse.publish(table, scd1_upsert(dim, stage, key, attrs, ts, sk, order=attrs[:1] or [key]), batch_id)


# --- SCD type 2 -----------------------------------------------------------------------------

VERSION_COLUMNS = ("valid_from", "valid_to", "is_current", "row_hash")


def scd2_apply(dim: DataFrame, stage: DataFrame, key: str, tracked: Sequence[str], batch_ts: str, sk: str) -> DataFrame:
    """The whole dimension after a batch: versions closed before pass through, see `scd2_changed` for the rest."""
    return dim.filter("NOT is_current").unionByName(scd2_changed(dim, stage, key, tracked, batch_ts, sk))


def scd2_changed(
    dim: DataFrame,
    stage: DataFrame,
    key: str,
    tracked: Sequence[str],
    batch_ts: str,
    sk: str,
) -> DataFrame:
    """The versions that were current before a batch, as they are after it, and the versions it opens.

    Close the current versions whose tracked attributes changed and open new versions.

    * unchanged key: nothing happens; key missing from the stage: stays current;
    * key never seen: valid from 1970-01-01, so that the first load covers all history;
    * key seen before: valid from `batch_ts`;
    * changed again at the same `batch_ts`: the version is replaced in place, because closing it
      would leave an empty interval; a `batch_ts` older than the current version raises.

    The comparison is with the current version only: going back to an older value is a new
    version. Of several staged rows per key the first by the tracked attributes counts (NULL last);
    staged rows without a key are left out.

    Current versions and the stage meet in one full outer join, which gives each key's old version as
    it is afterwards and, if one opens, its new version. Closed versions pass through.
    """
    ts = f"timestamp'{batch_ts}'"
    closed, current = dim.filter("NOT is_current"), dim.filter("is_current")
    fresh = first_per_key(stage.select(key, *tracked), [key], [F.col(c).asc_nulls_last() for c in tracked])
    staged = fresh.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), *[F.col(c).alias("_s_" + c) for c in tracked], X.row_hash(tracked).alias("_hash")
    )
    known = f"{key} IS NOT NULL"
    changed = f"coalesce({known} AND _hash <> row_hash, false)"
    close, replace = f"({changed} AND valid_from <> {ts})", f"({changed} AND valid_from = {ts})"
    late = f"raise_error(concat('batch {batch_ts} is older than the current version of ', CAST({key} AS STRING)))"
    opened = f"(_key IS NOT NULL AND ({key} IS NULL OR {close}))"
    after = {c: f"IF({replace}, _s_{c}, {c})" for c in tracked} | {
        "valid_to": f"IF({close}, IF(valid_from > {ts}, CAST({late} AS TIMESTAMP), {ts}), valid_to)",
        "is_current": f"is_current AND NOT {close}",
        "row_hash": f"IF({replace}, _hash, row_hash)",
    }
    begun = {c: f"_s_{c}" for c in tracked} | {
        sk: "NULL", key: "_key", "valid_from": ts, "valid_to": f"timestamp'{X.OPEN_END}'", "is_current": "true", "row_hash": "_hash",
    }

    def version(values: Mapping[str, str], state: str, keep: str) -> str:
        fields = [f"'{c}', CAST({values.get(c, c)} AS {dim.schema[c].dataType.simpleString()})" for c in dim.columns]
        return f"IF({keep}, named_struct({', '.join(fields)}, '_state', {state}), NULL)"

    both = ", ".join([
        version(after, "'old'", known), version(begun, f"IF({key} IS NULL, 'first', 'next')", opened),
    ])
    # written, so that the join isn't run once for the old and once for the numbered new versions
    rows = cut(current.join(staged, F.col(key) == F.col("_key"), "full_outer").selectExpr(f"inline(filter(array({both}), v -> v IS NOT NULL))"))
    kept = rows.filter("_state = 'old'").drop("_state")
    seen = closed.selectExpr(f"{key} AS _hk").distinct()
    first = rows.filter("_state = 'first'").join(seen, F.col(key) == F.col("_hk"), "left")
    first = first.withColumn("valid_from", F.expr(f"IF(_hk IS NULL, timestamp'{X.FIRST_SEEN}', valid_from)")).drop("_hk", "_state")
    new = rows.filter("_state = 'next'").drop("_state").unionByName(first)
    return kept.unionByName(_with_new_keys(dim, new, key, sk))


def empty_scd2(stage: DataFrame, key: str, tracked: Sequence[str], sk: str) -> DataFrame:
    """A history-keeping dimension without rows, with the types of `stage`."""
    spark = stage.sparkSession
    head = spark.range(0).select(F.col("id").alias(sk))
    types = {c: stage.schema[c].dataType for c in (key, *tracked)}
    return head.select(
        sk,
        *[F.lit(None).cast(t).alias(c) for c, t in types.items()],
        F.lit(None).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(None).cast("boolean").alias("is_current"),
        F.lit(None).cast("string").alias("row_hash"),
    )
