"""Small relational helpers shared by the other operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def literal_row(spark: SparkSession, schema: T.StructType, values: Mapping[str, object]) -> DataFrame:
    """One row of literals in the given schema; columns not named are NULL."""
    unknown = set(values) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"columns not in schema: {sorted(unknown)}")
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under `order`.

    Filtering row_number to 1 lets Catalyst keep one row per key in every input partition before
    the shuffle (WindowGroupLimit), so a key holding a third of all rows stays cheap.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def numbered_copies(df: DataFrame, name: str) -> DataFrame:
    """Equal rows numbered from 1 (NULL equals NULL). They are counted and spread out again, so very many copies of
    a row are combined before the shuffle and never sorted."""
    block = 10_000
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", F.explode(F.expr(f"sequence(0, (_n - 1) div {block})")))
    numbers = F.expr(f"sequence(CAST(_b * {block} + 1 AS INT), CAST(least(_n, (_b + 1) * {block}) AS INT))")
    return counted.withColumn(name, F.explode(numbers)).drop("_n", "_b")


def duplicate_groups(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """One row: how many key values occur more than once (NULL is a key value)."""
    return df.groupBy(*keys).count().filter("count > 1").agg(F.count(F.lit(1)).alias(name))


def without_match(df: DataFrame, key: str, ref: DataFrame, ref_key: str) -> DataFrame:
    """Rows of a reduced frame (grouped, or first per key) whose key is not in `ref`; NULL is not.

    Written as an outer join: an anti join would be moved below the grouping by the optimizer, and
    the raw rows of a hot key would meet in one join task instead of being combined first.
    """
    known = ref.select(F.col(ref_key).alias("_pk")).distinct().withColumn("_known", F.lit(True))
    return df.join(known, F.col(key) == F.col("_pk"), "left").filter("_known IS NULL").drop("_pk", "_known")


def orphan_keys(df: DataFrame, fk: str, ref: DataFrame, ref_key: str) -> DataFrame:
    """(fk, rows) for foreign keys without a parent; a NULL key has none. Both sides shrink to
    distinct keys before they are shuffled to the join."""
    return without_match(frequency(df, [fk], "rows"), fk, ref, ref_key)


def orphan_rows(df: DataFrame, fk: str, ref: DataFrame, ref_key: str, name: str = "n") -> DataFrame:
    """One row: number of child rows without a parent."""
    found = orphan_keys(df, fk, ref, ref_key)
    return found.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias(name))


def one_row(*frames: DataFrame) -> DataFrame:
    """Columns of several one-row frames side by side, as scalar subqueries."""
    base = frames[0].sparkSession.range(0, 1, 1, 1)
    return base.select(*[f.select(c).scalar().alias(c) for f in frames for c in f.columns])


def frequency(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
