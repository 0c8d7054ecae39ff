"""Ranks and neighbours in a total order, without a window over all rows.

Rows are dealt out by ranges of the sort keys; each range is numbered by itself and shifted by the sizes of
the ranges before it. Equal keys always lie in one range, and for ranks they are one row with a count, so ties
neither cross a border nor fill a task. What is known of all ranges is one entry per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stargrain.session import cut


def _order(keys: Sequence[str]) -> list[Column]:
    """'-name' sorts descending; NULL comes last either way."""
    return [F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys]


def _ranges(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` with the number of its range, `_p`. Written: the ranges come from a sample and must not be drawn twice."""
    return cut(df.repartitionByRange(*_order(keys)).withColumn("_p", F.spark_partition_id()))


def rank_rows(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """`df` with its rank under `keys` from 1; ties share a rank and skip the next."""
    columns = [k.removeprefix("-") for k in keys]
    placed = _ranges(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), keys)
    sizes = sorted(tuple(r) for r in placed.groupBy("_p").agg(F.sum("_n")).collect())  # one entry per range
    shifts = [(p, sum(n for q, n in sizes if q < p)) for p, _ in sizes]
    placed = placed.join(F.broadcast(df.sparkSession.createDataFrame(shifts, "_p int, _shift long")), "_p")
    inside = F.sum("_n").over(Window.partitionBy("_p").orderBy(*_order(keys)).rowsBetween(Window.unboundedPreceding, -1))
    ranks = placed.select(*[F.col(c).alias(f"_{c}") for c in columns], (F.col("_shift") + F.coalesce(inside, F.lit(0)) + 1).alias(name))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(ranks, same).select(*df.columns, name)


def previous_row(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """`df` with `value` of the row before it under `keys`, which tell all rows apart; NULL on the first row."""
    placed = _ranges(df, keys)
    order = Window.partitionBy("_p").orderBy(*_order(keys))
    numbered = placed.withColumns({"_r": F.row_number().over(order), "_before": F.lag(value).over(order)})
    last = numbered.groupBy("_p").agg(F.max_by(F.struct(F.col(value).alias("v")), "_r").alias("last"))
    ends = sorted(((r[0], r[1].v) for r in last.collect()), key=lambda e: e[0])  # one entry per range
    kind = df.schema[value].dataType.simpleString()
    carried = df.sparkSession.createDataFrame([(p, v) for (p, _), (_, v) in zip(ends[1:], ends)], f"_p int, _carried {kind}")
    return numbered.join(F.broadcast(carried), "_p", "left").select(
        *df.columns, F.when(F.col("_r") > 1, F.col("_before")).otherwise(F.col("_carried")).alias(name))
