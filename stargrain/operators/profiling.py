"""Profiling of raw, untyped tables: counts only, never rows.

A `TableProfile` says what to look at; `profile` returns one long frame
(table, check, metric, value) in which every value is text, ready for JSON or markdown.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.operators import marks
from stargrain.operators.marks import Marks
from stargrain.operators.rows import frequency

PROFILE_COLUMNS = ("table", "check", "metric", "value")


@dataclass(frozen=True)
class TableProfile:
    """What to profile in one table.

    typed        name -> SQL of a column read from text; computed once per row for all scalars
    scalars      metric name -> SQL aggregate; all of a table are computed in one pass
    examples     metric name -> column whose smallest text is shown
    distinct     metric name -> column whose distinct non-NULL values are counted
    duplicates   metric name -> key columns; counts key values occurring more than once
    frequencies  check name -> columns; one output row per value combination
    orphans      metric name -> (foreign key, parent table, parent key)
    childless    metric name -> (key, child table, child foreign key)
    """

    table: str
    typed: Mapping[str, str] = field(default_factory=dict)
    scalars: Mapping[str, str] = field(default_factory=dict)
    examples: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)
    duplicates: Mapping[str, Sequence[str]] = field(default_factory=dict)
    frequencies: Mapping[str, Sequence[str]] = field(default_factory=dict)
    orphans: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)
    childless: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)


def scalar_profile(df: DataFrame, spec: TableProfile, approximate: bool = False) -> DataFrame:
    """One row with every scalar, example and distinct count of a table, from one scan.

    Several exact distinct counts are counted from marks, combined before they are shuffled;
    `approximate` uses sketches instead, for first looks at very large sources.
    """
    if len(spec.distinct) < 2 or approximate:
        distinct = F.approx_count_distinct if approximate else F.count_distinct
        if spec.typed:
            df = df.select("*", *[F.expr(sql).alias(name) for name, sql in spec.typed.items()])
        aggs = [F.expr(sql).alias(name) for name, sql in spec.scalars.items()]
        aggs += [F.min(c).alias(name) for name, c in spec.examples.items()]
        return df.agg(*aggs, *[distinct(F.col(c)).alias(name) for name, c in spec.distinct.items()])
    columns = {c: [c] for c in (*spec.examples.values(), *spec.distinct.values())}
    m = Marks(spec.typed, spec.scalars, columns)
    of_none = marks.empty_scalars(df, m)
    mine = lambda c: F.col("set") == c
    aggs = [F.coalesce(F.max(F.when(mine(marks.ROWS), F.col(f"`{name}`"))), F.lit(of_none[name])).alias(name) for name in spec.scalars]
    aggs += [F.min(F.when(mine(c), F.get("key", F.lit(0)))).alias(name) for name, c in spec.examples.items()]
    aggs += [F.count_if(mine(c) & marks.present()).alias(name) for name, c in spec.distinct.items()]
    return marks.counted(df, m).agg(*aggs)


def frequencies(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """Value frequencies, most frequent first."""
    return frequency(df, columns, name).orderBy(F.desc(name), *[F.col(c).asc_nulls_last() for c in columns])


def _set(table: str, columns: Sequence[str]) -> str:
    return f"{table}: {', '.join(columns)}"


def _plan(specs: Sequence[TableProfile]) -> tuple[dict[str, Marks], list[tuple], list[tuple]]:
    """What each table marks; (set, kind, bit, table, check, metric) of the metrics; and the same of the frequencies.
    Checks of the same columns share a set."""
    typed, scalars, sets, parents = {}, {}, {}, {}
    metrics, listed = [], []

    def key(table: str, columns: Sequence[str]) -> str:
        name = _set(table, columns)
        sets.setdefault(table, {})[name] = tuple(columns)
        return name

    bits: dict[str, int] = {}
    for s in specs:
        typed.setdefault(s.table, {}).update(s.typed)
        scalars.setdefault(s.table, {}).update(s.scalars)
        metrics += [(key(s.table, [c]), "example", 0, s.table, "scalars", n) for n, c in s.examples.items()]
        metrics += [(key(s.table, [c]), "distinct", 0, s.table, "scalars", n) for n, c in s.distinct.items()]
        metrics += [(key(s.table, cs), "duplicates", 0, s.table, "duplicates", n) for n, cs in s.duplicates.items()]
        for check, wanted in (("orphans", s.orphans), ("childless", s.childless)):
            for n, (column, ref, ref_column) in wanted.items():
                name = key(s.table, [column])
                bit = bits[name] = bits.get(name, -1) + 1
                parents.setdefault(ref, {})[name, bit] = ref_column
                metrics.append((name, "orphans", bit, s.table, check, n))
        listed += [(key(s.table, cs), "frequency", 0, s.table, "frequency", n) for n, cs in s.frequencies.items()]
    names = {*typed, *scalars, *sets, *parents}
    plan = {t: Marks(typed.get(t, {}), scalars.get(t, {}), sets.get(t, {}), parents.get(t, {})) for t in sorted(names)}
    return {t: m for t, m in plan.items() if m.scalars or m.sets or m.parents}, metrics, listed


def profile(tables: Mapping[str, DataFrame], specs: Sequence[TableProfile], approximate: bool = False) -> DataFrame:
    """All metrics of the specs, each table scanned once (`marks`). With `approximate`, distinct
    counts come from sketches, in a scan of their own, and the other checks stay exact."""
    if approximate:
        rough = [_sketched(tables[s.table], s) for s in specs if s.distinct]
        exact = [replace(s, distinct={}) for s in specs]
        return reduce(DataFrame.union, [profile(tables, exact), *rough])
    plan, metrics, listed = _plan(specs)
    keys = marks.together(tables, plan)
    frequent = sorted({m[0] for m in listed})
    # a row of a frequency stays a row; all keys of a set give one more
    either = F.array(
        F.when((F.col("set") == marks.ROWS) | F.col("set").isin(frequent) & (F.col("n") > 0), F.struct(F.col("key").alias("row"))),
        F.when(F.col("set") != marks.ROWS, F.struct(F.lit(None).cast("array<string>").alias("row"))))
    bits = 1 + max((m[2] for m in metrics), default=0)
    own = F.col("n") > 0
    sums = keys.select("*", F.inline(F.array_compact(either))).groupBy("set", "row").agg(
        F.sum("n").alias("n"), F.count_if(own & marks.present()).alias("distinct"), F.count_if(F.col("n") > 1).alias("duplicates"),
        *[F.sum(F.when(marks.is_orphan(b), F.col("n")).otherwise(0)).alias(f"orphans{b}") for b in range(bits)],
        *([F.min(F.get("key", F.lit(0))).alias("example")] if any(m[1] == "example" for m in metrics) else []))
    spark = keys.sparkSession
    schema = "set string, kind string, bit int, table string, check string, metric string"
    wanted = spark.createDataFrame([*metrics, *listed], schema)  # one row per metric
    orphans = F.coalesce(*[F.when(F.col("bit") == b, F.col(f"orphans{b}")) for b in range(bits)])
    label = F.concat_ws(" | ", F.transform("row", lambda x: F.coalesce(x, F.lit("NULL"))))
    value = (F.when(F.col("kind") == "distinct", F.col("distinct")).when(F.col("kind") == "duplicates", F.col("duplicates"))
             .when(F.col("kind") == "orphans", orphans).otherwise(F.col("n"))).cast("string")
    if any(m[1] == "example" for m in metrics):
        value = F.when(F.col("kind") == "example", F.col("example")).otherwise(value)
    is_list = F.col("kind") == "frequency"
    joined = sums.join(F.broadcast(wanted), "set", "left").filter((F.col("set") == marks.ROWS) | (is_list == F.col("row").isNotNull()))
    got = joined.select(
        F.coalesce("table", F.get("row", F.lit(0))).alias("table"), F.coalesce("check", F.lit("scalars")).alias("check"),
        F.when(F.col("set") == marks.ROWS, F.get("row", F.lit(1))).when(is_list, F.concat("metric", F.lit(": "), label)).otherwise(F.col("metric")).alias("metric"),
        F.when(F.col("set") == marks.ROWS, F.get("row", F.lit(2))).otherwise(value).alias("value"), F.lit(True).alias("found"))
    # tables without rows mark nothing
    of_none = [(t, "scalars", n, None if v is None else str(v)) for t, m in plan.items() for n, v in marks.empty_scalars(tables[t], m).items()]
    of_none += [(t, check, n, None if kind == "example" else "0") for _, kind, _, t, check, n in metrics]
    if not of_none:
        return got.select(*PROFILE_COLUMNS)
    unless = spark.createDataFrame(of_none, "table string, check string, metric string, otherwise string")
    return got.join(unless, ["table", "check", "metric"], "full").select(
        "table", "check", "metric", F.when(F.col("found"), F.col("value")).otherwise(F.col("otherwise")).alias("value"))


def _sketched(df: DataFrame, spec: TableProfile) -> DataFrame:
    one = df.agg(*[F.approx_count_distinct(F.col(c)).alias(name) for name, c in spec.distinct.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("string").alias("value")) for c in one.columns])
    return one.select(F.lit(spec.table).alias("table"), F.lit("scalars").alias("check"), F.inline(pairs))


# --- sketches -------------------------------------------------------------------------------
# Exact profiles are the default. Sketches of a month can be merged, so that a batch of a very large source is profiled
# without reading older rows again.

#: log2 of the registers of a distinct-count sketch, and three standard errors of its estimate
REGISTERS, DISTINCT_ERROR = 14, 3 * 1.04 / 2**7
#: k of a quantile sketch, and a bound on how far the rank of its median lies off (99 of 100 sketches)
QUANTILES, RANK_ERROR = 400, 0.01


def sketch_numbers(df: DataFrame, column: str) -> Column:
    """Whole number that stands for a column's value in a quantile sketch: days of a date, the number rounded
    down; a text that is no number has none."""
    kind = df.schema[column].dataType.simpleString()
    c = F.col(f"`{column}`")
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_date(c.cast("date")).cast("bigint")
    return F.floor(c.try_cast("double")).cast("bigint")


def sketches(df: DataFrame, columns: Sequence[str], month: str) -> DataFrame:
    """(month, kolom, terisi, unik, nilai): per month and column the filled values, a distinct-count sketch and a
    quantile sketch, from one scan."""
    marks_of = [F.struct(F.lit(c).alias("kolom"), F.col(f"`{c}`").cast("string").alias("v"), sketch_numbers(df, c).alias("x")) for c in columns]
    return df.select(month, F.inline(F.array(*marks_of))).groupBy(month, "kolom").agg(
        F.count("v").alias("terisi"), F.hll_sketch_agg("v", REGISTERS).alias("unik"), F.kll_sketch_agg_bigint("x", QUANTILES).alias("nilai"))


def merged_sketches(kept: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of equal `by` and column as one; without `by`, of a column."""
    return kept.groupBy(*by, "kolom").agg(
        F.sum("terisi").alias("terisi"), F.hll_union_agg("unik").alias("unik"), F.kll_merge_agg_bigint("nilai").alias("nilai"))


def sketch_profile(kept: DataFrame) -> DataFrame:
    """(kolom, terisi, perkiraan_unik, median) over all months of `kept`; a column without numbers has no median."""
    one = merged_sketches(kept, [])
    some = F.kll_sketch_get_n_bigint("nilai") > 0
    return one.select("kolom", "terisi", F.hll_sketch_estimate("unik").alias("perkiraan_unik"),
                      F.when(some, F.kll_sketch_get_quantile_bigint("nilai", F.lit(0.5))).alias("median"))


def write_profile(result: DataFrame, path: str) -> None:
    """Profile as JSON lines, written by the executors."""
    result.write.mode("overwrite").json(path)


def write_markdown(result: DataFrame, path: str, title: str) -> None:
    """Markdown report, written by the executors in order: a heading and a table per profiled table,
    one part file after the other. A frequency of very many values makes a long report, not a large driver."""
    cell = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[|\r\n]", " ")
    line = F.concat(F.lit("| "), cell("check"), F.lit(" | "), cell("metric"), F.lit(" | "), cell("value"), F.lit(" |"))
    head = F.concat(F.lit("## "), F.col("table"), F.lit("\n\n| check | metric | value |\n|---|---|---|"))
    rows = result.select("table", "check", "metric", line.alias("value"))
    heads = result.select("table").distinct().select("table", F.lit("").alias("check"), F.lit("").alias("metric"), head.alias("value"))
    top = result.sparkSession.range(1).select(F.lit("").alias("table"), F.lit("").alias("check"), F.lit("").alias("metric"), F.lit(f"# {title}").alias("value"))
    top.union(heads).union(rows).orderBy("table", "check", "metric").select("value").write.mode("overwrite").text(path)


#: rows up to which a report is made on the driver
REPORT_ROWS = 10_000


def _few(result: DataFrame) -> list:
    rows = result.orderBy("table", "check", "metric").limit(REPORT_ROWS + 1).collect()
    if len(rows) > REPORT_ROWS:
        raise ValueError(f"more than {REPORT_ROWS} rows; write_markdown and write_profile let the executors write them")
    return rows


def profile_markdown(result: DataFrame, title: str) -> str:
    """The same report as one text; raises beyond REPORT_ROWS rows."""
    out, table = [f"# {title}", ""], None
    for r in _few(result):
        if r.table != table:
            table = r.table
            out += [f"## {table}", "", "| check | metric | value |", "|---|---|---|"]
        out.append(f"| {r.check} | {r.metric} | {'' if r.value is None else r.value} |")
    return "\n".join(out) + "\n"


def profile_json(result: DataFrame) -> str:
    """The profile as one JSON text; raises beyond REPORT_ROWS rows."""
    return json.dumps([r.asDict() for r in _few(result)], indent=2, ensure_ascii=False)
