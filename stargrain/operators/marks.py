"""Many checks of a table from one scan: every row marks its keys, and marks are counted together.

A row gives one mark (set, key) for each key set that is looked at, and one for the row itself. Marks are combined in
the tasks that read the table and shuffled once, whatever the number of checks. Distinct values,
repeated keys, frequencies and rows without a parent are all read off the counted marks; single
aggregates of the rows ride on the row's own mark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: set of the marks that stand for rows
ROWS = "#"


@dataclass(frozen=True)
class Marks:
    """What the rows of one table mark.

    typed    name -> SQL of a column computed once per row
    scalars  name -> SQL aggregate over the rows. One of text type makes Spark sort the marks: Spark's hash
             aggregation holds no text; `sets` finds the smallest text without
    sets     id -> columns of a key
    parents  (set id, bit) -> column whose values are parents of that set, in this or another table
    flags    name -> SQL predicate: rows that satisfy it are counted. Only they give a mark, which is counted with the
             keys, so a table with flags needs no round of its own as one with scalars does
    """

    typed: Mapping[str, str] = field(default_factory=dict)
    scalars: Mapping[str, str] = field(default_factory=dict)
    sets: Mapping[str, Sequence[str]] = field(default_factory=dict)
    parents: Mapping[tuple[str, int], str] = field(default_factory=dict)
    flags: Mapping[str, str] = field(default_factory=dict)


def _text(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.simpleString()
    value = F.col(f"`{column}`")
    if kind in ("double", "float"):
        value = F.when(value == 0, F.lit(0.0)).otherwise(value)  # -0.0 is 0.0
    return value.cast("string")


@dataclass(frozen=True)
class _Layout:
    """How marks are written while they are counted. Columns whose values are compared with each other are sides of one
    domain, and a row marks a side once, whatever the number of sets and parents that read it."""

    #: (table, columns) -> (domain, side)
    places: Mapping[tuple[str, tuple[str, ...]], tuple[int, int]]
    #: (domain, set, sides whose rows are counted, (bit, side) of parents)
    views: Sequence[tuple[int, str, Sequence[int], Sequence[tuple[int, int]]]]
    widths: Mapping[int, int]
    keys: Sequence[str]
    counts: Sequence[str]
    #: (table, name) -> domain of the rows that a flag marks
    flags: Mapping[tuple[str, str], int]


def _layout(plan: Mapping[str, Marks]) -> _Layout:
    own: dict[str, list] = {}
    refs: dict[str, list] = {}
    for t, m in plan.items():
        for name, columns in m.sets.items():
            own.setdefault(name, []).append((t, tuple(columns)))
        for (name, bit), c in m.parents.items():
            refs.setdefault(name, []).append((bit, (t, (c,))))
    names = sorted({*own, *refs})
    nodes = sorted({n for name in names for n in (*own.get(name, ()), *[n for _, n in refs.get(name, ())])})
    group = {n: k for k, n in enumerate(nodes)}
    for name in names:
        met = [*own.get(name, ()), *[n for _, n in refs.get(name, ())]]
        for n in met:  # keys of different width never match
            first = next(x for x in met if len(x[1]) == len(n[1]))
            group = {x: group[first] if g == group[n] else g for x, g in group.items()}
    sides: dict[int, list] = {}
    for n in nodes:
        sides.setdefault(group[n], []).append(n)
    domains = list(sides.values())
    places = {n: (d, side) for d, ns in enumerate(domains) for side, n in enumerate(ns)}
    views = [(d, name, [places[n][1] for n in own.get(name, ()) if places[n][0] == d], [(bit, places[n][1]) for bit, n in refs.get(name, ()) if places[n][0] == d])
             for name in names for d in sorted({places[n][0] for n in (*own.get(name, ()), *[n for _, n in refs.get(name, ())])})]
    widths = {d: len(ns[0][1]) for d, ns in enumerate(domains)}
    width = max([3 if any(m.scalars for m in plan.values()) else 1, *widths.values()])
    most = max([1, *[len(ns) for ns in domains]])
    flags = {(t, name): _ROWS - 1 - i for i, (t, name) in enumerate((t, name) for t, m in plan.items() for name in m.flags)}
    return _Layout(places, views, widths, [f"_k{i}" for i in range(width)], [f"_n{i}" for i in range(most)], flags)


#: domain of the marks that stand for rows; those of flags lie below
_ROWS = -1


def _spread(df: DataFrame, table: str, m: Marks, to: _Layout) -> DataFrame:
    """The rows, once for each of their marks, with the mark as `_m`: domain, side and key columns. A number and plain texts
    take less than half of the memory that a set's name and an array do, and there is one such row for each key."""
    if m.typed:
        df = df.select("*", *[F.expr(sql).alias(name) for name, sql in m.typed.items()])

    def mark(domain: int, side: int, texts: Sequence[Column]) -> Column:
        padded = [*texts, *[F.lit(None)] * (len(to.keys) - len(texts))]
        return F.struct(F.lit(domain).alias("d"), F.lit(side).alias("side"), *[c.cast("string").alias(k) for k, c in zip(to.keys, padded)])

    marks = [mark(_ROWS, 0, [])] if m.scalars else []
    marks += [mark(d, side, [_text(df, c) for c in columns]) for (t, columns), (d, side) in to.places.items() if t == table]
    if m.flags:
        marks += [F.when(F.expr(sql), mark(to.flags[table, name], 0, [])) for name, sql in m.flags.items()]
        return df.withColumn("_m", F.explode(F.array(*marks))).filter("_m IS NOT NULL")
    return df.withColumn("_m", F.explode(F.array(*marks)))


def _grouped(spread: DataFrame, m: Marks, to: _Layout) -> DataFrame:
    counts = [F.count_if(F.col("_m.side") == j).alias(n) for j, n in enumerate(to.counts)]
    return spread.groupBy(F.col("_m.d").alias("_d"), *[F.col(f"_m.{k}").alias(k) for k in to.keys]).agg(
        *counts, *[F.expr(sql).alias(name) for name, sql in m.scalars.items()])


def _views(found: DataFrame, to: _Layout, rows: Column, more: Sequence[str] = ()) -> DataFrame:
    """(set, key, n, refs) of counted marks: each set as it sees its domain."""
    long = lambda x: F.lit(x).cast("long")
    one = lambda name, key, n, refs: F.struct(F.lit(name).alias("set"), key.cast("array<string>").alias("key"), n.alias("n"), refs.alias("refs"))
    seen = F.when(F.col("_d") == _ROWS, F.array(one(ROWS, rows, F.col(to.counts[0]), long(0))))
    for (table, name), d in to.flags.items():
        seen = seen.when(F.col("_d") == d, F.array(one(ROWS, F.array(F.lit(table), F.lit(name), F.col(to.counts[0]).cast("string")), F.col(to.counts[0]), long(0))))
    for d in sorted({v[0] for v in to.views}):
        key = F.array(*to.keys[:to.widths[d]])
        of_d = []
        for _, name, own, parents in [v for v in to.views if v[0] == d]:
            n = reduce(Column.__add__, [F.col(to.counts[side]) for side in own], long(0))
            bits = [F.when(F.col(to.counts[side]) > 0, long(1 << bit)).otherwise(long(0)) for bit, side in parents]
            of_d.append(one(name, key, n, reduce(Column.bitwiseOR, bits, long(0))))
        seen = seen.when(F.col("_d") == d, F.array(*of_d))
    return found.select(F.inline(seen), *more).filter((F.col("set") == ROWS) | (F.col("n") > 0) | (F.col("refs") != 0))


def counted(df: DataFrame, m: Marks) -> DataFrame:
    """(set, key array<string>, n, refs, scalars...): how many rows mark the key, and for which bits it is a parent.
    Scalars hold on the row of set ROWS only."""
    to = _layout({"": m})
    return _views(_grouped(_spread(df, "", m, to), m, to), to, F.array(), [f"`{name}`" for name in m.scalars])


def empty_scalars(df: DataFrame, m: Marks) -> dict[str, object]:
    """Scalars of no rows: 0 for counts, None for extremes. Spark answers without reading the table."""
    if not m.scalars:
        return {}
    none = df.limit(0)
    if m.typed:
        none = none.select("*", *[F.expr(sql).alias(name) for name, sql in m.typed.items()])
    return none.agg(*[F.expr(sql).alias(name) for name, sql in m.scalars.items()]).first().asDict()


def together(tables: Mapping[str, DataFrame], plan: Mapping[str, Marks]) -> DataFrame:
    """(set, key, n, refs) over all tables of `plan`; each table is scanned once. The scalars of a table, and those
    of its flags that a row satisfies, are rows of set ROWS, with (table, name, value) as key."""
    to = _layout(plan)
    parts = []
    for name, m in plan.items():
        spread = _spread(tables[name], name, m, to)
        if not m.scalars:  # counted below, with the other tables
            parts.append(spread.select(F.col("_m.d").alias("_d"), *[f"_m.{k}" for k in to.keys],
                                       *[(F.col("_m.side") == j).cast("long").alias(n) for j, n in enumerate(to.counts)]))
            continue
        none = [F.lit(0).cast("long").alias(n) for n in to.counts]
        empty = [F.lit(None).cast("string").alias(k) for k in to.keys[3:]]
        pairs = F.array(*[
            F.struct(F.lit(name).alias(to.keys[0]), F.lit(s).alias(to.keys[1]), F.col(f"`{s}`").cast("string").alias(to.keys[2]), *empty, *none) for s in m.scalars])
        own = F.array(F.struct(*to.keys, *to.counts))
        parts.append(_grouped(spread, m, to).select("_d", F.inline(F.when(F.col("_d") == _ROWS, pairs).otherwise(own))))
    found = reduce(DataFrame.union, parts)
    if len(parts) > 1 or not any(m.scalars for m in plan.values()):
        found = found.groupBy("_d", *to.keys).agg(*[F.sum(n).alias(n) for n in to.counts])
    return _views(found, to, F.array(*to.keys[:3]))


def present() -> Column:
    """The key holds a value (of its first column)."""
    return F.get("key", F.lit(0)).isNotNull()


def is_orphan(bit: int) -> Column:
    """No parent of this bit has the key; NULL is no key of a parent."""
    return ~present() | (F.col("refs").bitwiseAND(1 << bit) == 0)
