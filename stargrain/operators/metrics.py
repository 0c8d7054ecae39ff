"""Threshold alerts over the newest run, ranking, day-over-day change, and the metric registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators.ranking import previous_row, rank_rows


# --- thresholds -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Cause:
    """One alert cause: `measure` >= `threshold`. Its count is reported as `slots`."""

    name: str
    measure: str
    threshold: float
    slots: str


def flag_causes(df: DataFrame, causes: Sequence[Cause]) -> DataFrame:
    """Boolean column per cause plus `alert` (any cause). A NULL measure never raises an alert."""
    flags = {c.name: F.col(c.measure) >= F.lit(c.threshold) for c in causes}
    out = df.withColumns(flags)
    any_cause = F.lit(False)
    for c in causes:
        any_cause = any_cause | F.col(c.name)
    return out.withColumn("alert", F.coalesce(any_cause, F.lit(False)))


def _count_if(flag: str, name: str) -> Column:
    return F.count_if(F.col(flag)).alias(name)


# --- alert queries --------------------------------------------------------------------------
# Output names are those of the weather subject area; `names` maps them for other areas.

def alert_entities(slots: DataFrame, group: Mapping[str, str], causes: Sequence[Cause]) -> DataFrame:
    """Entities with at least one alert slot, by cause. `group` maps column -> output name.

    Names alone are no key: with the entity's code in `group`, entities of one name stay apart.
    """
    flagged = flag_causes(slots, causes)
    per = flagged.groupBy(*[F.col(c).alias(n) for c, n in group.items()]).agg(
        _count_if("alert", "slot_siaga"),
        *[_count_if(c.name, c.slots) for c in causes],
        F.count(F.lit(1)).alias("slot_total"),
    )
    return (
        per.filter("slot_siaga > 0")
        .withColumn("rasio_siaga", X.share_2("slot_siaga", "slot_total"))
        .orderBy(F.desc("slot_siaga"), F.desc("rasio_siaga"), *group.values())
    )


def alert_rank(
    slots: DataFrame, entity: str, area: str, causes: Sequence[Cause], maxima: Mapping[str, str], area_name: str = "kecamatan"
) -> DataFrame:
    """Areas ranked by the share of their entities in alert, then by alert slots.

    Ties share a rank and skip the next. Areas are numbered by ranges (`rank_rows`), not in one task. Shares are
    compared exactly by their unrounded quotient.
    """
    per_entity = flag_causes(slots, causes).groupBy(area, entity).agg(
        _count_if("alert", "_slots"), *[F.max(m).alias(n) for m, n in maxima.items()]
    )
    per_area = per_entity.groupBy(F.col(area).alias(area_name)).agg(
        F.count(F.lit(1)).alias("desa_total"),
        F.count_if(F.col("_slots") > 0).alias("desa_siaga"),
        F.sum("_slots").cast("bigint").alias("slot_siaga"),
        *[F.max(n).alias(n) for n in maxima.values()],
    )
    share = F.col("desa_siaga").cast("double") / F.col("desa_total")
    ranked = rank_rows(per_area.withColumn("_share", share), ["-_share", "-slot_siaga"], "peringkat")
    return ranked.select(
        F.col("peringkat").cast("int").alias("peringkat"),
        area_name, "desa_total", "desa_siaga",
        X.share_2("desa_siaga", "desa_total").alias("rasio_desa"),
        "slot_siaga", *maxima.values(),
    ).orderBy("peringkat", area_name)


def alert_daily(slots: DataFrame, entity: str, day: Sequence[str], causes: Sequence[Cause], maxima: Mapping[str, str]) -> DataFrame:
    """Per day: entities, slots, entities in alert, slots by cause, maxima, change of entities in
    alert against the previous row (not the previous calendar day; NULL on the first row).

    Entities are counted from one row per (day, entity): distinct counting without expanding the
    slots, and one shuffle whose input is already combined on the map side.
    """
    per_entity = flag_causes(slots, causes).groupBy(*day, entity).agg(
        F.count(F.lit(1)).alias("_n"),
        _count_if("alert", "_alerts"),
        *[_count_if(c.name, "_" + c.slots) for c in causes],
        *[F.max(m).alias("_" + n) for m, n in maxima.items()],
    )
    per_day = per_entity.groupBy(*day).agg(
        F.count(entity).alias("desa_total"),
        F.sum("_n").cast("bigint").alias("slot_total"),
        F.count_if((F.col("_alerts") > 0) & F.col(entity).isNotNull()).alias("desa_siaga"),
        F.sum("_alerts").cast("bigint").alias("slot_siaga"),
        *[F.sum("_" + c.slots).cast("bigint").alias(c.slots) for c in causes],
        *[F.max("_" + n).alias(n) for n in maxima.values()],
    )
    before = previous_row(per_day, [day[0]], "desa_siaga", "_previous")
    return before.withColumn("perubahan_desa_siaga", F.col("desa_siaga") - F.col("_previous")).drop("_previous").orderBy(day[0])


def present_per_day(slots: DataFrame, entity: str, day: str, name: str = "ada") -> DataFrame:
    """(day, entities there): those whose first day is not later and whose last is not earlier. One that joins or
    leaves counts from its first to its last day only."""
    span = slots.filter(F.col(entity).isNotNull()).groupBy(entity).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    return span.select(F.explode(F.sequence("_a", "_b")).alias(day)).groupBy(day).agg(F.count(F.lit(1)).alias(name))


# --- registry -------------------------------------------------------------------------------

class MetricError(ValueError):
    """A metric was asked for in a way its definition forbids."""


@dataclass(frozen=True)
class Metric:
    """Dictionary entry and calculation of one metric: entities with at least one alert slot."""

    name: str
    definition: str
    formula: str
    grain: str
    sources: tuple[str, ...]
    owner: str
    time_basis: str
    unit: str
    dimensions: tuple[str, ...]
    default_filter: str | None
    empty_meaning: str
    version: int
    entity: str
    causes: tuple[Cause, ...]
    numerator: str = "desa_siaga"
    denominator: str = "desa_total"

    def compute(self, slots: DataFrame, by: Sequence[str] = (), where: str | None = None) -> DataFrame:
        """Value per `by`, over newest-run slots joined with their dimensions.

        Without `by` the whole window is counted as distinct entities; adding up days is wrong
        because one entity may be in alert on several days.
        """
        refused = [c for c in by if c not in self.dimensions]
        if refused:
            raise MetricError(f"{self.name} may not be sliced by {refused}; allowed: {list(self.dimensions)}")
        where = where or self.default_filter
        if where:
            slots = slots.filter(F.expr(where))
        per_entity = flag_causes(slots, self.causes).groupBy(*by, self.entity).agg(F.max("alert").alias("_alert"))
        return per_entity.filter(F.col(self.entity).isNotNull()).groupBy(*by).agg(
            F.count_if("_alert").alias(self.numerator), F.count(F.lit(1)).alias(self.denominator)
        )

    def with_thresholds(self, **thresholds: float) -> "Metric":
        """New thresholds make a new version of the metric, never a silent edit."""
        names = {c.name for c in self.causes}
        if set(thresholds) - names:
            raise MetricError(f"unknown causes {sorted(set(thresholds) - names)}")
        causes = tuple(Cause(c.name, c.measure, thresholds.get(c.name, c.threshold), c.slots) for c in self.causes)
        if causes == self.causes:
            return self
        return Metric(**{**self.__dict__, "causes": causes, "version": self.version + 1})


@dataclass
class MetricRegistry:
    metrics: dict[tuple[str, int], Metric] = field(default_factory=dict)

    def add(self, metric: Metric) -> Metric:
        known = self.metrics.get((metric.name, metric.version))
        if known is not None and known != metric:
            raise MetricError(f"{metric.name} v{metric.version} exists with another definition; raise the version")
        self.metrics[(metric.name, metric.version)] = metric
        return metric

    def get(self, name: str, version: int | None = None) -> Metric:
        versions = [v for n, v in self.metrics if n == name]
        if not versions or (version is not None and version not in versions):
            raise MetricError(f"unknown metric {name} v{version}")
        return self.metrics[(name, max(versions) if version is None else version)]


# --- additivity -----------------------------------------------------------------------------

ADDITIVE, SEMI, NON, CIRCULAR = "additive", "semi-additive", "non-additive", "circular"


@dataclass(frozen=True)
class Measure:
    """A fact column with its additivity. `how` lists the aggregates that make sense."""

    column: str
    additivity: str
    how: tuple[str, ...] = ("avg", "min", "max")

    def check(self, how: str) -> None:
        if how not in self.how:
            raise MetricError(f"{how}({self.column}) is meaningless: {self.additivity}, use {list(self.how)}")


def _exact(c: str) -> Column:
    """Values as decimals, whose sum doesn't depend on the order in which partitions arrive."""
    return F.col(c).cast("decimal(28,6)")


def _sum(c: str, kind: str) -> Column:
    return F.sum(_exact(c)).cast("double") if kind in ("double", "float") else F.sum(c)


def _avg(c: str, kind: str) -> Column:
    return (F.sum(_exact(c)).cast("double") / F.count(c)) if kind in ("double", "float") else F.avg(c)


_SIMPLE = {"min": F.min, "max": F.max, "circular_mean": X.circular_mean}


def _one(measure: Measure, how: str, kind: str) -> Column:
    """Aggregate of rows that lie on one level: no place is added over."""
    if how in ("sum", "avg"):
        return (_sum if how == "sum" else _avg)(measure.column, kind)
    return _SIMPLE[how](measure.column)


def aggregate(df: DataFrame, measure: Measure, how: str, by: Sequence[str] = (), place: str | None = None, name: str | None = None) -> DataFrame:
    """Aggregate one measure, refusing what its additivity forbids.

    A semi-additive measure adds up over time but not over places: with `place` given, it is
    summed per place and those sums are averaged.
    """
    return aggregates(df, [(measure, how, name or f"{how}_{measure.column}")], by, place)


def aggregates(df: DataFrame, wanted: Sequence[tuple[Measure, str, str]], by: Sequence[str] = (), place: str | None = None) -> DataFrame:
    """Several (measure, how, output name) of one frame in one pass, each refused or not as by `aggregate`.

    Sums of semi-additive measures need a level of their own, one row per place; they are computed together there,
    and joined with the others, if there are others, on `by`.
    """
    kinds = {m.column: df.schema[m.column].dataType.typeName() for m, _, _ in wanted}
    per_place, flat = [], []
    for measure, how, name in wanted:
        measure.check(how)
        spread = measure.additivity == SEMI and how == "sum"
        if spread and place is None:
            raise MetricError(f"sum({measure.column}) needs the place column: it must not be added over places")
        if spread and place not in by:
            per_place.append((measure, name))
        else:
            flat.append(_one(measure, how, kinds[measure.column]).alias(name))
    one = df.groupBy(*by).agg(*flat) if flat else None
    if not per_place:
        return one
    sums = df.groupBy(*by, place).agg(*[F.sum(_exact(m.column)).alias(name) for m, name in per_place])
    averaged = sums.groupBy(*by).agg(*[(F.sum(name).cast("double") / F.count(name)).alias(name) for _, name in per_place])
    if one is None:
        return averaged
    # NULL groups of both sides belong together
    other = averaged.select(*[F.col(c).alias(f"_{c}") for c in by], *[name for _, name in per_place])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return one.join(other, same).select(*by, *[name for _, _, name in wanted])
