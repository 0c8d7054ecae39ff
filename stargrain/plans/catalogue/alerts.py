"""Newest run, alert queries, the alert metric and additivity-aware aggregates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators import calendar, facts, metrics
from stargrain.operators.ranking import rank_rows
from stargrain.plans.catalogue.base import NEWEST, PLACES, Tables, events_with_slots, places, query, share_2_sql
from stargrain.session import cut, work_folder
from stargrain.sources.warehouse import Warehouse

AREA = "ASIA"
CAUSES = (
    metrics.Cause("siaga_angin", "ws", 200.0, "slot_angin"),
    metrics.Cause("siaga_suhu", "suhu", 95.0, "slot_suhu"),
)
MAXIMA = {"ws": "ws_maks", "suhu": "t_maks"}
METRIC = metrics.Metric(
    name="desa_siaga_harian",
    definition="Entities with at least one slot on the day whose value reaches 200 or whose k reaches 95.",
    formula="count(distinct user_id) filter (where ws >= 200 or suhu >= 95), newest run per entity and slot",
    grain="one value per day and area",
    sources=("events", "customer", "nation", "region"),
    owner="operations",
    time_basis="calendar day of the event",
    unit="entities",
    dimensions=("tanggal", "n_name", "r_name", "siaga_angin", "siaga_suhu"),
    default_filter=f"r_name = '{AREA}'",
    empty_meaning="0 = slots exist and none is in alert; a day without slots has no row",
    version=1,
    entity="c_custkey",
    causes=CAUSES,
)

AREA_SLOTS = f"""
    SELECT n.*, p.* FROM ({NEWEST}) n JOIN ({PLACES}) p ON p.c_custkey = n.user_id WHERE r_name = '{AREA}'"""
WIND, HEAT = "ws >= 200.0", "suhu >= 95.0"
ALERT = f"({WIND} OR {HEAT})"
DAILY = f"""
    SELECT tanggal, dayname(tanggal) AS nama_hari, count(*) AS desa_total, CAST(sum(slot) AS BIGINT) AS slot_total,
           count(*) FILTER (WHERE siaga > 0) AS desa_siaga, CAST(sum(siaga) AS BIGINT) AS slot_siaga,
           CAST(sum(angin) AS BIGINT) AS slot_angin, CAST(sum(panas) AS BIGINT) AS slot_suhu, max(ws_maks) AS ws_maks, max(t_maks) AS t_maks
    FROM (SELECT tanggal, c_custkey, count(*) AS slot, count(*) FILTER (WHERE {ALERT}) AS siaga, count(*) FILTER (WHERE {WIND}) AS angin,
                 count(*) FILTER (WHERE {HEAT}) AS panas, max(ws) AS ws_maks, max(suhu) AS t_maks
          FROM ({AREA_SLOTS}) s GROUP BY tanggal, c_custkey) per_desa
    GROUP BY tanggal"""


def newest(t: Tables, area: str | None = None) -> DataFrame:
    """Newest run per entity and slot with the place of the entity. A place has one version only,
    so it can be joined, and the area filtered, before rows are shuffled for the window."""
    where = places(t).filter(F.col("r_name") == area) if area else places(t)
    slots = events_with_slots(t).join(where, F.col("user_id") == F.col("c_custkey"))
    return facts.latest_run(slots, ["user_id", "slot"], ["ts", "event_id"])


def with_day(t: Tables, slots: DataFrame) -> DataFrame:
    """Day names from a calendar over the days of the events."""
    span = t.events.agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    days = calendar.date_role(calendar.dim_date_over(span), "tanggal_sk", "hari_kalender").select("tanggal_sk", "nama_hari")
    return slots.withColumn("tanggal_sk", X.date_key("tanggal")).join(days, "tanggal_sk")


@query("latest_run", f"SELECT user_id, slot, event_id, ts, ws, suhu FROM ({NEWEST}) n")
def latest_run(t):
    run = facts.latest_run(events_with_slots(t), ["user_id", "slot"], ["ts", "event_id"])
    return run.select("user_id", "slot", "event_id", "ts", "ws", "suhu")


@query("newest_run_overwrites", f"SELECT user_id, slot, event_id, ts, ws, suhu FROM ({NEWEST}) n")
def newest_run_overwrites(t):
    """The rejected grain without the run: a later batch overwrites, older runs are lost. Both
    batches hold part of one slot, and the result equals the newest run."""
    events = events_with_slots(t)
    run = lambda where: facts.latest_run(events.filter(where), ["user_id", "slot"], ["ts", "event_id"])
    columns = ["user_id", "slot", "event_id", "ts", "ws", "suhu"]
    early = run("ts < TIMESTAMP_NTZ '2024-01-15 13:30:00'").select(*columns)
    late = run("ts >= TIMESTAMP_NTZ '2024-01-15 13:30:00'").select(*columns)
    return facts.merge_fact(early, late, ["user_id", "slot"], ["event_id", "ts", "ws", "suhu"])


@query("alert_entities", f"""
    SELECT n_name AS kecamatan, c_name AS desa, slot_siaga, slot_angin, slot_suhu, slot_total,
           {share_2_sql("slot_siaga", "slot_total")} AS rasio_siaga
    FROM (SELECT n_name, c_name, count(*) FILTER (WHERE {ALERT}) AS slot_siaga,
                 count(*) FILTER (WHERE {WIND}) AS slot_angin, count(*) FILTER (WHERE {HEAT}) AS slot_suhu,
                 count(*) AS slot_total
          FROM ({AREA_SLOTS}) s GROUP BY n_name, c_name HAVING count(*) FILTER (WHERE {ALERT}) > 0) g""")
def alert_entities(t):
    return metrics.alert_entities(newest(t, AREA), {"n_name": "kecamatan", "c_name": "desa"}, CAUSES)


@query("alert_entities_same_name", f"""
    SELECT n_name AS kecamatan, desa, c_custkey AS kode, slot_siaga, slot_angin, slot_suhu, slot_total,
           {share_2_sql("slot_siaga", "slot_total")} AS rasio_siaga
    FROM (SELECT n_name, 'Desa ' || c_custkey % 3 AS desa, c_custkey, count(*) FILTER (WHERE {ALERT}) AS slot_siaga,
                 count(*) FILTER (WHERE {WIND}) AS slot_angin, count(*) FILTER (WHERE {HEAT}) AS slot_suhu, count(*) AS slot_total
          FROM ({AREA_SLOTS}) s GROUP BY n_name, c_custkey HAVING count(*) FILTER (WHERE {ALERT}) > 0) g""")
def alert_entities_same_name(t):
    """Three names for all entities of an area: the code keeps them apart."""
    named = newest(t, AREA).withColumn("desa", F.concat(F.lit("Desa "), F.col("c_custkey") % 3))
    return metrics.alert_entities(named, {"n_name": "kecamatan", "desa": "desa", "c_custkey": "kode"}, CAUSES)


PER_AREA = f"""
    SELECT n_name, count(DISTINCT c_custkey) AS semua, count(DISTINCT CASE WHEN {ALERT} THEN c_custkey END) AS kena,
           count(CASE WHEN {ALERT} THEN 1 END) AS slot, max(ws) AS ws_maks, max(suhu) AS t_maks
    FROM ({AREA_SLOTS}) s GROUP BY n_name"""


@query("alert_rank", f"""
    SELECT CAST(1 + count(lain.n_name) AS INTEGER) AS peringkat, ini.n_name AS kecamatan, ini.semua AS desa_total, ini.kena AS desa_siaga,
           {share_2_sql("ini.kena", "ini.semua")} AS rasio_desa, ini.slot AS slot_siaga, ini.ws_maks, ini.t_maks
    FROM ({PER_AREA}) ini LEFT JOIN ({PER_AREA}) lain
      ON lain.kena * ini.semua > ini.kena * lain.semua OR (lain.kena * ini.semua = ini.kena * lain.semua AND lain.slot > ini.slot)
    GROUP BY ini.n_name, ini.semua, ini.kena, ini.slot, ini.ws_maks, ini.t_maks""")
def alert_rank(t):
    return metrics.alert_rank(newest(t, AREA), "c_custkey", "n_name", CAUSES, MAXIMA)


@query("order_value_rank", """
    SELECT o_orderkey, rank() OVER (ORDER BY o_orderpriority, o_totalprice DESC) AS peringkat FROM orders""")
def order_value_rank(t):
    """Every order ranked in a total order, with ties, by ranges: no task sees them all."""
    named = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rank_rows(named, ["o_orderpriority", "-o_totalprice"], "peringkat").select("o_orderkey", "peringkat")


@query("alert_daily", f"""
    SELECT tanggal, nama_hari, desa_total, CAST(slot_total AS BIGINT) AS slot_total, desa_siaga, slot_siaga,
           slot_angin, slot_suhu, ws_maks, t_maks,
           desa_siaga - lag(desa_siaga) OVER (ORDER BY tanggal) AS perubahan_desa_siaga
    FROM ({DAILY}) d""")
def alert_daily(t):
    return metrics.alert_daily(with_day(t, newest(t, AREA)), "c_custkey", ["tanggal", "nama_hari"], CAUSES, MAXIMA)


def _metric_sql(columns: str, where: str = "true") -> str:
    return f"""
    SELECT {columns}count(DISTINCT c_custkey) FILTER (WHERE {ALERT}) AS desa_siaga, count(DISTINCT c_custkey) AS desa_total
    FROM ({NEWEST}) n JOIN ({PLACES}) p ON p.c_custkey = n.user_id WHERE {where}"""


@query("metric_daily", _metric_sql("tanggal, ", f"r_name = '{AREA}'") + " GROUP BY tanggal")
def metric_daily(t):
    return METRIC.compute(newest(t, AREA), ["tanggal"]).orderBy("tanggal")


@query("metric_upkeep", f"""
    SELECT CAST(strftime(tanggal, '%Y%m%d') AS INTEGER) AS tanggal_sk, r_name,
           count(DISTINCT c_custkey) FILTER (WHERE {ALERT}) AS desa_siaga, count(DISTINCT c_custkey) AS desa_total
    FROM ({NEWEST}) n JOIN ({PLACES}) p ON p.c_custkey = n.user_id GROUP BY tanggal, r_name""")
def metric_upkeep(t):
    """The daily metric of every region, kept up to date through four batches, the last of which brings the oldest days
    again: after each only the days of the batch are computed."""
    w = Warehouse(t.spark, f"{work_folder(t.spark)}/wh/{uuid.uuid4().hex}")
    slots = events_with_slots(t).withColumn("tanggal_sk", X.date_key("tanggal"))
    late = "event_id % 5 = 0"
    parts = [f"NOT {late} AND day(ts) {where}" for where in ("<= 10", "BETWEEN 11 AND 20", "> 20")] + [late]
    key = ("user_id", "slot", "event_id", "tanggal_sk")
    for batch_id, where in enumerate(parts):
        rows = slots.filter(where).withColumn("batch_id", F.lit(str(batch_id)))
        w.merge_months("fact_slot", rows, key, ("ts", "tanggal", "ws", "suhu", "batch_id"), str(batch_id), "tanggal_sk")
        fact = w.read("fact_slot")
        days = cut(fact.filter(F.col("batch_id") == str(batch_id)).select("tanggal_sk").distinct())
        touched = fact.join(days, "tanggal_sk", "left_semi").join(places(t), F.col("user_id") == F.col("c_custkey"))
        newest_rows = facts.latest_run(touched, ["user_id", "slot"], ["ts", "event_id"])
        fresh = METRIC.compute(newest_rows, ["tanggal", "r_name"], where="true").withColumn("tanggal_sk", X.date_key("tanggal")).drop("tanggal")
        w.replace_days("metrik", fresh, days, str(batch_id), "tanggal_sk")
    return w.read("metrik").select("tanggal_sk", "r_name", "desa_siaga", "desa_total")


@query("metric_window", _metric_sql("", f"r_name = '{AREA}'"))
def metric_window(t):
    return METRIC.compute(newest(t, AREA))


@query("metric_by_area", _metric_sql("r_name, n_name, ") + " GROUP BY r_name, n_name")
def metric_by_area(t):
    return METRIC.compute(newest(t), ["r_name", "n_name"], where="true")


@query("metric_by_cause", f"""
    SELECT tanggal, {WIND} AS siaga_angin, {HEAT} AS siaga_suhu,
           count(DISTINCT c_custkey) FILTER (WHERE {ALERT}) AS desa_siaga, count(DISTINCT c_custkey) AS desa_total
    FROM ({AREA_SLOTS}) s GROUP BY ALL""")
def metric_by_cause(t):
    return METRIC.compute(newest(t, AREA), ["tanggal", "siaga_angin", "siaga_suhu"])


@query("metric_new_threshold", f"""
    SELECT tanggal, count(DISTINCT c_custkey) FILTER (WHERE ws >= 150.0 OR {HEAT}) AS desa_siaga,
           count(DISTINCT c_custkey) AS desa_total, 2 AS versi
    FROM ({AREA_SLOTS}) s GROUP BY tanggal""")
def metric_new_threshold(t):
    changed = METRIC.with_thresholds(siaga_angin=150.0)
    return changed.compute(newest(t, AREA), ["tanggal"]).withColumn("versi", F.lit(changed.version))


RAIN = metrics.Measure("hujan", metrics.SEMI, ("sum", "avg"))
VALUE = metrics.Measure("ws", metrics.NON, ("avg", "min", "max"))
SLOTS = metrics.Measure("jumlah_slot", metrics.ADDITIVE, ("sum",))


def _measured(t: Tables) -> DataFrame:
    return newest(t).select(
        "tanggal", "c_custkey", "n_name", "r_name", "ws", "suhu",
        F.col("ws").cast("decimal(18,2)").alias("hujan"), F.lit(1).alias("jumlah_slot"), (F.col("suhu") * 3).alias("arah"),
    )


MEASURED = f"""
    SELECT tanggal, c_custkey, n_name, r_name, ws, suhu, CAST(ws AS DECIMAL(18,2)) AS hujan, suhu * 3 AS arah
    FROM ({NEWEST}) n JOIN ({PLACES}) p ON p.c_custkey = n.user_id"""


@query("semi_additive", f"""
    SELECT tanggal, n_name, CAST(sum(s) AS DOUBLE) / count(s) AS hujan_rata
    FROM (SELECT tanggal, n_name, c_custkey, sum(hujan) AS s FROM ({MEASURED}) m GROUP BY ALL) x GROUP BY tanggal, n_name""")
def semi_additive(t):
    return metrics.aggregate(_measured(t), RAIN, "sum", ["tanggal", "n_name"], place="c_custkey", name="hujan_rata")


@query("semi_additive_per_place", f"""
    SELECT n_name, c_custkey, CAST(sum(hujan) AS DOUBLE) AS hujan_total FROM ({MEASURED}) m GROUP BY n_name, c_custkey""")
def semi_additive_per_place(t):
    per = metrics.aggregate(_measured(t), RAIN, "sum", ["n_name", "c_custkey"], place="c_custkey", name="hujan_total")
    return per.withColumn("hujan_total", F.col("hujan_total").cast("double"))


@query("additive_and_extremes", f"""
    SELECT r_name, CAST(count(*) AS BIGINT) AS slot, min(ws) AS ws_min, max(ws) AS ws_maks
    FROM ({MEASURED}) m GROUP BY r_name""")
def additive_and_extremes(t):
    return metrics.aggregates(_measured(t), [(SLOTS, "sum", "slot"), (VALUE, "min", "ws_min"), (VALUE, "max", "ws_maks")], ["r_name"])


@query("average_measure", f"""
    SELECT tanggal, CAST(sum(hujan) AS DOUBLE) / count(hujan) AS ws_rata FROM ({MEASURED}) m GROUP BY tanggal""")
def average_measure(t):
    return metrics.aggregate(_measured(t), VALUE, "avg", ["tanggal"], name="ws_rata")


@query("circular_mean", f"""
    SELECT n_name, CASE WHEN d < 0 THEN d + 360.0 ELSE d END AS arah_rata
    FROM (SELECT n_name, round(degrees(atan2(avg(sin(radians(arah))), avg(cos(radians(arah))))), 6) AS d
          FROM ({MEASURED}) m GROUP BY n_name) x""")
def circular_mean(t):
    direction = metrics.Measure("arah", metrics.CIRCULAR, ("circular_mean",))
    return metrics.aggregate(_measured(t), direction, "circular_mean", ["n_name"], name="arah_rata")
