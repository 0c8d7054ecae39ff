"""Calendar, its roles, and dated aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators import calendar
from stargrain.plans.catalogue.base import Tables, query

SPAN = """
    SELECT make_date(year(min(d)), 1, 1) AS a, make_date(year(max(d)), 12, 31) AS b
    FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem) x"""
MONTHS = "['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August', 'September', 'October', 'November', 'December']"
DAYS = "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']"
# the unknown row is fixed
DIM_DATE = f"""
    SELECT CAST((p.year * 100 + p.month) * 100 + p.day AS INTEGER) AS date_sk, d AS full_date, CAST(p.year AS INTEGER) AS tahun,
           CAST((p.month + 2) // 3 AS INTEGER) AS triwulan, CAST(p.month AS INTEGER) AS bulan, {MONTHS}[p.month] AS nama_bulan,
           CAST(p.week AS INTEGER) AS pekan_iso, CAST(p.day AS INTEGER) AS hari, CAST(p.dow AS INTEGER) AS hari_ke,
           {DAYS}[p.dow + 1] AS nama_hari, p.dow % 6 = 0 AS akhir_pekan
    FROM (SELECT d, date_part(['year', 'month', 'day', 'dow', 'week'], d) AS p
          FROM (SELECT a + CAST(unnest(range(b - a + 1)) AS INTEGER) AS d FROM ({SPAN}) s) g) x
    UNION ALL
    SELECT -1, DATE '1900-01-01', 1900, 0, 0, 'TIDAK DIKETAHUI', 0, 0, -1, 'TIDAK DIKETAHUI', false"""


def order_calendar(t: Tables):
    """Calendar of whole years around all order and ship dates."""
    spans = [
        t.orders.agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end")),
        t.lineitem.agg(F.min("l_shipdate").alias("start"), F.max("l_shipdate").alias("end")),
    ]
    span = spans[0].unionByName(spans[1]).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return calendar.dim_date_over(calendar.whole_years(span))


@query("dim_date", DIM_DATE)
def dim_date(t):
    return order_calendar(t)


@query("dim_date_roles", f"""
    WITH d AS ({DIM_DATE})
    SELECT o.tahun AS pesan_tahun, o.triwulan AS pesan_triwulan, s.tahun AS kirim_tahun, s.nama_bulan AS kirim_nama_bulan,
           s.akhir_pekan AS kirim_akhir_pekan, count(*) AS baris
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    JOIN d o ON o.full_date = CAST(o_orderdate AS DATE) JOIN d s ON s.full_date = CAST(l_shipdate AS DATE)
    GROUP BY ALL""")
def dim_date_roles(t):
    """Lines by order date and ship date, one calendar in two roles. Lines are counted per order
    and ship date before the join, and dates meet the calendar only once per pair."""
    lines = t.lineitem.groupBy("l_orderkey", X.date_key("l_shipdate").alias("kirim_sk")).agg(F.count(F.lit(1)).alias("n"))
    orders = t.orders.select("o_orderkey", X.date_key("o_orderdate").alias("pesan_sk"))
    pairs = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("pesan_sk", "kirim_sk").agg(F.sum("n").alias("n"))
    )
    days = order_calendar(t)
    ordered = calendar.date_role(days, "pesan_sk", "pesan_tanggal", "pesan_")
    shipped = calendar.date_role(days, "kirim_sk", "kirim_tanggal", "kirim_")
    keys = ["pesan_tahun", "pesan_triwulan", "kirim_tahun", "kirim_nama_bulan", "kirim_akhir_pekan"]
    return pairs.join(ordered, "pesan_sk").join(shipped, "kirim_sk").groupBy(*keys).agg(F.sum("n").alias("baris"))


@query("date_without_calendar_row", """
    SELECT count(*) FILTER (WHERE extract(year FROM o_orderdate) NOT BETWEEN 1996 AND 2000) AS di_luar_kalender, count(*) AS baris
    FROM orders""")
def date_without_calendar_row(t):
    """Orders that an inner join to a calendar of 1996-2000 would drop silently."""
    days = calendar.build_dim_date(t.spark, "1996-01-01", "2000-12-31").select(F.col("date_sk").alias("_d"))
    keyed = t.orders.groupBy(X.date_key("o_orderdate").alias("date_sk")).agg(F.count(F.lit(1)).alias("n"))
    outside = keyed.join(days, F.col("date_sk") == F.col("_d"), "left")
    return outside.agg(
        F.sum(F.when(F.col("_d").isNull(), F.col("n")).otherwise(0)).alias("di_luar_kalender"), F.sum("n").alias("baris")
    )


@query("local_wall_clock", """
    SELECT CAST(strftime(ts + INTERVAL 8 HOUR, '%Y%m%d') AS INTEGER) AS tanggal_sk,
           CAST(hour(ts + INTERVAL 8 HOUR) AS INTEGER) AS jam_lokal, count(*) AS slot
    FROM events GROUP BY ALL""")
def local_wall_clock(t):
    """UTC events by local date key and local hour (UTC+8, no daylight saving)."""
    local = X.local_time("ts", "Asia/Makassar")
    return t.events.groupBy(X.date_key(local).alias("tanggal_sk"), F.hour(local).alias("jam_lokal")).agg(
        F.count(F.lit(1)).alias("slot")
    )
