"""Data-quality expectations on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators import metrics, quality
from stargrain.operators.quality import Expectation
from stargrain.plans.catalogue import alerts
from stargrain.plans.catalogue.base import EVENT_SLOTS, NEWEST, Tables, events_with_slots, query
from stargrain.sources.raw import as_text

EXPECTATIONS = [
    Expectation("pesanan_unik", "t2", "blocking", "pass", "orders", count=quality.unique("orders", ["o_orderkey"])),
    Expectation("grain_item_unik", "t2", "warning", "fail", "lineitem", count=quality.unique("lineitem", ["l_orderkey", "l_linenumber"])),
    Expectation("item_tanpa_pesanan", "t2", "blocking", "pass", "lineitem", count=quality.references("lineitem", "l_orderkey", "orders", "o_orderkey")),
    Expectation("pesanan_tanpa_item", "t2", "warning", "fail", "orders", count=quality.references("orders", "o_orderkey", "lineitem", "l_orderkey")),
    Expectation("run_basi", "t3", "warning", "fail", "slots", count=quality.stale_run("slots", "user_id", "run")),
    Expectation("kode_bertentangan", "t3", "warning", "fail", "raw_events",
                row_rule=f"{X.double_text('value')} > 100 AND event_type IN ('error', 'view')"),
    Expectation("props_kosong", "t3", "blocking", "pass", "raw_events", row_rule="props IS NULL OR trim(props) = ''"),
    Expectation("nilai_di_luar_rentang", "t3", "warning", "fail", "raw_events",
                row_rule=f"{X.double_text('value')} NOT BETWEEN 0 AND 250 OR {X.int_text('user_id')} < 0"),
    Expectation("tabel_berisi", "t3", "blocking", "pass", "raw_events", count=quality.not_empty("raw_events")),
    Expectation("jumlah_wilayah", "t3", "blocking", "pass", "nation", count=quality.row_count_is("nation", 25)),
    Expectation("jam_slot", "t3", "blocking", "pass", "slots", row_rule="hour(slot) NOT BETWEEN 0 AND 23 OR hour(slot) % 3 <> 0"),
]
COUNTS = f"""
    SELECT 'pesanan_unik' AS name, (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1) g) AS violations
    UNION ALL SELECT 'grain_item_unik', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) g)
    UNION ALL SELECT 'item_tanpa_pesanan', (SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
    UNION ALL SELECT 'pesanan_tanpa_item', (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
    UNION ALL SELECT 'run_basi', (
        WITH s AS (SELECT user_id, CAST(ts AS DATE) AS run FROM events), r AS (SELECT user_id, max(run) AS terbaru FROM s GROUP BY user_id)
        SELECT count(*) FROM s JOIN r USING (user_id) WHERE r.terbaru < (SELECT max(run) FROM s))
    UNION ALL SELECT 'kode_bertentangan', (SELECT count(*) FROM events WHERE value > 100 AND event_type IN ('error', 'view'))
    UNION ALL SELECT 'props_kosong', (SELECT count(*) FROM events WHERE props IS NULL OR trim(props) = '')
    UNION ALL SELECT 'nilai_di_luar_rentang', (SELECT count(*) FROM events WHERE value NOT BETWEEN 0 AND 250 OR user_id < 0)
    UNION ALL SELECT 'tabel_berisi', (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM events)
    UNION ALL SELECT 'jumlah_wilayah', (SELECT abs(count(*) - 25) FROM nation)
    UNION ALL SELECT 'jam_slot', (SELECT count(*) FROM ({EVENT_SLOTS}) s WHERE hour(slot) % 3 <> 0)"""
SPEC = "(VALUES " + ", ".join(f"('{e.name}', '{e.topic}', '{e.severity}', '{e.expected}')" for e in EXPECTATIONS) + ") AS e(name, topic, severity, expected)"
VERDICTS = f"""
    SELECT c.name, topic, severity, expected, violations, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
           (expected = 'fail') = (violations > 0) AS as_expected
    FROM ({COUNTS}) c JOIN {SPEC} ON e.name = c.name"""


def checked_tables(t: Tables) -> dict:
    return {
        "orders": t.orders, "lineitem": t.lineitem, "nation": t.nation,
        "raw_events": as_text(t.events),
        "slots": events_with_slots(t).withColumn("run", F.to_date("ts")),
    }


@query("dq_violations", COUNTS)
def dq_violations(t):
    return quality.violation_counts(EXPECTATIONS, checked_tables(t), t.spark)


@query("dq_verdicts", VERDICTS)
def dq_verdicts(t):
    return quality.verdicts(quality.violation_counts(EXPECTATIONS, checked_tables(t), t.spark), EXPECTATIONS).drop("note")


@query("dq_summary", f"""
    SELECT count(*) AS tests, count(*) FILTER (WHERE status = 'FAIL') AS failed,
           count(*) FILTER (WHERE severity = 'blocking' AND NOT as_expected) AS blocking_deviations,
           count(*) FILTER (WHERE status = 'FAIL') = 0 AS suspicious
    FROM ({VERDICTS}) v""")
def dq_summary(t):
    return quality.summary(quality.run_expectations(EXPECTATIONS, checked_tables(t), t.spark))


@query("dq_sql_checks", """
    SELECT 'grain' AS name, (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1) g) AS violations
    UNION ALL SELECT 'saldo_negatif', (SELECT count(*) FROM customer WHERE c_acctbal < 0)
    UNION ALL SELECT 'terbesar', (SELECT count(*) FROM orders WHERE o_totalprice >= (SELECT max(o_totalprice) FROM orders))""")
def dq_sql_checks(t):
    """Checks written as SQL text over views, each returning one count."""
    t.orders.createOrReplaceTempView("cek_orders")
    t.customer.createOrReplaceTempView("cek_customer")
    checks = {
        "grain": "SELECT count(*) FROM (SELECT o_custkey, o_orderdate FROM cek_orders GROUP BY 1, 2 HAVING count(*) > 1)",
        "saldo_negatif": "SELECT count(*) FROM cek_customer WHERE c_acctbal < 0",
        "terbesar": "SELECT count(*) FROM cek_orders WHERE o_totalprice >= (SELECT max(o_totalprice) FROM cek_orders)",
    }
    made = [Expectation(n, "t2", "warning", "fail", "", sql=s) for n, s in checks.items()]
    return quality.violation_counts(made, {}, t.spark)


@query("dq_unreadable_numbers", """
    SELECT count(*) FILTER (WHERE try_cast(nilai AS DOUBLE) NOT BETWEEN 0 AND 250) AS di_luar_rentang,
           count(*) FILTER (WHERE try_cast(nilai AS DOUBLE) IS NULL AND trim(nilai) <> '') AS tidak_terbaca
    FROM (SELECT CASE event_type WHEN 'error' THEN 'n/a ' || CAST(value AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS nilai FROM events) x""")
def dq_unreadable_numbers(t):
    """Unreadable numbers pass a range check, so they have a check of their own."""
    text = F.col("value").cast("string")
    raw = t.events.select(F.when(F.col("event_type") == "error", F.concat(F.lit("n/a "), text)).otherwise(text).alias("nilai"))
    number = X.double_text("nilai")
    return raw.agg(
        F.count_if(F.expr(f"{number} NOT BETWEEN 0 AND 250")).alias("di_luar_rentang"),
        F.count_if(F.expr(f"{number} IS NULL AND trim(nilai) <> ''")).alias("tidak_terbaca"),
    )


@query("dq_metric_guard", f"""
    SELECT count(*) FILTER (WHERE n <> (SELECT count(DISTINCT user_id) FROM events)) AS hari_tidak_lengkap, count(*) AS hari
    FROM (SELECT tanggal, count(DISTINCT user_id) AS n FROM ({NEWEST}) x GROUP BY tanggal) d""")
def dq_metric_guard(t):
    """Days whose denominator is not the full number of entities."""
    per_day = alerts.METRIC.compute(alerts.newest(t), ["tanggal"], where="true")
    everyone = t.events.agg(F.count_distinct("user_id")).scalar()
    return per_day.withColumn("_all", everyone).agg(
        F.count_if(F.col("desa_total") != F.col("_all")).alias("hari_tidak_lengkap"), F.count(F.lit(1)).alias("hari")
    )


@query("dq_metric_guard_present", f"""
    WITH d AS (SELECT DISTINCT user_id, tanggal FROM ({NEWEST}) x),
    span AS (SELECT user_id, min(tanggal) AS a, max(tanggal) AS b FROM d GROUP BY user_id)
    SELECT tanggal, CAST(count(*) AS BIGINT) AS desa_total, (SELECT count(*) FROM span WHERE a <= tanggal AND b >= tanggal) AS ada FROM d GROUP BY tanggal""")
def dq_metric_guard_present(t):
    """The denominator of each day beside the entities that are there then: one that joins or leaves is no gap."""
    slots = alerts.newest(t)
    per_day = alerts.METRIC.compute(slots, ["tanggal"], where="true").select("tanggal", "desa_total")
    return per_day.join(metrics.present_per_day(slots, "c_custkey", "tanggal"), "tanggal")


@query("stale_entities", """
    WITH r AS (SELECT user_id, max(ts) AS terbaru, count(*) AS baris FROM events GROUP BY user_id)
    SELECT user_id, CAST(terbaru AS DATE) AS run_terbaru, baris FROM r
    WHERE CAST(terbaru AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events)""")
def stale_entities(t):
    """Entities whose newest run is older than the newest of all."""
    per = t.events.groupBy("user_id").agg(F.max(F.to_date("ts")).alias("run_terbaru"), F.count(F.lit(1)).alias("baris"))
    return per.filter(F.col("run_terbaru") < t.events.agg(F.max(F.to_date("ts"))).scalar())
