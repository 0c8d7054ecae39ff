"""Fact loads on orders: idempotent merge, append, month partitions, proofs.

The fact holds orders before 1999. The batch holds all orders since 1998 with open orders closed,
the value of pending orders withdrawn (NULL) and another priority; the priority is not among the
updated columns, so known orders keep theirs.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators import facts
from stargrain.operators.rows import one_row
from stargrain.plans.catalogue.base import Tables, query
from stargrain.session import cut, work_folder
from stargrain.sources.warehouse import Warehouse, changed_parts

KEY, UPDATES = ("o_orderkey", "tanggal"), ("status", "nilai")


def target(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1999-01-01'").select(
        "o_orderkey", F.to_date("o_orderdate").alias("tanggal"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("nilai"), F.col("o_orderpriority").alias("prioritas"),
    )


def stage(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'").select(
        "o_orderkey", F.to_date("o_orderdate").alias("tanggal"), F.when(status == "O", "F").otherwise(status).alias("status"),
        F.when(status != "P", F.col("o_totalprice")).alias("nilai"), F.lit("BARU").alias("prioritas"),
    )


CTES = """
    WITH target AS (
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS tanggal, o_orderstatus AS status, o_totalprice AS nilai,
               o_orderpriority AS prioritas FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    stage AS (
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS tanggal,
               CASE o_orderstatus WHEN 'O' THEN 'F' ELSE o_orderstatus END AS status,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS nilai, 'BARU' AS prioritas
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
    merged AS (
        SELECT t.o_orderkey, t.tanggal, CASE WHEN s.o_orderkey IS NULL THEN t.status ELSE s.status END AS status,
               CASE WHEN s.o_orderkey IS NULL THEN t.nilai ELSE s.nilai END AS nilai, t.prioritas
        FROM target t LEFT JOIN stage s ON s.o_orderkey = t.o_orderkey AND s.tanggal = t.tanggal
        UNION ALL
        SELECT s.* FROM stage s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey AND t.tanggal = s.tanggal))"""
MONTH = "CAST(extract(year FROM tanggal) * 100 + extract(month FROM tanggal) AS INTEGER)"


@query("fact_merge", CTES + " SELECT * FROM merged")
def fact_merge(t):
    return facts.merge_fact(target(t), stage(t), KEY, UPDATES)


@query("fact_merge_shuffled", CTES + " SELECT * FROM merged")
def fact_merge_shuffled(t):
    """The same merge, sorted on both sides."""
    return facts.merge_fact(target(t), stage(t).hint("merge"), KEY, UPDATES)


@query("fact_merge_twice", CTES + " SELECT * FROM merged")
def fact_merge_twice(t):
    """Loading the batch again changes nothing."""
    once = cut(facts.merge_fact(target(t), stage(t), KEY, UPDATES))
    return facts.merge_fact(once, stage(t), KEY, UPDATES)


@query("fact_append_twice", CTES + """
    SELECT o_orderkey, tanggal, status, nilai, prioritas FROM target
    UNION ALL SELECT * FROM stage UNION ALL SELECT * FROM stage""")
def fact_append_twice(t):
    """Appending the batch again doubles it."""
    return facts.append_fact(facts.append_fact(target(t), stage(t)), stage(t))


@query("run_comparison", CTES + """
    SELECT 'merge' AS strategi, (SELECT count(*) FROM merged) AS baris_run1, (SELECT count(*) FROM merged) AS baris_run2, true AS idempoten
    UNION ALL
    SELECT 'append', (SELECT count(*) FROM target) + (SELECT count(*) FROM stage),
           (SELECT count(*) FROM target) + 2 * (SELECT count(*) FROM stage), false""")
def run_comparison(t):
    """Row counts and content of run 1 and run 2 by strategy; content decides."""
    t0, s = target(t), stage(t)
    once = cut(facts.merge_fact(t0, s, KEY, UPDATES))
    runs = {
        "merge": (once, facts.merge_fact(once, s, KEY, UPDATES)),
        "append": (facts.append_fact(t0, s), facts.append_fact(facts.append_fact(t0, s), s)),
    }
    out = []
    for name, (first, second) in runs.items():
        a, b = facts.fingerprint(first), facts.fingerprint(second)
        both = one_row(a.select(F.struct("*").alias("a")), b.select(F.struct("*").alias("b")))
        out.append(both.select(
            F.lit(name).alias("strategi"), F.col("a.n_rows").alias("baris_run1"), F.col("b.n_rows").alias("baris_run2"),
            (F.col("a") == F.col("b")).alias("idempoten"),
        ))
    return reduce(DataFrame.unionByName, out)


@query("content_difference", CTES + """
    SELECT o_orderkey, tanggal, status, nilai, prioritas, 'hilang' AS sisi FROM (SELECT * FROM target EXCEPT ALL SELECT * FROM merged) a
    UNION ALL
    SELECT o_orderkey, tanggal, status, nilai, prioritas, 'muncul' FROM (SELECT * FROM merged EXCEPT ALL SELECT * FROM target) b""")
def content_difference(t):
    """Rows that a load took away and rows that it brought."""
    before = target(t)
    after = cut(facts.merge_fact(before, stage(t), KEY, UPDATES))
    gone, came = before.exceptAll(after), after.exceptAll(before)
    return gone.withColumn("sisi", F.lit("hilang")).unionByName(came.withColumn("sisi", F.lit("muncul")))


@query("partition_month_counts", f"""
    SELECT bulan, count(*) AS n FROM (
        SELECT CASE WHEN o_orderstatus = 'P' THEN -1 ELSE {MONTH} END AS bulan
        FROM (SELECT CAST(o_orderdate AS DATE) AS tanggal, o_orderstatus FROM orders) o) x GROUP BY bulan""")
def partition_month_counts(t):
    """Rows per month partition; rows without a date (here: pending orders) keep one of their own."""
    dated = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return facts.month_counts(t.orders.select(X.date_key_or_unknown(dated).alias("tanggal_sk")), "tanggal_sk")


@query("partition_replace", CTES + f"""
    SELECT o_orderkey, tanggal, status, nilai, prioritas, {MONTH} AS bulan FROM target
    WHERE {MONTH} NOT IN (SELECT {MONTH} FROM stage)
    UNION ALL SELECT o_orderkey, tanggal, status, nilai, prioritas, {MONTH} FROM stage""")
def partition_replace(t):
    """Delete the months of the batch, then insert it."""
    month = lambda df: df.withColumn("bulan", X.month_of_key(X.date_key("tanggal")))
    return facts.replace_months(month(target(t)), month(stage(t)), "bulan")


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("tanggal_sk", X.date_key("tanggal"))


MONTH_KEY = ("o_orderkey", "tanggal_sk")


def _warehouse(t: Tables) -> Warehouse:
    return Warehouse(t.spark, f"{work_folder(t.spark)}/wh/{uuid.uuid4().hex}")


def _merge(w: Warehouse, rows: DataFrame, batch_id: str) -> DataFrame:
    return w.merge_months("fact_pesanan", rows, MONTH_KEY, UPDATES, batch_id, "tanggal_sk")


def _per_month(fact: DataFrame) -> DataFrame:
    return fact.groupBy("bulan").agg(
        F.count(F.lit(1)).alias("baris"), F.sum(F.col("nilai").cast("decimal(18,2)")).cast("double").alias("nilai"),
        F.count_if(F.col("prioritas") == "BARU").alias("baru"),
    )


PER_MONTH = f"""
    SELECT {MONTH} AS bulan, count(*) AS baris, CAST(sum(CAST(nilai AS DECIMAL(18,2))) AS DOUBLE) AS nilai,
           count(*) FILTER (WHERE prioritas = 'BARU') AS baru"""


@query("warehouse_month_load", CTES + PER_MONTH + " FROM merged GROUP BY 1")
def warehouse_month_load(t):
    """First load, batch, and batch again through the published table; only touched months are
    written anew."""
    w = _warehouse(t)
    for batch_id, rows in (("1", target(t)), ("2", stage(t)), ("2", stage(t))):
        _merge(w, _keyed(rows), batch_id)
    return _per_month(w.read("fact_pesanan"))


@query("warehouse_four_loads", CTES + PER_MONTH + " FROM stage GROUP BY 1")
def warehouse_four_loads(t):
    """The same batch four times, the first of them into an empty warehouse."""
    w = _warehouse(t)
    for _ in range(4):
        _merge(w, _keyed(stage(t)), "2")
    return _per_month(w.read("fact_pesanan"))


@query("warehouse_repeated_key", CTES + """
    SELECT true AS ditolak_awal, true AS ditolak_lanjut, true AS ditolak_null, (SELECT count(*) FROM target) AS baris""")
def warehouse_repeated_key(t):
    """A batch that repeats a key, or lacks one, is refused, as first load and later, and leaves nothing behind."""
    w, rows = _warehouse(t), _keyed(stage(t))

    def refused(bad: DataFrame) -> bool:
        try:
            _merge(w, bad, "bad")
        except ValueError:
            return True
        return False

    first = refused(rows.union(rows))
    _merge(w, _keyed(target(t)), "1")
    missing = rows.withColumn("o_orderkey", F.when(F.col("status") != "F", F.col("o_orderkey")))
    found = first, refused(rows.union(rows)), refused(missing)
    names = ("ditolak_awal", "ditolak_lanjut", "ditolak_null")
    return w.read("fact_pesanan").agg(F.count(F.lit(1)).alias("baris")).select(*[F.lit(r).alias(n) for r, n in zip(found, names)], "baris")


@query("warehouse_null_dates", CTES + f"""
    SELECT CASE WHEN status = 'P' THEN -1 ELSE {MONTH} END AS bulan, count(*) AS baris FROM
        (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS tanggal, o_orderstatus AS status FROM orders) o GROUP BY 1""")
def warehouse_null_dates(t):
    """Two batches with rows that have no date: those of the first stay when the second comes."""
    w = _warehouse(t)
    undated = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("tanggal"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("nilai"), F.col("o_orderpriority").alias("prioritas"),
    )
    for k in (0, 1):
        _merge(w, _keyed(undated.filter(F.col("o_orderkey") % 2 == k)), str(k))
    return w.read("fact_pesanan").groupBy("bulan").agg(F.count(F.lit(1)).alias("baris"))


@query("warehouse_dead_load", CTES + PER_MONTH + " FROM stage GROUP BY 1")
def warehouse_dead_load(t):
    """Rows that a load left before it could publish them never show, not even with the next good load."""
    w = _warehouse(t)
    dead = _keyed(target(t)).withColumns({"bulan": X.month_of_key("tanggal_sk"), "_v": F.lit("dead")})
    dead.write.partitionBy("bulan", "_v").parquet(f"{w.root}/fact_pesanan/months")
    _merge(w, _keyed(stage(t)), "2")
    return _per_month(w.read("fact_pesanan"))


@query("warehouse_kinds", CTES + """
    SELECT true AS gabung_ditolak, true AS tambah_ditolak, count(*) AS baris FROM target""")
def warehouse_kinds(t):
    """A table that is published whole refuses a merge and an append, which would hide each other."""
    w = _warehouse(t)
    w.publish("fact_pesanan", _keyed(target(t)), "1")
    refused = []
    for write in (lambda: _merge(w, _keyed(stage(t)), "2"), lambda: w.append("fact_pesanan", _keyed(stage(t)), "3")):
        try:
            write()
            refused.append(False)
        except ValueError:
            refused.append(True)
    return w.read("fact_pesanan").agg(F.count(F.lit(1)).alias("baris")).select(
        F.lit(refused[0]).alias("gabung_ditolak"), F.lit(refused[1]).alias("tambah_ditolak"), "baris")


@query("warehouse_changed_months", CTES + f""",
    old AS (SELECT *, {MONTH} AS bulan FROM target), new AS (SELECT *, {MONTH} AS bulan FROM merged)
    SELECT CAST(coalesce(o.bulan, n.bulan) AS VARCHAR) AS part, coalesce(o.n, 0) AS n_before, coalesce(n.n, 0) AS n_after
    FROM (SELECT bulan, count(*) AS n FROM old GROUP BY bulan) o FULL JOIN (SELECT bulan, count(*) AS n FROM new GROUP BY bulan) n ON o.bulan = n.bulan
    WHERE coalesce(o.bulan, n.bulan) IN (
        SELECT bulan FROM (SELECT * FROM old EXCEPT SELECT * FROM new) a UNION SELECT bulan FROM (SELECT * FROM new EXCEPT SELECT * FROM old) b)""")
def warehouse_changed_months(t):
    """Which months a batch changed, from checksums kept by month and key bucket: no row is compared."""
    w = _warehouse(t)
    _merge(w, _keyed(target(t)), "1")
    before = cut(w.checksums("fact_pesanan", MONTH_KEY))
    _merge(w, _keyed(stage(t)), "2")
    after = w.checksums("fact_pesanan", MONTH_KEY)
    changed = changed_parts(before, after).select("part").distinct()
    rows = lambda sums, name: sums.groupBy("part").agg(F.sum("n_rows").alias(name))
    return changed.join(rows(before, "n_before"), "part", "left").join(rows(after, "n_after"), "part", "left").na.fill(0)


@query("warehouse_replace_months", CTES + PER_MONTH + f""" FROM (
        SELECT * FROM target WHERE {MONTH} NOT IN (SELECT {MONTH} FROM stage) UNION ALL SELECT * FROM stage) x GROUP BY 1""")
def warehouse_replace_months(t):
    """The months of a batch are replaced in the published table; the others aren't touched."""
    w = _warehouse(t)
    _merge(w, _keyed(target(t)), "1")
    return _per_month(w.replace_months("fact_pesanan", _keyed(stage(t)), "2", "tanggal_sk"))


@query("merge_null_keys", CTES + """
    SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey, tanggal, status, nilai, prioritas FROM target
    WHERE o_orderkey % 7 = 0 OR NOT EXISTS (SELECT 1 FROM stage s WHERE s.o_orderkey = target.o_orderkey AND s.tanggal = target.tanggal)
    UNION ALL
    SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END, tanggal, status, nilai, prioritas FROM stage
    WHERE o_orderkey % 7 = 0 OR NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = stage.o_orderkey AND t.tanggal = stage.tanggal)
    UNION ALL
    SELECT s.o_orderkey, s.tanggal, s.status, s.nilai, t.prioritas
    FROM stage s JOIN target t ON t.o_orderkey = s.o_orderkey AND t.tanggal = s.tanggal WHERE s.o_orderkey % 7 <> 0""")
def merge_null_keys(t):
    """NULL in a key equals nothing: such rows of either side stay as they are."""
    holes = lambda df: df.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")))
    return facts.merge_fact(holes(target(t)), holes(stage(t)), KEY, UPDATES).orderBy(F.col("o_orderkey").asc_nulls_last())
