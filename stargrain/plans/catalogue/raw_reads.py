"""Raw text reads, slices and text-to-number casts."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.plans.catalogue.base import TABLES, Tables, heat, query, slot_of
from stargrain.session import work_folder
from stargrain.sources.raw import as_text, read_text_csv, register_folder, slice_by


@query("raw_csv_scan", """
    SELECT s_nationkey AS negara, count(*) AS baris, count(DISTINCT s_name) AS nama_unik,
           min(CAST(s_suppkey AS VARCHAR)) AS kunci_teks_min
    FROM (SELECT CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_name, s_suppkey FROM supplier) s GROUP BY s_nationkey""")
def raw_csv_scan(t):
    """The supplier table as a CSV source with every column read as text."""
    path = f"{work_folder(t.spark)}/csv/{uuid.uuid4().hex}"
    t.supplier.write.option("header", True).csv(path)
    raw = read_text_csv(t.spark, path)
    return raw.groupBy(F.col("s_nationkey").alias("negara")).agg(
        F.count(F.lit(1)).alias("baris"), F.count_distinct("s_name").alias("nama_unik"), F.min("s_suppkey").alias("kunci_teks_min")
    )


@query("raw_csv_quoted", """
    SELECT s_nationkey AS negara, 'kata "' || s_name || '", lalu' || chr(10) || 'baris kedua' AS teks FROM supplier""")
def raw_csv_quoted(t):
    """Fields with quotes, commas and line ends come back as they were."""
    path = f"{work_folder(t.spark)}/csv/{uuid.uuid4().hex}"
    text = F.concat(F.lit('kata "'), "s_name", F.lit('", lalu\nbaris kedua'))
    t.supplier.select("s_nationkey", text.alias("teks")).write.options(header=True, escape='"').csv(path)
    raw = read_text_csv(t.spark, path, multiline=True)
    return raw.select(F.col("s_nationkey").cast(t.supplier.schema["s_nationkey"].dataType).alias("negara"), "teks")


@query("raw_folder_of_parts", """
    SELECT 'raw_nation' AS sumber, count(*) AS baris FROM nation UNION ALL SELECT 'raw_orders', count(*) FROM orders""")
def raw_folder_of_parts(t):
    """Sources of a folder, one of them a folder of parts itself, without naming them."""
    path = f"{work_folder(t.spark)}/csv/{uuid.uuid4().hex}"
    for name in ("nation", "orders"):
        getattr(t, name).repartition(3).write.option("header", True).csv(f"{path}/{name}.csv")
    found = register_folder(t.spark, path)
    one = [df.agg(F.count(F.lit(1)).alias("baris")).select(F.lit(v).alias("sumber"), "baris") for v, df in found.items()]
    return reduce(DataFrame.unionByName, one)


@query("json_shapes", """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) WHEN 1 THEN 7 WHEN 2 THEN 8 END AS suhu,
           CASE WHEN event_id % 5 > 0 THEN time_bucket(INTERVAL '3 hours', ts) END AS slot
    FROM events""")
def json_shapes(t):
    """k from records of several shapes; rows without a time keep their place without a slot."""
    part = F.col("event_id") % 4
    props = F.when(part == 0, F.col("props")).when(part == 1, '{ "k":7, "z": 1}').when(part == 2, '{"z": {"k": 1}, "k": 7.5}').otherwise("{}")
    rows = t.events.select("event_id", props.alias("p"), F.when(F.col("event_id") % 5 > 0, F.col("ts")).alias("ts"))
    return rows.select("event_id", heat("p").alias("suhu"), slot_of(t).alias("slot"))


@query("slice_folder", """
    SELECT count(*) AS baris, count(DISTINCT CAST(c_nationkey AS VARCHAR)) AS negara_unik,
           max(CAST(c_custkey AS VARCHAR)) AS kunci_teks_max
    FROM customer WHERE c_mktsegment = 'BUILDING'""")
def slice_folder(t):
    """A slice that is a folder of its own: the other folders are not opened."""
    path = f"{work_folder(t.spark)}/csv/{uuid.uuid4().hex}"
    t.customer.write.partitionBy("c_mktsegment").option("header", True).csv(path)
    raw = read_text_csv(t.spark, f"{path}/c_mktsegment=BUILDING")
    return raw.agg(
        F.count(F.lit(1)).alias("baris"), F.count_distinct("c_nationkey").alias("negara_unik"), F.max("c_custkey").alias("kunci_teks_max")
    )


@query("staging_cast", """
    SELECT o_orderkey AS kunci, o_orderdate AS waktu, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS tanggal_sk,
           CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(12,1)) AS DOUBLE) AS nilai,
           CAST(round(o_totalprice) AS BIGINT) AS nilai_bulat, CAST(o_orderpriority AS VARCHAR) AS prioritas
    FROM orders""")
def staging_cast(t):
    """Raw text renamed and cast to typed staging columns; the decimal keeps one digit."""
    raw = as_text(t.orders)
    return raw.select(
        F.expr(X.bigint_text("o_orderkey")).alias("kunci"),
        F.try_to_timestamp("o_orderdate", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("waktu"),
        X.date_key(F.col("o_orderdate").try_cast("timestamp_ntz")).alias("tanggal_sk"),
        F.expr(f"CAST(try_cast({X.double_text('o_totalprice')} AS DECIMAL(12,1)) AS DOUBLE)").alias("nilai"),
        F.expr(X.bigint_text("o_totalprice")).alias("nilai_bulat"),
        F.col("o_orderpriority").alias("prioritas"),
    )


@query("raw_try_cast", """
    SELECT p_partkey, try_cast(CAST(p_size AS VARCHAR) AS INTEGER) AS ukuran,
           try_cast(p_name AS INTEGER) AS nama_angka,
           try_cast(concat('  ', CAST(p_size AS VARCHAR), ' ') AS BIGINT) AS ukuran_berspasi,
           try_cast(concat(CAST(p_size AS VARCHAR), 'f') AS DOUBLE) AS ukuran_berakhiran,
           try_cast(concat(CAST(p_size AS VARCHAR), '.5') AS INTEGER) AS dibulatkan,
           try_cast(concat('-', CAST(p_size AS VARCHAR), '.5') AS BIGINT) AS dibulatkan_negatif,
           try_cast(concat(CAST(p_size AS VARCHAR), 'e2') AS INTEGER) AS ilmiah,
           try_cast(concat(CAST(p_partkey AS VARCHAR), '000000000') AS INTEGER) AS terlalu_besar
    FROM part""")
def raw_try_cast(t):
    """Text to number with the rules of the raw checks: round halves away, NULL when unreadable."""
    p = as_text(t.part).select(
        "p_partkey", "p_size", "p_name",
        F.concat(F.lit("  "), "p_size", F.lit(" ")).alias("spaced"), F.concat("p_size", F.lit("f")).alias("suffixed"),
        F.concat("p_size", F.lit(".5")).alias("half"), F.concat(F.lit("-"), "p_size", F.lit(".5")).alias("minus_half"),
        F.concat("p_size", F.lit("e2")).alias("science"), F.concat("p_partkey", F.lit("000000000")).alias("large"),
    )
    return p.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        F.expr(X.int_text("p_size")).alias("ukuran"),
        F.expr(X.int_text("p_name")).alias("nama_angka"),
        F.expr(X.bigint_text("spaced")).alias("ukuran_berspasi"),
        F.expr(X.double_text("suffixed")).alias("ukuran_berakhiran"),
        F.expr(X.int_text("half")).alias("dibulatkan"),
        F.expr(X.bigint_text("minus_half")).alias("dibulatkan_negatif"),
        F.expr(X.int_text("science")).alias("ilmiah"),
        F.expr(X.int_text("large")).alias("terlalu_besar"),
    )


@query("slice_predicate", """
    SELECT 'k8' AS irisan, o_orderstatus AS status, count(*) AS baris, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS nilai
    FROM orders WHERE o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') GROUP BY o_orderstatus
    UNION ALL
    SELECT 'semua', o_orderstatus, count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders GROUP BY o_orderstatus""")
def slice_predicate(t):
    """A slice by predicate beside the table without one."""

    def totals(name: str, predicate: str | None) -> DataFrame:
        return slice_by(t.orders, predicate).groupBy(F.lit(name).alias("irisan"), F.col("o_orderstatus").alias("status")).agg(
            F.count(F.lit(1)).alias("baris"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("nilai")
        )

    return totals("k8", "o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM')").unionByName(totals("semua", None))


@query("slice_date_range", """
    SELECT o_orderpriority AS prioritas, count(*) AS baris FROM orders
    WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o_orderdate AS DATE) < DATE '1996-07-01'
    GROUP BY o_orderpriority""")
def slice_date_range(t):
    """Half-open range. The stored timestamp is compared, not its date, so the scan can skip."""
    where = "o_orderdate >= TIMESTAMP_NTZ '1996-01-01' AND o_orderdate < TIMESTAMP_NTZ '1996-07-01'"
    return slice_by(t.orders, where).groupBy(F.col("o_orderpriority").alias("prioritas")).agg(F.count(F.lit(1)).alias("baris"))


@query("threshold_relation", """
    WITH ambang AS (SELECT 10000.0 AS besar, 0.05 AS diskon)
    SELECT l_returnflag AS tanda, count(*) FILTER (WHERE l_extendedprice >= besar) AS besar,
           count(*) FILTER (WHERE l_discount >= diskon) AS berdiskon, count(*) AS baris
    FROM lineitem CROSS JOIN ambang GROUP BY l_returnflag""")
def threshold_relation(t):
    """Named thresholds kept in one place; as literals they fold into the aggregate."""
    limits = {"besar": 10000.0, "diskon": 0.05}
    return t.lineitem.groupBy(F.col("l_returnflag").alias("tanda")).agg(
        F.count_if(F.col("l_extendedprice") >= limits["besar"]).alias("besar"),
        F.count_if(F.col("l_discount") >= limits["diskon"]).alias("berdiskon"),
        F.count(F.lit(1)).alias("baris"),
    )


@query("table_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS tabel, count(*) AS baris FROM {n}" for n in TABLES))
def table_row_counts(t: Tables):
    one = [getattr(t, n).agg(F.count(F.lit(1)).alias("baris")).select(F.lit(n).alias("tabel"), "baris") for n in TABLES]
    return reduce(DataFrame.unionByName, one)
