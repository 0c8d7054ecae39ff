"""Dimension maintenance on customers: hierarchy, keys, unknown members, overwrite and history.

Batches are rules on whole tables, applied to every customer:
  1995-06-01   customers with a balance of at least 0
  1997-06-01   all customers; segment FURNITURE is now called HOME
  1999-06-01   those other than MACHINERY; old segment names are back
  2000-06-01   the same batch once more
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators import dimensions, facts, quality
from stargrain.operators.rows import literal_row
from stargrain.plans.catalogue.base import Tables, query
from stargrain.session import cut, work_folder
from stargrain.sources.warehouse import Warehouse

KEY, TRACKED, SK = "c_custkey", ("c_name", "c_mktsegment", "c_nationkey"), "pelanggan_sk"
HOME = "CASE WHEN c_mktsegment = 'FURNITURE' THEN 'HOME' ELSE c_mktsegment END"
BATCHES = (
    ("1995-06-01", "c_acctbal >= 0", "c_mktsegment"),
    ("1997-06-01", "true", HOME),
    ("1999-06-01", "c_mktsegment <> 'MACHINERY'", "c_mktsegment"),
    ("2000-06-01", "c_mktsegment <> 'MACHINERY'", "c_mktsegment"),
)


def batch(t: Tables, number: int) -> DataFrame:
    _, where, segment = BATCHES[number]
    return t.customer.filter(F.expr(where)).select(KEY, "c_name", F.expr(segment).alias("c_mktsegment"), "c_nationkey")


def history(t: Tables, batches: int = len(BATCHES)) -> DataFrame:
    """The history-keeping customer dimension after the given number of batches. Each batch starts
    from the written result of the one before, as a load does."""
    dim = dimensions.empty_scd2(batch(t, 0), KEY, TRACKED, SK)
    for i in range(batches):
        dim = cut(dimensions.scd2_apply(dim, batch(t, i), KEY, TRACKED, BATCHES[i][0] + " 00:00:00", SK))
    return dim


def _hash(prefix: str = "") -> str:
    return f"md5({prefix}c_name || '|' || {prefix}c_mktsegment || '|' || CAST({prefix}c_nationkey AS VARCHAR))"


def history_ctes(batches: int = len(BATCHES)) -> str:
    """The same history step by step: close changed versions, then insert keys without a current one."""
    cols = f"{SK}, {KEY}, c_name, c_mktsegment, c_nationkey, valid_from, valid_to, is_current, row_hash"
    parts = [
        "d0 AS (SELECT CAST(0 AS BIGINT) AS pelanggan_sk, c_custkey, c_name, c_mktsegment, c_nationkey, "
        "TIMESTAMP '1970-01-01' AS valid_from, TIMESTAMP '9999-12-31' AS valid_to, true AS is_current, '' AS row_hash "
        "FROM customer WHERE false)"
    ]
    for i, (day, where, segment) in enumerate(BATCHES[:batches]):
        ts = f"TIMESTAMP '{day}'"
        parts.append(f"b{i} AS (SELECT s.*, {_hash()} AS h FROM (SELECT {KEY}, c_name, {segment} AS c_mktsegment, c_nationkey FROM customer WHERE {where}) s)")
        parts.append(f"""u{i} AS (
            SELECT d.* REPLACE (CASE WHEN d.is_current AND b.h <> d.row_hash THEN {ts} ELSE d.valid_to END AS valid_to,
                                CASE WHEN d.is_current AND b.h <> d.row_hash THEN false ELSE d.is_current END AS is_current)
            FROM d{i} d LEFT JOIN b{i} b ON b.{KEY} = d.{KEY})""")
        parts.append(f"""n{i} AS (
            SELECT CAST((SELECT coalesce(max({SK}), 0) FROM u{i}) + row_number() OVER (ORDER BY md5(CAST({KEY} AS VARCHAR))) AS BIGINT) AS {SK},
                   {KEY}, c_name, c_mktsegment, c_nationkey,
                   CASE WHEN EXISTS (SELECT 1 FROM u{i} x WHERE x.{KEY} = b.{KEY}) THEN {ts} ELSE TIMESTAMP '1970-01-01' END AS valid_from,
                   TIMESTAMP '9999-12-31' AS valid_to, true AS is_current, h AS row_hash
            FROM b{i} b WHERE NOT EXISTS (SELECT 1 FROM u{i} x WHERE x.{KEY} = b.{KEY} AND x.is_current))""")
        parts.append(f"d{i + 1} AS (SELECT {cols} FROM u{i} UNION ALL SELECT {cols} FROM n{i})")
    return "WITH " + ",\n".join(parts)


HISTORY = history_ctes()
LAST = f"d{len(BATCHES)}"


def _plain_dates(dim: DataFrame) -> DataFrame:
    return dim.withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})


# --- hierarchy, hashes, keys ----------------------------------------------------------------

@query("location_hierarchy", """
    SELECT c_custkey, c_name, n_nationkey, n_name, r_regionkey, r_name
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def location_hierarchy(t):
    nations = t.nation.withColumn("key", F.col("n_nationkey"))
    regions = t.region.withColumn("key", F.col("r_regionkey"))
    flat = dimensions.flatten_hierarchy(t.customer, [(nations, F.col("c_nationkey"), "key"), (regions, F.col("n_regionkey"), "key")])
    return flat.select("c_custkey", "c_name", "n_nationkey", "n_name", "r_regionkey", "r_name")


@query("hierarchy_from_code", """
    SELECT kode, split_part(kode, '.', 1) AS kode_induk, r_name
    FROM (SELECT CAST(n_regionkey AS VARCHAR) || '.' || CAST(n_nationkey AS VARCHAR) || '.' || CAST(s_suppkey AS VARCHAR) AS kode
          FROM supplier JOIN nation ON n_nationkey = s_nationkey) s
    LEFT JOIN region ON CAST(r_regionkey AS VARCHAR) = split_part(kode, '.', 1)""")
def hierarchy_from_code(t):
    """The parent is found by the part of a dotted code before the first dot."""
    coded = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(
        F.concat_ws(".", F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string"), F.col("s_suppkey").cast("string")).alias("kode")
    )
    parent = F.split_part("kode", F.lit("."), F.lit(1))
    regions = t.region.select(F.col("r_regionkey").cast("string").alias("k"), "r_name")
    return dimensions.flatten_hierarchy(coded.withColumn("kode_induk", parent), [(regions, F.col("kode_induk"), "k")])


@query("row_hash", f"SELECT {KEY}, {_hash()} AS row_hash FROM customer")
def row_hash(t):
    return t.customer.select(KEY, X.row_hash(TRACKED).alias("row_hash"))


@query("surrogate_keys", f"SELECT {KEY}, row_number() OVER (ORDER BY md5(CAST({KEY} AS VARCHAR))) AS {SK} FROM customer")
def surrogate_keys(t):
    return dimensions.number_rows(t.customer.select(KEY), KEY, SK)


# --- unknown members ------------------------------------------------------------------------

GOOD_STANDING = f"""
    SELECT row_number() OVER (ORDER BY md5(CAST({KEY} AS VARCHAR))) AS {SK}, {KEY}, c_name FROM customer WHERE c_acctbal >= 0"""


def good_standing(t: Tables) -> DataFrame:
    return dimensions.number_rows(t.customer.filter("c_acctbal >= 0").select(KEY, "c_name"), KEY, SK).select(SK, KEY, "c_name")


@query("unknown_member", f"SELECT * FROM ({GOOD_STANDING}) d UNION ALL SELECT -1, -1, 'Tidak diketahui'")
def unknown_member(t):
    return dimensions.add_unknown(good_standing(t), {SK: -1, KEY: -1, "c_name": "Tidak diketahui"})


@query("insert_if_absent", f"SELECT * FROM ({GOOD_STANDING}) d UNION ALL SELECT -1, -1, 'Tidak diketahui'")
def insert_if_absent(t):
    """Inserting the unknown member twice leaves one."""
    dim = good_standing(t)
    unknown = literal_row(t.spark, dim.schema, {SK: -1, KEY: -1, "c_name": "Tidak diketahui"})
    once = dimensions.insert_if_absent(dim, unknown, SK)
    return dimensions.insert_if_absent(once, unknown, SK)


@query("unknown_member_lookup", f"""
    SELECT o_orderkey, o_custkey, coalesce({SK}, -1) AS {SK} FROM orders LEFT JOIN ({GOOD_STANDING}) d ON d.{KEY} = o_custkey""")
def unknown_member_lookup(t):
    return facts.lookup(t.orders.select("o_orderkey", "o_custkey"), good_standing(t), "o_custkey", KEY, SK)


@query("orphan_accounting", f"""
    SELECT o_orderpriority, count(*) AS baris, count(*) FILTER (WHERE {SK} IS NULL) AS tanpa_dimensi
    FROM orders LEFT JOIN ({GOOD_STANDING}) d ON d.{KEY} = o_custkey GROUP BY o_orderpriority""")
def orphan_accounting(t):
    keyed = facts.lookup(t.orders.select("o_orderpriority", "o_custkey"), good_standing(t), "o_custkey", KEY, SK)
    return keyed.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("baris"), F.count_if(F.col(SK) == -1).alias("tanpa_dimensi"))


# --- overwrite ------------------------------------------------------------------------------

@query("scd1_upsert", """
    WITH a AS (SELECT p_brand AS kode, min(p_type) AS deskripsi FROM part WHERE p_size <= 10 GROUP BY 1),
    dim AS (SELECT CAST(row_number() OVER (ORDER BY md5(kode)) AS BIGINT) AS merek_sk, kode, deskripsi, DATE '1998-01-01' AS updated_at FROM a),
    b AS (SELECT p_brand AS kode, min(p_type || ' ' || p_name) AS deskripsi FROM part GROUP BY 1)
    SELECT dim.merek_sk, dim.kode, coalesce(b.deskripsi, dim.deskripsi) AS deskripsi,
           CASE WHEN b.kode IS NULL THEN dim.updated_at ELSE DATE '1999-01-01' END AS updated_at
    FROM dim LEFT JOIN b ON b.kode = dim.kode
    UNION ALL
    SELECT (SELECT coalesce(max(merek_sk), 0) FROM dim) + row_number() OVER (ORDER BY md5(kode)), kode, deskripsi, DATE '1999-01-01'
    FROM b WHERE kode NOT IN (SELECT kode FROM dim)""")
def scd1_upsert(t):
    """Brands with one description each, loaded from small parts, then from all with another text; several staged
    rows per brand are reduced to the first description."""
    empty = t.spark.range(0).select(
        F.col("id").alias("merek_sk"), F.lit(None).cast("string").alias("kode"),
        F.lit(None).cast("string").alias("deskripsi"), F.lit(None).cast("date").alias("updated_at"),
    )
    first = t.part.filter("p_size <= 10").select(F.col("p_brand").alias("kode"), F.col("p_type").alias("deskripsi"))
    second = t.part.select(F.col("p_brand").alias("kode"), F.concat_ws(" ", "p_type", "p_name").alias("deskripsi"))
    day = lambda d: F.lit(d).cast("date")
    dim = cut(dimensions.scd1_upsert(empty, first, "kode", ["deskripsi"], day("1998-01-01"), "merek_sk"))
    return dimensions.scd1_upsert(dim, second, "kode", ["deskripsi"], day("1999-01-01"), "merek_sk")


# --- history --------------------------------------------------------------------------------

@query("scd2_apply", f"""{HISTORY}
    SELECT {SK}, {KEY}, c_name, c_mktsegment, c_nationkey, CAST(valid_from AS DATE) AS valid_from,
           CAST(valid_to AS DATE) AS valid_to, is_current, row_hash FROM {LAST}""")
def scd2_apply(t):
    return _plain_dates(history(t))


@query("scd2_versions_per_key", f"""{HISTORY}
    SELECT versi, count(*) AS pelanggan FROM (SELECT {KEY}, count(*) AS versi FROM {LAST} GROUP BY {KEY}) v GROUP BY versi""")
def scd2_versions_per_key(t):
    return history(t).groupBy(KEY).agg(F.count(F.lit(1)).alias("versi")).groupBy("versi").agg(F.count(F.lit(1)).alias("pelanggan"))


ASOF = f"""
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS tanggal, coalesce(d.{SK}, -1) AS {SK}
    FROM orders LEFT JOIN {LAST} d ON d.{KEY} = o_custkey AND o_orderdate >= d.valid_from AND o_orderdate < d.valid_to"""


def _asof(t: Tables, method: str | None = None) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    found = facts.lookup_asof(orders, history(t), "o_custkey", KEY, "o_orderdate", SK, method=method)
    return found.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("tanggal"), SK)


@query("scd2_asof_lookup", HISTORY + ASOF)
def scd2_asof_lookup(t):
    return _asof(t)


@query("scd2_asof_join", HISTORY + ASOF)
def scd2_asof_join(t):
    """The same lookup without broadcasting."""
    return _asof(t, "join")


@query("warehouse_history", HISTORY + f"""
    SELECT {SK}, {KEY}, c_name, c_mktsegment, c_nationkey, CAST(valid_from AS DATE) AS valid_from, CAST(valid_to AS DATE) AS valid_to,
           is_current, row_hash FROM {LAST}""")
def warehouse_history(t):
    """The batches through a published dimension, the last of them twice; closed versions are written once."""
    w = Warehouse(t.spark, f"{work_folder(t.spark)}/wh/{uuid.uuid4().hex}")
    empty = dimensions.empty_scd2(batch(t, 0), KEY, TRACKED, SK)
    for i in [*range(len(BATCHES)), len(BATCHES) - 1]:
        w.merge_history("dim_pelanggan", batch(t, i), KEY, TRACKED, BATCHES[i][0] + " 00:00:00", SK, str(i), empty)
    return _plain_dates(w.read("dim_pelanggan"))


@query("scd2_asof_sweep", HISTORY + ASOF)
def scd2_asof_sweep(t):
    """The same lookup for dimensions with very many versions per key."""
    return _asof(t, "sweep")


@query("scd2_asof_segments", f"""{HISTORY}
    SELECT coalesce(d.c_mktsegment, 'Tidak diketahui') AS segmen, count(*) AS pesanan,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS nilai
    FROM orders LEFT JOIN {LAST} d ON d.{KEY} = o_custkey AND o_orderdate >= d.valid_from AND o_orderdate < d.valid_to
    GROUP BY 1""")
def scd2_asof_segments(t):
    """Order value by the segment the customer had at the time of the order. Once the key is
    looked up, a report joins on it alone; orders are summed per key before that join."""
    dim = dimensions.add_unknown(history(t), {
        SK: -1, KEY: -1, "c_name": "Tidak diketahui", "c_mktsegment": "Tidak diketahui", "is_current": True,
    })
    orders = t.orders.select("o_custkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("nilai"))
    found = facts.lookup_asof(orders, dim.filter(F.col(SK) != -1), "o_custkey", KEY, "o_orderdate", SK)
    per_key = found.groupBy(SK).agg(F.count(F.lit(1)).alias("n"), F.sum("nilai").alias("nilai"))
    return per_key.join(dim.select(SK, F.col("c_mktsegment").alias("segmen")), SK).groupBy("segmen").agg(
        F.sum("n").alias("pesanan"), F.sum("nilai").cast("double").alias("nilai")
    )


@query("scd2_fanout", f"""{HISTORY}
    SELECT (SELECT count(*) FROM orders) AS fact_rows,
           (SELECT count(*) FROM orders LEFT JOIN {LAST} d ON d.{KEY} = o_custkey) AS joined_rows""")
def scd2_fanout(t):
    return facts.fan_out(t.orders, history(t), "o_custkey", KEY)


BROKEN = f"""
    SELECT {KEY}, CASE WHEN c_mktsegment = 'HOME' THEN valid_from + INTERVAL 30 DAY ELSE valid_from END AS valid_from,
           CASE WHEN c_mktsegment = 'BUILDING' THEN valid_from ELSE valid_to END AS valid_to,
           is_current OR c_mktsegment = 'HOME' AS is_current
    FROM {LAST}"""


def _invariants_sql() -> str:
    return f"""
    SELECT (SELECT count(*) FROM v WHERE valid_to <= valid_from) AS empty_interval,
           (SELECT count(*) FROM v WHERE is_current <> (valid_to = TIMESTAMP '9999-12-31')) AS current_not_open,
           (SELECT count(*) FROM (SELECT {KEY} FROM v GROUP BY {KEY} HAVING count(*) FILTER (WHERE is_current) <> 1) g) AS not_one_current,
           (SELECT count(*) FROM (SELECT 1 FROM v GROUP BY {KEY}, valid_from HAVING count(*) > 1) g) AS repeated_start,
           (SELECT count(*) FROM (SELECT 1 FROM v WHERE NOT is_current GROUP BY {KEY}, valid_to HAVING count(*) > 1) g) AS repeated_end,
           (SELECT count(*) FROM v a WHERE NOT is_current
               AND NOT EXISTS (SELECT 1 FROM v b WHERE b.{KEY} = a.{KEY} AND b.valid_from = a.valid_to)) AS gap_after_version"""


@query("scd2_invariants", f"{HISTORY}, v AS (SELECT * FROM {LAST})" + _invariants_sql())
def scd2_invariants(t):
    return quality.scd2_invariants(history(t), KEY)


@query("scd2_invariants_broken", f"{HISTORY}, v AS ({BROKEN})" + _invariants_sql())
def scd2_invariants_broken(t):
    """The same checks on a history damaged on purpose: they must find something."""
    home, building = F.col("c_mktsegment") == "HOME", F.col("c_mktsegment") == "BUILDING"
    damaged = history(t).select(
        KEY,
        F.when(home, F.col("valid_from") + F.expr("INTERVAL 30 DAYS")).otherwise(F.col("valid_from")).alias("valid_from"),
        F.when(building, F.col("valid_from")).otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") | home).alias("is_current"),
    )
    return quality.scd2_invariants(damaged, KEY)
