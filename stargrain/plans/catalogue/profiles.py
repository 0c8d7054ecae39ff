"""Profiling operators over the given tables read as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators import profiling, rows
from stargrain.operators.profiling import TableProfile
from stargrain.plans.catalogue.base import query
from stargrain.plans.profiles import offset_rule
from stargrain.session import cut
from stargrain.sources.raw import as_text


@query("profile_rows_distinct", """
    SELECT count(*) AS baris, count(DISTINCT o_orderkey) AS id_unik, count(DISTINCT o_custkey) AS pelanggan_unik FROM orders""")
def profile_rows_distinct(t):
    spec = TableProfile("orders", scalars={"baris": "count(*)"}, distinct={"id_unik": "o_orderkey", "pelanggan_unik": "o_custkey"})
    return profiling.scalar_profile(t.orders, spec)


@query("profile_dup_key", """
    SELECT count(*) AS nama_duplikat FROM (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1) g""")
def profile_dup_key(t):
    return rows.duplicate_groups(t.part, ["p_name"], "nama_duplikat")


@query("profile_dup_grain", """
    SELECT count(*) AS duplikat_grain
    FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) g""")
def profile_dup_grain(t):
    return rows.duplicate_groups(t.lineitem, ["l_orderkey", "l_linenumber"], "duplikat_grain")


@query("profile_missing", """
    SELECT count(*) AS baris,
           count(*) FILTER (WHERE quality IS NULL) AS label_null,
           count(*) FILTER (WHERE lang IS NULL OR lang = '') AS bahasa_kosong,
           count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS teks_kosong,
           count(*) FILTER (WHERE replace(lang, 'en', '') = '' OR lang IS NULL) AS bahasa_kosong_tanpa_en
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def profile_missing(t):
    """Missing as NULL, as empty text and as blank text, beside a foreign key without a row."""
    joined = t.documents.select("doc_id", "lang", "text").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    without_en = F.replace(F.col("lang"), F.lit("en"), F.lit(""))
    return joined.agg(
        F.count(F.lit(1)).alias("baris"),
        F.count_if(F.col("quality").isNull()).alias("label_null"),
        F.count_if(X.is_missing("lang")).alias("bahasa_kosong"),
        F.count_if(X.is_blank("text")).alias("teks_kosong"),
        F.count_if(X.is_missing(without_en)).alias("bahasa_kosong_tanpa_en"),
    )


@query("profile_variants", """
    SELECT count(DISTINCT l_returnflag) AS varian_tanda, count(DISTINCT l_linestatus) AS varian_status,
           count(DISTINCT l_linenumber) AS varian_nomor FROM lineitem""")
def profile_variants(t):
    spec = TableProfile("lineitem", distinct={"varian_tanda": "l_returnflag", "varian_status": "l_linestatus", "varian_nomor": "l_linenumber"})
    return profiling.scalar_profile(t.lineitem, spec)


@query("profile_freq", "SELECT o_orderpriority, count(*) AS baris FROM orders GROUP BY o_orderpriority ORDER BY 2 DESC")
def profile_freq(t):
    return profiling.frequencies(t.orders, ["o_orderpriority"], "baris")


@query("profile_freq2", """
    SELECT l_returnflag AS kode, l_linestatus AS deskripsi, count(*) AS baris FROM lineitem GROUP BY 1, 2 ORDER BY 3 DESC""")
def profile_freq2(t):
    named = t.lineitem.select(F.col("l_returnflag").alias("kode"), F.col("l_linestatus").alias("deskripsi"))
    return profiling.frequencies(named, ["kode", "deskripsi"], "baris")


@query("profile_minmax", """
    SELECT min(try_cast(qty AS INTEGER)) AS qty_min, max(try_cast(qty AS INTEGER)) AS qty_max,
           min(try_cast(harga AS BIGINT)) AS harga_min, max(try_cast(harga AS BIGINT)) AS harga_max,
           max(try_cast(diskon AS DOUBLE)) AS diskon_max, min(tanda) AS tanda_contoh
    FROM (SELECT CAST(l_quantity AS VARCHAR) AS qty, CAST(l_extendedprice AS VARCHAR) AS harga,
                 CAST(l_discount AS VARCHAR) AS diskon, l_returnflag AS tanda FROM lineitem) x""")
def profile_minmax(t):
    raw = as_text(t.lineitem.select("l_quantity", "l_extendedprice", "l_discount", "l_returnflag"))
    spec = TableProfile(
        "lineitem",
        typed={"_qty": X.int_text("l_quantity"), "_harga": X.bigint_text("l_extendedprice")},
        scalars={
            "qty_min": "min(_qty)", "qty_max": "max(_qty)", "harga_min": "min(_harga)", "harga_max": "max(_harga)",
            "diskon_max": f"max({X.double_text('l_discount')})",
        },
        examples={"tanda_contoh": "l_returnflag"},
    )
    return profiling.scalar_profile(raw, spec)


@query("profile_out_of_range", """
    SELECT count(*) FILTER (WHERE try_cast(saldo AS DOUBLE) < 0) AS saldo_negatif,
           count(*) FILTER (WHERE try_cast(saldo AS DOUBLE) NOT BETWEEN 0 AND 9000) AS saldo_luar_rentang,
           count(*) FILTER (WHERE try_cast(saldo AS INTEGER) > 9000 OR try_cast(saldo AS INTEGER) < -500) AS saldo_ekstrem,
           count(*) FILTER (WHERE try_cast(nama AS DOUBLE) NOT BETWEEN 0 AND 1) AS tak_terbaca_tidak_dihitung,
           count(*) FILTER (WHERE try_cast(nama AS DOUBLE) NOT BETWEEN 0 AND 1 OR try_cast(saldo AS DOUBLE) < 0) AS salah_satu,
           count(*) AS baris
    FROM (SELECT CAST(c_acctbal AS VARCHAR) AS saldo, c_name AS nama FROM customer) x""")
def profile_out_of_range(t):
    """Range tests under three-valued logic: an unreadable number is not out of range."""
    raw = as_text(t.customer.select("c_acctbal", "c_name"))
    spec = TableProfile(
        "customer",
        typed={"_saldo": X.double_text("c_acctbal"), "_bulat": X.int_text("c_acctbal"), "_nama": X.double_text("c_name")},
        scalars={
            "saldo_negatif": "count_if(_saldo < 0)",
            "saldo_luar_rentang": "count_if(_saldo NOT BETWEEN 0 AND 9000)",
            "saldo_ekstrem": "count_if(_bulat > 9000 OR _bulat < -500)",
            "tak_terbaca_tidak_dihitung": "count_if(_nama NOT BETWEEN 0 AND 1)",
            "salah_satu": "count_if(_nama NOT BETWEEN 0 AND 1 OR _saldo < 0)",
            "baris": "count(*)",
        },
    )
    return profiling.scalar_profile(raw, spec)


@query("profile_zero", """
    SELECT count(*) FILTER (WHERE try_cast(CAST(l_discount AS VARCHAR) AS DOUBLE) = 0) AS diskon_nol,
           count(*) FILTER (WHERE try_cast(CAST(l_tax AS VARCHAR) AS DOUBLE) = 0) AS pajak_nol, count(*) AS baris FROM lineitem""")
def profile_zero(t):
    raw = as_text(t.lineitem.select("l_discount", "l_tax"))
    spec = TableProfile("lineitem", scalars={
        "diskon_nol": f"count_if({X.double_text('l_discount')} = 0)",
        "pajak_nol": f"count_if({X.double_text('l_tax')} = 0)",
        "baris": "count(*)",
    })
    return profiling.scalar_profile(raw, spec)


@query("profile_pattern", """
    SELECT count(*) FILTER (WHERE url LIKE 'https://%') AS aman, count(*) FILTER (WHERE url NOT LIKE 'https://%') AS tidak_aman,
           count(*) FILTER (WHERE url LIKE '%#top') AS berakhiran_top, count(*) FILTER (WHERE url LIKE '%.example.___/%') AS posisi
    FROM pages""")
def profile_pattern(t):
    spec = TableProfile("pages", scalars={
        "aman": "count_if(url LIKE 'https://%')",
        "tidak_aman": "count_if(url NOT LIKE 'https://%')",
        "berakhiran_top": "count_if(url LIKE '%#top')",
        "posisi": "count_if(url LIKE '%.example.___/%')",
    })
    return profiling.scalar_profile(t.pages, spec)


@query("profile_date_formats", """
    SELECT count(*) FILTER (WHERE tanggal LIKE '__/__/____') AS tanggal_format_lain,
           count(*) FILTER (WHERE tanggal LIKE '%Z') AS timestamp_utc,
           count(*) FILTER (WHERE tanggal NOT LIKE '%Z') AS waktu_lokal, count(*) AS baris
    FROM (SELECT CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
                                    WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
                                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS tanggal FROM orders) x""")
def profile_date_formats(t):
    """One column, three date formats (by order status)."""
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "P", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )
    spec = TableProfile("orders", scalars={
        "tanggal_format_lain": "count_if(tanggal LIKE '__/__/____')",
        "timestamp_utc": "count_if(tanggal LIKE '%Z')",
        "waktu_lokal": "count_if(tanggal NOT LIKE '%Z')",
        "baris": "count(*)",
    })
    return profiling.scalar_profile(t.orders.select(text.alias("tanggal")), spec)


CLOCKS = """
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc_datetime,
           strftime(ts + CASE WHEN event_type = 'signup' THEN INTERVAL 7 HOUR ELSE INTERVAL 8 HOUR END, '%Y-%m-%d %H:%M:%S') AS local_datetime
    FROM events"""
GAP = "epoch(strptime(local_datetime, '%Y-%m-%d %H:%M:%S')) - epoch(strptime(utc_datetime, '%Y-%m-%d %H:%M:%S'))"


@query("profile_offset", f"""
    SELECT count(*) FILTER (WHERE {GAP} = 25200) AS selisih_7jam, count(*) FILTER (WHERE {GAP} = 28800) AS selisih_8jam,
           count(*) AS baris FROM ({CLOCKS}) c""")
def profile_offset(t):
    """Time-zone offset between two text clocks; sign-ups stand for a source in another zone."""
    text = "yyyy-MM-dd HH:mm:ss"
    local = F.when(F.col("event_type") == "signup", X.local_time("ts", "Asia/Jakarta")).otherwise(X.local_time("ts", "Asia/Makassar"))
    raw = t.events.select(F.date_format("ts", text).alias("utc_datetime"), F.date_format(local, text).alias("local_datetime"))
    spec = TableProfile("events", scalars={
        "selisih_7jam": offset_rule("local_datetime", "utc_datetime", 25200),
        "selisih_8jam": offset_rule("local_datetime", "utc_datetime", 28800),
        "baris": "count(*)",
    })
    return profiling.scalar_profile(raw, spec)


LOOSE = f"""
    SELECT utc_datetime, CASE event_id % 6 WHEN 0 THEN local_datetime || ' ' WHEN 1 THEN replace(local_datetime, ' ', 'T') WHEN 2 THEN local_datetime || 'Z'
                              WHEN 3 THEN replace(local_datetime, '2024-01-', '2024-1-') ELSE local_datetime END AS local_datetime
    FROM ({CLOCKS.replace("SELECT ", "SELECT event_id, ", 1)}) c"""
EXACT = "regexp_full_match(local_datetime, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}')"


@query("profile_offset_strict", f"""
    SELECT count(*) FILTER (WHERE {EXACT} AND epoch(try_strptime(local_datetime, '%Y-%m-%d %H:%M:%S')) - epoch(strptime(utc_datetime, '%Y-%m-%d %H:%M:%S')) = 28800)
               AS selisih_8jam,
           count(*) FILTER (WHERE NOT {EXACT}) AS tak_terbaca, count(*) AS baris FROM ({LOOSE}) c""")
def profile_offset_strict(t):
    """Clocks that only a lenient reader takes (a blank or a zone behind, a T between, a zero lacking) are none."""
    text = "yyyy-MM-dd HH:mm:ss"
    local = F.when(F.col("event_type") == "signup", X.local_time("ts", "Asia/Jakarta")).otherwise(X.local_time("ts", "Asia/Makassar"))
    clock, k = F.date_format(local, text), F.col("event_id") % 6
    loose = (F.when(k == 0, F.concat(clock, F.lit(" "))).when(k == 1, F.replace(clock, F.lit(" "), F.lit("T"))).when(k == 2, F.concat(clock, F.lit("Z")))
             .when(k == 3, F.replace(clock, F.lit("2024-01-"), F.lit("2024-1-"))).otherwise(clock))
    raw = t.events.select(F.date_format("ts", text).alias("utc_datetime"), loose.alias("local_datetime"))
    spec = TableProfile("events", scalars={
        "selisih_8jam": offset_rule("local_datetime", "utc_datetime", 28800),
        "tak_terbaca": f"count_if({X.clock_text('local_datetime')} IS NULL)",
        "baris": "count(*)",
    })
    return profiling.scalar_profile(raw, spec)


SKETCHED = ("o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")


@query("profile_sketches", " UNION ALL ".join(f"""
    SELECT '{c}' AS kolom, (SELECT count(DISTINCT {c}) FROM orders) AS unik, (SELECT count({c}) FROM orders) AS terisi,
           true AS unik_dalam_batas, true AS median_dalam_batas""" for c in SKETCHED))
def profile_sketches(t):
    """Distinct counts and medians from sketches of single months, merged, beside exact counts: four batches are sketched
    one by one, and no earlier row is read again."""
    dated = t.orders.withColumn("bulan", X.month_of_key(X.date_key("o_orderdate")))
    kept = None
    for k in range(4):
        fresh = profiling.sketches(dated.filter(F.col("o_orderkey") % 4 == k), SKETCHED, "bulan")
        kept = cut(fresh if kept is None else profiling.merged_sketches(kept.unionByName(fresh), ["bulan"]))
    rough = profiling.sketch_profile(kept)
    numbers = profiling.sketch_numbers
    exact = reduce(DataFrame.union, [
        t.orders.select(F.lit(c).alias("kolom"), F.col(c).cast("string").alias("v"), numbers(t.orders, c).alias("x")).groupBy("kolom").agg(
            F.count_distinct("v").alias("unik"), F.count("v").alias("terisi"),
            F.percentile("x", F.array(F.lit(0.5 - profiling.RANK_ERROR), F.lit(0.5 + profiling.RANK_ERROR))).alias("around"))
        for c in SKETCHED])
    inside = (F.col("median") >= F.floor(F.get("around", F.lit(0)))) & (F.col("median") <= F.ceil(F.get("around", F.lit(1))))
    return exact.join(rough.drop("terisi"), "kolom").select(
        "kolom", "unik", "terisi",
        (F.abs(F.col("perkiraan_unik") - F.col("unik")) <= F.greatest(F.lit(1.0), profiling.DISTINCT_ERROR * F.col("unik"))).alias("unik_dalam_batas"),
        F.coalesce(inside, F.lit(True)).alias("median_dalam_batas"))


@query("profile_orphans", """
    SELECT (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)) AS tanpa_item,
           (SELECT count(*) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)) AS tanpa_pesanan,
           (SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_type <> 'PROMO')) AS fk_orphan""")
def profile_orphans(t):
    """Orders without lines, customers without orders, lines whose product is not in a master
    that lacks one product type."""
    parts = t.part.filter("p_type <> 'PROMO'")
    return rows.one_row(
        rows.orphan_rows(t.orders, "o_orderkey", t.lineitem, "l_orderkey", "tanpa_item"),
        rows.orphan_rows(t.customer, "c_custkey", t.orders, "o_custkey", "tanpa_pesanan"),
        rows.orphan_rows(t.lineitem, "l_partkey", parts, "p_partkey", "fk_orphan"),
    )


@query("orphan_keys", """
    SELECT l_partkey, count(*) AS rows FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_type <> 'PROMO') GROUP BY l_partkey""")
def orphan_keys(t):
    """Which foreign keys lack a parent, and how many rows hang on each."""
    return rows.orphan_keys(t.lineitem, "l_partkey", t.part.filter("p_type <> 'PROMO'"), "p_partkey")


SUITE = (
    TableProfile(
        "orders",
        scalars={"baris": "count(*)", "pelanggan_kosong": "count_if(o_custkey IS NULL OR o_custkey = '')"},
        distinct={"id_unik": "o_orderkey", "varian_status": "o_orderstatus"},
        duplicates={"id_duplikat": ("o_orderkey",)},
        frequencies={"status": ("o_orderstatus",)},
        childless={"tanpa_item": ("o_orderkey", "lineitem", "l_orderkey")},
    ),
    TableProfile(
        "lineitem",
        scalars={"baris": "count(*)", "qty_negatif": f"count_if({X.int_text('l_quantity')} < 0)"},
        duplicates={"duplikat_grain": ("l_orderkey", "l_linenumber")},
        orphans={"fk_orphan": ("l_partkey", "part", "p_partkey")},
    ),
    TableProfile("part", scalars={"produk": "count(*)"}, distinct={"varian_harga": "p_retailprice"}),
)


def _metric(table: str, check: str, metric: str, count: str) -> str:
    return f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{metric}' AS metric, CAST(({count}) AS VARCHAR) AS value"


@query("profile_suite", " UNION ALL ".join([
    _metric("orders", "scalars", "baris", "SELECT count(*) FROM orders"),
    _metric("orders", "scalars", "pelanggan_kosong", "SELECT count(*) FROM orders WHERE o_custkey IS NULL"),
    _metric("orders", "scalars", "id_unik", "SELECT count(DISTINCT o_orderkey) FROM orders"),
    _metric("orders", "scalars", "varian_status", "SELECT count(DISTINCT o_orderstatus) FROM orders"),
    _metric("orders", "duplicates", "id_duplikat", "SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) g"),
    _metric("orders", "childless", "tanpa_item", "SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"),
    "SELECT 'orders', 'frequency', 'status: ' || o_orderstatus, CAST(count(*) AS VARCHAR) FROM orders GROUP BY o_orderstatus",
    _metric("lineitem", "scalars", "baris", "SELECT count(*) FROM lineitem"),
    _metric("lineitem", "scalars", "qty_negatif", "SELECT count(*) FROM lineitem WHERE l_quantity < 0"),
    _metric("lineitem", "duplicates", "duplikat_grain",
            "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) g"),
    _metric("lineitem", "orphans", "fk_orphan", "SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)"),
    _metric("part", "scalars", "produk", "SELECT count(*) FROM part"),
    _metric("part", "scalars", "varian_harga", "SELECT count(DISTINCT p_retailprice) FROM part"),
]))
def profile_suite(t):
    columns = {
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus"],
        "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"],
        "part": ["p_partkey", "p_retailprice"],
    }
    return profiling.profile({n: as_text(getattr(t, n).select(*cs)) for n, cs in columns.items()}, SUITE)
