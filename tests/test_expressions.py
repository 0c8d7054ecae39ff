import datetime as dt

import pytest
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators import calendar


def one(spark, sql_value, expression):
    return spark.sql(f"SELECT {sql_value} AS c").select(expression).first()[0]


@pytest.mark.parametrize("text, want", [
    ("'3'", 3), ("'3.7'", 4), ("'-2.5'", -3), ("'2.5'", 3), ("'1e2'", 100), ("' 7 '", 7), ("'x'", None), ("''", None),
    ("'12f'", None), ("CAST(NULL AS STRING)", None), ("'99999999999'", None), ("'.5'", 1), ("'5.'", 5), ("'+4'", 4),
])
def test_int_text(spark, text, want):
    assert one(spark, text, F.expr(X.int_text("c"))) == want


def test_bigint_text_keeps_large_whole_numbers(spark):
    assert one(spark, "'9007199254740993'", F.expr(X.bigint_text("c"))) == 9007199254740993


@pytest.mark.parametrize("text, want", [("'1.5'", 1.5), ("'3d'", None), ("'inf'", float("inf")), ("'1,5'", None), ("'-0.0'", 0.0)])
def test_double_text(spark, text, want):
    assert one(spark, text, F.expr(X.double_text("c"))) == want


def test_missing_and_blank(spark):
    df = spark.sql("SELECT * FROM VALUES (NULL), (''), (' '), ('a') AS t(c)")
    assert df.filter(X.is_missing("c")).count() == 2
    assert df.filter(X.is_blank("c")).count() == 3


@pytest.mark.parametrize("part, whole, want", [(29, 200, 0.15), (1, 8, 0.13), (0, 5, 0.0), (5, 19, 0.26), (2, 3, 0.67), (1, 0, None)])
def test_share_rounds_exact_halves_up(spark, part, whole, want):
    df = spark.sql(f"SELECT {part} AS a, {whole} AS b")
    assert df.select(X.share_2("a", "b")).first()[0] == want


def test_row_hash_trims_and_keeps_null_places(spark):
    df = spark.sql("SELECT * FROM VALUES ('a ', NULL, 'b'), ('a', '', ' b'), ('a', 'b', NULL) AS t(x, y, z)")
    h = [r[0] for r in df.select(X.row_hash(["x", "y", "z"])).collect()]
    assert h[0] == h[1] != h[2]


def test_date_keys(spark):
    df = spark.sql("SELECT DATE '2026-09-20' AS d, CAST(NULL AS DATE) AS n")
    assert df.select(X.date_key("d"), X.date_key_or_unknown("n"), X.month_of_key(X.date_key("d")),
                     X.month_of_key(F.lit(-1))).first()[:] == (20260920, -1, 202609, -1)


def test_local_time_and_offset(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2026-09-19 22:00:00' AS u")
    local = X.local_time("u", "Asia/Makassar")
    assert df.select(local, X.offset_seconds(local, "u")).first()[:] == (dt.datetime(2026, 9, 20, 6), 28800)


def test_circular_mean_wraps(spark):
    df = spark.sql("SELECT * FROM VALUES (350), (10) AS t(d)")
    assert df.agg(X.circular_mean("d")).first()[0] == pytest.approx(0.0)


def test_calendar(spark):
    dim = calendar.build_dim_date(spark)
    assert dim.count() == 1462 and len(dim.columns) == 11
    day = dim.filter("date_sk = 20260920").first()
    assert (day.triwulan, day.pekan_iso, day.hari_ke, day.nama_hari, day.nama_bulan, day.akhir_pekan) == (
        3, 38, 0, "Sunday", "September", True)
    unknown = dim.filter("date_sk = -1").first()
    assert (unknown.full_date, unknown.tahun, unknown.hari_ke, unknown.akhir_pekan) == (dt.date(1900, 1, 1), 1900, -1, False)
    assert dim.select("date_sk").distinct().count() == 1462


def test_calendar_names_and_roles(spark):
    days = ["Minggu", "Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu"]
    dim = calendar.build_dim_date(spark, "2026-09-20", "2026-09-21", day_names=days)
    assert {r.nama_hari for r in dim.collect()} == {"Minggu", "Senin", "TIDAK DIKETAHUI"}
    role = calendar.date_role(dim, "tanggal_analisis_sk", "tanggal_analisis")
    assert role.columns[:2] == ["tanggal_analisis_sk", "tanggal_analisis"]
