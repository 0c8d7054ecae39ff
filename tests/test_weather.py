"""The weather subject area end to end, against the published answers of the snapshot."""

import contextlib
import datetime as dt
import io

import pytest
import weather_fixture
from stargrain.operators import facts, quality
from stargrain.operators.metrics import ADDITIVE, Measure, MetricError, aggregate
from stargrain.plans import weather
from stargrain.plans.profiles import T3_PROFILE
from stargrain.operators.profiling import profile
from stargrain.sources.raw import register_folder
from stargrain.sources.warehouse import Warehouse, assert_idempotent, months_between

BATCH, BATCH_TS = "20260919T152857Z", "2026-09-19 15:28:57"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("k3")
    weather_fixture.write(str(folder))
    return register_folder(spark, str(folder))


@pytest.fixture(scope="module")
def wh(spark, raw, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("wh")))
    pinned = weather.source_expectations(
        {"desa_run_terbaru_basi": 18, "hujan_berlabel_cerah": 30, "visibilitas_vs_kosong": 2874}
    )
    expectations = pinned + [weather.manifest_expectation(2874)] + weather.readability_expectations()
    assert_idempotent(w, lambda: weather.load(raw, w, BATCH, BATCH_TS, expectations))
    return w


def tables(w):
    return w.read("fact_prakiraan_cuaca"), w.read("dim_lokasi"), w.read("dim_date")


def test_row_counts_after_two_loads(wh):
    assert wh.row_counts() == {"dim_cuaca": 3, "dim_date": 1462, "dim_lokasi": 154, "fact_prakiraan_cuaca": 2874}


def test_warehouse_checks(spark, wh):
    t = {n: wh.read(n) for n in wh.tables()}
    res = quality.run_expectations(weather.warehouse_expectations(), t, spark)
    assert {r.name: r.violations for r in res.collect()} == {e.name: 0 for e in weather.warehouse_expectations()}
    quality.gate(res)
    assert quality.summary(res).first().suspicious


def test_source_checks(spark, raw):
    res = quality.run_expectations(weather.source_expectations(), raw, spark)
    got = {r.name: (r.violations, r.status, r.as_expected) for r in res.collect()}
    assert got == {
        "grain_desa_slot_run_unik": (0, "PASS", True),
        "desa_orphan_tanpa_master": (0, "PASS", True),
        "desa_run_terbaru_basi": (18, "FAIL", True),
        "hujan_berlabel_cerah": (30, "FAIL", True),
        "visibilitas_vs_kosong": (2874, "FAIL", True),
        "suhu_angin_di_luar_rentang_fisik": (0, "PASS", True),
    }
    assert "0 blocking deviations" in quality.report_text(res)


def test_q01_alert_villages(wh):
    fact, places, _ = tables(wh)
    rows = weather.q01(fact, places).collect()
    assert len(rows) == 67 and len({r.kecamatan for r in rows}) == 11
    assert sum(r.slot_siaga for r in rows) == 160
    assert sum(r.slot_angin > 0 for r in rows) == 48 and sum(r.slot_suhu > 0 for r in rows) == 19
    assert not any(r.slot_angin and r.slot_suhu for r in rows)
    assert [(r.slot_siaga, r.slot_total, r.rasio_siaga) for r in rows[:2]] == [(5, 19, 0.26)] * 2


def test_q02_ranking(wh):
    fact, places, _ = tables(wh)
    rows = weather.q02(fact, places).collect()
    assert sorted(r.peringkat for r in rows)[:4] == [1, 2, 3, 4]
    assert {r.rasio_desa for r in rows if r.peringkat <= 4} == {1.0}
    assert sum(r.peringkat == 12 and r.rasio_desa == 0 for r in rows) == 4


def test_q03_and_m01(wh):
    fact, places, days = tables(wh)
    rows = weather.q03(fact, places, days).collect()
    assert [(r.tanggal, r.nama_hari, r.desa_siaga, r.slot_siaga, r.perubahan_desa_siaga) for r in rows] == [
        (dt.date(2026, 9, 19), "Saturday", 0, 0, None),
        (dt.date(2026, 9, 20), "Sunday", 65, 76, 65),
        (dt.date(2026, 9, 21), "Monday", 66, 84, 1),
        (dt.date(2026, 9, 22), "Tuesday", 0, 0, -66),
    ]
    assert [r.slot_total for r in rows[1:3]] == [1224, 1224]
    assert sum(r.slot_angin for r in rows) == 98 and sum(r.slot_suhu for r in rows) == 62
    assert [(r.desa_siaga, r.desa_total) for r in weather.m01(fact, places, days).collect()][1:3] == [(65, 153), (66, 153)]
    w = weather.m01_window(fact, places, days).first()
    assert (w.desa_siaga, w.desa_total) == (67, 153)


def test_metric_refuses_hours_and_silent_threshold_changes(wh):
    fact, places, days = tables(wh)
    metric = weather.REGISTRY.get("desa_siaga_harian")
    with pytest.raises(MetricError):
        metric.compute(weather.newest_slots(fact, places), ["jam_lokal"])
    changed = metric.with_thresholds(siaga_angin=25.0)
    assert changed.version == 2
    with pytest.raises(MetricError):
        weather.REGISTRY.add(type(metric)(**{**metric.__dict__, "causes": changed.causes}))


def test_additivity(wh):
    fact, _, _ = tables(wh)
    with pytest.raises(MetricError):
        aggregate(fact, weather.MEASURES["t_celsius"], "sum")
    with pytest.raises(MetricError):
        aggregate(fact, weather.MEASURES["wd_deg"], "avg")
    with pytest.raises(MetricError):
        aggregate(fact, weather.MEASURES["tp_mm"], "sum")
    assert aggregate(fact, Measure("jumlah_slot", ADDITIVE, ("sum",)), "sum").first()[0] == 2874
    rain = aggregate(fact, weather.MEASURES["tp_mm"], "sum", place="kode_desa").first()[0]
    assert rain == pytest.approx(3.0 / 153)
    assert aggregate(fact, weather.MEASURES["wd_deg"], "circular_mean").first()[0] == 45.0


def test_month_pruning(wh):
    fact, _, _ = tables(wh)
    part = months_between(fact, "bulan", "tanggal_sk", 20260920, 20260921)
    assert part.count() == 1224
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        part.explain("formatted")
    assert "PartitionFilters: [isnotnull(bulan" in out.getvalue()


def test_profile(raw):
    got = {(r.check, r.metric): r.value for r in profile(raw, T3_PROFILE).collect()}
    assert got[("scalars", "baris")] == "2874" and got[("scalars", "desa")] == "153"
    values = {m: v for (_, m), v in got.items()}
    assert values["vs_kosong"] == "2874" and values["tp_nol"] == "2844"
    assert values["analysis_date_unik"] == "2" and values["baris_selisih"] == "0"


def test_later_run_history_and_stale_key(spark, raw, tmp_path):
    """A later run with a renamed, a removed and an added village: both runs stay, history grows."""
    w = Warehouse(spark, str(tmp_path / "wh"))
    weather.load(raw, w, "b1", BATCH_TS)

    def change(vs):
        kept = [v for v in vs if v[0] != "73.71.15.1010"]
        kept[0] = (kept[0][0], "Desa Baru", *kept[0][2:])
        return kept + [("73.71.15.1099", "Desa Tambahan", "73.71.15", "Kecamatan 15")]

    weather_fixture.write(str(tmp_path / "k3b"), run_hour="18", change=change)
    raw2 = register_folder(spark, str(tmp_path / "k3b"))
    with pytest.raises(quality.QualityGateError):  # forecasts of the removed village have no master
        weather.load(raw2, w, "b2", "2026-09-20 12:00:00")
    relaxed = [e for e in weather.source_expectations() if e.name != "desa_orphan_tanpa_master"]
    for _ in range(2):
        weather.load(raw2, w, "b2", "2026-09-20 12:00:00", relaxed)

    places = w.read("dim_lokasi")
    versions = places.filter("kode_desa = '73.71.01.1001'").orderBy("valid_from").collect()
    assert [(v.nama_desa, v.is_current) for v in versions] == [("Desa 1-1", False), ("Desa Baru", True)]
    assert versions[0].valid_to == versions[1].valid_from == dt.datetime(2026, 9, 20, 12)
    assert places.filter("kode_desa = '73.71.15.1010'").first().is_current  # no delete handling
    assert places.filter("kode_desa = '73.71.15.1099'").first().valid_from == dt.datetime(1970, 1, 1)
    assert places.count() == 156

    fact = w.read("fact_prakiraan_cuaca")
    assert fact.count() == 2874 + 2856  # 18 rows keep their run
    assert facts.latest_run(fact, ["kode_desa", "waktu_utc"], ["analisis_utc"]).count() == 2874
    # event time decides the version, also within one run
    names = fact.filter("kode_desa = '73.71.01.1001' AND batch_id = 'b2'").join(places, "lokasi_sk").groupBy("nama_desa").count()
    got = {r.nama_desa: r["count"] for r in names.collect()}
    assert set(got) == {"Desa 1-1", "Desa Baru"}
    assert weather.q01(fact, places).count() == 67


def test_views_for_sql_users(wh, spark):
    names = weather.register_views(wh)
    assert {"wh_dim_lokasi", "wh_prakiraan_terbaru", "wh_tanggal_analisis"} <= set(names)
    assert spark.sql("SELECT count(*) FROM wh_prakiraan_terbaru JOIN wh_tanggal_prakiraan USING (tanggal_sk)").first()[0] > 0


def test_villages_of_one_name_stay_apart(spark):
    from stargrain.operators import metrics

    rows = [("1", "Purwosari", 25.0, 20.0), ("2", "Purwosari", 25.0, 20.0), ("2", "Purwosari", 10.0, 34.0), ("3", "Lain", 1.0, 1.0)]
    slots = spark.createDataFrame(rows, "kode_desa string, nama_desa string, ws_kmh double, t_celsius double")
    got = metrics.alert_entities(slots, {"nama_desa": "desa", "kode_desa": "kode_desa"}, weather.CAUSES).collect()
    assert [(r.desa, r.kode_desa, r.slot_siaga) for r in got] == [("Purwosari", "2", 2), ("Purwosari", "1", 1)]


def test_metric_is_kept_up_to_date(spark, raw, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    weather.load(raw, w, BATCH, BATCH_TS, expectations=[], slice_id="k3")
    for _ in range(2):
        kept = weather.refresh_metric(w, BATCH)
        got = sorted((r.tanggal, r.desa_siaga, r.desa_total) for r in kept.filter("kode_kabkot = '73.71'").collect())
        assert got == sorted((r.tanggal, r.desa_siaga, r.desa_total) for r in weather.m01(*tables(w)).collect())
    before = w._newest(weather.METRIC_TABLE).parts
    assert weather.refresh_metric(w, "another batch").count() == len(got) and w._newest(weather.METRIC_TABLE).parts == before


def test_a_manifest_that_states_other_rows_stops_the_load(spark, raw, tmp_path):
    with pytest.raises(quality.QualityGateError, match="jumlah_baris_manifest"):
        weather.load(raw, Warehouse(spark, str(tmp_path)), BATCH, BATCH_TS, expectations=[], slice_id="k1")
