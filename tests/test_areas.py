"""Sales and campus: dirty fixtures with planted defects, cleaned by the documented rules."""

import datetime as dt
import hashlib
import random
from decimal import Decimal

import pytest

from stargrain.operators.profiling import profile
from stargrain.operators.quality import QualityGateError
from stargrain.plans import campus, sales
from stargrain.plans.profiles import PROFILES, T1_PROFILE, T2_PROFILE, TEMPLATE_PROFILE
from stargrain.plans.topics import TOPICS
from stargrain.sources.warehouse import Warehouse, assert_idempotent


@pytest.fixture(scope="module")
def shop(spark):
    rng = random.Random(3)
    tx, items = [], []
    for i in range(400):
        t = dt.datetime(2025, 1, 1) + dt.timedelta(hours=rng.randrange(0, 24 * 300))
        z = i % 7 == 0
        tx.append((f"T{i}", f"C{i % 30}", f"OUT-{'ABCD'[i % 4]}", ["selesai", "Selesai", "BATAL", "batal ", "x"][i % 5],
                   t.strftime("%Y-%m-%dT%H:%M:%SZ" if z else "%Y-%m-%d %H:%M:%S")))
        if i % 10:
            # a third of all lines belongs to one transaction
            for _ in range(200 if i == 1 else 1):
                items.append((f"T{i}", f"PRD-{rng.randrange(1, 20):04d}", str(-1 if i % 50 == 3 else 2), "1000"))
    for i in range(0, 400, 20):
        tx.append((f"T{i}", "C0", "OUT-A", "selesai", "2026-01-01 00:00:00"))  # sent again, later
    items += [("T5", "PRD-XXXX", "1", "500"), ("T-none", "PRD-0001", "1", "500")]
    return {
        "raw_transactions": spark.createDataFrame(tx, "transaction_id string, customer_id string, outlet_id string, status string, tanggal_waktu string"),
        "raw_transaction_items": spark.createDataFrame(items, "transaction_id string, product_id string, qty string, harga_satuan string"),
        "raw_products": spark.createDataFrame([(f"PRD-{i:04d}", str(1000 * (i % 9))) for i in range(1, 21)], "product_id string, harga_satuan string"),
    }, tx, items


def test_sales_profile(shop):
    tables, tx, items = shop
    got = {(r.table, r.metric): int(r.value) for r in profile(tables, T2_PROFILE).collect()}
    assert got[("raw_transactions", "baris")] == 420 and got[("raw_transactions", "id_unik")] == 400
    assert got[("raw_transactions", "id_duplikat")] == 20 and got[("raw_transactions", "varian_status")] == 5
    assert got[("raw_transactions", "timestamp_utc")] == sum(t[4].endswith("Z") for t in tx)
    assert got[("raw_transactions", "tanpa_item")] == 60  # 40 ids, 20 of them sent twice: rows are counted
    assert got[("raw_transaction_items", "qty_negatif")] == sum(i[2] == "-1" for i in items)
    assert got[("raw_transaction_items", "fk_orphan")] == 1
    assert got[("raw_products", "varian_harga")] == 9


def test_template_profile(shop):
    tables, _, _ = shop
    got = {r.metric: r.value for r in profile(tables, TEMPLATE_PROFILE).collect()}
    assert (got["qty_min"], got["qty_max"], got["harga_min"], got["harga_max"]) == ("-1", "2", "500", "1000")
    assert int(got["utc_tanpa_zona"]) + int(got["waktu_lokal"]) == 420 and got["customer_kosong"] == "0"


def test_sales_fact(spark, shop):
    tables, tx, items = shop
    products = spark.createDataFrame([(i, f"PRD-{i:04d}") for i in range(1, 21)], "product_sk int, product_id string")
    outlets = spark.createDataFrame([(1, "OUT-A"), (2, "OUT-B"), (3, "OUT-C")], "outlet_sk int, outlet_id string")
    clean = sales.clean_transactions(tables["raw_transactions"])
    assert clean.count() == 400
    utc = next(t for t in tx if t[4].endswith("Z") and int(t[0][1:]) % 20)
    moved = dt.datetime.strptime(utc[4], "%Y-%m-%dT%H:%M:%SZ") + dt.timedelta(hours=7)
    assert clean.filter(f"transaction_id = '{utc[0]}'").first().waktu == moved

    fact = sales.sales_item_fact(clean, sales.clean_items(tables["raw_transaction_items"]), products, outlets)
    rows = fact.collect()
    assert len(rows) == len({(i[0], i[1]) for i in items}) == len({(r.transaction_id, r.product_id) for r in rows})
    assert sum(r.jumlah_baris for r in rows) == len(items)
    assert sum(r.qty for r in rows) == sum(int(i[2]) for i in items)
    orphan = next(r for r in rows if r.transaction_id == "T-none")
    assert (orphan.date_sk, orphan.outlet_sk, orphan.status) == (-1, -1, None)
    assert next(r for r in rows if r.product_id == "PRD-XXXX").product_sk == -1
    assert {r.outlet_sk for r in rows if r.retur} and all(r.qty < 0 for r in rows if r.retur)

    k9 = sales.clean_transactions(
        tables["raw_transactions"], "outlet_id = 'OUT-A'",
        "CAST(waktu AS DATE) >= DATE '2025-01-01' AND CAST(waktu AS DATE) < DATE '2025-07-01'")
    part = sales.sales_item_fact(k9, sales.clean_items(tables["raw_transaction_items"]), products, outlets, sliced=True).collect()
    assert part and {r.outlet_sk for r in part} == {1} and all(20250101 <= r.date_sk < 20250701 for r in part)


def test_campus(spark):
    raw = spark.createDataFrame(
        [("1", "SD1", "2024-09-02", "Hadir"), ("1", "SD1", "02/09/2024", " alpa "), ("1", "SD1", "2024-09-09", "IJIN"),
         ("2", "SD1", "2024-09-02", "h"), ("9", "SD1", "32/13/2024", "?"), ("2", "XX", "2024-09-02", "Sakit")],
        "nim string, kode_mk string, tanggal string, status string")
    clean = campus.clean_attendance(raw)
    students = spark.createDataFrame([("1", 11), ("2", 12)], "nim string, mahasiswa_sk int")
    courses = spark.createDataFrame([("SD1", 5)], "kode_mk string, matakuliah_sk int")
    got = sorted(tuple(r) for r in campus.attendance_fact(clean, students, courses).collect())
    assert got == [
        ("1", "SD1", 20240902, "", 0, 11, 5, "HADIR", 1, 1), ("1", "SD1", 20240909, "", 0, 11, 5, "IZIN", 0, 1),
        ("2", "SD1", 20240902, "", 0, 12, 5, "HADIR", 1, 1), ("2", "XX", 20240902, "", 0, 12, -1, "SAKIT", 0, 1),
        ("9", "SD1", -1, hashlib.md5(b"TIDAK DIKETAHUI=32/13/2024").hexdigest(), 1, -1, 5, "TIDAK DIKETAHUI", 0, 1),
    ]
    prof = {r.metric: r.value for r in profile({"raw_presensi": raw}, [T1_PROFILE[1]]).collect()}
    assert (prof["baris"], prof["tanggal_format_lain"], prof["duplikat_grain"]) == ("6", "2", "0")
    master = spark.createDataFrame([("1", "2024", "aktif"), ("1", "2024", "lulus"), ("2", "2023", "aktif")], "nim string, angkatan string, status string")
    assert [r.nim for r in campus.students_of(master, "angkatan = '2024'").collect()] == ["1"]


def test_every_topic_has_a_suite():
    assert set(PROFILES) == {"t1", "t2", "t3", "template"}


def test_undated_meetings_stay_apart(spark):
    rows = [("1", "SD1", d, s) for d, s in (("2024-09-02junk", "h"), (None, "h"), (None, "h"), ("soon", "a"), ("2024-09-02", "h"), ("2024-09-02T08:00", "a"))]
    clean = campus.clean_attendance(spark.createDataFrame(rows, "nim string, kode_mk string, tanggal string, status string"))
    rows = clean.collect()
    got = sorted((str(r.tanggal), r.urutan, r.status) for r in rows)
    assert got == [("2024-09-02", 0, "HADIR"), ("None", 1, "ALPA"), ("None", 1, "HADIR"), ("None", 1, "HADIR"), ("None", 2, "HADIR")]
    assert len({r.isi for r in rows}) == 4  # none for the dated one, and three different contents


def campus_raw(spark):
    return {
        "raw_mahasiswa": spark.createDataFrame([("1", "Ani", "2024", "aktif"), ("2", "Budi", "2023", "aktif")], "nim string, nama string, angkatan string, status string"),
        "raw_matakuliah": spark.createDataFrame([("SD1", "Basis Data")], "kode_mk string, nama string"),
        "raw_presensi": spark.createDataFrame(
            [("1", "SD1", "2024-09-02", "h"), ("1", "SD1", "?", "h"), ("1", "SD1", "??", "h"), (" 2", "SD1", "02/09/2024", "h")],
            "nim string, kode_mk string, tanggal string, status string"),
        "raw_nilai": spark.createDataFrame([("1", "SD1", "A"), ("2", "SD1", "B")], "nim string, kode_mk string, nilai string"),
    }


def test_campus_load_twice_is_once(spark, tmp_path):
    raw = campus_raw(spark)
    w = Warehouse(spark, str(tmp_path / "all"))
    assert_idempotent(w, lambda: campus.load(raw, w, "b1"))
    assert w.row_counts()["fact_presensi"] == 4 and w.row_counts()["dim_mahasiswa"] == 3
    w = Warehouse(spark, str(tmp_path / "cohort"))
    campus.load(raw, w, "b1", "angkatan = '2024'")
    assert w.read("fact_presensi").select("nim").distinct().collect() == [("1",)]


def sales_raw(spark):
    tx = [("T1", "C1", "OUT-A", "ok", "2025-02-01 10:00:00"), ("T1", "C1", "OUT-A", "ok", "2024-12-31T23:00:00Z"),
          ("T2", "C1", "OUT-A", "ok", "2025-08-01 10:00:00"), ("T3", "C2", "OUT-B", "ok", "2025-02-01 10:00:00"),
          ("T4", "C2", "OUT-A", "ok", "2024-12-31T17:30:00Z")]
    items = [("T1", "P1", "2", "10.5"), ("T1", "P1", "1", "0.25"), ("T2", "P1", "1", "5"), ("T3", "P9", "1", "7"), ("T4", "P1", "1", "3"), ("T9", "P1", "1", "1")]
    return {
        "raw_outlets": spark.createDataFrame([("OUT-A", "Satu"), ("OUT-B", "Dua")], "outlet_id string, nama string"),
        "raw_products": spark.createDataFrame([("P1", "Kopi")], "product_id string, nama string"),
        "raw_customers": spark.createDataFrame([("C1",), ("C2",)], "customer_id string"),
        "raw_transactions": spark.createDataFrame(tx, "transaction_id string, customer_id string, outlet_id string, status string, tanggal_waktu string"),
        "raw_transaction_items": spark.createDataFrame(items, "transaction_id string, product_id string, qty string, harga_satuan string"),
    }


def test_prices_keep_their_decimals(spark):
    got = {(r.transaction_id, r.product_id): r.nilai for r in sales.clean_items(sales_raw(spark)["raw_transaction_items"]).collect()}
    assert got["T1", "P1"] == Decimal("21.2500")


def test_sales_load_twice_is_once(spark, tmp_path):
    raw = sales_raw(spark)
    w = Warehouse(spark, str(tmp_path))
    assert_idempotent(w, lambda: sales.load(raw, w, "b1"))
    assert w.row_counts()["fact_sales_item"] == 5
    lost = w.read("fact_sales_item").filter("transaction_id = 'T9'").first()
    assert (lost.date_sk, lost.outlet_sk) == (-1, -1)


def test_slices_reach_the_tables_that_depend_on_them(spark):
    cut = TOPICS["t2"].cut(sales_raw(spark), "k9")
    ids = lambda name: sorted({r.transaction_id for r in cut[name].collect()})
    assert cut["raw_outlets"].count() == 1
    assert ids("raw_transactions") == ids("raw_transaction_items") == ["T1", "T4"]  # T4 by its local time
    assert cut["raw_transactions"].count() == 3 and cut["raw_products"].count() == 1
    both = TOPICS["t2"].cut(sales_raw(spark), "k8")
    assert both["raw_transactions"].count() == 5
    cohort = TOPICS["t1"].cut(campus_raw(spark), "k5")
    assert [cohort[f"raw_{n}"].count() for n in ("mahasiswa", "presensi", "nilai", "matakuliah")] == [1, 1, 1, 1]


def test_load_stops_when_a_date_is_outside_the_calendar(spark, tmp_path):
    with pytest.raises(QualityGateError, match="penjualan_di_kalender"):
        sales.load(sales_raw(spark), Warehouse(spark, str(tmp_path)), "b1", calendar_range=("2025-01-01", "2025-03-31"))


def test_a_refused_batch_leaves_every_table_as_it_was(spark, tmp_path):
    w, raw = Warehouse(spark, str(tmp_path)), sales_raw(spark)
    sales.load(raw, w, "b1")
    before = {t: (w.read(t).count(), sorted(map(str, w.read(t).collect()))) for t in w.tables()}
    raw["raw_products"] = spark.createDataFrame([("P1", "Kopi Baru"), ("P2", "Teh")], "product_id string, nama string")
    with pytest.raises(QualityGateError, match="penjualan_di_kalender"):
        sales.load(raw, w, "b2", calendar_range=("2025-01-01", "2025-03-31"))
    assert before == {t: (w.read(t).count(), sorted(map(str, w.read(t).collect()))) for t in w.tables()}


def undated_batch(spark, raw, rows):
    return {**raw, "raw_presensi": spark.createDataFrame(rows, "nim string, kode_mk string, tanggal string, status string")}


def test_undated_records_of_two_batches_all_stay(spark, tmp_path):
    raw, w = campus_raw(spark), Warehouse(spark, str(tmp_path))
    one = undated_batch(spark, raw, [("1", "SD1", "junk z", "hadir")])
    two = undated_batch(spark, raw, [("1", "SD1", "junk a", "sakit"), ("1", "SD1", "junk z", "hadir"), ("1", "SD1", "junk z", "hadir")])
    got = lambda: sorted((r.status, r.urutan) for r in w.read("fact_presensi").collect())
    campus.load(one, w, "b1")
    assert got() == [("HADIR", 1)]
    for _ in range(2):
        campus.load(two, w, "b2")
        assert got() == [("HADIR", 1), ("HADIR", 2), ("SAKIT", 1)]
    campus.load(one, w, "b1")
    assert got() == [("HADIR", 1), ("HADIR", 2), ("SAKIT", 1)]


def test_a_corrected_date_moves_the_row(spark, tmp_path):
    raw, w = sales_raw(spark), Warehouse(spark, str(tmp_path))
    schema = "transaction_id string, customer_id string, outlet_id string, status string, tanggal_waktu string"
    batch = lambda when: {
        **raw, "raw_transactions": spark.createDataFrame([("T1", "C1", "OUT-A", "ok", when)], schema),
        "raw_transaction_items": spark.createDataFrame([("T1", "P1", "2", "10.5")], "transaction_id string, product_id string, qty string, harga_satuan string")}
    other = {**batch("2024-01-20 08:00:00"), "raw_transaction_items": spark.createDataFrame(
        [("T2", "P1", "1", "1")], "transaction_id string, product_id string, qty string, harga_satuan string"),
        "raw_transactions": spark.createDataFrame([("T2", "C1", "OUT-A", "ok", "2024-02-20 08:00:00")], schema)}
    dates = lambda: sorted((r.transaction_id, r.date_sk, r.bulan) for r in w.read("fact_sales_item").collect())
    sales.load(batch("kapan?"), w, "b1")
    assert dates() == [("T1", -1, -1)]
    sales.load(other, w, "b2")
    for when, date in (("2024-01-31 10:00:00", 20240131), ("2024-02-01 10:00:00", 20240201), ("kapan?", 20240201)):
        sales.load(batch(when), w, "b3")
        assert dates() == [("T1", date, date // 100), ("T2", 20240220, 202402)]


def test_two_batches_that_end_at_once(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    one = spark.range(3)
    with pytest.raises(FileExistsError, match="somebody else"):
        with w.staged() as mine:
            mine.publish("t", one, "a")
            mine.publish("t", one.limit(2), "a")  # a later write of the block replaces the first
            assert mine.read("t").count() == 2 and not w.exists("t")
            with w.staged() as other:
                other.publish("t", one.limit(1), "b")
    assert w.read("t").count() == 1
