import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from stargrain import session
from stargrain.operators import dimensions, facts, quality
from stargrain.operators.profiling import TableProfile, profile, profile_json, profile_markdown, scalar_profile, write_profile
from stargrain.plans.topics import TOPICS, profile_slice
from stargrain.session import cut, shared_folder
from stargrain.sources.raw import read_text_csv, register_folder, slice_by, view_name
from stargrain.sources.warehouse import CLOSED_FOLDERS, LOG_LINES, Warehouse, assert_idempotent, changed_parts, months_between
from stargrain.streaming.batches import merge_stream


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "mahasiswa.csv").write_bytes(
        b"nim,angkatan,status\r\n1,2024,aktif\r\n2,2023, \r\n2,,Aktif\r\n3,2024,\"\"\r\n"
    )
    (tmp_path / "nilai.csv").write_bytes(b"nim,nilai_angka\r\n1,101\r\n2,100\r\n3,x\r\n4,-1\r\n5,100.4\r\n")
    (tmp_path / "SOURCE.md").write_text("not a table")
    return str(tmp_path)


def test_csv_is_text_and_empty_is_null(spark, folder):
    raw = read_text_csv(spark, folder + "/mahasiswa.csv")
    assert {t for _, t in raw.dtypes} == {"string"}
    assert [r.status for r in raw.orderBy("nim", "status").collect()] == ["aktif", " ", "Aktif", None]
    assert raw.filter("angkatan IS NULL").count() == 1


def test_folder_becomes_views(spark, folder):
    assert view_name("/a/b/desa.csv") == "raw_desa"
    assert sorted(register_folder(spark, folder)) == ["raw_mahasiswa", "raw_nilai"]
    assert spark.sql("SELECT count(*) FROM raw_nilai").first()[0] == 5


def test_named_table_may_be_a_folder_of_parts(spark, folder, tmp_path):
    spark.range(100).selectExpr("CAST(id AS STRING) AS nim").repartition(4).write.option("header", True).csv(str(tmp_path / "presensi.csv"))
    tables = register_folder(spark, folder, ["nilai.csv", "presensi.csv"])
    assert sorted(tables) == ["raw_nilai", "raw_presensi"]
    assert spark.table("raw_presensi").agg(F.count_distinct("nim")).first()[0] == 100


def test_profile_suite_and_reports(spark, folder, tmp_path):
    tables = register_folder(spark, folder)
    spec = TableProfile(
        "raw_mahasiswa", scalars={"baris": "count(*)", "angkatan_kosong": "count_if(angkatan IS NULL OR angkatan = '')"},
        distinct={"nim_unik": "nim"}, duplicates={"nim_duplikat": ("nim",)}, frequencies={"status": ("status",)},
        childless={"tanpa_nilai": ("nim", "raw_nilai", "nim")},
    )
    from stargrain.plans.profiles import T1_PROFILE

    result = profile(tables, [spec, T1_PROFILE[2]])
    got = {(r.table, r.metric): r.value for r in result.collect()}
    assert got[("raw_mahasiswa", "baris")] == "4" and got[("raw_mahasiswa", "angkatan_kosong")] == "1"
    assert got[("raw_mahasiswa", "nim_duplikat")] == "1" and got[("raw_mahasiswa", "tanpa_nilai")] == "0"
    assert got[("raw_mahasiswa", "status: NULL")] == "1"
    assert got[("raw_nilai", "nilai_luar_rentang")] == "2"
    assert "| duplicates | nim_duplikat | 1 |" in profile_markdown(result, "T1")
    assert '"metric": "nim_unik"' in profile_json(result)
    write_profile(result, str(tmp_path / "profile"))
    assert spark.read.json(str(tmp_path / "profile")).count() == result.count()
    assert scalar_profile(tables["raw_mahasiswa"], spec, approximate=True).first().nim_unik == 3


def test_slices(spark, folder):
    topic = TOPICS["t1"]
    raw = read_text_csv(spark, folder + "/mahasiswa.csv")
    assert slice_by(raw, topic.slice("k4").where["mahasiswa"]).count() == 2
    assert slice_by(raw, None).count() == 4
    with pytest.raises(KeyError):
        topic.slice("k3")
    assert TOPICS["t3"].path("/data", "k3") == "/data/t3_publik/k3"


def test_topic_tables_apply_the_slice(spark, tmp_path):
    os.makedirs(tmp_path / "t1_kampus")
    (tmp_path / "t1_kampus" / "mahasiswa.csv").write_text("nim,angkatan\n1,2024\n2,2023\n")
    (tmp_path / "t1_kampus" / "presensi.csv").write_text("nim\n1\n2\n")
    tables = TOPICS["t1"].tables(spark, str(tmp_path), "k4")
    assert tables["raw_mahasiswa"].count() == 1 and tables["raw_presensi"].count() == 1


def test_slice_and_columns_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = plan_of(slice_by(orders, "o_orderstatus = 'P'").groupBy("o_orderpriority").count())
    assert "EqualTo(o_orderstatus,P)" in plan and "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in plan


def test_publish_switches_and_counts(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    assert w.tables() == [] and not w.exists("d") and w.row_counts() == {}
    w.publish("d", spark.range(3), "1")
    old = w.read("d")
    w.publish("d", w.read("d").union(spark.range(2)), "2")  # reads the table it replaces
    assert w.row_counts() == {"d": 5} and old.count() == 3
    assert w.register()["d"].count() == spark.table("wh_d").count() == 5
    with pytest.raises(LookupError):
        w.read("nothing")


def test_unfinished_publish_is_invisible(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.publish("d", spark.range(3), "1")
    spark.range(99).write.parquet(str(tmp_path / "d" / "2-dead"))  # written, never recorded
    assert w.read("d").count() == 3
    assert w.vacuum("d") == 1 and w.read("d").count() == 3 and w.vacuum("d") == 0


def test_two_writers_one_wins(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.publish("d", spark.range(3), "1")
    before = w._newest("d")
    w.publish("d", spark.range(4), "2")
    with pytest.raises(FileExistsError):
        w._record(before, dataclasses.replace(before, seq=before.seq + 1, batch_id="late"))
    assert w.read("d").count() == 4


def test_log_stays_short_and_fails_closed(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    for k in range(LOG_LINES + 3):
        w.publish("d", spark.range(k), str(k))
    lines = sorted(f for f in os.listdir(tmp_path / "_published" / "d") if f.endswith(".json"))
    assert len(lines) == LOG_LINES and w.read("d").count() == LOG_LINES + 2
    (tmp_path / "_published" / "d" / lines[-1]).write_text("{broken")
    with pytest.raises(Exception):  # noqa: B017  unreadable, whatever the reason, isn't "nothing published"
        w.merge_months("d", fact(spark, ("a", 20240105, 1.0, "1")), ("k", "tanggal_sk"), ("v",), "x", "tanggal_sk")


def fact(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, tanggal_sk int, v double, batch_id string")


def test_merge_rewrites_touched_months_only(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    args = (("k", "tanggal_sk"), ("v", "batch_id"))
    w.merge_months("f", fact(spark, ("a", 20240105, 1.0, "1"), ("b", 20240205, 1.0, "1"), ("c", -1, 1.0, "1")), *args, "1", "tanggal_sk")
    files = lambda m: sorted(os.listdir(tmp_path / "f" / "months" / f"bulan={m}"))
    before = files(202401), files(-1)
    assert len(files(202402)) == 1
    w.merge_months("f", fact(spark, ("b", 20240205, 2.0, "2"), ("n", 20240301, 3.0, "2")), *args, "2", "tanggal_sk")
    assert (files(202401), files(-1)) == before and len(files(202402)) == 2
    assert w.vacuum("f") == 1 and len(files(202402)) == 1
    assert sorted((r.k, r.v) for r in w.read("f").collect()) == [("a", 1.0), ("b", 2.0), ("c", 1.0), ("n", 3.0)]
    plan = plan_of(months_between(w.read("f"), "bulan", "tanggal_sk", 20240201, 20240301))
    assert "PartitionFilters: [isnotnull(bulan" in plan
    with pytest.raises(ValueError):
        w.merge_months("f", fact(spark), ("k",), ("v",), "3", "tanggal_sk")


def test_rows_that_move_are_found_without_further_steps(spark, tmp_path, monkeypatch):
    """Undated rows keep their date, months are those that rows leave and enter, and only the batch itself is written on the way."""
    w, steps = Warehouse(spark, str(tmp_path)), []
    write = session._write
    monkeypatch.setattr(session, "_write", lambda df, path: steps.append(path) or write(df, path))
    schema = "k string, tanggal_sk int, v double, batch_id string"
    load = lambda n, *rows: w.merge_months("f", spark.createDataFrame(rows, schema), ("k",), ("v", "batch_id"), n, "tanggal_sk", moves=True)
    load("1", ("a", 20240105, 1.0, "1"), ("b", 20240205, 1.0, "1"), ("c", -1, 1.0, "1"), ("d", 20240405, 1.0, "1"))
    steps.clear()
    before = w._newest("f").parts
    load("2", ("a", 20240301, 2.0, "2"), ("b", -1, 2.0, "2"), ("n", 20240303, 2.0, "2"))
    after = w._newest("f").parts
    assert len(steps) == 1
    assert sorted(after) == ["-1", "202402", "202403", "202404"] and {m for m in after if after[m] == before.get(m)} == {"-1", "202404"}
    load("3", ("c", 20240406, 3.0, "3"), ("u", None, 3.0, "3"))
    got = sorted((r.k, r.tanggal_sk, r.bulan, r.v) for r in w.read("f").collect())
    assert got == [("a", 20240301, 202403, 2.0), ("b", 20240205, 202402, 2.0), ("c", 20240406, 202404, 3.0), ("d", 20240405, 202404, 1.0),
                   ("n", 20240303, 202403, 2.0), ("u", -1, -1, 3.0)]
    assert sorted(w._newest("f").parts) == ["-1", "202402", "202403", "202404"]
    for rows, said in (([("x", 20240101, 1.0, "4")] * 2, "up to 2 times"), ([(None, 20240101, 1.0, "4"), ("y", 20240101, 1.0, "4")], "1 merge keys")):
        with pytest.raises(ValueError, match=said):
            load("4", *rows)


def test_append_is_not_idempotent(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    with pytest.raises(AssertionError, match="not idempotent"):
        assert_idempotent(w, lambda: w.append("f", fact(spark, ("a", 20240105, 1.0, "1")), "1"))
    assert w.row_counts() == {"f": 2}


def test_cut_writes_to_the_folder_of_the_session(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    out = cut(spark.range(5).withColumn("x", F.lit(None).cast("string")))
    assert out.count() == 5 and os.path.isdir(folder + "/cut")
    assert "Scan parquet" in plan_of(out) and "Range" not in plan_of(out)


def test_stream_of_batches_equals_batch_loads(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", 20240105, 1.0), ("b", 20240205, 1.0)], [("a", 20240105, 2.0), ("c", 20240210, 5.0)]
    for part in rows:
        spark.createDataFrame(part, "k string, tanggal_sk int, v double").coalesce(1).write.mode("append").json(source)
    w = Warehouse(spark, str(tmp_path / "wh"))
    stream = spark.readStream.schema("k string, tanggal_sk int, v double").option("maxFilesPerTrigger", 1).json(source)
    q = merge_stream(stream, w, "f", lambda df, b: df.withColumn("batch_id", F.lit(b)), ("k", "tanggal_sk"), ("v", "batch_id"), "tanggal_sk")
    q.awaitTermination(120)
    assert q.exception() is None
    assert sorted((r.k, r.v) for r in w.read("f").collect()) == [("a", 2.0), ("b", 1.0), ("c", 5.0)]
    assert facts.fingerprint(w.read("f")).first().n_rows == 3


def test_profile_of_a_slice_counts_the_whole_topic(spark, tmp_path):
    folder = tmp_path / "t1_kampus"
    os.makedirs(folder)
    (folder / "mahasiswa.csv").write_text("nim,angkatan,status\n1,2024,a\n2,2023,b\n2,,b\n")
    (folder / "presensi.csv").write_text("nim,kode_mk,tanggal,status\n1,x,01/02/2024,h\n")
    (folder / "nilai.csv").write_text("nim,nilai_angka\n1,101\n")
    got = {(r.table, r.metric): r.value for r in profile_slice(spark, str(tmp_path), "t1", "k4").collect()}
    assert got["raw_mahasiswa", "baris"] == "3" and got["raw_mahasiswa", "nim_duplikat"] == "1"
    assert got["raw_presensi", "tanggal_format_lain"] == "1" and got["raw_nilai", "nilai_luar_rentang"] == "1"


def test_profile_of_a_forecast_slice_uses_its_zone(spark, tmp_path):
    for k, local in (("k1", "2026-01-01 07:00:00"), ("k3", "2026-01-01 08:00:00")):
        os.makedirs(tmp_path / "t3_publik" / k)
        (tmp_path / "t3_publik" / k / "desa.csv").write_text("kode,desa,kecamatan\n1,a,b\n")
        (tmp_path / "t3_publik" / k / "prakiraan_cuaca.csv").write_text(
            "adm4,analysis_date,time_index,vs,tp,weather,weather_desc,local_datetime,utc_datetime\n"
            f"1,2026,0-1,,0,1,Cerah,{local},2026-01-01 00:00:00\n")
        got = {r.metric: r.value for r in profile_slice(spark, str(tmp_path), "t3", k).collect()}
        assert (got["baris"], got["baris_selisih"]) == ("1", "1")


def test_history_writes_closed_versions_once(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    stage = lambda *rows: spark.createDataFrame(list(rows), "k string, a string")
    empty = dimensions.empty_scd2(stage(), "k", ("a",), "sk")
    load = lambda ts, *rows: w.merge_history("d", stage(*rows), "k", ("a",), ts, "sk", ts[:4], empty)
    load("2020-01-01 00:00:00", ("x", "1"), ("y", "1"))
    load("2021-01-01 00:00:00", ("x", "2"), ("y", "1"), ("x", "2"))  # a repeated stage key opens one version
    closed = [f for f in os.listdir(tmp_path / "d") if f.startswith("closed")]
    before = w.fingerprints()
    load("2021-01-01 00:00:00", ("x", "2"), ("y", "1"))
    assert w.fingerprints() == before and [f for f in os.listdir(tmp_path / "d") if f.startswith("closed")] == closed and len(closed) == 1
    got = sorted((r.k, r.a, r.is_current) for r in w.read("d").collect())
    assert got == [("x", "1", False), ("x", "2", True), ("y", "1", True)]
    assert w.vacuum("d") == 2 and w.read("d").count() == 3


def test_history_reads_no_closed_version_and_keeps_few_folders(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path))
    stage = lambda n: spark.range(3).selectExpr("CAST(id AS STRING) AS k", f"CAST(IF(id < 2, {n}, 0) AS STRING) AS a")
    empty = dimensions.empty_scd2(stage(0), "k", ("a",), "sk")
    load = lambda n: w.merge_history("d", stage(n), "k", ("a",), f"{2000 + n}-01-01 00:00:00", "sk", str(n), empty)
    batches = 2 * CLOSED_FOLDERS + 2
    for n in range(batches):
        load(n)
        parts = [k for k in w._newest("d").parts if k.startswith("closed")]
        assert len(parts) <= 2 * (CLOSED_FOLDERS - 1)
    rows = w.read("d").collect()
    assert len(rows) == 2 * batches + 1 and sorted(r.sk for r in rows) == list(range(1, 2 * batches + 2))
    assert quality.scd2_invariants(w.read("d"), "k").first() == (0, 0, 0, 0, 0, 0)
    opened, plain = [], Warehouse._open
    monkeypatch.setattr(Warehouse, "_open", lambda self, line, parts=None: opened.append(parts) or plain(self, line, parts))
    w.merge_history("d", stage(999).filter("k = '0'"), "k", ("a",), "2999-01-01 00:00:00", "sk", "x", empty)
    assert opened == [["current"], None]  # the second one reads the result


def test_history_starts_without_gaps(spark, tmp_path):
    stage = spark.createDataFrame([("x", "1")], "k string, a string")
    begun = dimensions.scd2_apply(dimensions.empty_scd2(stage, "k", ("a",), "sk"), stage, "k", ("a",), "2020-01-01 00:00:00", "sk")
    gap = begun.withColumn("is_current", F.lit(False))
    with pytest.raises(ValueError, match="no current one"):
        Warehouse(spark, str(tmp_path)).merge_history("d", stage, "k", ("a",), "2021-01-01 00:00:00", "sk", "1", gap)


def test_days_of_a_batch_are_replaced_and_others_stay(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    rows = lambda *r: spark.createDataFrame(list(r), "tanggal_sk int, desa int")
    days = lambda *d: spark.createDataFrame([(x,) for x in d], "tanggal_sk int")
    w.replace_days("m", rows((20240101, 1), (20240102, 2), (20240201, 3)), days(20240101, 20240102, 20240201), "1", "tanggal_sk")
    before = os.listdir(tmp_path / "m" / "months" / "bulan=202402")
    w.replace_days("m", rows((20240102, 9)), days(20240101, 20240102, 20240103), "2", "tanggal_sk")  # the first day has no row any more
    assert sorted((r.tanggal_sk, r.desa) for r in w.read("m").collect()) == [(20240102, 9), (20240201, 3)]
    assert os.listdir(tmp_path / "m" / "months" / "bulan=202402") == before


def test_a_change_is_named_by_month_and_bucket_and_old_months_are_not_read(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    args = (("k", "tanggal_sk"), ("v", "batch_id"))
    w.merge_months("f", fact(spark, *[(f"k{n}", 20240105 + 100 * (n % 3), float(n), "1") for n in range(30)]), *args, "1", "tanggal_sk")
    first = cut(w.checksums("f", ["k"]))
    sums = tmp_path / "_sums"
    kept = {str(p) for p in sums.rglob("*.parquet")}
    assert changed_parts(first, w.checksums("f", ["k"])).count() == 0 and {str(p) for p in sums.rglob("*.parquet")} == kept
    w.merge_months("f", fact(spark, ("k4", 20240205, 99.0, "2"), ("k7", 20240205, 7.0, "2")), *args, "2", "tanggal_sk")
    found = changed_parts(first, w.checksums("f", ["k"])).collect()
    bucket = spark.sql("SELECT pmod(xxhash64('k4'), 64)").first()[0]
    assert [(r.part, r.bucket, r.n_before, r.n_after) for r in found] == [("202402", bucket, r.n_before, r.n_before) for r in found] and len(found) == 1
    new = {str(p) for p in sums.rglob("*.parquet")} - kept
    assert {r.part for r in spark.read.parquet(*new).collect()} == {"202402"}
