"""Weather forecast per village: staging, dimensions, fact, analytic queries and the alert metric."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators import calendar, dimensions, facts, metrics, quality
from stargrain.operators.quality import Expectation
from stargrain.operators.rows import first_per_key, literal_row
from stargrain.session import cut
from stargrain.sources.warehouse import Warehouse

# --- fixed values ---------------------------------------------------------------------------

# Order matters: the row hash joins the attributes in this order.
LOCATION_KEY = "kode_desa"
LOCATION_TRACKED = (
    "nama_desa", "kode_kecamatan", "nama_kecamatan", "kode_kabkot", "nama_kabkot", "kode_provinsi", "nama_provinsi",
)
LOCATION_LENGTHS = {
    "kode_desa": 16, "nama_desa": 100, "kode_kecamatan": 10, "nama_kecamatan": 100, "kode_kabkot": 6, "nama_kabkot": 100,
    "kode_provinsi": 2, "nama_provinsi": 100, "row_hash": 32,
}
UNKNOWN_LOCATION = {
    "lokasi_sk": -1, "kode_desa": "-", "nama_desa": "Tidak diketahui", "kode_kecamatan": "-",
    "nama_kecamatan": "Tidak diketahui", "kode_kabkot": "-", "nama_kabkot": "Tidak diketahui",
    "kode_provinsi": "-", "nama_provinsi": "Tidak diketahui",
    "valid_from": X.FIRST_SEEN, "valid_to": X.OPEN_END, "is_current": True,
    "row_hash": "ad921d60486366258809553a3db49a4a",  # md5('unknown')
}
UNKNOWN_WEATHER = {"cuaca_sk": -1, "kode_cuaca": -1, "deskripsi_id": "Tidak diketahui", "deskripsi_en": "Unknown"}
WEATHER_SCHEMA = "cuaca_sk bigint, kode_cuaca int, deskripsi_id string, deskripsi_en string, updated_at timestamp"

FACT_KEY = ("kode_desa", "waktu_utc", "analisis_utc", "tanggal_sk")
FACT_UPDATES = (
    "lokasi_sk", "cuaca_sk", "t_celsius", "hu_persen", "tp_mm", "tcc_persen", "ws_kmh", "wd_deg", "vs_m",
    "batch_id", "loaded_at",
)
SURROGATES = ("lokasi_sk", "cuaca_sk")

# Time zones of the slices (Western and Central Indonesian Time).
SLICE_ZONE = {"k1": "Asia/Jakarta", "k2": "Asia/Jakarta", "k3": "Asia/Makassar", "k6": "Asia/Makassar"}
ZONE_SECONDS = {"Asia/Jakarta": 7 * 3600, "Asia/Makassar": 8 * 3600}  # neither keeps summer time

WIND = metrics.Cause("siaga_angin", "ws_kmh", 20.0, "slot_angin")
HEAT = metrics.Cause("siaga_suhu", "t_celsius", 33.0, "slot_suhu")
CAUSES = (WIND, HEAT)
MAXIMA = {"ws_kmh": "ws_maks", "t_celsius": "t_maks"}

MEASURES = {
    m.column: m
    for m in (
        metrics.Measure("t_celsius", metrics.NON),
        metrics.Measure("hu_persen", metrics.NON),
        metrics.Measure("tp_mm", metrics.SEMI, ("sum", "avg", "min", "max")),
        metrics.Measure("tcc_persen", metrics.NON, ("avg",)),
        metrics.Measure("ws_kmh", metrics.NON, ("avg", "max")),
        metrics.Measure("wd_deg", metrics.CIRCULAR, ("circular_mean",)),
        metrics.Measure("vs_m", metrics.NON, ("avg", "min")),
        metrics.Measure("jumlah_slot", metrics.ADDITIVE, ("sum",)),
    )
}

DAILY_ALERTS = metrics.Metric(
    name="desa_siaga_harian",
    definition="Villages forecast to have at least one 3-hour slot on the day with 33 °C or more, or wind of 20 km/h or more.",
    formula="count(distinct kode_desa) filter (where t_celsius >= 33 or ws_kmh >= 20) per local date, newest run per village and slot",
    grain="one value per local date and area, from village x 3-hour slot x run, newest run only",
    sources=("fact_prakiraan_cuaca", "dim_lokasi", "dim_date"),
    owner="Head of Emergency and Logistics, city disaster agency",
    time_basis="local calendar day of the slot; neither the UTC day nor the day of the run",
    unit="villages",
    dimensions=(
        "tanggal", "nama_hari", "kode_kecamatan", "nama_kecamatan", "kode_kabkot", "nama_kabkot",
        "kode_provinsi", "nama_provinsi", "siaga_angin", "siaga_suhu",
    ),
    default_filter="kode_kabkot = '73.71'",
    empty_meaning="0 = forecasts exist and no village is in alert; a date without forecasts has no row",
    version=1,
    entity="kode_desa",
    causes=CAUSES,
)
REGISTRY = metrics.MetricRegistry()
REGISTRY.add(DAILY_ALERTS)


# --- staging --------------------------------------------------------------------------------

def stage_locations(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Villages with their district, city and province. The city file names no province, so the
    province code is the part of the city code before the first dot."""
    villages = raw["raw_desa"].select(
        F.trim("kode").alias("kode_desa"), F.trim("desa").alias("nama_desa"),
        F.trim("kode_kecamatan").alias("kode_kecamatan"), F.trim("kode_kabkot").alias("kode_kabkot"),
    )
    districts = raw["raw_kecamatan"].select(F.trim("kode").alias("k"), F.trim("kecamatan").alias("nama_kecamatan"))
    cities = raw["raw_kabkot"].select(F.trim("kode").alias("k"), F.trim("kabkot").alias("nama_kabkot"))
    provinces = raw["raw_provinsi"].select(F.trim("kode").alias("k"), F.trim("provinsi").alias("nama_provinsi"))
    flat = dimensions.flatten_hierarchy(
        villages.withColumn("kode_provinsi", F.split_part("kode_kabkot", F.lit("."), F.lit(1))),
        [
            (districts, F.col("kode_kecamatan"), "k"),
            (cities, F.col("kode_kabkot"), "k"),
            (provinces, F.col("kode_provinsi"), "k"),
        ],
    )
    return first_per_key(flat.select(LOCATION_KEY, *LOCATION_TRACKED), [LOCATION_KEY], [F.col(c).asc_nulls_last() for c in LOCATION_TRACKED])


def stage_forecasts(raw: DataFrame) -> DataFrame:
    """Raw text to typed staging columns. Unreadable values become NULL and are counted by tests."""
    cast = lambda c, t: F.expr(f"try_cast({c} AS {t})")
    number = lambda c, t: F.expr(f"try_cast({X.double_text(c)} AS {t})")
    return raw.select(
        F.trim("adm4").alias("kode_desa"),
        cast("utc_datetime", "timestamp").alias("waktu_utc"),
        cast("analysis_date", "timestamp").alias("analisis_utc"),
        cast("local_datetime", "timestamp_ntz").alias("waktu_lokal"),
        F.expr(X.int_text("weather")).alias("kode_cuaca"),
        F.trim("weather_desc").alias("deskripsi_id"),
        F.trim("weather_desc_en").alias("deskripsi_en"),
        F.col("wd").alias("arah_angin"),
        F.col("wd_to").alias("arah_angin_tujuan"),
        number("t", "decimal(4,1)").alias("t_celsius"),
        number("hu", "decimal(5,2)").alias("hu_persen"),
        number("tp", "decimal(6,2)").alias("tp_mm"),
        number("tcc", "decimal(5,2)").alias("tcc_persen"),
        number("ws", "decimal(6,2)").alias("ws_kmh"),
        F.expr(f"try_cast({X.int_text('wd_deg')} AS smallint)").alias("wd_deg"),
        number("vs", "decimal(8,1)").alias("vs_m"),
    )


# --- dimensions and fact --------------------------------------------------------------------

def new_dim_lokasi(stage: DataFrame) -> DataFrame:
    empty = dimensions.empty_scd2(stage, LOCATION_KEY, LOCATION_TRACKED, "lokasi_sk")
    return dimensions.add_unknown(empty, UNKNOWN_LOCATION)


def new_dim_cuaca(spark: SparkSession, ts) -> DataFrame:
    empty = spark.createDataFrame([], WEATHER_SCHEMA)
    return empty.unionByName(literal_row(spark, empty.schema, UNKNOWN_WEATHER).withColumn("updated_at", ts))


def assemble_fact(stage: DataFrame, dim_lokasi: DataFrame, dim_cuaca: DataFrame, batch_id: str, loaded_at) -> DataFrame:
    """Fact rows of a batch. Unmatched village or weather code goes to -1; no row is lost."""
    located = facts.lookup_asof(stage, dim_lokasi, "kode_desa", "kode_desa", "waktu_utc", "lokasi_sk")
    rows = facts.lookup(located, dim_cuaca, "kode_cuaca", "kode_cuaca", "cuaca_sk")
    return rows.select(
        "lokasi_sk",
        X.date_key_or_unknown("waktu_lokal").alias("tanggal_sk"),
        X.date_key_or_unknown("analisis_utc").alias("tanggal_analisis_sk"),
        "cuaca_sk", "kode_desa", "waktu_utc", "analisis_utc", "waktu_lokal",
        F.hour("waktu_lokal").cast("smallint").alias("jam_lokal"),
        "arah_angin", "arah_angin_tujuan",
        "t_celsius", "hu_persen", "tp_mm", "tcc_persen", "ws_kmh", "wd_deg", "vs_m",
        F.lit(1).cast("smallint").alias("jumlah_slot"),
        F.lit(batch_id).alias("batch_id"),
        loaded_at.alias("loaded_at"),
    )


# --- expectations ---------------------------------------------------------------------------

FORECAST = "raw_prakiraan_cuaca"


def _double(column: str) -> str:
    return X.double_text(column)


def source_expectations(expected: Mapping[str, int] | None = None) -> list[Expectation]:
    """The six checks on the raw forecast. `expected` pins violation counts of a known snapshot."""
    n = expected or {}
    t, ws, hu, tp = (_double(c) for c in ("t", "ws", "hu", "tp"))
    made = [
        Expectation(
            "grain_desa_slot_run_unik", "t3", "blocking", "pass", FORECAST,
            count=quality.unique(FORECAST, ["adm4", "utc_datetime", "analysis_date"]),
            reason="The fact grain; repeated keys would overwrite each other in the merge.",
        ),
        Expectation(
            "desa_orphan_tanpa_master", "t3", "blocking", "pass", FORECAST,
            count=quality.references(FORECAST, "adm4", "raw_desa", "kode"),
            reason="Villages missing from the master fall to -1 and out of every city filter.",
        ),
        Expectation(
            "desa_run_terbaru_basi", "t3", "warning", "fail", FORECAST,
            count=quality.stale_run(FORECAST, "adm4", "analysis_date"), expected_count=n.get("desa_run_terbaru_basi"),
            reason="Villages without the newest run; zero would mean that older runs were thrown away.",
        ),
        Expectation(
            "hujan_berlabel_cerah", "t3", "warning", "fail", FORECAST,
            row_rule=f"{tp} > 0 AND {X.int_text('weather')} IN (0, 1)", expected_count=n.get("hujan_berlabel_cerah"),
            reason="Rain under a code for clear sky.",
        ),
        Expectation(
            "visibilitas_vs_kosong", "t3", "warning", "fail", FORECAST,
            row_rule="vs IS NULL OR trim(vs) = ''", expected_count=n.get("visibilitas_vs_kosong"),
            reason="Visibility is empty in the source.",
        ),
        Expectation(
            "suhu_angin_di_luar_rentang_fisik", "t3", "blocking", "pass", FORECAST,
            row_rule=(
                f"{t} NOT BETWEEN 15 AND 42 OR {ws} NOT BETWEEN 0 AND 120 "
                f"OR {hu} NOT BETWEEN 0 AND 100 OR {tp} < 0"
            ),
            reason="Impossible values change the number of alert slots.",
        ),
    ]
    return made


def readability_expectations() -> list[Expectation]:
    """Numbers that cannot be read pass the range check as NULL; count them separately."""
    unreadable = " OR ".join(f"({_double(c)} IS NULL AND trim({c}) <> '')" for c in ("t", "ws", "hu", "tp"))
    return [Expectation("angka_tidak_terbaca", "t3", "warning", "pass", FORECAST, row_rule=unreadable)]


def staging_expectations() -> list[Expectation]:
    """The merge key after the casts: complete and unique. Different texts may be the same time."""
    return [
        Expectation("kunci_fakta_lengkap", "t3", "blocking", "pass", "stg_prakiraan",
                    row_rule="kode_desa IS NULL OR waktu_utc IS NULL OR analisis_utc IS NULL OR waktu_lokal IS NULL"),
        Expectation("kunci_fakta_unik", "t3", "blocking", "pass", "stg_prakiraan",
                    count=quality.unique("stg_prakiraan", ["kode_desa", "waktu_utc", "analisis_utc"])),
    ]


def too_long(limits: Mapping[str, int]) -> str:
    return " OR ".join(f"length({c}) > {n}" for c, n in limits.items())


def manifest_expectation(rows: int) -> Expectation:
    return Expectation("jumlah_baris_manifest", "t3", "blocking", "pass", FORECAST, count=quality.row_count_is(FORECAST, rows))


# Forecast rows of each slice.
MANIFEST_ROWS = {"k1": 1156, "k2": 3009, "k3": 2874, "k6": 774}


def metric_expectations() -> list[Expectation]:
    """Guards of the alert metric: on no day may villages in alert exceed villages with a forecast, and the
    denominator should be all villages that are forecast then: from a village's first day to its last."""
    def slots(tables: Mapping[str, DataFrame]) -> DataFrame:
        fact, places, days = (tables[t] for t in ("fact_prakiraan_cuaca", "dim_lokasi", "dim_date"))
        return dated(newest_slots(fact, places, "true"), days)

    def per_day(tables: Mapping[str, DataFrame]) -> DataFrame:
        return REGISTRY.get("desa_siaga_harian").compute(slots(tables), ["tanggal"], where="true")

    def beyond(tables: Mapping[str, DataFrame]) -> DataFrame:
        return per_day(tables).agg(F.count_if(F.col("desa_siaga") > F.col("desa_total")).cast("bigint").alias("n"))

    def incomplete(tables: Mapping[str, DataFrame]) -> DataFrame:
        there = metrics.present_per_day(slots(tables), "kode_desa", "tanggal")
        return per_day(tables).join(there, "tanggal").agg(F.count_if(F.col("desa_total") != F.col("ada")).cast("bigint").alias("n"))

    table = "fact_prakiraan_cuaca"
    return [
        Expectation("siaga_dalam_batas", "t3", "blocking", "pass", table, count=beyond),
        Expectation("penyebut_lengkap", "t3", "warning", "pass", table, count=incomplete),
    ]


def warehouse_expectations(orphans_expected: str = "pass") -> list[Expectation]:
    """Checks before the switch: fact filled, every row dated, no unknown member, sound history."""
    fact = "fact_prakiraan_cuaca"
    return [
        Expectation("fact_berisi", "t3", "blocking", "pass", fact, count=quality.not_empty(fact)),
        Expectation("fact_bertanggal", "t3", "blocking", "pass", fact, row_rule="tanggal_sk IS NULL"),
        Expectation("tanggal_di_kalender", "t3", "blocking", "pass", fact, count=quality.references(fact, "tanggal_sk", "dim_date", "date_sk")),
        Expectation("lokasi_dikenal", "t3", "warning", orphans_expected, fact, row_rule="lokasi_sk = -1"),
        Expectation("jam_valid", "t3", "blocking", "pass", fact, row_rule="jam_lokal IS NULL OR jam_lokal NOT BETWEEN 0 AND 23"),
        Expectation("fact_grain_unik", "t3", "blocking", "pass", fact, count=quality.unique(fact, FACT_KEY)),
        Expectation("riwayat_lokasi_utuh", "t3", "blocking", "pass", "dim_lokasi", count=quality.scd2_violations("dim_lokasi", "kode_desa")),
        Expectation("panjang_lokasi", "t3", "blocking", "pass", "dim_lokasi", row_rule=too_long(LOCATION_LENGTHS)),
        Expectation("lokasi_lengkap", "t3", "blocking", "pass", "dim_lokasi",
                    row_rule=" OR ".join(f"{c} IS NULL" for c in (LOCATION_KEY, *LOCATION_TRACKED, "valid_from", "valid_to"))),
        Expectation("panjang_cuaca", "t3", "blocking", "pass", "dim_cuaca",
                    row_rule=too_long({"deskripsi_id": 50, "deskripsi_en": 50})),
        Expectation("lokasi_sk_unik", "t3", "blocking", "pass", "dim_lokasi", count=quality.unique("dim_lokasi", ["lokasi_sk"])),
        Expectation("kode_cuaca_unik", "t3", "blocking", "pass", "dim_cuaca", count=quality.unique("dim_cuaca", ["kode_cuaca"])),
    ]


# --- load -----------------------------------------------------------------------------------

def load(
    raw: Mapping[str, DataFrame],
    warehouse: Warehouse,
    batch_id: str,
    batch_ts: str,
    expectations: list[Expectation] | None = None,
    loaded_at=None,
    calendar_range: tuple[str, str] = ("2024-01-01", "2027-12-31"),
    after: list[Expectation] | None = None,
    manifest_rows: int | None = None,
    slice_id: str | None = None,
) -> DataFrame:
    """One batch: gate on the source (with the row count that the manifest of `slice_id` states, or `manifest_rows`), then
    calendar, weather codes, locations, fact, in that order, and a gate on the result. Only then are the tables
    switched, in the same order; until then, and if a gate closes, readers see every table as it was.

    Repeating a batch leaves every table as it was, apart from audit columns.
    """
    spark = warehouse.spark
    now = loaded_at if loaded_at is not None else F.current_timestamp()
    checks = list(source_expectations() if expectations is None else expectations)
    manifest_rows = MANIFEST_ROWS.get(slice_id) if manifest_rows is None else manifest_rows
    if manifest_rows is not None:
        checks.append(manifest_expectation(manifest_rows))
    quality.gate(quality.run_expectations(checks, raw, spark))

    forecasts = cut(stage_forecasts(raw[FORECAST]))
    locations = cut(stage_locations(raw))
    quality.gate(quality.run_expectations(staging_expectations(), {"stg_prakiraan": forecasts}, spark))

    with warehouse.staged() as w:
        w.publish("dim_date", calendar.build_dim_date(spark, *calendar_range), batch_id)
        codes = w.read("dim_cuaca") if w.exists("dim_cuaca") else new_dim_cuaca(spark, now)
        dim_cuaca = w.publish(
            "dim_cuaca",
            dimensions.scd1_upsert(codes, forecasts, "kode_cuaca", ["deskripsi_id", "deskripsi_en"], now, "cuaca_sk"),
            batch_id,
        )
        dim_lokasi = w.merge_history(
            "dim_lokasi", locations, LOCATION_KEY, LOCATION_TRACKED, batch_ts, "lokasi_sk", batch_id, new_dim_lokasi(locations)
        )
        w.merge_months(
            "fact_prakiraan_cuaca",
            assemble_fact(forecasts, dim_lokasi, dim_cuaca, batch_id, now),
            FACT_KEY, FACT_UPDATES, batch_id, "tanggal_sk", SURROGATES, sort=("lokasi_sk", "tanggal_sk"),
        )
        checks = warehouse_expectations() + metric_expectations() if after is None else after
        quality.gate(quality.run_expectations(checks, {t: w.read(t) for t in w.tables()}, spark))
    return warehouse.read("fact_prakiraan_cuaca")


METRIC_TABLE = "metrik_desa_siaga_harian"


def refresh_metric(warehouse: Warehouse, batch_id: str) -> DataFrame:
    """Bring the published daily metric of every city up to date after a batch.

    A slot belongs to one local day, so a batch can only change the days on which it has rows. These are computed
    again from the fact rows of those days, all runs included; the other days stay as they are. The first call, or one
    for a batch that is not in the fact, finds the days of that batch only: call it once per batch.
    """
    fact, places, days = (warehouse.read(t) for t in ("fact_prakiraan_cuaca", "dim_lokasi", "dim_date"))
    touched = cut(fact.filter(F.col("batch_id") == batch_id).select("tanggal_sk", "bulan").distinct())
    months = [r[0] for r in touched.select("bulan").distinct().collect()]
    rows = fact.filter(F.col("bulan").isin(months)).join(touched.select("tanggal_sk"), "tanggal_sk", "left_semi")
    metric = REGISTRY.get("desa_siaga_harian")
    fresh = metric.compute(dated(newest_slots(rows, places, "true"), days), ["tanggal", "kode_kabkot"], where="true")
    fresh = fresh.withColumns({"tanggal_sk": X.date_key("tanggal"), "versi": F.lit(metric.version)})
    return warehouse.replace_days(METRIC_TABLE, fresh, touched.select("tanggal_sk"), batch_id, "tanggal_sk", sort=("tanggal_sk",))


def register_views(warehouse: Warehouse) -> list[str]:
    """Temporary views for SQL users beside the tables (`wh_` and name): the newest run of each village and slot,
    and the calendar in the roles of forecast day and analysis day."""
    tables = warehouse.register()
    days = tables["dim_date"]
    views = {
        "wh_prakiraan_terbaru": facts.latest_run(
            tables["fact_prakiraan_cuaca"], ["kode_desa", "waktu_utc"], ["analisis_utc", "tanggal_sk"]),
        "wh_tanggal_prakiraan": calendar.date_role(days, "tanggal_sk", "tanggal"),
        "wh_tanggal_analisis": calendar.date_role(days, "tanggal_analisis_sk", "tanggal_analisis"),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted([*(f"wh_{t}" for t in tables), *views])


# --- analytics ------------------------------------------------------------------------------

def newest_slots(fact: DataFrame, dim_lokasi: DataFrame, where: str = "kode_kabkot = '73.71'") -> DataFrame:
    """Newest run per village and slot, joined with the location version chosen at load time.

    Villages that carry the slice in any version are kept before the window, by natural code;
    the slice itself is decided afterwards on the version of the row.
    """
    places = dim_lokasi.filter(F.expr(where))
    newest = facts.latest_run(fact, ["kode_desa", "waktu_utc"], ["analisis_utc", "tanggal_sk"], places, "kode_desa")
    return newest.drop("kode_desa").join(places, "lokasi_sk")


def dated(slots: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Join the calendar in the role of forecast date."""
    role = calendar.date_role(dim_date, "tanggal_sk", "tanggal").select("tanggal_sk", "tanggal", "nama_hari")
    return slots.join(role, "tanggal_sk")


def q01(fact: DataFrame, dim_lokasi: DataFrame) -> DataFrame:
    """Villages in alert. Village names repeat, so the code is part of the group."""
    group = {"nama_kecamatan": "kecamatan", "nama_desa": "desa", "kode_desa": "kode_desa"}
    return metrics.alert_entities(newest_slots(fact, dim_lokasi), group, CAUSES)


def q02(fact: DataFrame, dim_lokasi: DataFrame) -> DataFrame:
    return metrics.alert_rank(newest_slots(fact, dim_lokasi), "kode_desa", "nama_kecamatan", CAUSES, MAXIMA)


def q03(fact: DataFrame, dim_lokasi: DataFrame, dim_date: DataFrame) -> DataFrame:
    slots = dated(newest_slots(fact, dim_lokasi), dim_date)
    return metrics.alert_daily(slots, "kode_desa", ["tanggal", "nama_hari"], CAUSES, MAXIMA)


def m01(fact: DataFrame, dim_lokasi: DataFrame, dim_date: DataFrame) -> DataFrame:
    metric = REGISTRY.get("desa_siaga_harian")
    slots = dated(newest_slots(fact, dim_lokasi, metric.default_filter), dim_date)
    return metric.compute(slots, ["tanggal"]).orderBy("tanggal")


def m01_window(fact: DataFrame, dim_lokasi: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Distinct villages in alert over the whole window."""
    metric = REGISTRY.get("desa_siaga_harian")
    return metric.compute(dated(newest_slots(fact, dim_lokasi, metric.default_filter), dim_date))
