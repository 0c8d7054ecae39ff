"""Campus attendance: one row per student, course and meeting.

The source has repeated grains, two date formats and many spellings of the status, without
cleaning rules. The rules here are ours:
  * dates are read as yyyy-MM-dd, with or without a time, else dd/MM/yyyy; any other text goes to the
    unknown date. Such meetings can't be told apart by their day, so their records form a multiset: a record
    is known by its content and by how many equal ones come before it in its batch. Batches are united by
    multiplicity, so different records of two batches all stay and a repeated batch adds none;
  * a status is matched on its letters only, ignoring case and blanks; unknown spellings become
    TIDAK DIKETAHUI;
  * a repeated grain keeps the record that counts most as present.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.operators import calendar, dimensions, facts, quality
from stargrain.operators.quality import Expectation
from stargrain.operators.rows import first_per_key, numbered_copies
from stargrain.sources.raw import slice_by
from stargrain.sources.warehouse import Warehouse

# Status spellings by canonical status, in order of precedence.
STATUS = {
    "HADIR": ("hadir", "h", "present", "masuk"),
    "IZIN": ("izin", "ijin", "i"),
    "SAKIT": ("sakit", "s"),
    "ALPA": ("alpa", "alpha", "a", "absen"),
}
UNKNOWN_STATUS = "TIDAK DIKETAHUI"


def canonical_date(text: str) -> Column:
    """Date of a text that is a date as a whole, in either format; reordering the parts and casting
    is cheaper than a formatter."""
    c = F.trim(F.col(text))
    reordered = F.concat_ws("-", F.substring(c, 7, 4), F.substring(c, 4, 2), F.substring(c, 1, 2))
    whole = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?Z?)?$"
    day = F.when(c.rlike(r"^\d{2}/\d{2}/\d{4}$"), reordered).when(c.rlike(whole), F.substring(c, 1, 10))
    return day.try_cast("date")


def canonical_status(text: str) -> Column:
    letters = F.lower(F.regexp_replace(F.col(text), "[^A-Za-z]", ""))
    out = F.lit(UNKNOWN_STATUS)
    for name, spellings in reversed(STATUS.items()):
        out = F.when(letters.isin(*spellings), name).otherwise(out)
    return out


def status_rank(status: str) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in (*STATUS, UNKNOWN_STATUS)]), F.col(status))


def clean_attendance(raw: DataFrame) -> DataFrame:
    """One row per student, course and day; records without a day are all kept.

    `isi` is a hash of what such a record says (its date text and status) and `urutan` numbers equal ones from
    1; a record with a day has an empty `isi` and `urutan` 0.
    """
    typed = raw.select(
        F.trim("nim").alias("nim"), F.trim("kode_mk").alias("kode_mk"),
        canonical_date("tanggal").alias("tanggal"), canonical_status("status").alias("status"), F.col("tanggal").alias("_text"),
    )
    dated = first_per_key(typed.filter("tanggal IS NOT NULL").drop("_text"), ["nim", "kode_mk", "tanggal"], [status_rank("status")])
    said = F.md5(F.concat(F.col("status"), F.coalesce(F.concat(F.lit("="), F.col("_text")), F.lit(""))))  # NULL is not ''
    undated = numbered_copies(typed.filter("tanggal IS NULL").withColumn("isi", said).drop("_text"), "urutan")
    return dated.withColumns({"isi": F.lit(""), "urutan": F.lit(0)}).unionByName(undated)


def attendance_fact(attendance: DataFrame, dim_student: DataFrame, dim_course: DataFrame) -> DataFrame:
    keyed = facts.lookup(attendance, dim_student, "nim", "nim", "mahasiswa_sk")
    keyed = facts.lookup(keyed, dim_course, "kode_mk", "kode_mk", "matakuliah_sk")
    return keyed.select(
        "nim", "kode_mk", X.date_key_or_unknown("tanggal").alias("date_sk"), "isi", "urutan", "mahasiswa_sk", "matakuliah_sk", "status",
        (F.col("status") == "HADIR").cast("int").alias("hadir"), F.lit(1).alias("jumlah_pertemuan"),
    )


def students_of(raw: DataFrame, cohort: str | None = None) -> DataFrame:
    """Students of a slice (a cohort predicate), one row per student id."""
    typed = raw.select(*[F.trim(c).alias(c) for c in raw.columns])
    order = sorted((c for c in raw.columns if c != "nim"), key=lambda c: (c != "angkatan", c != "status"))
    return first_per_key(slice_by(typed, cohort), ["nim"], [F.col(c).asc_nulls_last() for c in order or ["nim"]])


# --- load -----------------------------------------------------------------------------------

FACT, KEY = "fact_presensi", ("nim", "kode_mk", "date_sk", "isi", "urutan")
UPDATES = ("mahasiswa_sk", "matakuliah_sk", "status", "hadir", "jumlah_pertemuan", "batch_id", "loaded_at")


def source_expectations() -> list[Expectation]:
    keys = " OR ".join(X.blank_text(c) for c in ("nim", "kode_mk"))
    return [
        Expectation("presensi_berkunci", "t1", "blocking", "pass", "raw_presensi", row_rule=keys),
        Expectation("mahasiswa_berkunci", "t1", "blocking", "pass", "raw_mahasiswa", row_rule=X.blank_text("nim")),
    ]


def warehouse_expectations() -> list[Expectation]:
    return [
        Expectation("presensi_berisi", "t1", "blocking", "pass", FACT, count=quality.not_empty(FACT)),
        Expectation("presensi_unik", "t1", "blocking", "pass", FACT, count=quality.unique(FACT, KEY)),
        Expectation("presensi_di_kalender", "t1", "blocking", "pass", FACT, count=quality.references(FACT, "date_sk", "dim_date", "date_sk")),
        Expectation("mahasiswa_dikenal", "t1", "warning", "pass", FACT, row_rule="mahasiswa_sk = -1"),
    ]


def load(
    raw: Mapping[str, DataFrame],
    warehouse: Warehouse,
    batch_id: str,
    cohort: str | None = None,
    loaded_at: Column | None = None,
    calendar_range: tuple[str, str] = ("2020-01-01", "2027-12-31"),
    expectations: Sequence[Expectation] | None = None,
) -> DataFrame:
    """One batch, of a cohort if given: gate on the source, calendar, students, courses, fact, gate on the
    result; then all tables are switched. Until then, and if a gate closes, readers see every table as it was. With a
    cohort, attendance of other students is left out. A repeat leaves every table as it was."""
    spark = warehouse.spark
    now = loaded_at if loaded_at is not None else F.current_timestamp()
    quality.gate(quality.run_expectations(source_expectations(), raw, spark))
    with warehouse.staged() as w:
        w.publish("dim_date", calendar.build_dim_date(spark, *calendar_range), batch_id)
        students = students_of(raw["raw_mahasiswa"], cohort)
        student = dimensions.load_plain(w, "dim_mahasiswa", students, "nim", "mahasiswa_sk", now, batch_id)
        course = dimensions.load_plain(w, "dim_matakuliah", raw["raw_matakuliah"], "kode_mk", "matakuliah_sk", now, batch_id)
        attendance = raw["raw_presensi"]
        if cohort:
            attendance = attendance.join(students.select(F.col("nim").alias("_nim")), F.trim("nim") == F.col("_nim"), "left_semi")
        rows = attendance_fact(clean_attendance(attendance), student, course).withColumns({"batch_id": F.lit(batch_id), "loaded_at": now})
        w.merge_months(FACT, rows, KEY, UPDATES, batch_id, "date_sk", ("mahasiswa_sk", "matakuliah_sk"), sort=("mahasiswa_sk", "date_sk"))
        checks = warehouse_expectations() if expectations is None else expectations
        quality.gate(quality.run_expectations(checks, {t: w.read(t) for t in w.tables()}, spark))
    return warehouse.read(FACT)
