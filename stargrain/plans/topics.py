"""Subject areas, their source files and slices."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.operators.profiling import profile
from stargrain.plans import campus, sales, weather
from stargrain.plans.profiles import PROFILES, weather_profile
from stargrain.sources.raw import register_folder, slice_by


@dataclass(frozen=True)
class Slice:
    """A part of the data. `where` holds predicates by table alias; no predicate means all rows.
    `folder` names a sub-folder when the slice is a folder of its own."""

    label: str
    where: dict[str, str] = field(default_factory=dict)
    folder: str = ""


@dataclass(frozen=True)
class Topic:
    label: str
    folder: str
    files: tuple[str, ...]
    fact: str
    grain: str
    slices: dict[str, Slice]
    rule: Callable[[dict[str, DataFrame], Mapping[str, str]], dict[str, DataFrame]] | None = None

    def slice(self, slice_id: str) -> Slice:
        if slice_id not in self.slices:
            raise KeyError(f"unknown slice {slice_id}; known: {sorted(self.slices)}")
        return self.slices[slice_id]

    def path(self, root: str, slice_id: str) -> str:
        part = self.slice(slice_id).folder
        return f"{root}/{self.folder}" + (f"/{part}" if part else "")

    def tables(self, spark: SparkSession, root: str, slice_id: str) -> dict[str, DataFrame]:
        """Raw views of the slice folder's sources, cut to the slice."""
        return self.cut(register_folder(spark, self.path(root, slice_id)), slice_id)

    def cut(self, raw: Mapping[str, DataFrame], slice_id: str) -> dict[str, DataFrame]:
        """Rows of the slice: those its predicates choose, and rows of the tables that depend on them."""
        where = self.slice(slice_id).where
        return self.rule(dict(raw), where) if self.rule and where else dict(raw)


def _depending(df: DataFrame, key: str, chosen: DataFrame) -> DataFrame:
    """Rows whose key, trimmed, is among the chosen ones."""
    ids = chosen.select(F.col(key).alias("_chosen")).distinct()
    return df.join(ids, F.trim(F.col(key)) == F.col("_chosen"), "left_semi")


def cohort_rows(raw: dict[str, DataFrame], where: Mapping[str, str]) -> dict[str, DataFrame]:
    """Students of the cohort, and the attendance and marks of these students."""
    chosen = campus.students_of(raw["raw_mahasiswa"], where["mahasiswa"])
    return {name: _depending(df, "nim", chosen) if name in ("raw_mahasiswa", "raw_presensi", "raw_nilai") else df for name, df in raw.items()}


def outlet_rows(raw: dict[str, DataFrame], where: Mapping[str, str]) -> dict[str, DataFrame]:
    """Outlets by `outlet_dim`; transactions whose newest record fits `outlets` and, in the outlet's local time,
    `hari`, with all their records; and their items. Products and customers stay whole."""
    chosen = sales.clean_transactions(raw["raw_transactions"], where.get("outlets"), where.get("hari"))
    out = dict(raw)
    out["raw_outlets"] = slice_by(raw["raw_outlets"], where.get("outlet_dim"))
    for name in ("raw_transactions", "raw_transaction_items"):
        out[name] = _depending(raw[name], "transaction_id", chosen)
    return out


# Topics, files, grains and slice predicates.
TOPICS = {
    "t1": Topic(
        label="T1: kehadiran dan kelulusan kampus",
        folder="t1_kampus",
        files=("mahasiswa.csv", "matakuliah.csv", "presensi.csv", "nilai.csv"),
        fact="fact_presensi",
        grain="satu baris per mahasiswa, mata kuliah, dan pertemuan",
        rule=cohort_rows,
        slices={
            "k4": Slice("mahasiswa angkatan 2024", {"mahasiswa": "angkatan = '2024'"}),
            "k5": Slice("mahasiswa angkatan 2023", {"mahasiswa": "angkatan = '2023'"}),
            "k7": Slice("mahasiswa angkatan 2022", {"mahasiswa": "angkatan = '2022'"}),
        },
    ),
    "t2": Topic(
        label="T2: kasir UMKM dengan beberapa outlet",
        folder="t2_umkm",
        files=("outlets.csv", "products.csv", "customers.csv", "transactions.csv", "transaction_items.csv"),
        fact="fact_sales_item",
        grain="satu baris per transaksi dan produk di dalamnya",
        rule=outlet_rows,
        slices={
            "k8": Slice(
                "tiga outlet, setahun penuh",
                {
                    "outlet_dim": "outlet_id IN ('OUT-A','OUT-B','OUT-C')",
                    "outlets": "outlet_id IN ('OUT-A','OUT-B','OUT-C')",
                    "hari": "TRUE",
                },
            ),
            "k9": Slice(
                "satu outlet, setengah tahun",
                {
                    "outlet_dim": "outlet_id = 'OUT-A'",
                    "outlets": "outlet_id = 'OUT-A'",
                    "hari": "CAST(waktu AS DATE) >= DATE '2025-01-01' AND CAST(waktu AS DATE) < DATE '2025-07-01'",
                },
            ),
        },
    ),
    "t3": Topic(
        label="T3: cuaca ekstrem per desa",
        folder="t3_publik",
        files=("provinsi.csv", "kabkot.csv", "kecamatan.csv", "desa.csv", "prakiraan_cuaca.csv"),
        fact="fact_prakiraan_cuaca",
        grain="satu baris per desa, slot prakiraan, dan waktu analisis",
        slices={
            "k1": Slice("Bogor", folder="k1"),
            "k2": Slice("Semarang", folder="k2"),
            "k3": Slice("Makassar", folder="k3"),
            "k6": Slice("Denpasar", folder="k6"),
        },
    ),
}


def profile_slice(spark: SparkSession, root: str, topic_id: str, slice_id: str, approximate: bool = False) -> DataFrame:
    """Profile of the sources of a slice as they lie: predicates aren't applied, so that the counts are those of
    the whole topic; a forecast slice is its own folder, and its local time is held against its own zone."""
    topic = TOPICS[topic_id]
    raw = register_folder(spark, topic.path(root, slice_id))
    specs = PROFILES[topic_id]
    if slice_id in weather.SLICE_ZONE:
        specs = weather_profile(weather.ZONE_SECONDS[weather.SLICE_ZONE[slice_id]])
    return profile(raw, specs, approximate)
