"""Profiling suites of the three subject areas and the generic first-look template."""

from __future__ import annotations

from stargrain.functions.expressions import bigint_text, clock_text, double_text, int_text
from stargrain.operators.profiling import TableProfile


def _missing(column: str) -> str:
    return f"count_if({column} IS NULL OR {column} = '')"


def offset_rule(local: str, utc: str, seconds: int) -> str:
    """Rows whose local and UTC wall clocks differ by the given offset. A text that is not exactly a clock is none."""
    return f"count_if(unix_timestamp({clock_text(local)}) - unix_timestamp({clock_text(utc)}) = {seconds})"


T1_PROFILE = (
    TableProfile(
        "raw_mahasiswa",
        scalars={"baris": "count(*)", "angkatan_kosong": _missing("angkatan")},
        distinct={"nim_unik": "nim", "varian_status": "status"},
        duplicates={"nim_duplikat": ("nim",)},
    ),
    TableProfile(
        "raw_presensi",
        scalars={
            "baris": "count(*)",
            "nim_null": "count_if(nim IS NULL)",
            "tanggal_format_lain": "count_if(tanggal LIKE '__/__/____')",
        },
        distinct={"varian_status": "status"},
        duplicates={"duplikat_grain": ("nim", "kode_mk", "tanggal")},
    ),
    TableProfile(
        "raw_nilai",
        typed={"_nilai": int_text("nilai_angka")},
        scalars={"nilai_luar_rentang": "count_if(_nilai > 100 OR _nilai < 0)"},
    ),
)

T2_PROFILE = (
    TableProfile(
        "raw_transactions",
        scalars={"baris": "count(*)", "timestamp_utc": "count_if(tanggal_waktu LIKE '%Z')"},
        distinct={"id_unik": "transaction_id", "varian_status": "status"},
        duplicates={"id_duplikat": ("transaction_id",)},
        childless={"tanpa_item": ("transaction_id", "raw_transaction_items", "transaction_id")},
    ),
    TableProfile(
        "raw_transaction_items",
        scalars={"baris": "count(*)", "qty_negatif": f"count_if({int_text('qty')} < 0)"},
        orphans={"fk_orphan": ("product_id", "raw_products", "product_id")},
    ),
    TableProfile("raw_products", scalars={"produk": "count(*)"}, distinct={"varian_harga": "harga_satuan"}),
)


def weather_profile(offset_seconds: int = 25200) -> tuple[TableProfile, ...]:
    """Offset 7 h fits the western slices; pass 28800 for the central ones."""
    return (
        TableProfile(
            "raw_prakiraan_cuaca",
            scalars={
                "baris": "count(*)",
                "vs_kosong": _missing("vs"),
                "tp_nol": f"count_if({double_text('tp')} = 0)",
                "baris_selisih": offset_rule("local_datetime", "utc_datetime", offset_seconds),
            },
            examples={"time_index_contoh": "time_index"},
            distinct={"desa": "adm4", "analysis_date_unik": "analysis_date"},
            frequencies={"cuaca": ("weather", "weather_desc")},
        ),
        TableProfile("raw_desa", scalars={"desa": "count(*)"}, distinct={"kecamatan": "kecamatan"}),
    )


T3_PROFILE = weather_profile()

# First look at any source of transactions and their items.
TEMPLATE_PROFILE = (
    TableProfile(
        "raw_transactions",
        scalars={
            "baris": "count(*)",
            "customer_kosong": _missing("customer_id"),
            "outlet_kosong": _missing("outlet_id"),
            "utc_tanpa_zona": "count_if(tanggal_waktu LIKE '%Z')",
            "waktu_lokal": "count_if(tanggal_waktu NOT LIKE '%Z')",
        },
        distinct={"id_unik": "transaction_id"},
        frequencies={"status": ("status",)},
    ),
    TableProfile(
        "raw_transaction_items",
        typed={"_qty": int_text("qty"), "_harga": bigint_text("harga_satuan")},
        scalars={"qty_min": "min(_qty)", "qty_max": "max(_qty)", "harga_min": "min(_harga)", "harga_max": "max(_harga)"},
        duplicates={"duplikat": ("transaction_id", "product_id")},
    ),
)

PROFILES = {"t1": T1_PROFILE, "t2": T2_PROFILE, "t3": T3_PROFILE, "template": TEMPLATE_PROFILE}
