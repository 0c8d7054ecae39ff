"""A made-up weather snapshot with the published totals of the real one (which is not available).

153 villages in 15 districts, 2,874 slots in a local window 2026-09-19 19:00 .. 2026-09-22 06:00,
two runs, 98 windy slots over 48 villages, 62 hot slots over 19 villages, 30 rainy slots coded
clear, visibility empty throughout.
"""

import csv
import datetime as dt
import os

DAY1, DAY2 = dt.date(2026, 9, 20), dt.date(2026, 9, 21)
# district sizes and alert villages: four districts wholly in alert, seven partly, four not at all
SIZES = [5, 6, 7, 8] + [12] * 7 + [11, 11, 11, 10]
IN_ALERT = [5, 6, 7, 8] + [6] * 6 + [5] + [0] * 4


def villages():
    return [
        (f"73.71.{d:02d}.{1000 + v}", f"Desa {d}-{v}", f"73.71.{d:02d}", f"Kecamatan {d}")
        for d, size in enumerate(SIZES, 1)
        for v in range(1, size + 1)
    ]


def alert_villages():
    out, first = [], 0
    for size, alerts in zip(SIZES, IN_ALERT):
        out += range(first, first + alerts)
        first += size
    return out


def slot_times(index):
    """136 villages on hours 0,3,6.. (19 slots), 16 on 2,5,8.. (17), 1 on 1,4,7.. (18)."""
    start, n = (
        (dt.datetime(2026, 9, 20, 0), 19) if index < 136
        else (dt.datetime(2026, 9, 19, 23), 17) if index < 152
        else (dt.datetime(2026, 9, 19, 19), 18)
    )
    return [start + dt.timedelta(hours=3 * k) for k in range(n)]


def alert_plan():
    """village index -> {slot: cause}: 65 villages on the first day (76 slots), 66 on the second (84)."""
    order = alert_villages()
    windy, hot = order[:48], order[48:]
    plan = {}

    def put(i, day, k, cause):
        plan.setdefault(i, {})[[t for t in slot_times(i) if t.date() == day][k]] = cause

    for i in order:
        cause = "wind" if i in windy else "heat"
        if i not in (windy[0], hot[0]):
            put(i, DAY1, 3, cause)
        if i != windy[1]:
            put(i, DAY2, 3, cause)
    for i in windy[2:6]:
        put(i, DAY1, 4, "wind")
    for i in hot[1:3]:  # the two villages with 5 of 19 slots
        put(i, DAY1, 4, "heat")
        put(i, DAY2, 4, "heat")
        put(i, DAY2, 5, "heat")
    for i in hot[3:8]:
        put(i, DAY1, 4, "heat")
    for i in hot[5:19]:
        put(i, DAY2, 4, "heat")
    return plan


def write(root, run_hour="12", change=None):
    """Write the five CSV files; returns (alert plan, rows)."""
    os.makedirs(root, exist_ok=True)
    vs = villages()
    if change:
        vs = change(vs)

    def put(name, header, rows):
        with open(os.path.join(root, name), "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator="\r\n")
            w.writerow(header)
            w.writerows(rows)

    put("provinsi.csv", ["kode", "provinsi"], [["73", "Sulawesi Selatan"]])
    put("kabkot.csv", ["kode", "kabkot"], [["73.71", "Kota Makassar"]])
    districts = sorted({(v[2], v[3]) for v in vs})
    put("kecamatan.csv", ["kode", "kecamatan", "kode_kabkot", "kabkot"], [[*d, "73.71", "Kota Makassar"] for d in districts])
    put("desa.csv", ["kode", "desa", "kode_kecamatan", "kecamatan", "kode_kabkot", "kabkot"], [[*v, "73.71", "Kota Makassar"] for v in vs])

    wanted = alert_plan()
    rows, rain = [], 0
    for i, v in enumerate(villages()):
        for t in slot_times(i):
            cause = wanted.get(i, {}).get(t)
            # the village on its own hour phase has only the older run
            run = "2026-09-19T00:00:00" if i == 152 else f"2026-09-19T{run_hour}:00:00"
            tp = "0"
            if rain < 30 and i % 5 == 0 and t.hour in (0, 3):
                tp, rain = "0.1", rain + 1
            rows.append([
                v[0], (t - dt.timedelta(hours=8)).strftime("%Y-%m-%d %H:%M:%S"), run, t.strftime("%Y-%m-%d %H:%M:%S"),
                "33" if cause == "heat" else "28", "60", tp, "20", "21.5" if cause == "wind" else "9.3", "NE", "SW", "45", "", "",
                "0" if i % 3 == 0 else "1", "Cerah", "Sunny", "10-11", v[0],
            ])
    header = ["adm4", "utc_datetime", "analysis_date", "local_datetime", "t", "hu", "tp", "tcc", "ws", "wd", "wd_to", "wd_deg",
              "vs", "vs_text", "weather", "weather_desc", "weather_desc_en", "time_index", "kode_diminta"]
    put("prakiraan_cuaca.csv", header, rows)
    return wanted, rows


if __name__ == "__main__":
    import tempfile

    w, r = write(tempfile.mkdtemp())
    print(len(r), sum(x == "wind" for d in w.values() for x in d.values()), sum(x == "heat" for d in w.values() for x in d.values()))
    for day in (DAY1, DAY2):
        print(day, sum(any(t.date() == day for t in d) for d in w.values()), sum(t.date() == day for d in w.values() for t in d))
    print(len(w), sum(len(slot_times(i)) for i in range(153)))
