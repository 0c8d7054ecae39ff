"""Registration and the table views that several queries share.

Analogues: village = customer (events.user_id), district = nation, city = region; a slot is a
3-hour bucket of events.ts, a run is one event; wind = events.value, heat = k of events.props.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.functions import expressions as X
from stargrain.session import configure

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Parquet tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._read = configure(spark), folder.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]


def query(name: str, sql: str | None = None):
    """Register fn(tables) under `name`; `sql` is the equivalent statement."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def heat(props: str) -> Column:
    """k of a JSON record as a whole number; NULL without one."""
    return F.expr(X.int_text(f"get_json_object({props}, '$.k')"))


def slot_of(t: Tables, ts: str = "ts") -> Column:
    """Start of the 3-hour slot of a time; NULL without one. (A window would drop such rows.)"""
    kind = t.events.schema[ts].dataType.simpleString()
    return F.expr(f"CAST(to_date({ts}) AS {kind}) + make_dt_interval(0, hour({ts}) div 3 * 3)")


def events_with_slots(t: Tables) -> DataFrame:
    """Events as forecast rows: entity, slot, run, wind and heat."""
    return t.events.select(
        "event_id", "user_id", "ts",
        slot_of(t).alias("slot"),
        F.to_date("ts").alias("tanggal"),
        F.col("value").alias("ws"),
        heat("props").alias("suhu"),
    )


def places(t: Tables) -> DataFrame:
    """Customers with their nation and region."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "n_nationkey", "n_name", "r_regionkey", "r_name"
    )


EVENT_SLOTS = """
    SELECT event_id, user_id, ts, time_bucket(INTERVAL '3 hours', ts) AS slot, CAST(ts AS DATE) AS tanggal,
           value AS ws, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS suhu
    FROM events"""

NEWEST = f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, slot ORDER BY ts DESC, event_id DESC) AS rn
        FROM ({EVENT_SLOTS}) e) r
    WHERE rn = 1"""

PLACES = """
    SELECT c_custkey, c_name, n_nationkey, n_name, r_regionkey, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def share_2_sql(part: str, whole: str) -> str:
    """part/whole of two counts rounded half up to 2 decimals, without passing through a double."""
    return f"CAST(({part} * 200 + {whole}) // ({whole} * 2) AS DOUBLE) / 100"
