"""Session settings and lineage cutting."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that decide results, not speed: wall clocks must not depend on the machine.
RESULT_CONF = {"spark.sql.session.timeZone": "UTC"}

# Plan settings for large inputs. Shuffle partitions stay the cluster's choice; AQE coalesces.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle further up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings this package relies on to an existing session."""
    for key, value in {**RESULT_CONF, **SCALE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, name: str = "stargrain", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster hands in its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")  # small inputs on many cores
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per column
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master without the setting (tests) falls back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = os.path.join(tempfile.gettempdir(), f"stargrain-{spark.sparkContext.applicationId}")
    if own not in _LOCAL:
        _LOCAL.add(own)
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return own


_LOCAL: set[str] = set()


def work_folder(spark: SparkSession) -> str:
    """Where this application keeps what it writes on the way, below the shared folder."""
    return f"{shared_folder(spark)}/cut/{spark.sparkContext.applicationId}"


#: bytes of a shuffled partition up to which a join may hold it in a hash table; counts from spark.sql.adaptive.advisoryPartitionSizeInBytes on
HASHED, HASHED_BYTES = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m"


@contextmanager
def hash_joins(spark: SparkSession) -> Iterator[None]:
    """Statements inside join by hash tables where the shuffled partitions of a side turn out small enough, instead of sorting
    both sides. Adaptive execution decides from the sizes it sees; larger partitions are sorted as ever."""
    before = spark.conf.get(HASHED, None)
    spark.conf.set(HASHED, HASHED_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(HASHED)
        else:
            spark.conf.set(HASHED, before)


#: removes the shuffle files of a statement when it ends, not when the driver happens to collect garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> None:
    """Write a step. What it shuffled is of no use afterwards, since the step is read from its files."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` as parquet to the shared folder and read it back.

    The plan restarts from files: lost executors are recovered by re-reading, and later joins see
    the true file size. Used between load steps, where a real load would publish a table. The
    application's steps lie in one folder, which `clear_cuts` removes.
    """
    path = f"{_STEPS.get() or work_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: folder of the steps that go together, inside `settled`
_STEPS: ContextVar[str | None] = ContextVar("steps", default=None)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """`cut` of what `make` returns. The steps that were cut on the way there are removed, so of a long computation
    only the result stays on disk."""
    from stargrain.sources.folders import Folders

    folder = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    outer = _STEPS.set(folder)
    try:
        made = make()
        _STEPS.reset(outer)
        outer = None
        return cut(made)
    finally:
        if outer is not None:
            _STEPS.reset(outer)
        Folders(spark, folder).delete("")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """`cut` for steps that only live until the block ends; their files are removed with it."""
    from stargrain.sources.folders import Folders

    folder = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    count = iter(range(1_000_000))

    def keep(df: DataFrame) -> DataFrame:
        path = f"{folder}/{next(count)}"
        _write(df, path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        Folders(spark, folder).delete("")


def clear_cuts(spark: SparkSession) -> None:
    """Remove everything below `work_folder`, when no result that reads it is needed any more. An application calls it
    at its end: results are read lazily, so the package can't know when that is."""
    from stargrain.sources.folders import Folders

    Folders(spark, work_folder(spark)).delete("")
