"""Raw sources: CSV folders read as text, slices by folder or by predicate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.sources.folders import Folders


def read_text_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with header, every column a string: see the source as it is. Empty fields are NULL.

    A doubled quote inside a quoted field is one quote. `multiline` reads fields that hold line
    ends; such a file can't be split, so it is asked for by source.
    """
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=multiline, quote='"', escape='"')


def as_text(df: DataFrame) -> DataFrame:
    """The same all-text view for a typed source."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def view_name(file_name: str) -> str:
    return "raw_" + file_name.rsplit("/", 1)[-1].rsplit(".", 1)[0]


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Sources of a folder: CSV files, and folders named like one that hold a large source in parts.
    Only names on the first level are read, on whatever file system the folder lives."""
    return [f"{folder}/{name}" for name in Folders(spark, folder).names() if name.endswith(".csv")]


def register_folder(
    spark: SparkSession, folder: str, files: Iterable[str] | None = None, multiline: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """Register every CSV of a folder as view raw_<stem>; returns the frames by view name.

    With `files` only those names are read. A name may be a file or, for a large source, a folder
    of part files. `multiline` names sources whose fields hold line ends.
    """
    paths = list_csv(spark, folder) if files is None else [f"{folder}/{f}" for f in files]
    tables = {}
    for path in paths:
        df = read_text_csv(spark, path, path.rsplit("/", 1)[-1] in set(multiline))
        name = view_name(path)
        df.createOrReplaceTempView(name)
        tables[name] = df
    return tables


def slice_by(df: DataFrame, predicate: str | None) -> DataFrame:
    """Rows of a slice; no predicate means all rows. Plain predicates reach the file scan."""
    return df.filter(F.expr(predicate or "true"))


def slice_tables(tables: Mapping[str, DataFrame], predicates: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: slice_by(df, predicates.get(name)) for name, df in tables.items()}


def parquet_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
