"""Helpers shared by the operators: reading, bounded Arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.session import cut

#: rows an Arrow batch may hold; with long texts the default of 10,000 would fill a worker's memory
BATCH_ROWS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound Arrow batches, and let Python workers import this package from where the driver did.

    On a cluster the package is installed on the executors or passed with --py-files.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id long, text string, ...): a null text is an empty one, other columns are dropped."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string column without nulls; no copy."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + lengths[i] - 1 of all i, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser over unsigned integers (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: 1 for the white space of the contracts (0x20, 0x09-0x0D)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_BYTE = mix(np.arange(256, dtype=np.uint64), 21)[LOWER]
_PLACE = mix(np.arange(4096, dtype=np.uint64), 22) | np.uint64(1)


def runs_of(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of `inside` bytes that don't cross texts: (start and end in raw of each, runs of each text)."""
    none = np.zeros(0, np.int64)
    if not len(raw):
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True  # a run ends with its text
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])


def hash_runs(raw: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run, A-Z lower-cased.

    It is the sum of the bytes' random numbers, each times one of its place, mixed: every run of the
    batch is hashed by a handful of passes over the bytes. A place past 4,096 takes the number of its block
    of 4,096 in as well, so that no two places share a factor.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    begin = np.cumsum(sizes) - sizes
    each = _BYTE[raw[inside]]
    place = np.arange(len(each), dtype=np.int32) - np.repeat(begin.astype(np.int32), sizes)
    with np.errstate(over="ignore"):
        each *= _PLACE[place & 4095]
        if sizes.max() > 4096:
            far = np.flatnonzero(place > 4095)
            each[far] *= mix(place[far] >> 12, 23) | np.uint64(1)
        return mix(np.add.reduceat(each, begin))


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words [^\x20\x09-\x0D]+ of texts, A-Z lower-cased: (64-bit hash, start and end in raw of each, words of each text)."""
    inside = ~SPACE[raw]
    starts, ends, counts = runs_of(raw, offsets, inside)
    return hash_runs(raw, inside, starts, ends), starts, ends, counts


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, words of each text)."""
    hashes, _, _, counts = words_of(raw, offsets)
    return hashes, counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of `size` words of each text: (hashes, sorted in each text; how many).

    A text with fewer words has its whole sequence as the only one; without words it has none.
    """
    own = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    first = np.cumsum(counts) - counts
    at = ragged(first, own)
    width = np.repeat(np.minimum(counts, size), own)
    owner = np.repeat(np.arange(len(counts)), own)
    with np.errstate(over="ignore"):
        h = width.astype(np.uint64)
        for k in range(size):
            here = at + k
            has = k < width
            nxt = words[np.minimum(here, max(len(words) - 1, 0))] if len(words) else h
            h = np.where(has, mix(h * np.uint64(0x100000001B3) ^ nxt, k + 1), h)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(counts))


def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in it if b.num_rows)


#: bytes of text that numpy looks at at once; its working arrays take some thirty times as much
SLICE_BYTES = 4_000_000


def slices(it: Iterator[pa.RecordBatch], *columns: int, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches cut to about `limit` bytes in their text columns of these numbers; a longer text comes alone."""
    limit = limit or SLICE_BYTES
    for b in batches(it):
        sizes = sum(np.diff(utf8(b.column(c))[1]) for c in columns)
        ends = np.cumsum(sizes)
        at = 0
        while at < b.num_rows:
            done = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield b.slice(at, end - at)
            at = end


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over `edges` (a, b), for every id in an edge.

    Labels flow along edges and through the label's own label until nothing changes; each round
    is written to the shared folder, so that both sides of a join are fresh shuffles and Spark can
    split a hub with very many edges. Messages are combined before they are shuffled. Only the
    count of changes reaches the driver.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                 .select("id", F.least("id", "m").alias("component")))
    while True:
        told = both.join(labels, F.col("a") == F.col("id")).groupBy("b").agg(F.min("component").alias("m"))
        near = labels.join(told, F.col("id") == F.col("b")).select(
            "id", F.col("component").alias("old"), F.least("component", "m").alias("mid"))
        up = labels.select(F.col("id").alias("mid"), F.col("component").alias("top"))
        now = cut(near.join(up, "mid", "left").select(
            "id", "old", F.least("mid", F.coalesce("top", "mid")).alias("component")))
        labels = now.select("id", "component")
        if now.filter("component <> old").limit(1).count() == 0:
            return labels
