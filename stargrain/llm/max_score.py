"""Exact top-k search over integer vectors with MaxScore."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stargrain.llm.common import batches, bounded_batches

#: vectors of a shard and queries of a block, on average
SHARD, BLOCK = 8192, 2048


class Shard:
    """Postings of one shard: for each component and sign the vectors with that sign, largest first.

    A query's terms are its non-zero components; a term's list holds the vectors whose component has
    the query's sign, so that every posting adds to the score and its bound. Components of the other
    sign only lower a score; they enter when a survivor is scored.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.lists: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for d in range(vectors.shape[1]):
            for sign in (1, -1):
                value = vectors[:, d] * sign
                at = np.flatnonzero(value > 0)
                at = at[np.argsort(-value[at], kind="stable")]
                self.lists[d, sign] = (at, value[at])

    def top(self, own_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best vectors but the query's own: highest score, then smallest id."""
        terms = []
        for d in np.flatnonzero(query):
            at, value = self.lists[int(d), 1 if query[d] > 0 else -1]
            if len(at):
                weight = abs(int(query[d]))
                terms.append((weight * int(value[0]), weight, int(d), at, value))
        terms.sort(key=lambda t: t[0])
        found = self._competitive(own_id, query, terms, k)
        score = self.vectors[found] @ query
        order = np.lexsort((self.ids[found], -score))[:k]
        return self.ids[found][order], score[order]

    def _competitive(self, own_id: int, query: np.ndarray, terms: list, k: int) -> np.ndarray:
        """Vectors that may be among the k best, those of other ids only."""
        other = self.ids != own_id
        every = np.flatnonzero(other)
        if not terms or len(every) <= k:
            return every
        heads = np.unique(np.concatenate([t[3][: 2 * k] for t in terms[-8:]]))
        heads = heads[other[heads]]
        if len(heads) < k:
            return every
        least = int(np.partition(self.vectors[heads] @ query, -k)[-k])
        if least <= 0:  # a vector in no list could compete
            return every
        bounds = np.cumsum([t[0] for t in terms])
        split = int(np.searchsorted(bounds, least))  # the first `split` terms together stay below `least`
        total = np.zeros(len(self.ids), np.int64)
        for _, weight, _, at, value in terms[split:]:
            total[at] += weight * value
        rest = int(bounds[split - 1]) if split else 0
        found = np.flatnonzero((total > 0) & (total + rest >= least) & other)
        total = total[found]
        for bound, _, d, _, _ in reversed(terms[:split]):
            rest -= bound
            total += np.maximum(self.vectors[found, d] * query[d], 0)
            going = total + rest >= least
            found, total = found[going], total[going]
        return found


def search(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with `is_query` its k best other rows, all if fewer.

    Components become floor(1024 * x); the score is their inner product, exact in 64 bits; ties go to the
    smaller vec_id. Vectors that are null or empty or hold a null or non-finite component, and rows
    without vec_id, take no part; vectors of different lengths aren't compared. Equal rows count once.

    Rows are dealt into shards, queries into blocks by a hash of vec_id; each block meets
    each shard in one task, which holds one shard's postings and streams the block. Every shard
    returns at most k rows per query, and the best k of those are the result.
    """
    spark = vectors.sparkSession
    bounded_batches(spark, 5000)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("q")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & sound)
    rows = rows.select("vec_id", F.size("embedding").alias("dims"), whole.cast("array<bigint>").alias("v"), F.coalesce("q", F.lit(False)).alias("q"))
    n, n_queries = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0))).first()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-n_queries // BLOCK))
    own = F.xxhash64("vec_id")

    def all_of(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    stored = rows.select("dims", F.pmod(own, F.lit(shards)).cast("int").alias("shard"), all_of(blocks).alias("block"), F.lit(0).alias("role"), "vec_id", "v")
    asked = rows.filter("q").select("dims", all_of(shards).alias("shard"), F.pmod(own, F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("role"), "vec_id", "v")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = stored.union(asked).repartition(max(parts, min(shards * blocks, 20_000)), "dims", "shard", "block").sortWithinPartitions(
        "dims", "shard", "block", "role", "vec_id")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, held, shard = None, [], [], None
        for b in batches(it):
            dims, key_s, key_b, role, vec = (np.asarray(b.column(j)) for j in range(5))
            flat, offsets = np.asarray(b.column(5).flatten()), np.concatenate([[0], np.cumsum(dims)])
            same = (dims[1:] == dims[:-1]) & (key_s[1:] == key_s[:-1]) & (key_b[1:] == key_b[:-1]) & (role[1:] == role[:-1])
            edges = [0, *(np.flatnonzero(~same) + 1), len(dims)]
            out: list[tuple] = []
            for lo, hi in zip(edges, edges[1:]):
                key = (dims[lo], key_s[lo], key_b[lo])
                if key != now:
                    now, ids, held, shard = key, [], [], None
                part = flat[offsets[lo]: offsets[hi]].reshape(hi - lo, dims[lo])
                if role[lo] == 0:
                    ids.append(vec[lo:hi])
                    held.append(part)
                    continue
                if not ids:
                    continue
                if shard is None:
                    names, values = np.concatenate(ids), np.concatenate(held)
                    first = np.unique(np.column_stack([names, values]), axis=0, return_index=True)[1]
                    shard = Shard(names[first], values[first])
                for query_id, query in zip(vec[lo:hi], part):
                    out.append((query_id, *shard.top(query_id, query, k)))
            sizes = [len(o[1]) for o in out]
            if sum(sizes):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([o[0] for o in out], sizes)), pa.array(np.concatenate([o[1] for o in out])),
                    pa.array(np.concatenate([o[2] for o in out]))], ["query_id", "vec_id", "score"])

    found = cells.mapInArrow(run, "query_id long, vec_id long, score long").distinct()
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
