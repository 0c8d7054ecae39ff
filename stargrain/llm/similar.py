"""Links between texts whose shingle sets are similar, found by banding signatures.

`near_dedup` and `paragraph_dedup` bring signatures of their own; bands, verification and grouping
are the same.

No step pairs all members of a bucket. First every member is compared with the smallest id of its
bucket only, on which the buckets of one group mostly agree; this joins most that belongs together. Then, in buckets whose members still lie in
different components, those outside the bucket's largest component are compared with its members
of other components, by signature and then by set, in cells of bounded size. A pair is looked at
by the first band it shares alone, and only links that join components leave a cell. All links
are confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import batches, bounded_batches, components, mix, shingle_hashes, slices, utf8, word_hashes
from stargrain.session import cut

#: members of a bucket that one task holds at once
CELL = 2048
#: ids that are broadcast, at most (8 bytes each)
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Scheme:
    """How texts are compared: `bands` bands of `rows` two-byte marks made by `sign`."""

    sign: Callable[[np.ndarray, np.ndarray, int], np.ndarray]
    bands: int
    rows: int
    words: int
    percent: int = 80
    #: whether one text may stand in many rows, each with its id
    repeated: bool = False
    #: texts with fewer words aren't compared at all
    min_words: int = 1
    #: pairs whose marks agree in a smaller share aren't verified: several standard errors below `percent`
    agree: float = 0.6

    @property
    def marks(self) -> int:
        return self.bands * self.rows


def signatures(units: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, n, set_a, set_b, marks) of (id, text): n distinct shingles, two sums that stand for the set."""
    bounded_batches(units.sparkSession, 2000)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1):
            hashes, counts = word_hashes(*utf8(b.column(1)))
            if scheme.min_words > 1:
                long = counts >= scheme.min_words
                hashes, counts, b = hashes[np.repeat(long, counts)], counts[long], b.filter(pa.array(long))
            h, n = shingle_hashes(hashes, counts, scheme.words)
            owner = np.repeat(np.arange(len(n)), n)
            sums = []
            for seed in (101, 102):
                total = np.zeros(len(n), np.uint64)
                has = n > 0
                if len(h):
                    total[has] = np.add.reduceat(mix(h, seed), (np.cumsum(n) - n)[has])
                sums.append(pa.array(total.view(np.int64)))
            marks = scheme.sign(h, owner, len(n)) if len(n) else np.zeros((0, scheme.marks), np.uint16)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n.astype(np.int64)), *sums, pa.array([m.tobytes() for m in marks.astype("<u2")], pa.binary())],
                ["id", "n", "set_a", "set_b", "marks"])

    return units.select("id", "text").mapInArrow(run, "id long, n long, set_a long, set_b long, marks binary")


def _agreeing(pairs: DataFrame, signed: DataFrame, scheme: Scheme) -> DataFrame:
    """The (a, b) whose marks agree often enough and whose sizes allow the similarity."""
    def side(x: str) -> DataFrame:
        return signed.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("marks").alias(f"m_{x}"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            ma, mb = (np.frombuffer(b"".join(b.column(k).to_pylist()), "<u2").reshape(-1, scheme.marks) for k in (2, 3))
            keep = pa.array((ma == mb).mean(1) >= scheme.agree)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    sized = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * scheme.percent)
    return sized.select("a", "b", "m_a", "m_b").mapInArrow(run, "a long, b long")


def _bounded(ids: DataFrame) -> DataFrame:
    """Written ids, broadcast if they are few; else the join shuffles both sides."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _texts_of(ids: DataFrame, units: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, text) of the units with these ids."""
    ids = _bounded(cut(ids.distinct()))
    texts = units.join(ids, "id", "left_semi").select("id", "text")
    return cut(texts.distinct() if scheme.repeated else texts)


def _sets_of(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, elements): the shingle hashes of a text in order."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1):
            h, n = shingle_hashes(*word_hashes(*utf8(b.column(1))), scheme.words)
            parts = [x.tobytes() for x in np.split(h.astype("<u8"), np.cumsum(n)[:-1])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(parts, pa.binary())], ["id", "elements"])

    return texts.select("id", "text").mapInArrow(run, "id long, elements binary")


def verified(pairs: DataFrame, units: DataFrame, scheme: Scheme) -> DataFrame:
    """The (a, b) with 100 * intersection >= percent * union, on the full sets of their texts."""
    pairs = cut(pairs)
    texts = _texts_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), units, scheme)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 2, 3):
            sets, owners, sizes = [], [], []
            for k in (2, 3):
                h, n = shingle_hashes(*word_hashes(*utf8(b.column(k))), scheme.words)
                sets.append(h)
                owners.append(np.repeat(np.arange(len(n)), n))
                sizes.append(n)
            h, owner = np.concatenate(sets), np.concatenate(owners)
            order = np.lexsort((h, owner))
            h, owner = h[order], owner[order]
            both = np.bincount(owner[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])], minlength=b.num_rows)
            keep = pa.array((100 * both >= scheme.percent * (sizes[0] + sizes[1] - both)) & (both > 0))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    bounded_batches(units.sparkSession, 256)
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return cut(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _across(members: DataFrame, signed: DataFrame, units: DataFrame, scheme: Scheme) -> DataFrame:
    """Links (a, b) that join the components of the members (bucket, band, id, component, minor, c) of each bucket.

    Every minor member is held against all members of other components, by their full sets. A cell joins
    components as it finds links, so it returns at most one link per component it takes in.
    """
    spark = members.sparkSession
    parts = F.ceil(F.col("c") / CELL).cast("int")
    own = F.pmod(F.xxhash64("id"), parts).cast("int")
    others = F.sequence(F.lit(0), parts - 1)
    left = members.filter("minor").select("bucket", "band", "id", "component", own.alias("i"), F.explode(others).alias("j"), F.lit(0).alias("role"))
    right = members.select("bucket", "band", "id", "component", F.explode(others).alias("i"), own.alias("j"), F.lit(1).alias("role"))
    bounded_batches(spark, 512)
    held = cut(signed.select("id", "n", "marks").join(_sets_of(_texts_of(members.select("id"), units, scheme), scheme), "id"))
    cells = left.select(right.columns).union(right).join(held, "id")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(shards, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "role")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, joined = None, [], {}

        def own_of(c: int) -> int:
            while c in joined:
                c = joined[c]
            return c

        for b in batches(it):
            key = list(zip(*(b.column(k).to_pylist() for k in (0, 1, 2))))
            band, role, ids, comp, n = (np.asarray(b.column(k)) for k in (3, 4, 5, 6, 7))
            marks = np.frombuffer(b"".join(b.column(8).to_pylist()), "<u2").reshape(-1, scheme.marks)
            comp = comp.copy()
            sets = [np.frombuffer(x, "<u8") for x in b.column(9).to_pylist()]
            found_a, found_b = [], []
            edges = [0, *(k for k in range(1, len(key)) if key[k] != key[k - 1]), len(key)]
            for lo, hi in zip(edges, edges[1:]):
                if key[lo] != now:
                    now, held, joined = key[lo], [], {}
                mid = lo + int(np.searchsorted(role[lo:hi], 1))
                held += [(ids[k], comp[k], n[k], marks[k], sets[k]) for k in range(lo, mid)]
                if mid == hi:
                    continue
                at, own, group_of = marks[mid:hi], int(band[mid]), comp[mid:hi]
                for old in joined:
                    group_of[group_of == old] = own_of(old)
                for one, c, size, m, elements in held:
                    c = own_of(c)
                    fit = (group_of != c) & (np.minimum(n[mid:hi], size) * 100 >= np.maximum(n[mid:hi], size) * scheme.percent)
                    fit = np.flatnonzero(fit)
                    same = at[fit] == m
                    near = same.mean(1) >= scheme.agree
                    fit, same = fit[near], same[near]
                    if not len(fit):
                        continue
                    # a pair shares many buckets: only the first of them looks at it
                    fit = fit[same.reshape(len(fit), scheme.bands, scheme.rows).all(2).argmax(1) == own]
                    if not len(fit):
                        continue
                    whole = np.concatenate([sets[mid + k] for k in fit])
                    hit = elements[np.minimum(np.searchsorted(elements, whole), len(elements) - 1)] == whole
                    sizes = n[mid:hi][fit]
                    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
                    fit = fit[100 * both >= scheme.percent * (sizes + size - both)]
                    others, first = np.unique(group_of[fit], return_index=True)
                    for other, k in zip(others.tolist(), fit[first]):
                        found_a.append(one)
                        found_b.append(ids[mid + k])
                        joined[other] = c
                        group_of[group_of == other] = c
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    found = dealt.select("bucket", "i", "j", "band", "role", "id", "component", "n", "marks", "elements").mapInArrow(run, "a long, b long")
    return found.select(*_ordered(F.col("a"), F.col("b"))).distinct()


def group(units: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, n, component) of (id, text): shingles, and the smallest id reachable over links.

    A text without shingles is linked with nothing. Equal sets become one before anything is banded;
    rows that share an id count as one unit. Rows without an id aren't returned.
    """
    signed = signatures(units.filter("id IS NOT NULL"), scheme)
    signed = cut(signed.distinct() if scheme.repeated else signed)
    same = cut(signed.filter("n > 0").groupBy("set_a", "set_b", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("c")).filter("c > 1"))
    copies = cut(signed.join(same.drop("c"), ["set_a", "set_b", "n"]).filter("id <> rep").select("id", "rep").distinct())
    reps = signed.filter("n > 0").join(_bounded(copies.select("id")), "id", "left_anti").select("id", "n", "marks")
    # the last byte of a bucket is its band
    bucket = [F.xxhash64(F.lit(k), F.substring("marks", 1 + 2 * k * scheme.rows, 2 * scheme.rows)).bitwiseAND(F.lit(~255)).bitwiseOR(F.lit(k))
              for k in range(scheme.bands)]
    rows = reps.select("id", F.explode(F.array(*bucket)).alias("bucket"))
    hubs = cut(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("hub")).filter("c > 1"))
    members = cut(rows.join(hubs, "bucket"))
    tried = cut(members.filter("id <> hub").select(*_ordered(F.col("id"), F.col("hub"))).distinct())
    links = verified(_agreeing(tried, reps, scheme), units, scheme)
    found = components(links)
    band = F.col("bucket").bitwiseAND(F.lit(255)).cast("int").alias("band")
    open_rows = members.filter("c > 2").select("bucket", band, "id").join(found, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    main = (open_rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k")).groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("kinds"), F.max_by("component", F.struct("k", "component")).alias("main"), F.sum("k").alias("c"))
            .filter("kinds > 1").drop("kinds"))
    left = cut(open_rows.join(cut(main), "bucket").withColumn("minor", F.col("component") != F.col("main")))
    more = cut(_across(left, reps, units, scheme))
    if more.limit(1).count():
        found = components(links.union(more))
    moved = copies.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    moved = cut(moved.union(found))
    return signed.select("id", "n").join(moved, "id", "left").select("id", "n", F.coalesce("component", "id").alias("component"))
