"""Exact deduplication with a cuckoo-filter index over live digests."""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import batches, bounded_batches, texts_of
from stargrain.session import cut

SLOTS = 4
MAX_KICKS = 200
#: digests of an index at which it is given out, or about which a shard holds
ENTRIES = 400_000


class CuckooIndex:
    """A cuckoo filter whose slots also store the full digest and a value.

    Each digest has two buckets of four slots; the second is the first xor a hash of the 16-bit
    fingerprint, so an entry moves without its digest being hashed again. A fingerprint hit is
    verified against the digests stored in the bucket. When an insertion finds no slot after
    MAX_KICKS moves, or nine tenths of the slots are taken, the index doubles and fills itself again
    from the stored digests.
    """

    def __init__(self, buckets: int = 64):
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = [0] * (buckets * SLOTS)
        self.keys: list[bytes | None] = [None] * (buckets * SLOTS)
        self.values: list = [None] * (buckets * SLOTS)
        self.live = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        first, mark = struct.unpack_from("<QH", digest)
        mark = mark or 1
        one = first & self.mask
        return mark, one, one ^ ((mark * 0x5BD1E995 >> 5) & self.mask)

    def _slot(self, digest: bytes) -> int:
        mark, one, two = self._places(digest)
        for bucket in (one, two):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.keys[slot] == digest:
                    return slot
        return -1

    def get(self, digest: bytes):
        slot = self._slot(digest)
        return None if slot < 0 else self.values[slot]

    def put(self, digest: bytes, value) -> None:
        """Insert, or replace the value of a live digest."""
        slot = self._slot(digest)
        if slot >= 0:
            self.values[slot] = value
            return
        if (self.live + 1) * 10 > len(self.keys) * 9:
            self._grow()
        self._insert(digest, value)

    def _insert(self, digest: bytes, value) -> None:
        mark, one, two = self._places(digest)
        entry, bucket = (mark, digest, value), one
        for bucket in (one, two):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self._store(slot, entry)
                    self.live += 1
                    return
        for kick in range(MAX_KICKS):
            slot = bucket * SLOTS + kick % SLOTS
            old = (self.prints[slot], self.keys[slot], self.values[slot])
            self._store(slot, entry)
            entry = old
            bucket ^= (entry[0] * 0x5BD1E995 >> 5) & self.mask
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[free]:
                    self._store(free, entry)
                    self.live += 1
                    return
        self._grow()
        self._insert(entry[1], entry[2])

    def _store(self, slot: int, entry: tuple) -> None:
        self.prints[slot], self.keys[slot], self.values[slot] = entry

    def _grow(self) -> None:
        stored = list(self.items())
        self._clear((self.mask + 1) * 2)
        for digest, value in stored:
            self._insert(digest, value)

    def remove(self, digest: bytes) -> bool:
        """Delete a live digest; False if it isn't there."""
        slot = self._slot(digest)
        if slot < 0:
            return False
        self._store(slot, (0, None, None))
        self.live -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((k, v) for k, v in zip(self.keys, self.values) if k is not None)


GROUPS = "digest binary, keep_id long, group_size long"


def _fold(it: Iterator[pa.RecordBatch], whole: bool = True) -> Iterator[pa.RecordBatch]:
    """Fold (digest, keep_id, group_size) rows of a partition into one row per digest.

    A group whose size falls to zero or below is deleted from the index. Unless the partition is to be folded as
    a whole, an index of ENTRIES digests is given out and a new one begun, so a digest may come several times.
    """
    index = CuckooIndex()
    for b in batches(it):
        if not whole and index.live >= ENTRIES:
            yield from _rows(index)
            index = CuckooIndex()
        for digest, keep, size in zip(*(c.to_pylist() for c in b.columns)):
            old = index.get(digest)
            if old is not None:
                keep = old[0] if keep is None else keep if old[0] is None else min(keep, old[0])
                size += old[1]
            index.put(digest, (keep, size))
    for digest, (_, size) in list(index.items()):
        if size <= 0:
            index.remove(digest)
    yield from _rows(index)


def _fold_partly(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _fold(it, whole=False)


def _rows(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    rows = index.items()
    while part := list(itertools.islice(rows, 10_000)):
        yield pa.RecordBatch.from_arrays([
            pa.array([d for d, _ in part], pa.binary()),
            pa.array([v[0] for _, v in part], pa.int64()),
            pa.array([v[1] for _, v in part], pa.int64())], ["digest", "keep_id", "group_size"])


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of the text with every run of white space as one space."""
    text = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    return texts_of(docs).select("doc_id", F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("digest"))


def build_index(found: DataFrame) -> DataFrame:
    """Index of (doc_id, digest) rows: (digest, keep_id = smallest doc_id, group_size).

    Every input partition folds its rows into indexes of its own first, so a text that a third
    of all rows share leaves each task as few rows; then digests are dealt out by hash and the
    partial indexes merge, one shard to a partition. There are as many shards as keep one at about ENTRIES digests:
    `found` is counted, so hand it in written.
    """
    bounded_batches(found.sparkSession, 10_000)
    rows = found.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return merge_index(rows.mapInArrow(_fold_partly, GROUPS), found.count())


def merge_index(groups: DataFrame, digests: int = 0) -> DataFrame:
    """One row per digest of partial indexes that hold at most so many `digests`."""
    bounded_batches(groups.sparkSession, 10_000)
    shards = max(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-digests // ENTRIES))
    return groups.repartition(shards, "digest").mapInArrow(_fold, GROUPS)


def update_index(index: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The index after new (doc_id, digest) rows come in and others go.

    A digest whose last row goes is deleted. The smallest doc_id of a group that loses rows isn't
    known from the index: it stays as it was while the group lives.
    """
    minus = removed.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(-1).cast("long").alias("group_size"))
    known = index.select("digest", "keep_id", "group_size")
    return merge_index(known.union(build_index(added)).union(minus), known.count() + added.count())


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of white space became one space; null
    is an empty text. Rows of one doc_id and text count each and share their flag; a null doc_id
    stays only where its whole group has none. An empty table gives no rows.
    """
    found = cut(digests(docs))
    copies = build_index(found).filter("group_size > 1")
    own = F.col("doc_id")
    keep = F.when(F.col("group_size").isNull(), own).otherwise(F.col("keep_id"))
    return found.join(copies, "digest", "left").select(
        own, keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        own.eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
