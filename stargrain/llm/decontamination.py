"""Benchmark decontamination: a prefix-filtered join of document words with item-sized windows.

An item of ten words or more has a window at each of its words that nine follow; a shorter one is a
window as a whole. A window is a sequence of shingles (pairs of words; of a single word, that word),
ordered by how rare they are in the documents. To occur a window must occur with all its shingles, so its
prefix in that order, the rarest one, is enough to find it: documents are looked up for prefixes only.
What is found is bounded by its place in the window (the window may not begin before the text nor end
after it) and then compared word by word, as text.

Nothing of the benchmark is sent to the tasks but a bitmap of fixed size; the rest are joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stargrain.llm.common import LOWER, bounded_batches, hash_runs, mix, ragged, runs_of, slices, texts_of, utf8
from stargrain.session import cut

#: words of a window
WORDS = 10
#: bits of the bitmap that says which shingles are worth a row: 2 MB, whatever the size of the benchmark
BITS = 24
#: candidates turned to rows at once
ROWS = 20_000

#: bytes of words: digits, letters and everything beyond ASCII
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = True
WORD[0x80:] = True


def _shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(word starts, ends, words of each text, hash of each word and the next, hash of each word alone); a word
    without a next one in its text has the first hash 0."""
    inside = WORD[raw]
    starts, ends, counts = runs_of(raw, offsets, inside)
    words = hash_runs(raw, inside, starts, ends)
    pairs = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        pairs[:-1] = mix(words[:-1] * np.uint64(0x100000001B3) ^ words[1:], 31)
    last = np.cumsum(counts) - 1
    pairs[last[counts > 0]] = 0
    return starts, ends, counts, pairs, mix(words, 32)


def _joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.Array:
    """Strings of `size` words from the `first` on, lower-cased, one space between them."""
    at = ragged(first, size)
    width = ends[at] - starts[at]
    bounds = np.concatenate([[0], np.cumsum(width + 1)])
    out = np.full(bounds[-1], 0x20, np.uint8)
    out[ragged(bounds[:-1], width)] = LOWER[raw[ragged(starts[at], width)]]
    ends_of = bounds[np.cumsum(size)]
    sizes = np.diff(np.concatenate([[0], ends_of]))
    keep = np.ones(len(out), bool)
    keep[ends_of[size > 0] - 1] = False  # the space after the last word
    places = np.concatenate([[0], np.cumsum(sizes - (size > 0))])
    buffers = [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(out[keep])]
    return pa.Array.from_buffers(pa.large_string(), len(size), buffers).cast(pa.string())


def windows(items: DataFrame, words: int = WORDS) -> DataFrame:
    """(item string, window string, n int, tokens array of long) of every window of items (item, text)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1):
            raw, offsets = utf8(b.column(1))
            starts, ends, counts, pairs, single = _shingles(raw, offsets)
            own = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
            first = ragged(np.cumsum(counts) - counts, own)
            owner = np.repeat(np.arange(len(counts)), own)
            size = np.minimum(counts, words)[owner]
            for k in range(0, len(first), ROWS):
                f, s, o = (x[k: k + ROWS] for x in (first, size, owner))
                tokens = [(single[a: a + 1] if n == 1 else pairs[a: a + n - 1]).astype(np.int64) for a, n in zip(f, s)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(o)), _joined(raw, starts, ends, f, s), pa.array(s, pa.int32()),
                     pa.array(tokens, pa.list_(pa.int64()))], ["item", "window", "n", "tokens"])

    return items.mapInArrow(run, "item string, window string, n int, tokens array<long>")


def _bitmap(tokens: DataFrame) -> np.ndarray:
    """Bits of the low BITS of each `token`; combined by Spark, so that 2**BITS / 8 bytes reach the driver at most."""
    low = F.col("token").bitwiseAND(2**BITS - 1)
    rows = tokens.select(low.alias("v")).groupBy(F.shiftright("v", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("v").bitwiseAND(32767)).alias("bits")).collect()
    out = np.zeros((2 ** max(BITS - 15, 0), 4096), np.uint8)
    for r in rows:
        out[r.part] = np.frombuffer(bytes(r.bits), np.uint8)
    return out.ravel()


def _set(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    low = (tokens & np.uint64(2**BITS - 1)).astype(np.int64)
    return (bits[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1


def _counts(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """(token, seen): occurrences in the documents of the shingles whose bit is set."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1):
            _, _, _, pairs, single = _shingles(*utf8(b.column(1)))
            tokens, n = np.unique(np.concatenate([t[_set(bits, t)] for t in (pairs, single)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.astype(np.int64)), pa.array(n, pa.int64())], ["token", "seen"])

    return texts.mapInArrow(run, "token long, seen long").groupBy("token").agg(F.sum("seen").alias("seen"))


def _look(texts: DataFrame, bits: np.ndarray, words: int) -> DataFrame:
    """Rows of documents (id, doc_id, n_words) and of places worth a join (id, token, at, before, context):
    word number `at` starts the shingle and is word number `before` of the words around it."""
    schema = "id long, doc_id long, n_words long, token long, at long, before int, context string"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        for b in slices(it, 1):
            raw, offsets = utf8(b.column(1))
            starts, ends, counts, pairs, single = _shingles(raw, offsets)
            n, ids = len(counts), base + np.arange(len(counts))
            base += n
            none = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(ids), b.column(0), pa.array(counts, pa.int64()), *none], names)
            found = [np.flatnonzero(_set(bits, t)) for t in (pairs, single)]
            places = np.concatenate(found)
            tokens = np.concatenate([pairs[found[0]], single[found[1]]]).astype(np.int64)
            first = np.cumsum(counts) - counts
            for k in range(0, len(places), ROWS):
                p = places[k: k + ROWS]
                owner = np.searchsorted(first + counts, p, side="right")
                at = p - first[owner]
                before = np.minimum(at, words - 1)
                after = np.minimum(counts[owner] - at, words)
                none = [pa.nulls(len(p), pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[owner]), *none, pa.array(tokens[k: k + ROWS]), pa.array(at), pa.array(before, pa.int32()),
                     _joined(raw, starts, ends, p - before, before + after)], names)

    return texts.mapInArrow(run, schema)


def find(docs: DataFrame, benchmark: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, occurrences, items): (id, doc_id, n_words) of every row of `docs`; (id, window, start, n) of each
    occurrence of each window of `benchmark` (item_id, text), `start` being the number of its first word; and
    (item, window), the windows of each item."""
    bounded_batches(docs.sparkSession)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts_of(docs)
    every = cut(windows(items, words))
    single = every.groupBy("window", "n").agg(F.first("tokens").alias("tokens"))
    shingles = single.select("window", "n", F.posexplode("tokens").alias("offset", "token"))
    seen = _counts(texts, _bitmap(shingles.select("token")))
    ranked = shingles.join(seen, "token", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token", "offset")).alias("rarest"))
    # a shingle that no document has: the window can't occur
    prefix = cut(ranked.filter("rarest.seen > 0").select("window", "n", "rarest.token", "rarest.offset"))
    looked = cut(_look(texts, _bitmap(prefix.select("token")), words))
    around = F.split("context", " ")
    begin = F.col("before") - F.col("offset")
    hits = (looked.filter("token IS NOT NULL").select("id", "token", "at", "before", "context").join(prefix, "token")
            .filter((begin >= 0) & (begin + F.col("n") <= F.size(around)))
            .filter(F.array_join(F.slice(around, begin + 1, F.col("n")), " ") == F.col("window"))
            .select("id", "window", (F.col("at") - F.col("offset")).alias("start"), "n"))
    return looked.filter("token IS NULL").select("id", "doc_id", "n_words"), cut(hits), every.select("item", "window").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of `docs`, repeated ones and
    those without doc_id included.

    A word is hit if it lies in an occurrence of a window; n_items counts the items with such windows, and
    items_sha256 is taken of their ids, sorted as strings and joined by commas. Null and empty texts have no words
    and no hit, on either side; an item without id goes by the empty id, and rows of one id are one item.
    """
    rows, hits, named = find(docs, benchmark, words)
    longest = hits.groupBy("id", "start").agg(F.max("n").alias("n"))
    before = Window.partitionBy("id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    spans = longest.withColumn("done", F.max(end).over(before)).select(
        "id", F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("done", F.lit(0)))).alias("more"))
    covered = spans.groupBy("id").agg(F.sum("more").alias("n_hit"))
    items = hits.select("id", "window").distinct().join(named, "window").groupBy("id").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return rows.join(covered, "id", "left").join(items, "id", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
