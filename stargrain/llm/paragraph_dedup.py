"""Substring deduplication by paragraphs: MinHash bands, exact Jaccard, components of removals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import batches, bounded_batches, mix, ragged, slices, texts_of, utf8, words_of
from stargrain.llm.similar import Scheme, group
from stargrain.session import cut, settled

#: words a paragraph needs to be compared; shorter ones stay
MIN_WORDS = 10
#: 12 bands of 3, tuned for recall: paragraphs at a similarity of 0.8 share no band with a probability of 2e-4
BANDS, ROWS = 12, 3
#: words of a window, and places of which one window is chosen: passages of 44 words are always found
WINDOW, REACH = 20, 25
#: (words hashed so far, words added): how windows of 20 words are made from shorter ones
WIDTHS = ((1, 1), (2, 2), (4, 4), (8, 8), (16, 4))
FACTORS = mix(np.arange(BANDS * ROWS, dtype=np.uint64), 7) | np.uint64(1)


def min_hash(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Two-byte marks of n sets: the smallest member under each of BANDS * ROWS multiplicative hashes."""
    counts = np.bincount(owner, minlength=n)
    has = counts > 0
    marks = np.zeros((n, len(FACTORS)), np.uint16)
    if has.any():
        starts = (np.cumsum(counts) - counts)[has]
        for k, factor in enumerate(FACTORS):
            with np.errstate(over="ignore"):
                least = np.minimum.reduceat(hashes * factor, starts)
            marks[has, k] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return marks


SCHEME = Scheme(min_hash, BANDS, ROWS, words=5, repeated=True, agree=0.5, min_words=MIN_WORDS)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, id, text) of each line that may have MIN_WORDS words; equal ones share an id (64-bit
    hash). Those that differ in case or white space alone have equal sets and meet later."""
    rows = docs.select("doc_id", F.posexplode(_lines(F.col("text"))).alias("pos", "text"))
    return rows.filter(F.length("text") >= 2 * MIN_WORDS - 1).select("doc_id", "pos", F.xxhash64("text").alias("id"), "text")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos) of the paragraphs that go: all but the first of each component."""
    units = paragraphs(docs)
    grouped = settled(docs.sparkSession, lambda: group(units.select("id", "text"), SCHEME).select("id", "component"))
    places = cut(units.select("doc_id", "pos", "id").join(grouped, "id").select("doc_id", "pos", "component"))
    first = cut(places.groupBy("component").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"))
    repeated = cut(places.join(first, "component"))
    keep = cut(repeated.filter("doc_id = first_doc").groupBy("component").agg(F.min("pos").alias("first_pos")))
    return repeated.join(keep, "component").filter("doc_id <> first_doc OR pos <> first_pos").select("doc_id", "pos")


def windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, end in raw, hash) of windows of WINDOW words, chosen by content.

    Of every REACH consecutive places the one whose window has the smallest hash is chosen, so that two texts
    that share WINDOW + REACH - 1 words choose a common window there, whatever surrounds them.
    """
    words, starts, ends, counts = words_of(raw, offsets)
    own = np.maximum(counts - WINDOW + 1, 0)
    if not own.sum():
        none = np.zeros(0, np.int64)
        return none, none, none, none
    with np.errstate(over="ignore"):
        h = words
        for level, (width, step) in enumerate(WIDTHS):
            h = mix(h[: len(h) - step] * np.uint64(0x100000001B3) + h[step:], level)
    at = ragged(np.cumsum(counts) - counts, own)
    owner = np.repeat(np.arange(len(counts)), own)
    h = h[at]
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    # the smallest of the places i .. i + REACH - 1 of the same text; short texts have what there is
    reach, least = 1, key
    last = np.repeat(np.cumsum(own), own) - 1
    place = np.arange(len(h))
    while reach * 2 <= REACH:
        least = np.minimum(least, least[np.minimum(place + reach, last)])
        reach *= 2
    least = np.minimum(least, least[np.minimum(place + REACH - reach, last)])
    chosen = np.unique((least & np.uint64(0xFFFFFFFF)).astype(np.int64))
    begin = at[chosen]
    return owner[chosen], starts[begin], ends[begin + WINDOW - 1], h[chosen].view(np.int64)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end): byte ranges of windows that also stand in a document before, or further up."""
    bounded_batches(docs.sparkSession, 1000)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1):
            raw, offsets = utf8(b.column(1))
            owner, start, end, h = windows(raw, offsets)
            doc, start, end = np.asarray(b.column(0))[owner], start - offsets[owner], end - offsets[owner]
            order = np.lexsort((start, doc, h))
            doc, start, end, h = doc[order], start[order], end[order], h[order]
            # a window that stands before in this slice goes for sure; a repeated row is the same place
            again = np.zeros(len(h), bool)
            again[1:] = h[1:] == h[:-1]
            again[1:] &= (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (h, doc, start, end, again)], ["hash", "doc_id", "start", "end", "again"])

    found = cut(docs.select("doc_id", "text").mapInArrow(run, "hash long, doc_id long, start long, end long, again boolean"))
    first = found.filter("NOT again")
    several = cut(first.groupBy("hash").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
                  .filter("first_doc <> last_doc").drop("last_doc"))
    later = first.join(several, "hash").filter("doc_id <> first_doc")
    return found.filter("again").select("doc_id", "start", "end").union(later.select("doc_id", "start", "end"))


def without(docs: DataFrame) -> DataFrame:
    """(__llm_doc, __llm_text, __llm_drop, __llm_spans): for documents that lose something, what is left, the
    positions of their removed paragraphs and the removed byte ranges."""
    plain = texts_of(docs).filter("doc_id IS NOT NULL")
    lines = settled(docs.sparkSession, lambda: repeated_lines(plain))
    ranges = settled(docs.sparkSession, lambda: repeated_windows(plain))
    gone = lines.groupBy("doc_id").agg(F.collect_set("pos").alias("drop"))
    spans = ranges.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    lost = cut(gone.join(spans, "doc_id", "full_outer"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            out = []
            for doc_id, text, drop, ranges in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(),
                                                  b.column(2).to_pylist(), b.column(3).to_pylist()):
                drop = set(drop or ())
                at, kept, cuts = 0, [], sorted((r["start"], r["end"]) for r in ranges or ())
                merged: list[list[int]] = []
                for start, end in cuts:
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                k = 0
                for pos, line in enumerate(text.split(b"\n")):
                    end = at + len(line)
                    while k < len(merged) and merged[k][1] <= at:
                        k += 1
                    if pos not in drop:
                        parts, here, j = [], at, k
                        while j < len(merged) and merged[j][0] < end:
                            parts.append(text[here: max(here, merged[j][0])])
                            here = min(max(here, merged[j][1]), end)
                            j += 1
                        parts.append(text[here:end])
                        left = b"".join(parts)
                        if left.strip() or not line.strip():
                            kept.append(left)
                    at = end + 1
                out.append((doc_id, b"\n".join(kept).decode(), sorted(drop), [{"start": s, "end": e} for s, e in merged]))
            ids, texts, drops, spans = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(drops, pa.list_(pa.int32())),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["doc", "text", "drop", "spans"])

    bounded_batches(docs.sparkSession, 1000)
    rows = plain.join(lost, "doc_id").select("doc_id", "text", "drop", "spans")
    return rows.mapInArrow(run, "__llm_doc long, __llm_text string, __llm_drop array<int>, __llm_spans array<struct<start: long, end: long>>").dropDuplicates(["__llm_doc"])


def _joined(docs: DataFrame) -> DataFrame:
    return docs.join(settled(docs.sparkSession, lambda: without(docs)), F.col("doc_id").cast("long") == F.col("__llm_doc"), "left")


def _left() -> Column:
    return F.when(F.col("__llm_doc").isNull(), F.col("text")).otherwise(F.col("__llm_text"))


def drop_paragraphs(docs: DataFrame) -> DataFrame:
    """`docs` with all columns, repeated passages gone from `text`.

    Paragraphs are lines of at least MIN_WORDS words. Two are linked with a Jaccard similarity of at least
    0.8 over shingles of five words, or when they are equal; of each component the first
    paragraph (smallest doc_id, then position) stays. A passage inside paragraphs that differ otherwise goes by
    equal windows of words, all but the first; one of WINDOW + REACH - 1 words always holds one. Lines that keep
    nothing go with their line end. Null and empty texts, rows without doc_id and what is shorter stay as
    they are; rows of one doc_id are one document.
    """
    return _joined(docs).select(*[_left().alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def paragraph_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, n_removed, removed, spans, text) of every row: lines, how many went as paragraphs and
    which, removed byte ranges inside the text as it was, what is left of the text."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _joined(narrow).select(
        "doc_id", F.size(_lines(F.col("text"))).alias("n_paragraphs"), F.coalesce(F.size("__llm_drop"), F.lit(0)).alias("n_removed"),
        F.coalesce("__llm_drop", F.array().cast("array<int>")).alias("removed"),
        F.coalesce(F.col("__llm_spans"), F.array().cast("array<struct<start: long, end: long>>")).alias("spans"),
        F.coalesce(_left(), F.lit("")).alias("text"))
