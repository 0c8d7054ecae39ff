"""MinHash near-deduplication with SuperMinHash signatures."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import mix, texts_of
from stargrain.llm.similar import Scheme, group

#: 32 bands of 5: texts at a similarity of 0.8 share no band with a probability of 3e-6
BANDS, ROWS = 32, 5


def super_minhash(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Two-byte marks of the SuperMinHash signatures of n sets.

    Element x visits the slots in the order of a random permutation of its own (Fisher-Yates) and
    offers j + r at its j-th slot, r random in [0, 1); a slot keeps the smallest offer. Offers of one
    step are made for all elements of all sets at once. A set stops as soon as its largest slot is
    below the next step's smallest offer, for large sets after one or two steps.
    """
    m = BANDS * ROWS
    slots = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)
    draws: list[np.ndarray] = []
    for j in range(m):
        random = mix(hashes, j + 1)
        draw = j + (((random & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int16)
        place = draw.astype(np.int64)
        for i in range(j - 1, -1, -1):  # undo the swaps of the steps before
            place = np.where(place == draws[i], i, np.where(place == i, draws[i], place))
        offer = np.uint64(j << 32) | (random >> np.uint64(32))
        np.minimum.at(slots, owner * m + place, offer)
        open_sets = slots.reshape(n, m).max(1) >= np.uint64((j + 1) << 32)
        going = open_sets[owner]
        if not going.any():
            break
        hashes, owner = hashes[going], owner[going]
        draws = [d[going] for d in [*draws, draw]]
    return (mix(slots) & np.uint64(0xFFFF)).astype(np.uint16).reshape(n, m)


def scheme(words: int) -> Scheme:
    return Scheme(super_minhash, BANDS, ROWS, words, agree=0.65)


def near_groups(docs: DataFrame, words: int = 5) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A-Z are lower-cased; words lie between white space; the set of a text is its distinct shingles of
    `words` words, with fewer words the whole sequence. Documents with a Jaccard similarity of at
    least 0.8 are linked; of each component the smallest doc_id is kept. Null and empty texts have
    no shingles and are kept, linked with nothing. Rows of one doc_id are one document: its
    n_shingles is the largest. Rows without doc_id can't be compared: they return as they come,
    without a component, and are kept.
    """
    units = texts_of(docs).select(F.col("doc_id").alias("id"), "text")
    found = group(units, scheme(words)).groupBy("id").agg(F.max("n").alias("n"), F.min("component").alias("component"))
    ids = texts_of(docs).select("doc_id")
    known = ids.filter("doc_id IS NOT NULL").join(found, F.col("doc_id") == F.col("id")).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"))
    none = F.lit(None).cast("long")
    return known.union(ids.filter("doc_id IS NULL").select("doc_id", none, none, F.lit(True)))


def drop_near_copies(docs: DataFrame, words: int = 5) -> DataFrame:
    """The rows of `docs`, all columns, that `near_groups` keeps."""
    gone = near_groups(docs, words).filter("NOT kept").select(F.col("doc_id").alias("__llm_id")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__llm_id"), "left_anti")
