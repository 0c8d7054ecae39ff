"""Spelling variants: a frontier of states over a trie kept as an edge table.

The words, and the words read backwards, stand in two tries. A node is the prefix its words share; an edge
(node, ch, label, child, leaf, nexts) leads on by all characters its words have in common, so a node is where words
part, or the only word of a leaf; `nexts` are the characters that lead on from the child. Tries are built level by level: words grouped by (node, next character), the child being
the common prefix of the group's smallest and largest word.

A state (s, position, node, edits) says that a word, read up to a position, arrives at a node with so many
edits. Without an edit a word runs along its own path, which the levels give. The one edit may always be placed
where two words first differ, so states with one edit spring from the other edges of a word's own nodes; from then
on they are joined with the edge table, round by round, and have to match it. Those that end with a word are neighbours.

Of two words one edit apart, the word of m characters shares at least (m - 1) // 2 at the beginning or at the end
with the other. So in either trie edits are only made past that place, where the tries are thin. Each pair is
looked for from one of its words only: the longer one, or of equally long ones that with the smaller differing character.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import LOWER, bounded_batches, ragged, runs_of, slices, texts_of, utf8
from stargrain.session import cut

#: code points and occurrences a word must have
LETTERS, TIMES = 7, 2
#: one of so many (document, run) loses a letter
MISSPELT = 31
#: a form is so many times as frequent
RATIO = 10

ALPHA = np.zeros(256, bool)
ALPHA[0x41:0x5B] = ALPHA[0x61:0x7B] = True
LEAD = 0xC3  # first byte of U+00C0 to U+00FF, and of nothing else


def _occurrences(b: pa.RecordBatch, letters: int) -> tuple[list[str], list[int]]:
    """Words of a batch of (doc_id, text) with their numbers of occurrences; some words may come twice."""
    raw, offsets = utf8(b.column(1))
    lead = raw == LEAD
    inside = ALPHA[raw] | lead
    inside[1:] |= lead[:-1]
    starts, ends, counts = runs_of(raw, offsets, inside)
    leads = np.concatenate([[0], np.cumsum(lead)])
    points = ends - starts - (leads[ends] - leads[starts])
    long = points >= letters
    owner = np.repeat(np.arange(len(counts)), counts)[long]
    starts, ends = starts[long], ends[long]
    sizes = ends - starts
    data = LOWER[raw[ragged(starts, sizes)]]
    places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(places), pa.py_buffer(data)]).dictionary_encode()
    known = found.dictionary.to_pylist()
    pairs, n = np.unique(owner << 32 | found.indices.to_numpy(), return_counts=True)
    document, word = pairs >> 32, pairs & 0xFFFFFFFF
    ids = [zlib.crc32(f"{'' if d is None else d}:".encode()) for d in b.column(0).to_pylist()]
    h = np.array([zlib.crc32(known[w], ids[d]) for d, w in zip(document.tolist(), word.tolist())], np.int64)
    less = h % MISSPELT == 0
    total = np.bincount(word[~less], n[~less], minlength=len(known)).astype(np.int64)
    words, times = [w.decode() for w in known], total.tolist()
    for w, k, times_here in zip(word[less].tolist(), h[less].tolist(), n[less].tolist()):
        at = k % len(words[w])
        shorter = words[w][:at] + words[w][at + 1:]
        if len(shorter) >= letters:
            words.append(shorter)
            times.append(times_here)
    return words, times


def vocabulary(docs: DataFrame, letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """(word, n): words of enough letters and occurrences in the whole of `docs`."""
    bounded_batches(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1):
            words, n = _occurrences(b, letters)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    found = texts_of(docs).mapInArrow(run, "word string, n long").filter("n > 0")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def _rest(s: str, start: Column, size: Column | None = None) -> Column:
    """Characters of column `s` from number `start` (from 0) on."""
    return F.substr(F.col(s), start + 1) if size is None else F.substr(F.col(s), start + 1, size)


#: stands for the end of a word among next characters, where it can't be a letter
END = "$"


def _mark(ch: str | Column) -> Column:
    ch = F.col(ch) if isinstance(ch, str) else ch
    return F.when(ch == "", END).otherwise(ch)


def _common(a: str, b: str) -> Column:
    """How many characters two different strings share at the beginning."""
    same = F.zip_with(F.split(F.col(a), ""), F.split(F.col(b), ""), lambda x, y: x.eqNullSafe(y))
    return (F.array_position(same, False) - 1).cast("int")


def tries(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, paths) of the tries of the distinct `word`s forwards (nodes begin with >) and backwards (<).

    edges: (node, ch, label, child, leaf, nexts); a leaf's child is its word, as read in that trie, and a word that ends
    in a node is a leaf with an empty label. paths: (s, node) of the nodes on the way of each word.
    """
    both = F.array(F.struct(F.col("word").alias("s"), F.lit(">").alias("node")), F.struct(F.reverse("word").alias("s"), F.lit("<").alias("node")))
    live = cut(words.select(F.inline(both)))
    edges, paths = [], []
    depth = F.length("node") - 1
    while True:
        paths.append(live)
        placed = live.withColumn("ch", _rest("s", depth, F.lit(1)))
        met = placed.groupBy("node", "ch").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"))
        ended = met.withColumn("leaf", F.col("n") == 1).withColumn("end", F.when(F.col("leaf"), F.length("lo")).otherwise(_common("lo", "hi")))
        level = cut(ended.select(
            "node", "ch", _rest("lo", depth, F.col("end") - depth).alias("label"),
            F.when(F.col("leaf"), F.col("lo")).otherwise(F.concat(F.substr("node", F.lit(1), F.lit(1)), F.substr("lo", F.lit(1), F.col("end")))).alias("child"),
            "leaf"))
        edges.append(level)
        onwards = level.filter("NOT leaf")
        if not onwards.limit(1).count():
            every = reduce(DataFrame.union, edges)
            ahead = every.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_list(_mark("ch")), "").alias("nexts"))
            inner = every.filter("NOT leaf").join(ahead, "child").select(*every.columns, "nexts")
            return inner.union(every.filter("leaf").withColumn("nexts", F.lit(""))), reduce(DataFrame.union, paths)
        live = cut(placed.join(onwards.select("node", "ch", "child"), ["node", "ch"]).select("s", F.col("child").alias("node")))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near) of all pairs of distinct `word`s, in both orders, that differ by exactly one inserted, deleted or
    replaced code point."""
    edges, paths = tries(words)
    edges = cut(edges)
    m, size, p = F.length("s"), F.length("label"), F.col("p")
    start = paths.withColumn("p", F.length("node") - 1).filter((p >= F.floor((m - 1) / 2)) & (p < m)).withColumn("own", _rest("s", p, F.lit(1)))
    replaced = (F.col("ch") > F.col("own")) & (_rest("s", p + 1, size - 1) == _rest("label", F.lit(1)))
    inserted = (F.col("ch") != F.col("own")) & (_rest("s", p + 1, size) == F.col("label"))  # the word has a character more
    ends = F.array_compact(F.array(F.when(replaced, p + size), F.when(inserted, p + 1 + size)))
    # a state has to be at its word's end in a leaf; in another node its next character has to lead on
    fits = F.when(F.col("leaf"), p == m).otherwise((p <= m) & (F.instr("nexts", _mark(_rest("s", p, F.lit(1)))) > 0))
    states = (start.join(edges, "node").filter(replaced | inserted)
              .select("s", "child", "leaf", "nexts", F.substr("node", F.lit(1), F.lit(1)).alias("side"), F.explode(ends).alias("p")).filter(fits))
    found = []
    while True:
        states = cut(states.drop("nexts"))
        found.append(states.filter("leaf").select("side", "s", F.col("child").alias("t")))
        onwards = states.filter("NOT leaf").select("s", "side", F.col("child").alias("node"), "p", _rest("s", p, F.lit(1)).alias("ch"))
        if not onwards.limit(1).count():
            break
        states = (onwards.join(edges, ["node", "ch"]).filter(_rest("s", p, size) == F.col("label"))
                  .select("s", "child", "leaf", "nexts", "side", (p + size).alias("p")).filter(fits))
    turned = lambda c: F.when(F.col("side") == ">", F.col(c)).otherwise(F.reverse(c))
    pairs = reduce(DataFrame.union, found).select(turned("s").alias("a"), turned("t").alias("b"))
    return pairs.union(pairs.select("b", "a")).distinct().toDF("word", "near")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where (word, form) leads in the end. A form is always more frequent, so the way ends; each
    round doubles what a row has gone."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("top"))
        following = cut(now.join(ahead, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
        now = following.select("word", "root")
        if not following.filter("moved").limit(1).count():
            return now


def variants(docs: DataFrame, letters: int = LETTERS, times: int = TIMES, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of `docs` with enough letters and occurrences.

    `form` is the word's most frequent neighbour (of equals the smallest in code-point order) if it is `ratio`
    times as frequent, else null; `root` is where forms lead in the end, the word itself without one. Null and
    empty texts have no words. A null doc_id counts as empty text in the hash that decides on letters lost; rows
    that repeat are counted each.
    """
    words = cut(vocabulary(docs, letters, times))
    pairs = neighbours(words.select("word"))
    named = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("m")), "near")
    best = named.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("best"))
    much = -F.col("best.less") >= ratio * F.col("n")
    rows = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(much, F.col("best.near")).alias("form"), F.when(much, -F.col("best.less")).alias("form_n")))
    roots = _roots(rows.filter("form IS NOT NULL").select("word", "form"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
