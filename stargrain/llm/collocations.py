"""Phrase collocation mining by multikey three-way quicksort of suffix pointers.

A suffix is the language of a text, then up to four words from one word on, within a piece. Equal suffixes
of a slice of texts become one with a count. All are then routed by their leading words: a suffix goes to the bucket of its
shortest prefix that isn't hot, so every phrase from that length on is counted whole in one bucket. Hot
prefixes are few by their definition and are counted where they are read; so no word or pair fills a bucket.

A bucket is sorted in memory: each round splits every open segment of suffix pointers three ways by the word
at the segment's depth against a pivot; the equal part goes on one word deeper. The size of an equal part is the count of a
phrase, and a part of fewer suffixes than asked for is abandoned whatever it holds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stargrain.llm.common import LOWER, batches, bounded_batches, hash_runs, mix, ragged, runs_of, slices, texts_of, utf8
from stargrain.session import cut

#: words of the longest phrase, occurrences of a candidate, rows of a language
WORDS, TIMES, TOP = 4, 30, 2000
#: a phrase goes if a longer one has at least this share of its occurrences, in percent
INSIDE = 80
#: bytes of texts looked at at once; the words' arrays take some hundred times as much
SLICE = 1_500_000
#: suffixes of a bucket, which is sorted at once; buckets of a group, which is read at once, compressed; and
#: suffixes made to text at once
BUCKET, BUCKETS, ROWS = 250_000, 16, 50_000
#: a prefix in this share of all suffixes, and in a quarter of a bucket, is hot
HOT = 1e-4

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORD = ~BREAK
WORD[[0x20, 0x09]] = False


class _Slice:
    """Words of a slice of texts, and for each the words of its piece that follow."""

    def __init__(self, b: pa.RecordBatch):
        self.raw, offsets = utf8(b.column(1))
        self.langs = b.column(2).dictionary_encode()
        inside = WORD[self.raw]
        self.starts, self.ends, counts = runs_of(self.raw, offsets, inside)
        n = len(self.starts)
        self.owner = np.repeat(np.arange(len(counts)), counts)
        self.lang = self.langs.indices.to_numpy()[self.owner].astype(np.int64)
        breaks = np.cumsum(BREAK[self.raw])[self.starts] if n else np.zeros(0, np.int64)
        on = np.zeros(n + WORDS, bool)  # the next word is in the same piece
        on[: max(n - 1, 0)] = (self.owner[1:] == self.owner[:-1]) & (breaks[1:] == breaks[:-1])
        self.room = np.ones(n, np.int64)
        far = np.ones(n, bool)
        for k in range(WORDS - 1):
            far &= on[k: n + k]
            self.room += far
        words = hash_runs(self.raw, inside, self.starts, self.ends)
        named = np.array([hash_of(x) for x in self.langs.dictionary.to_pylist()], np.uint64)
        #: prefixes[d - 1] is the hash of language and d words; of no meaning where there is no room for d
        self.prefixes, h = [], named[self.lang] if n else np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            for d in range(WORDS):
                following = np.concatenate([words[d:], np.zeros(min(d, n), np.uint64)])
                h = mix(h * np.uint64(0x100000001B3) ^ following, 41 + d)
                self.prefixes.append(h)

    def spread(self) -> list[np.ndarray]:
        """Exact codes, equal for equal prefixes of d words (with their language) of this slice."""
        n = len(self.starts)
        sizes = self.ends - self.starts
        places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        data = LOWER[self.raw[ragged(self.starts, sizes)]]
        words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(places), pa.py_buffer(data)])
        ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        out, code = [], self.lang
        for d in range(WORDS):
            has = np.flatnonzero(self.room > d)
            now = np.full(n, -1, np.int64)
            now[has] = np.unique(code[has] << 32 | ids[has + d], return_inverse=True)[1]
            out.append(now)
            code = now
        return out

    def texts(self, first: np.ndarray, size: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, bounds) of `size` words from `first` on, lower-cased, with a space between them and byte `end` behind them."""
        at = ragged(first, size)
        width = self.ends[at] - self.starts[at]
        bounds = np.concatenate([[0], np.cumsum(width + 1)])
        out = np.full(bounds[-1], 0x20, np.uint8)
        out[ragged(bounds[:-1], width)] = LOWER[self.raw[ragged(self.starts[at], width)]]
        done = bounds[np.cumsum(size)]
        out[done - 1] = end
        return out, np.concatenate([[0], done])


def hash_of(text: str) -> int:
    """64 bits of a short text, the same in every process."""
    h = 0
    for byte in text.encode():
        h = (h * 0x100000001B3 ^ byte ^ 0x5BD1E995) & (2**64 - 1)
    return h


def _totals(texts: DataFrame) -> DataFrame:
    """(lang, depth, hash, n): words of each language (depth 0), and prefixes that reach the hot share in a slice.

    A prefix with twice that share of all suffixes has at least half of its occurrences in slices that report it.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1, limit=SLICE):
            s = _Slice(b)
            least = max(2, int(HOT * len(s.starts)))
            langs, hashes, depths, n = [], [], [], []
            for code, (lang, count) in enumerate(zip(s.langs.dictionary.to_pylist(), np.bincount(s.lang, minlength=len(s.langs.dictionary)))):
                langs.append(lang), hashes.append(0), depths.append(0), n.append(int(count))
            for d, h in enumerate(s.prefixes, 1):
                h = h[s.room >= d]
                low = (h & np.uint64(0xFFFF)).astype(np.int64)
                found, counts = np.unique(h[(np.bincount(low, minlength=65536) >= least)[low]], return_counts=True)
                often = counts >= least
                hashes += found[often].astype(np.int64).tolist()
                n += counts[often].tolist()
                langs += [""] * int(often.sum())
                depths += [d] * int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(depths, pa.int32()), pa.array(hashes, pa.int64()), pa.array(n, pa.int64())],
                ["lang", "depth", "hash", "n"])

    return texts.mapInArrow(run, "lang string, depth int, hash long, n long").groupBy("lang", "depth", "hash").agg(F.sum("n").alias("n"))


ROUTED = "group long, parts binary, data binary, langs string, phrase string, words int, n long"
ROUTED_NAMES = [f.split()[0] for f in ROUTED.split(", ")]


def _routed(texts: DataFrame, hot: list[np.ndarray], groups: int) -> DataFrame:
    """One row for each slice and group of buckets (group, parts, data, langs), and rows of hot phrases with their
    occurrences in a slice (langs, phrase, words, n; group null).

    `data` holds, bucket by bucket, compressed lines of words and a compressed number for each line: its language's
    place in `langs`, its count, and the words of the prefix that routed it. `parts` says where (bucket, bytes of the lines,
    then of the compressed lines and numbers).
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 1, limit=SLICE):
            s = _Slice(b)
            n = len(s.starts)
            if not n:
                continue
            codes, langs = s.spread(), s.langs.dictionary.to_pylist()
            by, route = np.zeros(n, np.int64), np.zeros(n, np.uint64)
            open_ = np.ones(n, bool)
            for d in range(1, WORDS + 1):
                open_ &= s.room >= d
                is_hot = np.zeros(n, bool)
                is_hot[open_] = np.isin(s.prefixes[d - 1][open_], hot[d - 1])
                here = open_ & ~is_hot
                by[here], route[here] = d, s.prefixes[d - 1][here]
                open_ &= is_hot
                at = np.flatnonzero(open_)
                if len(at):
                    _, first, counts = np.unique(codes[d - 1][at], return_index=True, return_counts=True)
                    first = at[first]
                    data, bounds = s.texts(first, np.full(len(first), d), 0x20)
                    phrases = [data[x: y - 1].tobytes().decode() for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                    m = len(first)
                    none = [pa.nulls(m, t) for t in (pa.int64(), pa.binary(), pa.binary())]
                    yield pa.RecordBatch.from_arrays(
                        [*none, pa.array([langs[k] for k in s.lang[first]], pa.string()), pa.array(phrases, pa.string()),
                         pa.array(np.full(m, d), pa.int32()), pa.array(counts, pa.int64())], ROUTED_NAMES)
            # equal suffixes of the slice become one
            at = np.flatnonzero(by)
            last = np.stack(codes)[s.room[at] - 1, at] << 3 | s.room[at]
            _, first, counts = np.unique(last, return_index=True, return_counts=True)
            first = at[first]
            bucket = (route[first] % np.uint64(groups * BUCKETS)).astype(np.int64)  # those of a group follow each other
            order = np.lexsort((last[np.searchsorted(at, first)], bucket))
            first, counts, bucket = first[order], counts[order], bucket[order]
            parts: dict[int, list[tuple[int, int, bytes, bytes]]] = {}
            for k in range(0, len(first), ROWS):
                for part in _parts(s, first[k: k + ROWS], counts[k: k + ROWS], bucket[k: k + ROWS], by):
                    parts.setdefault(part[0] // BUCKETS, []).append(part)
            m = len(parts)
            index = [np.array([(number, size, len(x), len(y)) for number, size, x, y in ps], np.int64).tobytes() for ps in parts.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(parts), pa.int64()), pa.array(index, pa.binary()), pa.array([b"".join(z for p in ps for z in p[2:]) for ps in parts.values()], pa.binary()),
                 pa.array([json.dumps(langs)] * m, pa.string()), pa.nulls(m, pa.string()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64())], ROUTED_NAMES)

    return texts.mapInArrow(run, ROUTED)


def _parts(s: _Slice, first: np.ndarray, counts: np.ndarray, bucket: np.ndarray, by: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(bucket, bytes of the lines, compressed lines, compressed counts) of suffixes in order of their buckets."""
    data, bounds = s.texts(first, s.room[first], 0x0A)
    packed = (s.lang[first] << 40 | counts << 3 | by[first]).astype(np.uint64)
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    press = lambda x: pa.compress(x.tobytes(), codec="zstd", asbytes=True)
    for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(first)]):
        lines = data[bounds[x]: bounds[y]]
        yield int(bucket[x]), len(lines), press(lines), press(packed[x:y])


def equal_parts(keys: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a pointer, words, weight) of each prefix of key 0 and one word or more that weighs `least` or more.

    keys[d] are the codes at depth d: the language, then words; 0 stands for none. Segments of pointers lie
    one after the other; a round partitions them all, each by its own pivot at its own depth.
    """
    order = np.arange(keys.shape[1])
    bounds, depth = np.array([0, len(order)]), np.zeros(1, np.int64)
    found = []
    while len(order):
        sizes = np.diff(bounds)
        segment = np.repeat(np.arange(len(sizes)), sizes)
        here = keys[depth[segment], order]
        ends = np.stack([here[bounds[:-1]], here[bounds[:-1] + sizes // 2], here[bounds[1:] - 1]])
        pivot = np.median(ends, axis=0).astype(keys.dtype)  # of three: one of them
        side = (here >= pivot[segment]).astype(np.int8) + (here > pivot[segment])  # 0 less, 1 equal, 2 greater
        part = segment * 3 + side
        number = np.bincount(part, minlength=3 * len(sizes))
        weight = np.bincount(part, weights[order], minlength=3 * len(sizes)).astype(np.int64)
        start = np.cumsum(number) - number
        to = np.empty(len(order), np.int64)
        for k in range(3):
            mine = np.flatnonzero(side == k)
            # their places among the equals of their segment
            before = np.searchsorted(mine, bounds[:-1])
            to[mine] = start[part[mine]] + np.arange(len(mine)) - before[segment[mine]]
        moved = np.empty_like(order)
        moved[to] = order
        deeper = np.tile(np.array([0, 1, 0]), len(sizes))
        depths, pivots = np.repeat(depth, 3), np.repeat(pivot, 3)
        alive = (weight >= least) & ~((deeper == 1) & (pivots == 0) & (depths > 0))
        words = alive & (deeper == 1) & (depths > 0)
        found.append((moved[start[words]], depths[words], weight[words]))
        alive &= depths + deeper < len(keys)
        order = moved[np.repeat(alive, number)]
        depth = (depths + deeper)[alive]
        bounds = np.concatenate([[0], np.cumsum(number[alive])])
    return tuple(np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in range(3))


def _sorted_bucket(parts: list[tuple[int, bytes, bytes, list[str]]], least: int) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """(languages, phrases, words, occurrences) of the frequent phrases of a bucket that no other bucket has, from
    (size, lines, counts, languages) of slices."""
    names = sorted({x for *_, langs in parts for x in langs})
    texts, numbers, lang = [], [], []
    for size, lines, counts, langs in parts:
        texts.append(np.frombuffer(pa.decompress(lines, decompressed_size=size, codec="zstd"), np.uint8))
        many = int((texts[-1] == 0x0A).sum())
        numbers.append(np.frombuffer(pa.decompress(counts, decompressed_size=8 * many, codec="zstd"), np.uint64).astype(np.int64))
        lang.append(np.array([names.index(x) + 1 for x in langs])[numbers[-1] >> 40])
    data, packed, lang = np.concatenate(texts), np.concatenate(numbers) & (1 << 40) - 1, np.concatenate(lang)
    line = data == 0x0A
    gap = np.flatnonzero(line | (data == 0x20))
    last = np.flatnonzero(line[gap])
    first = np.concatenate([[0], last[:-1] + 1])
    room = last - first + 1
    data = np.where(line, np.uint8(0x20), data)
    places = np.concatenate([[0], gap + 1]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(gap), [None, pa.py_buffer(places), pa.py_buffer(data)])
    ids = words.dictionary_encode().indices.to_numpy()
    keys = np.zeros((WORDS + 1, len(first)), np.int32)
    keys[0] = lang
    for d in range(WORDS):
        has = room > d
        keys[d + 1, has] = ids[first[has] + d] + 1
    at, size, n = equal_parts(keys, packed >> 3, least)
    whole = (packed[at] & 7) <= size  # a shorter prefix of these is hot and stands in other buckets too
    at, size, n = at[whole], size[whole], n[whole]
    begin, end = places[first[at]], places[first[at] + size] - 1
    phrases = [data[x:y].tobytes().decode() for x, y in zip(begin.tolist(), end.tolist())]
    return [names[k - 1] for k in lang[at]], phrases, size, n


def phrase_counts(docs: DataFrame, least: int = TIMES) -> tuple[DataFrame, DataFrame]:
    """(totals, phrases): (lang, n) words of each language, and (lang, phrase, words, n) of every phrase of up to
    four words that occurs `least` times or more within pieces of one language."""
    bounded_batches(docs.sparkSession)
    texts = texts_of(docs, F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    known = cut(_totals(texts))
    totals = known.filter("depth = 0").select("lang", "n")
    n = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # at most 1 / HOT of each depth, since no suffix has two prefixes of one depth
    rows = known.filter("depth > 0").filter(F.col("n") >= max(BUCKET // 4, int(n * HOT))).select("depth", "hash").collect()
    hot = [np.array([r.hash for r in rows if r.depth == d], np.int64).astype(np.uint64) for d in range(1, WORDS + 1)]
    routed = cut(_routed(texts, hot, max(1, -(-n // (BUCKET * BUCKETS)))))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}

        def done() -> Iterator[pa.RecordBatch]:
            for parts in held.values():
                langs, phrases, words, counts = _sorted_bucket(parts, least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(words, pa.int32()), pa.array(counts, pa.int64())],
                    ["lang", "phrase", "words", "n"])

        for b in batches(it):
            for group, index, data, langs in zip(*(c.to_pylist() for c in b.columns)):
                if group != now:
                    yield from done()
                    now, held = group, {}
                at, langs = 0, json.loads(langs)
                for bucket, size, lines, numbers in np.frombuffer(index, np.int64).reshape(-1, 4).tolist():
                    held.setdefault(bucket, []).append((size, data[at: at + lines], data[at + lines: at + lines + numbers], langs))
                    at += lines + numbers
        yield from done()

    bounded_batches(docs.sparkSession, 16)  # a row holds up to a slice's suffixes
    whole = (routed.filter("group IS NOT NULL").select("group", "parts", "data", "langs").repartition("group")
             .sortWithinPartitions("group").mapInArrow(run, "lang string, phrase string, words int, n long"))
    hot_ones = (routed.filter("phrase IS NOT NULL").groupBy(F.col("langs").alias("lang"), "phrase", "words").agg(F.sum("n").alias("n"))
                .filter(F.col("n") >= least))
    found = cut(whole.unionByName(hot_ones))
    bounded_batches(docs.sparkSession)
    return totals, found


def collocations(docs: DataFrame, least: int = TIMES, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language of `docs`.

    a counts the phrase, l and r the parts of its lowest-scoring cut, n all words of the language; the score is
    2,000,000 a / (l + r), rounded down. Phrases inside a longer one that makes up 80 % of them don't count. A null
    language is `und`; null and empty texts have no words; rows that repeat count each. A language without
    frequent phrases has no row.
    """
    totals, known = phrase_counts(docs, least)
    parts = known.select("lang", F.col("phrase").alias("part"), F.col("n").alias("of_part"))
    candidates = known.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    halves = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("head"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("tail"))
    sized = (halves.join(parts.withColumnsRenamed({"part": "head", "of_part": "l"}), ["lang", "head"])
             .join(parts.withColumnsRenamed({"part": "tail", "of_part": "r"}), ["lang", "tail"]))
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)")
    lowest = sized.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = F.array(
        F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2),
        F.when(F.col("words") == 4, F.substring_index(F.substring_index("phrase", " ", 3), " ", -2)),
        F.when(F.col("words") == 4, F.substring_index("phrase", " ", 3)), F.when(F.col("words") == 4, F.substring_index("phrase", " ", -3)))
    longer = (candidates.filter("words > 2").select("lang", F.explode(F.array_compact(inner)).alias("phrase"), F.col("a").alias("b"))
              .groupBy("lang", "phrase").agg(F.max("b").alias("b")))
    much = F.col("b").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * INSIDE
    left = lowest.join(longer, ["lang", "phrase"], "left").filter(F.col("b").isNull() | ~much)
    best = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
