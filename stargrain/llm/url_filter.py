"""URL filter: host and path rules, then the ratio of two character language models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.llm.common import batches, bounded_batches, slices, utf8
from stargrain.session import cut

#: fixed values: the rules of the production filter as (verdict, host and path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: longest context in bytes
ORDER = 4
#: share of accepted held-out URLs that the calibrated threshold may reject
FALSE_BLOCKS = 0.02
#: one of so many accepted URLs, chosen by hash, is held out for the threshold
HELD = 5
#: the threshold's rank is exact to one in so many held-out URLs
RANKS = 100_000
START, END = 2, 3


def parts(url: Column) -> tuple[Column, Column, Column]:
    """(host with A-Z lower-cased, path, all from the path on); empty without `://` or url."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    after = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    rest = after.substr(F.length(host) + 1, F.length(after))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(rest, r"^[^?#]*", 0), rest


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; among equally long ones the first by text."""
    rule = verdict = F.lit(None).cast("string")
    for said, name in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        where, slash, rest = name.partition("/")
        fits = ((host == where) | host.endswith(f".{where}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, next byte, context of ORDER bytes as one integer) of each position, with an end byte per URL."""
    lengths = np.diff(offsets) + ORDER + 1
    out = np.full(int(lengths.sum()), START, np.uint8)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    place = np.arange(len(out)) - begin[owner]
    out[place == lengths[owner] - 1] = END
    out[(place >= ORDER) & (place < lengths[owner] - 1)] = raw
    at = np.flatnonzero(place >= ORDER)
    context = np.zeros(len(at), np.int64)
    for k in range(ORDER, 0, -1):
        context = (context << 8) | out[at - k]
    return owner[at], out[at].astype(np.int64), context


def _counted(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram of ORDER + 1 bytes, times)."""
    _, nxt, context = _grams(raw, offsets)
    return np.unique(context << 8 | nxt, return_counts=True)


class Markov:
    """Byte counts after contexts of 0 to ORDER bytes, mixed by Witten-Bell weights."""

    def __init__(self, longest: np.ndarray, times: np.ndarray):
        """From the grams of ORDER + 1 bytes and how often each stands."""
        self.levels = []
        for n in range(ORDER + 1):
            grams, place = np.unique(longest & ((1 << 8 * (n + 1)) - 1), return_inverse=True)
            counts = np.zeros(len(grams), np.int64)
            np.add.at(counts, place, times)
            contexts, first = np.unique(grams >> 8, return_index=True)
            totals = np.add.reduceat(counts, first) if len(counts) else counts
            kinds = np.diff(np.append(first, len(grams)))
            self.levels.append((grams, counts, contexts, totals, kinds))

    def log_probability(self, nxt: np.ndarray, context: np.ndarray) -> np.ndarray:
        p = np.full(len(nxt), 1 / 256)
        for n, (grams, counts, contexts, totals, kinds) in enumerate(self.levels):
            if not len(grams):
                continue
            own = context & ((1 << 8 * n) - 1)
            c = np.minimum(np.searchsorted(contexts, own), len(contexts) - 1)
            g = np.minimum(np.searchsorted(grams, own << 8 | nxt), len(grams) - 1)
            count = np.where(grams[g] == own << 8 | nxt, counts[g], 0)
            known = contexts[c] == own
            p = np.where(known, (count + kinds[c] * p) / (totals[c] + kinds[c]), p)
        return np.log(p)


@dataclass
class Ratio:
    accepted: Markov
    rejected: Markov
    threshold: float = 0.0

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean over a URL's bytes of log p(accepted) - log p(rejected)."""
        owner, nxt, context = _grams(raw, offsets)
        gain = self.accepted.log_probability(nxt, context) - self.rejected.log_probability(nxt, context)
        n = len(offsets) - 1
        return np.bincount(owner, gain, minlength=n) / np.bincount(owner, minlength=n)


def _joined(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pa.array(list(texts), pa.string()))


def fit(accepted: Sequence[str], rejected: Sequence[str]) -> Ratio | None:
    """Fit on four of five URLs; the rest sets the threshold so that at most FALSE_BLOCKS of the
    accepted ones fall below it. Without URLs of both kinds there is no model."""
    if not accepted or not rejected:
        return None
    held = [u for k, u in enumerate(accepted) if k % 5 == 4]
    model = Ratio(Markov(*_counted(*_joined([u for k, u in enumerate(accepted) if k % 5 != 4]))), Markov(*_counted(*_joined(rejected))))
    if held:
        model.threshold = float(np.quantile(model.score(*_joined(held)), FALSE_BLOCKS))
    return model


def _markov(texts: DataFrame) -> Markov:
    """Counted over all texts in the tasks; only distinct grams with their sums reach the driver."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 0):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _counted(*utf8(b.column(0)))], ["gram", "times"])

    found = texts.select("text").mapInArrow(run, "gram long, times long").groupBy("gram").agg(F.sum("times").alias("times")).toArrow()
    return Markov(found["gram"].to_numpy(), found["times"].to_numpy())


def train(urls: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> Ratio | None:
    """Models of all distinct URLs that rules decide, or none without URLs of both verdicts.

    What a rule fixes (the end of the host, the start of the path) is cut from them: it says why
    they were labelled, not what such URLs look like. One of HELD accepted URLs isn't fitted on; the
    threshold is the score that at most FALSE_BLOCKS of those fall below. No URL reaches the driver, only
    the counts of grams.
    """
    bounded_batches(urls.sparkSession, 5000)
    host, path, rest = parts(F.col("url"))
    rule, verdict = ruled(host, path, rules)
    own = F.substring_index("rule", "/", 1)
    free = F.concat(F.col("host").substr(F.lit(1), F.length("host") - F.length(own)),
                    F.col("rest").substr(F.length("rule") - F.length(own) + 1, F.length("rest")))
    known = (urls.select(host.alias("host"), rest.alias("rest"), rule.alias("rule"), verdict.alias("verdict"))
             .filter("rule IS NOT NULL").select("verdict", free.alias("text")).distinct())
    known = cut(known.withColumn("held", (F.col("verdict") == "allow") & (F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0)))
    sizes = {(r.verdict, r.held): r["count"] for r in known.groupBy("verdict", "held").count().collect()}
    fitted, held = sizes.get(("allow", False), 0), sizes.get(("allow", True), 0)
    if not fitted + held or ("block", False) not in sizes:
        return None
    accepted = known.filter("verdict = 'allow'")
    model = Ratio(_markov(accepted.filter("NOT held") if fitted else accepted), _markov(known.filter("verdict = 'block'")))
    if not fitted or not held:
        return model

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(it, 0):
            yield pa.RecordBatch.from_arrays([pa.array(model.score(*utf8(b.column(0))))], ["score"])

    scores = accepted.filter("held").select("text").mapInArrow(run, "score double")
    model.threshold = scores.agg(F.percentile_approx("score", FALSE_BLOCKS, RANKS)).first()[0]
    return model


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row.

    The longest rule that fits decides; else the URL is blocked if its score is below the calibrated
    threshold. `score` is null where a rule decided or no model could be fitted, which allows the
    URL. A null url, and one without `://`, is judged as an empty one; repeated rows alike.
    """
    spark = pages.sparkSession
    bounded_batches(spark, 5000)
    model = train(pages.select("url"), rules)
    host, path, rest = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), rest.alias("rest"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), F.concat("host", "rest").alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            score: list[float | None] = [None] * b.num_rows
            free = np.flatnonzero(np.asarray(b.column(3).is_null()))
            if model and len(free):
                found = model.score(*utf8(b.column(5).take(pa.array(free))))
                for k, s in zip(free, found):
                    score[k] = float(s)
            own = [v or ("block" if s is not None and s < model.threshold else "allow") for v, s in zip(b.column(4).to_pylist(), score)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(own, pa.string()), pa.array(score, pa.float64())],
                                             ["page_id", "host", "path", "rule", "verdict", "score"])

    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, score double")
