"""Collocations, decontamination and spelling variants beside plain re-computations."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from stargrain.llm import collocations, decontamination, near_dedup, spelling
from tests.llm.fixtures import awkward, frame, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_long_words_that_are_rotations_of_each_other_are_different(spark):
    rows = [(1, "a" * 4096 + "b"), (2, "b" + "a" * 4096), (3, "a" * 4096 + "b")]
    found = near_dedup.near_groups(frame(spark, rows), words=4).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 2, 3: 1}


# --- collocations -----------------------------------------------------------------------------------


def plain_collocations(rows, least, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                own.update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in counts.items():
        often = {p: n for p, n in own.items() if len(p) > 1 and n >= least}
        kept = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i: i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out, key=repr)


def texts_with_phrases(seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 3))) for _ in range(12)] + ["\u0000x", "UPPER", "x" * 5000]
    out = [(lang, None) for lang in ("en", None)] + [("fr", ""), ("de", " \t\n.,")]
    for k in range(60):
        text = "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "!"]) for _ in range(rng.randint(1, 60)))
        out.append((rng.choice(["en", "en", "de", None]), text + rng.choice(["", " Wie geht es dir", " wie geht es"])))
    return out + out[5:9]


def collocation_frame(spark, rows):
    full = [(k, text, lang, 1, "p", 2, "x") for k, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, n int, phrase string, words int, bucket string").repartition(3)


@pytest.mark.parametrize("bucket", [250_000, 30])
def test_collocations(spark, monkeypatch, bucket):
    """With few suffixes to a bucket, frequent prefixes are hot and there are many buckets."""
    monkeypatch.setattr(collocations, "BUCKET", bucket)  # read by the driver alone
    rows = texts_with_phrases(4)
    found = collocations.collocations(collocation_frame(spark, rows), least=5, top=15)
    assert rows_of(found) == plain_collocations(rows, 5, 15)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(collocation_frame(spark, []).limit(0)).count() == 0
    assert collocations.collocations(collocation_frame(spark, [(None, None), ("en", "")])).count() == 0


def test_equal_parts_are_counts():
    import numpy as np

    rng = np.random.default_rng(1)
    keys = rng.integers(0, 4, (5, 3000)).astype(np.int32)
    keys[0] += 1
    for d in range(1, 5):
        keys[d][keys[d - 1] == 0] = 0  # behind the end there is nothing
    weights = rng.integers(1, 4, 3000)
    want = Counter()
    for column, w in zip(keys.T.tolist(), weights.tolist()):
        for d in range(2, 6):
            if column[d - 1]:
                want[tuple(column[:d])] += w
    at, size, n = collocations.equal_parts(keys, weights, 20)
    assert {tuple(keys[: k + 1, a].tolist()): w for a, k, w in zip(at, size, n)} == {p: w for p, w in want.items() if w >= 20}


# --- decontamination --------------------------------------------------------------------------------


def benchmark_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain_contamination(docs, items, size=10):
    windows = set()
    for item, text in items:
        w = benchmark_words(text)
        n = min(len(w), size)
        windows |= {(tuple(w[i: i + n]), "" if item is None else str(item)) for i in range(len(w) - n + 1) if n}
    out = []
    for doc_id, text in docs:
        w = benchmark_words(text)
        hit, found = set(), set()
        for n in {len(x) for x, _ in windows}:
            at = {}
            for i in range(len(w) - n + 1):
                at.setdefault(tuple(w[i: i + n]), []).append(i)
            for x, item in windows:
                for i in at.get(x, ()):
                    hit |= set(range(i, i + n))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def contaminated_rows():
    rng = random.Random(9)
    item = words("", 25, rng)
    items = [(1, item), (2, words("", 10, rng)), (10, "Straße  42 é"), (3, "zzqone"), (4, None), (5, ""), (None, "!!! ..."), (6, "a " * 30),
             (7, item), (7, "second text of seven"), (None, "the item without id"), (8, "y" * 5000 + " " + "z" * 5000)]
    long = words("", 3000, rng).split()
    docs = awkward() + [
        (1001, f"before {item} after"), (1002, "x-" + item.upper().replace(" ", "\n- ") + "!"), (1003, " ".join(item.split()[3:14])),
        (1004, " ".join(item.split()[3:12])), (1005, "straße 42 É"), (1006, "STRAßE,42,é"), (1007, "ZZQone zzqone zzqtwo"),
        (1008, "A a a a a a a a a a a a a"), (1009, " ".join(long[:900] + item.split() + long[900:] + item.split()[5:20])),
        (1010, "second text of seven, the item without id"), (1011, "y" * 5000 + "\t" + "z" * 5000), (1012, "z" * 5000 + " " + "y" * 5000),
        (1001, f"before {item} after")]
    return docs, items


def test_contamination(spark):
    docs, items = contaminated_rows()
    bench = spark.createDataFrame([(i, t, 1, "w", 2) for i, t in items], "item_id long, text string, id int, window string, n int").repartition(2)
    found = decontamination.contamination(frame(spark, docs), bench)
    assert rows_of(found) == plain_contamination(docs, items)
    short = decontamination.contamination(frame(spark, docs), bench, words=4)
    assert rows_of(short) == plain_contamination(docs, items, 4)


def test_contamination_of_nothing(spark):
    docs, items = contaminated_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontamination.contamination(frame(spark, docs).limit(0), bench).count() == 0
    clean = decontamination.contamination(frame(spark, docs), bench.limit(0))
    assert clean.count() == len(docs) and not clean.filter("contaminated").count()


# --- spelling ---------------------------------------------------------------------------------------


def plain_variants(docs, letters=7, times=2, ratio=10):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= letters
    counts = {w: n for w, n in counts.items() if n >= times}
    by_rest = {}
    for w in counts:
        for i in range(len(w)):
            by_rest.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    near = {w: set() for w in counts}
    for (i, rest), group in by_rest.items():
        for w in group:
            near[w] |= group - {w}
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n, len(near[w]), form[w] and counts[form[w]]) for w, n in counts.items()), key=repr)


def misspelt(seed, alphabet="abé", size=40):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(7, 12))) for _ in range(size)]
    every = []
    for k, w in enumerate(base):
        every += [w] * (300 if k % 7 == 0 else 3)
        for _ in range(8):
            i = rng.randrange(len(w) + 1)
            v = rng.choice([w[:i] + rng.choice(alphabet) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(alphabet) + w[i + 1:]])
            every += [v] * rng.choice([1, 2, 30])
    rng.shuffle(every)
    return [(k, " ".join(every[k * 50: k * 50 + 50])) for k in range(len(every) // 50 + 1)]


def test_variants(spark):
    docs = misspelt(2) + [(None, "without identity without identity"), (None, None), (7001, ""), (7002, "a" * 3000 + " " + "a" * 3001 + " Ümläut×ß ümläut×ß"),
                          (7003, "a" * 3000 + "1" + "a" * 3001), (7004, "ŠTRANGE strangely9strangely"), (7005, "y" * 700 + "b y" + "y" * 699 + "c"),
                          (7006, "y" * 700 + "b y" + "y" * 699 + "c"),
                          (7007, "chainaab " * 2 + "chainabb " * 25 + "chainbbb " * 300)] + awkward()
    found = spelling.variants(frame(spark, docs))
    want = plain_variants(docs)
    assert rows_of(found) == want
    assert ("chainaab", "chainabb", "chainbbb", 2, 1, 25) in want


def test_neighbours_of_every_kind(spark):
    rng = random.Random(3)
    every = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(300)})
    found = set(map(tuple, spelling.neighbours(spark.createDataFrame([(w,) for w in every], "word string")).collect()))

    def one_apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    assert found == {(a, b) for a in every for b in every if one_apart(a, b)}


def test_variants_of_nothing(spark):
    assert spelling.variants(frame(spark, [(1, "x")]).limit(0)).count() == 0
    assert spelling.variants(frame(spark, [(1, None), (2, "short")])).count() == 0
