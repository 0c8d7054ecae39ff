import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from stargrain.llm import exact_dedup, line_dedup, near_dedup, paragraph_dedup, suffix_dedup
from stargrain.llm.common import shingle_hashes, utf8, word_hashes
from stargrain.session import CLEANUP, work_folder
from stargrain.sources.folders import Folders
from tests.llm.fixtures import awkward, frame, groups, shingles, tokens, words

import pyarrow as pa


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- suffix arrays ---------------------------------------------------------------------------------


def removed(rows, length=100):
    """Plain: walk all strings in order of doc_id and start."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if raw[k: k + length] in seen:
                gone[k: k + length] = b"\1" * length
            seen.add(raw[k: k + length])
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[doc_id, text] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_as_walked(spark):
    rows = [r for r in awkward() if r[0] is not None] + [(None, "no id")]
    found = suffix_dedup.remove_repeats(frame(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    want = removed(rows)
    by_id = {d: v for (d, _), v in want.items()}
    assert len(found) == len(rows)
    assert {r[0]: tuple(r[1:]) for r in found} == by_id
    assert by_id[801][1] == 4999  # a run of one byte repeats itself from its second byte on


def test_partial_indexes_are_given_out_when_full(monkeypatch):
    monkeypatch.setattr(exact_dedup, "ENTRIES", 50)
    rng = random.Random(4)
    rows = [(hashlib.sha256(bytes([rng.randrange(200)])).digest(), n, 1) for n in range(3000)]
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], ["digest", "keep_id", "group_size"])
    parts = list(exact_dedup._fold_partly(batch(rows[k: k + 10]) for k in range(0, 3000, 10)))
    assert all(b.num_rows < 60 for b in parts) and len(parts) > 4
    whole = [r for b in exact_dedup._fold(iter(parts)) for r in b.to_pylist()]
    want = {}
    for digest, n, _ in rows:
        keep, size = want.get(digest, (n, 0))
        want[digest] = (keep, size + 1)
    assert {r["digest"]: (r["keep_id"], r["group_size"]) for r in whole} == want and len(whole) == len(want)


def test_hot_gram_parts_into_single_strings(spark, monkeypatch):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh") for _ in range(130))
    rows = [(k, "".join(rng.choice("qrstuvwxyz") for _ in range(150)) + shared + "".join(rng.choice("QRSTUVWXYZ") for _ in range(150))) for k in range(40)]
    monkeypatch.setattr(suffix_dedup, "MEET", 8)
    hot = list(suffix_dedup._collapse(iter(_places(rows))))
    assert any(b.column(1).to_numpy(zero_copy_only=False).any() for b in hot)
    found = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    want = {d: v for (d, _), v in removed(rows).items()}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want


def _places(rows):
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["doc", "text"])
    got = pa.Table.from_batches(suffix_dedup._gather(iter([batch])))
    got = got.sort_by([(c, "ascending") for c in ("gram", "content", "doc", "start")])
    return got.to_batches(max_chunksize=7)


def test_merged_transforms_find_all_repeats():
    rng = random.Random(2)
    for _ in range(30):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 40))).encode() for _ in range(rng.randint(1, 9))]
        depth = rng.randint(1, 8)
        cut = rng.randint(0, len(strings))
        shards = [suffix_dedup.Shard(s) for s in (strings[:cut], strings[cut:]) if s]
        interval, string, place = suffix_dedup.repeated_intervals(shards, depth)
        got = {}
        for i, s, p in zip(interval, string, place):
            got.setdefault(int(i), set()).add((int(s), int(p)))
        want = {}
        for s, text in enumerate(strings):
            for p in range(len(text) - depth + 1):
                want.setdefault(text[p: p + depth], set()).add((s, p))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_suffix_order_is_sorted():
    strings = [b"banana", b"", b"ana", b"ana", b"\x00\xff"]
    shard = suffix_dedup.Shard(strings)
    order = [(strings[s][p:], s) for s, p in zip(shard.string, shard.place)]
    assert order == sorted(order)


def test_empty_tables(spark):
    empty = frame(spark, [])
    for f in (suffix_dedup.remove_repeats, exact_dedup.exact_dedup, near_dedup.near_groups, near_dedup.drop_near_copies,
              paragraph_dedup.paragraph_dedup, line_dedup.line_dedup):
        assert f(empty).count() == 0


# --- exact ------------------------------------------------------------------------------------------


def test_exact_groups(spark):
    rows = awkward()
    body = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    same = {}
    for d, t in rows:
        same.setdefault(body(t), []).append(d)
    want = []
    for d, t in rows:
        ids = [x for x in same[body(t)] if x is not None]
        keep = min(ids) if ids else None
        want.append((d, keep, len(same[body(t)]), d == keep, hashlib.sha256(body(t).encode()).hexdigest()))
    assert rows_of(exact_dedup.exact_dedup(frame(spark, rows))) == sorted(want, key=repr)


def test_cuckoo_index_inserts_grows_and_deletes():
    index, rng, live = exact_dedup.CuckooIndex(2), random.Random(1), {}
    keys = [hashlib.sha256(bytes([k % 251, k // 251])).digest() for k in range(3000)]
    for step in range(12_000):
        key = rng.choice(keys)
        if rng.random() < 0.6:
            index.put(key, step)
            live[key] = step
        else:
            assert index.remove(key) == (live.pop(key, None) is not None)
    assert dict(index.items()) == live and index.live == len(live)
    assert all(index.get(k) == live.get(k) for k in keys)


def test_cuckoo_index_with_equal_fingerprints_verifies_content():
    index = exact_dedup.CuckooIndex(2)
    one, two = b"\x07" * 10 + b"a" * 22, b"\x07" * 10 + b"b" * 22
    index.put(one, 1)
    assert index.get(two) is None
    index.put(two, 2)
    assert index.remove(one) and index.get(two) == 2


def test_index_takes_and_drops_rows(spark):
    first = exact_dedup.digests(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string"))
    more = exact_dedup.digests(spark.createDataFrame([(4, "c"), (0, "a")], "doc_id long, text string"))
    gone = exact_dedup.digests(spark.createDataFrame([(3, "b"), (2, "a")], "doc_id long, text string"))
    index = exact_dedup.update_index(exact_dedup.build_index(first), more, gone)
    assert sorted((r.keep_id, r.group_size) for r in index.collect()) == [(0, 2), (4, 1)]


# --- near copies -------------------------------------------------------------------------------------


def test_near_groups_as_compared_pairwise(spark):
    rows = awkward()
    sets = {d: shingles(t, 4) for d, t in rows if d is not None}
    root = groups(sets)
    want = [(d, len(sets[d]), root[d], d == root[d]) if d is not None else (None, None, None, True) for d, _ in rows]
    assert rows_of(near_dedup.near_groups(frame(spark, rows), words=4)) == sorted(want, key=repr)


def test_large_group_with_weak_members(spark, monkeypatch):
    """Chains and members that no hub is linked to are found all the same, with small cells."""
    from stargrain.llm import similar

    monkeypatch.setattr(similar, "CELL", 16)
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(80)]
    rows, text = [], list(base)
    for k in range(60):
        if k % 3:
            text = list(base)
        for _ in range(rng.randint(1, 3)):
            text[rng.randrange(80)] = f"x{k}y{rng.randint(0, 9)}"
        rows.append((k, " ".join(text)))
    sets = {d: shingles(t, 5) for d, t in rows}
    want = groups(sets)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(frame(spark, rows), words=5).collect()}
    assert got == want


def test_dropping_near_copies_keeps_columns_and_rows(spark):
    rows = [(5, "a b c d e f g h"), (3, "a b c d e f g h"), (None, "a b c d e f g h"), (8, None), (9, ""), (9, "")]
    df = frame(spark, rows)
    got = near_dedup.drop_near_copies(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id or 0 for r in got.collect()) == [0, 3, 8, 9, 9]


def test_hashes_of_words_and_shingles():
    texts = ["A b  c\td", "a b c d", "", " ", "x", "d c b a", "ab c d", "a bc d"]
    h, n = shingle_hashes(*word_hashes(*utf8(pa.array(texts))), 3)
    assert n.tolist() == [len(shingles(t, 3)) for t in texts]
    parts = np.split(h, np.cumsum(n)[:-1])
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(set(parts[i]) & set(parts[j])) == len(shingles(a, 3) & shingles(b, 3))


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 900).astype(np.uint64)
    sets = [np.unique(pool[:600]), np.unique(pool[100:700]), np.unique(pool[300:900]), pool[:3], pool[:3]]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    marks = near_dedup.super_minhash(np.concatenate(sets), owner, len(sets))
    assert abs((marks[0] == marks[1]).mean() - 500 / 700) < 0.12
    assert abs((marks[0] == marks[2]).mean() - 300 / 900) < 0.12
    assert (marks[3] == marks[4]).all()


# --- paragraphs and lines -----------------------------------------------------------------------------


def test_paragraphs_as_compared_pairwise(spark):
    rows = [r for r in awkward() if r[0] != 800]
    sets = {}
    for d, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            if d is not None and len(tokens(line)) >= 10:
                sets[d, p] = shingles(line, 5)
    root = groups(sets)
    gone = {}
    for place, first in root.items():
        if place != first:
            gone.setdefault(place[0], []).append(place[1])
    got = paragraph_dedup.paragraph_dedup(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = {d: t or "" for d, t in rows if d is not None}
    for r in got:
        if r.doc_id is None:
            assert not r.removed and not r.spans
            continue
        want = sorted(gone.get(r.doc_id, []))
        assert (list(r.removed), r.n_removed) == (want, len(want))
        assert squeeze(r.text) == squeeze(left_by(texts[r.doc_id], r.removed, r.spans))
        if not r.removed and not r.spans:
            assert r.text == texts[r.doc_id]
    assert_no_passage_twice([(r.doc_id, r.text) for r in got if r.doc_id is not None])


def squeeze(text):
    return " ".join(tokens(text))


def left_by(text, removed, spans):
    raw, at, out = text.encode(), 0, []
    inside = bytearray(len(raw))
    for s in spans:
        inside[s.start: s.end] = b"\1" * (s.end - s.start)
    for pos, line in enumerate(raw.split(b"\n")):
        if pos not in removed:
            out.append(bytes(x for k, x in enumerate(line, at) if not inside[k]))
        at += len(line) + 1
    return b"\n".join(out).decode()


def assert_no_passage_twice(rows, size=paragraph_dedup.WINDOW + paragraph_dedup.REACH - 1):
    seen = {}
    for d, t in set(rows):
        w = tokens(t)
        for k in range(len(w) - size + 1):
            assert seen.setdefault(tuple(w[k: k + size]), (d, k)) == (d, k)


def test_passages_inside_other_paragraphs_go(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(55)]
    rows = [(k, " ".join([word() for _ in range(40)] + passage + [word() for _ in range(40)])) for k in range(6)]
    clean = [(10 + k, " ".join(word() for _ in range(120)) + "\nshort line") for k in range(4)]
    got = {r.doc_id: r for r in paragraph_dedup.paragraph_dedup(frame(spark, rows + clean)).collect()}
    assert got[0].text == rows[0][1]
    for d, t in rows[1:]:
        assert " ".join(passage) not in got[d].text and got[d].spans
        assert tokens(t)[:20] == tokens(got[d].text)[:20] and tokens(t)[-20:] == tokens(got[d].text)[-20:]
    for d, t in clean:
        assert got[d].text == t
    assert_no_passage_twice([(d, r.text) for d, r in got.items()])


def test_recurring_lines_go_and_copies_stay(spark):
    rows = awkward()
    df = frame(spark, rows)
    got = line_dedup.drop_lines(df)
    assert got.columns == [*df.columns, "__llm_lines", "__llm_dropped"]
    texts = {r.doc_id: r.text for r in got.collect()}
    for k in range(7):  # a variable field
        assert "reserved" not in texts[500 + k] and len(texts[500 + k].split("\n")) == 2
    for d, t in rows:
        if d is not None and d < 500 or d in (600, 601, 700, 701, 702, 800):
            assert texts[d] == t  # 400-404 share a paragraph, which is no line of a log
    assert got.count() == len(rows)


def test_line_counts_need_different_surroundings(spark):
    line = "this line is everywhere"
    copies = [(k, f"same before\n{line}\nsame after") for k in range(20)]
    inside = [(50, "\n".join(f"{x} and more\n{line}" for x in "abcdefgh"))]
    got = {r.doc_id: r.n_dropped for r in line_dedup.line_dedup(frame(spark, copies + inside)).collect()}
    assert set(got.values()) == {0}
    varied = [(k, f"before {chr(97 + k)} it\n{line}") for k in range(5)]
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(frame(spark, varied + [(9, None), (10, "")])).collect()}
    assert got == {**{k: (2, 1) for k in range(5)}, 9: (0, 0), 10: (1, 0)}


def test_blocks_go_whole(spark):
    rng = random.Random(8)
    own = lambda: words("", rng.randint(30, 40), rng)
    head, block, foot = ["a fixed header", "with two lines"], [f"fixed block line {x}" for x in ("one", "two of", "it is three", "and it is four", "end of all five")], ["this is the footer", "of the same site"]
    rows = [(k, [*head, own(), own(), *block, own(), *foot]) for k in range(6)]
    for gap in ("\n", "\n\n", "\n \t\n"):
        got = {r.doc_id: r.text for r in line_dedup.drop_lines(frame(spark, [(d, gap.join(x)) for d, x in rows])).collect()}
        for d, x in rows:
            assert [y for y in got[d].split("\n") if y.strip()] == [x[2], x[3], x[9]]


def test_copied_blocks_stay(spark):
    copies = [(k, "\n".join(["one line of it", "two lines of it", "three lines of it"]) + "\n" * (k % 9)) for k in range(20)]
    assert {r.n_dropped for r in line_dedup.line_dedup(frame(spark, copies)).collect()} == {0}


def test_lines_are_told_by_their_tokens_alone(spark):
    rng = random.Random(8)
    gaps = [" ", " ", " ", "  ", "\t", " \r\x0b", "\x0c "]
    texts = ["\n".join(rng.choice(["", " ", "\t"]) + "".join(f"w{k}é" + rng.choice(gaps) for k in range(rng.randrange(60))) for _ in range(12)) for _ in range(40)]
    got = line_dedup._lines(frame(spark, list(enumerate(texts)))).select(F.inline(line_dedup._bodies())).select("body").collect()
    split = [re.split(r"[\x20\x09-\x0D]+", line.strip(" \t\x0b\x0c\r")) for t in texts for line in t.split("\n")]
    assert sorted(r.body for r in got) == sorted(" ".join(x) for x in split if x != [""] and len(x) <= line_dedup.MAX_TOKENS)


def test_steps_and_shuffles_go_when_they_are_done(spark):
    folders = Folders(spark, work_folder(spark))
    before = set(folders.names())
    rows = [(k, " ".join(f"w{(k // 2 * 40 + i) % 97}" for i in range(60))) for k in range(8)]
    left = paragraph_dedup.paragraph_dedup(frame(spark, rows))
    assert len(set(folders.names()) - before) == 1  # of some twenty
    assert left.filter("n_removed > 0").count() == 4
    assert spark.conf.get(CLEANUP) == "false"
