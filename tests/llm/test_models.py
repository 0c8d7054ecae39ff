import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stargrain.llm import max_score, packing, pieces, quality_model, url_filter
from stargrain.llm.common import utf8
from tests.llm.fixtures import awkward, frame, words

import pyarrow as pa

tokenizers = pytest.importorskip("public_tokenizers")


# --- packing -------------------------------------------------------------------------------------------


def packed_like_the_tokenizer(rows, got):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[d, len(ids), zlib.crc32(ids.tobytes())] += 1
    pieces_of = {}
    for r in got:
        pieces_of.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    return tokenizer, want, pieces_of


def test_pieces_cover_documents_and_fill_sequences(spark):
    rows = [r for r in awkward() if r[0] != 901]
    got = packing.pack(frame(spark, rows), tokenizers.path("word_bpe_49k.json")).collect()
    tokenizer, _, pieces_of = packed_like_the_tokenizer(rows, got)
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces_of[d, len(ids)], key=lambda r: r.start):
            assert r.start == at and zlib.crc32(ids[at: at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    unfilled = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len({(r.tier, r.step_id) for r in parts}) == 1
        unfilled += at != parts[0].tier
    assert unfilled <= 3  # one for each task
    steps = {}
    for s, parts in sequences.items():
        steps.setdefault(parts[0].step_id, set()).add(parts[0].tier)
    assert all(len(t) == 1 for t in steps.values())


def test_repeated_rows_are_packed_each(spark):
    rows = [(1, "x y z"), (1, "x y z"), (None, "x"), (2, None)]
    got = packing.pack(frame(spark, rows), tokenizers.path("word_bpe_49k.json")).collect()
    assert Counter(r.doc_id for r in got if r.start == 0) == {1: 2, None: 1, 2: 1}
    assert packing.pack(frame(spark, []), tokenizers.path("word_bpe_49k.json")).count() == 0


def test_encoder_equals_the_tokenizer_on_odd_texts():
    from tokenizers import Tokenizer

    path = tokenizers.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), packing.Encoder(path)
    texts = ["It's A Test's  don't", "é\u0301 e\u0301 \u0301x", "ΣΑΣ ὈΔΥΣΣΕΎΣ İ", "a\u00a0b\u2003c\u0085d\x1ce", "<|endoftext|> x<|startoftext|>y", "12 3a4", "\x00 \x07",
             "日本語 テスト", "👩‍👩‍👧 ok", "", "\n\t", "ab" * 3000, "'s 'll '", "x\u200by"]
    for t, ids in zip(texts, own([t.encode() for t in texts])):
        assert ids[:-1].tolist() == plain.encode(t, add_special_tokens=False).ids and ids[-1] == 1


def test_words_are_encoded_once_whatever_their_case_and_marks():
    from tokenizers import Tokenizer

    path = tokenizers.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), packing.Encoder(path)
    own([b"word Word (WORD) word, word."])
    assert set(own.known) == {b"word", b"(", b")", b",", b"."}
    rng = random.Random(9)
    parts = ["a", "T", "re", "S", "LL", "'", "'s", ".", ",", "...", "(", "é", "É", "×", "÷", "ß", "h\u0331", "H\u0331", "\u0301", "\u0307", "I", "7", "42", " ",
             "  ", "\n", "\u00a0", "\u0085", "\x01", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "Σ", "日", "“", "²", "\u200b", "K"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(3000)]
    for at in range(0, len(texts), 100):
        some = texts[at: at + 100]
        for t, ids in zip(some, own([t.encode() for t in some])):
            assert ids[:-1].tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_frequent_words_stay_when_the_table_is_full(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 8)
    own = packing.Encoder(tokenizers.path("word_bpe_49k.json"))
    own([b"a b c"])
    first = own.known[b"a"]
    own([b"a d e"])
    assert own.known[b"a"] is first and set(own.known) == {b"a", b"d", b"e"} and set(own.older) == {b"a", b"b", b"c"}


# --- sentence pieces -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return pieces.codec(tokenizers.path("piece_bpe_32k.model"))


def best(codec, text):
    """Plain Viterbi over the whole text."""
    score, back = [0.0] + [-math.inf] * len(text), [0] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        score[end], back[end] = score[end - 1] + codec.no_piece, end - 1
        for at in range(end - 1, max(0, end - codec.longest) - 1, -1):
            s = codec.scores.get(text[at:end])
            if s is not None and score[at] + s >= score[end]:
                score[end], back[end] = score[at] + s, at
    out, end = [], len(text)
    while end:
        out.append(text[back[end]: end])
        end = back[end]
    return out[::-1]


def test_streamed_paths_are_the_best(codec):
    rng = random.Random(4)
    for k in range(60):
        text = "".join(rng.choice("abcdefgh ▁tionesr\né") for _ in range(rng.randint(0, 400)))
        text = text.replace(" ", "▁")
        assert list(codec.segment(text)) == best(codec, text)
    long = "internationalization" * 400
    assert list(codec.segment(long)) == best(codec, long)


def test_chunks_equal_whole_texts(codec):
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice(["the ", "  ", "\n", "tion", "é", "\u6f22", "x", " a", "\U0001f600", "\t"]) for _ in range(rng.randint(1, 60)))
        ids = np.frombuffer(codec.encode(text), "<i4")
        whole = [i for p in best(codec, "▁" + text.replace(" ", "▁")) for i in codec._ids(p)]
        assert ids.tolist() == whole
        assert codec.decode(ids) == text


def test_round_trip_of_every_row(spark):
    path = tokenizers.path("piece_bpe_32k.model")
    rows = awkward()
    got = pieces.encode(frame(spark, rows), path)
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in got.collect())
    back = pieces.decode(got, path).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((d, t or "") for d, t in rows)
    odd = spark.createDataFrame([(1, [5, None, 99_999, -1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(odd, path).collect()} == {1: "\x02", 2: "", 3: ""}
    assert pieces.encode(frame(spark, []), path).count() == 0


# --- quality --------------------------------------------------------------------------------------------


def test_features_of_awkward_texts_are_finite():
    x = quality_model.features(*utf8(pa.array(["", " ", "\n\n", "a", "A!! B!! A!!", "é", "x" * 100_000, ""])))
    assert np.isfinite(x).all() and x.shape == (8, len(quality_model.FEATURES))
    alone = [quality_model.features(*utf8(pa.array([t])))[0] for t in ("a", "A!! B!! A!!")]
    assert np.allclose(x[[3, 4]], alone)


def test_model_learns_steps_and_pairs():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells anything
    model = quality_model.fit(x[:3000], y[:3000])
    assert (0, 1) in [tuple(sorted(p)) for p in model.pairs]
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_held_out_accuracy_and_order(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_model.train(docs, labels)
    got = quality_model.score(docs, model).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() >= 0.9
    assert ((got.score >= 0.7) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_scores_without_labels_and_of_awkward_rows(spark):
    rows = awkward()
    df = frame(spark, rows)
    labels = spark.createDataFrame([(5, 1), (15, None), (None, 0)], "doc_id long, quality int")
    model = quality_model.train(df, labels)
    got = quality_model.score(df, model).collect()
    assert len(got) == len(rows) and len({r.score for r in got}) == 1
    assert {r.doc_id: r.held_out for r in got if r.doc_id} == {d: zlib.crc32(str(d).encode()) % 4 == 2 for d, _ in rows if d}
    kept = quality_model.keep_good(df, quality_model.Model(5.0))
    assert kept.columns == df.columns and kept.count() == len(rows)
    assert quality_model.score(frame(spark, []), model).count() == 0


def test_nothing_is_rejected_without_both_labels(spark):
    rows = awkward()
    df = frame(spark, rows)
    for known in ([], [(5, 1)], [(5, 0), (15, 0)], [(99_999, 1), (99_998, 0)]):
        kept = quality_model.keep_good(df, quality_model.train(df, spark.createDataFrame(known, "doc_id long, quality int")))
        assert kept.columns == df.columns and kept.count() == len(rows)


# --- URLs -----------------------------------------------------------------------------------------------


def split_url(url):
    if not url or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(host, path):
    fits = [(len(r), r, v) for v, r in url_filter.RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


URLS = ["https://a.example.net/en/x", "https://example.net/en/", "https://EXAMPLE.NET/EN/", "http://b.net", "http://b.net/", "http://net/", "http://xnet/", "http://x.org/fr/1?q#f",
        "http://org/fr/", "http://example.com/de/", "http://www.example.com/de", "http://example.com?x=/de/", "ftp://u@h:1/p;q?r#s", "no scheme", "", None, "://", "http://", "http:///p",
        "http://a://b/c", "http://ÉX.org/fr/é", "http://x.com/\n?", "HTTP://A.B/C#d?e", "http://x.example.net.evil.com/en/"]


def test_parts_rules_and_verdicts(spark):
    rows = [(k, u, "x", "y") for k, u in enumerate(URLS * 3)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string, rule string")).collect()}
    assert len(got) == len(rows)
    for k, u, *_ in rows:
        host, path = split_url(u)
        rule, verdict = rule_of(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule), u
        assert got[k].verdict == verdict if rule else got[k].verdict in ("allow", "block")


def plain_probability(texts, order):
    """Witten-Bell mixture, byte by byte over dictionaries."""
    counts = Counter()
    for t in texts:
        raw = bytes([2] * order) + t.encode() + bytes([3])
        for k in range(order, len(raw)):
            for n in range(order + 1):
                counts[raw[k - n: k], raw[k]] += 1
    after = {}
    for (context, _), n in counts.items():
        total, kinds = after.get(context, (0, 0))
        after[context] = total + n, kinds + 1

    def score(text):
        raw, out = bytes([2] * order) + text.encode() + bytes([3]), []
        for k in range(order, len(raw)):
            p = 1 / 256
            for n in range(order + 1):
                context = raw[k - n: k]
                if context in after:
                    total, kinds = after[context]
                    p = (counts[context, raw[k]] + kinds * p) / (total + kinds)
            out.append(math.log(p))
        return out

    return score


def test_ratio_equals_plain_models():
    good, bad = ["news/1", "news/22", "blog/a"] * 3, ["pills/9", "cheap/pills", ""]
    model = url_filter.fit(good, bad)
    a = plain_probability([u for k, u in enumerate(good) if k % 5 != 4], url_filter.ORDER)
    b = plain_probability(bad, url_filter.ORDER)
    texts = ["news/1", "pills", "", "é", "zzz"]
    got = model.score(*utf8(pa.array(texts)))
    want = [np.mean(np.array(a(t)) - np.array(b(t))) for t in texts]
    assert np.allclose(got, want) and got[0] > 0 > got[1]
    assert url_filter.fit([], bad) is None


def test_models_count_every_labelled_url(spark):
    good, bad = [f"g{k}.org/fr/{k * k}" for k in range(3000)], [f"b{k}.net/{k:x}" for k in range(21_000)]
    model = url_filter.train(spark.createDataFrame([(f"http://{u}",) for u in good + bad], "url string").repartition(3))
    free = [u.replace(".net/", ".") for u in bad]  # what the rule says is cut
    assert model.rejected.levels[0][1].sum() == sum(len(u) + 1 for u in free)
    want, grams = Counter(b for u in free for b in u.encode() + b"\3"), model.rejected.levels[0]
    assert dict(zip(grams[0].tolist(), grams[1].tolist())) == want
    scores = model.score(*utf8(pa.array([u.replace("org/fr/", "") for u in good])))
    assert 0 < (scores < model.threshold).mean() < 0.04


def test_url_filter_without_rows_or_known_urls(spark):
    schema = "page_id long, url string"
    assert url_filter.judge(spark.createDataFrame([], schema)).count() == 0
    got = url_filter.judge(spark.createDataFrame([(1, "http://x.com/")], schema)).first()
    assert (got.verdict, got.score) == ("allow", None)


# --- search ---------------------------------------------------------------------------------------------


def test_search_equals_all_scores(spark, monkeypatch):
    monkeypatch.setattr(max_score, "SHARD", 60)
    monkeypatch.setattr(max_score, "BLOCK", 3)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 16))
    rows = [(k, [float(x) for x in centres[k % 4] + 0.3 * rng.normal(size=16)]) for k in range(400)]
    rows += [(k, rows[7][1]) for k in range(400, 460)]  # one very common vector
    rows += [(500, None), (600, [float("nan")] * 16), (700, [None] * 16), (800, [float("inf")] * 16), (900, []), (1000, [0.5] * 3), (1001, [0.25, -0.5, 1.0]),
             (None, [1.0] * 16), (1100, [0.0] * 16), (1200, [-1.0] * 16), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, q int, score int")
    got = sorted(map(tuple, max_score.search(df, F.col("vec_id") % 100 == 0).collect()))
    whole = {(i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for i, v in whole:
        if i % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i and len(w) == len(v))
            want += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:10])]
    assert got == sorted(want)


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(4)
    vectors = np.floor(rng.normal(size=(3000, 32)) ** 3 * 100).astype(np.int64)
    shard = max_score.Shard(np.arange(3000), vectors)
    for q in range(0, 3000, 500):
        ids, scores = shard.top(q, vectors[q], 10)
        all_scores = vectors @ vectors[q]
        want = sorted((-s, i) for i, s in enumerate(all_scores) if i != q)[:10]
        assert [(-s, i) for s, i in zip(scores, ids)] == want


def test_search_of_no_rows(spark):
    assert max_score.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") == 0).count() == 0
