"""Hierarchical multi-length packing of token ids into training sequences."""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stargrain.llm.common import batches, bounded_batches, texts_of

#: context sizes, longest first; each is a power of two, so a full sequence of any tier has no padding
TIERS = (2048, 1024, 512, 256)
#: tokens of one step group; all its sequences have one length
STEP_TOKENS = 32 * TIERS[0]
#: remainders that a task holds before it packs them
POOL = 4096
#: distinct words whose ids a worker remembers
CACHE_WORDS = 1_000_000
END_ID = 1
#: words of one call of the tokenizer, and the control character between them
CALL_WORDS, BETWEEN = 256, b"\x01"
#: the steps of a tokenizer that lower-cases, and cuts at every change between letters, single digits and the rest
FOLDS = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
CUTS = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: words of letters up to U+00FF alone
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: ASCII letters are 1, digits 2, marks 3, but "'" 4; all else is 0
KIND = np.zeros(256, np.uint8)
KIND[33:127] = 3
KIND[[*range(65, 91), *range(97, 123)]] = 1
KIND[48:58] = 2
KIND[39] = 4

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, tier int, step_id long")

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of whole texts by a tokenizer that drops white space and never joins two words.

    Words between ASCII white space are encoded by the tokenizer once each and remembered, in a
    bounded table that lives as long as the worker: words of its newer half stay when the older half goes.

    A tokenizer with the steps FOLDS and CUTS gives `Word` and `word`, and a word and the marks at its ends, the ids they
    have alone. Such words are lower-cased and cut there before they are looked up, so fewer are new. Texts with a
    combining mark or an added token are not.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        spec = json.loads(self.tokenizer.to_str())
        self.folds = spec["normalizer"] == FOLDS and spec["pre_tokenizer"] == CUTS
        self.odd = [b"\xcc", b"\xcd", *(t["content"].lower().encode() for t in spec["added_tokens"])]
        self.between = self._plain([BETWEEN.decode()])[0]
        # lower-case letters up to U+00FF pass the normalizer and the cuts unchanged
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Lowercase()
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        split = self._folded(texts) if self.folds else [t.split() for t in texts]  # bytes split at exactly the six ASCII spaces
        words = set().union(*split)
        if len(self.known) + len(words) > CACHE_WORDS // 2:
            self.known, self.older = {}, self.known
        here = dict(zip(words, map(self.known.get, words)))  # small beside `known`, so quick to look up
        new = [w for w, ids in here.items() if ids is None]
        found = {w: self.older[w] for w in new if w in self.older}
        letters, others = [], []
        for w in new:
            if w not in found:
                (letters if self.folds and LETTERS.fullmatch(w) else others).append(w)
        found.update(zip(letters, self._joined(self.letters, letters)))
        if self.folds and not any(BETWEEN in w for w in others):
            found.update(zip(others, self._joined(self.tokenizer, others)))
        else:
            found.update(zip(others, self._plain([w.decode() for w in others])))
        self.known.update(found)
        here.update(found)
        get = here.__getitem__
        end = np.uint32(END_ID).tobytes()
        return [np.frombuffer(b"".join([*map(get, words), end]), "<u4") for words in split]

    def _folded(self, texts: list[bytes]) -> list[list[bytes]]:
        """Words in lower case, with a cut between a letter or digit and a mark, and between a mark and a letter."""
        odd = [any(x in low for x in self.odd) for low in map(bytes.lower, texts)]
        texts = [t if o else t.lower() for t, o in zip(texts, odd)]
        offsets = np.cumsum([0, *map(len, texts)])
        raw = np.frombuffer(b"".join(texts), np.uint8)
        kind = KIND[raw]
        ends = (kind == 1) | (kind == 2)  # a letter or digit ends here
        ends[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] < 0xC0) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        cut = np.zeros(len(raw), bool)
        # "'" begins an ending like "'s", which only a letter or digit before it leaves whole
        cut[1:] = (ends[:-1] & (kind[1:] >= 3)) | ((kind[:-1] == 3) & (kind[1:] == 1))
        for k in np.flatnonzero(odd):
            cut[offsets[k]: offsets[k + 1]] = False
        at = np.flatnonzero(cut)
        offsets = offsets + np.searchsorted(at, offsets)
        whole = np.insert(raw, at, 0x20).tobytes()
        return [whole[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]

    def _plain(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _joined(self, tokenizer, words: list[bytes]) -> list[bytes]:
        """Ids of words without BETWEEN. Many go into one call, each followed by BETWEEN, which is one id of no other word."""
        joint = b" " + BETWEEN + b" "
        calls = [joint.join([*words[k: k + CALL_WORDS], b""]).decode() for k in range(0, len(words), CALL_WORDS)]
        parts = [np.asarray(e.ids, "<u4") for e in tokenizer.encode_batch_fast(calls, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, "<u4"), *parts])
        ends = np.flatnonzero(ids == np.frombuffer(self.between, "<u4"))
        starts = np.concatenate([[0], ends[:-1] + 1])
        flat = ids.tobytes()
        return [flat[4 * a: 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Packer:
    """Packs the documents of one task; ready pieces gather in `rows`.

    A document gives its full 2048-token windows first. What remains is routed to the smallest tier
    that holds it. Tiers are packed from the longest: a window starts with the longest piece of its
    tier, its gap takes the longest fitting pieces of any shorter tier, and the last gap is filled by
    cutting a piece, whose rest goes back to its own tier. Every window is thus full, except the
    last one of the task.
    """

    def __init__(self, task: int):
        self.base = task << 40
        self.rows: list[tuple] = []
        self.pool: list[tuple[int, int]] = []  # (length, key), sorted
        self.held: dict[int, tuple] = {}  # key: (doc_id, start, ids, doc_tokens)
        self.keys = self.sequences = 0
        self.steps = 0
        self.open_step = dict.fromkeys(TIERS, (0, 0))

    def add(self, doc_id, ids: np.ndarray) -> None:
        full = len(ids) // TIERS[0] * TIERS[0]
        for at in range(0, full, TIERS[0]):
            self._emit(TIERS[0], [(doc_id, at, ids[at: at + TIERS[0]], len(ids))])
        if full < len(ids):
            self._hold((doc_id, full, ids[full:], len(ids)))
        if len(self.pool) >= POOL:
            self.pack(POOL // 8)

    def _hold(self, piece: tuple) -> None:
        self.keys += 1
        self.held[self.keys] = piece
        insort(self.pool, (len(piece[2]), self.keys))

    def _take(self, at: int) -> tuple:
        return self.held.pop(self.pool.pop(at)[1])

    def pack(self, leave: int = 0) -> None:
        """Pack until at most `leave` pieces are held; they serve as fill for later windows."""
        while len(self.pool) > leave:
            window = [self._take(-1)]
            size = len(window[0][2])
            tier = min(t for t in TIERS if t >= size)
            while size < tier and self.pool:
                fit = bisect_right(self.pool, (tier - size, self.keys + 1))
                if fit:
                    piece = self._take(fit - 1)
                else:  # all that is left is longer than the gap
                    doc_id, start, ids, total = self._take(0)
                    room = tier - size
                    piece = (doc_id, start, ids[:room], total)
                    self._hold((doc_id, start + room, ids[room:], total))
                window.append(piece)
                size += len(piece[2])
            self._emit(tier if size == tier else TIERS[0], window)

    def _emit(self, tier: int, window: list[tuple]) -> None:
        step, room = self.open_step[tier]
        if not room:
            step, room = self.steps, STEP_TOKENS // tier
            self.steps += 1
        self.open_step[tier] = (step, room - 1)
        offset = 0
        for doc_id, start, ids, total in window:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total,
                              self.base + self.sequences, offset, tier, self.base + step))
            offset += len(ids)
        self.sequences += 1

    def ready(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in PIECES.split(", ")]
        kinds = [pa.int32() if c.endswith(" int") else pa.int64() for c in PIECES.split(", ")]
        columns = zip(*self.rows) if self.rows else [[] for _ in names]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece of a document in a sequence of at most 2048 ids.

    A document is its ids by `tokenizer` (a path that executors can read) and END_ID; an empty or null
    text is END_ID alone. Repeated rows and rows without doc_id are packed as documents of their own.
    `tier` is the padded length of the sequence, `step_id` joins sequences of one tier to groups of
    equally many tokens. Nothing is shuffled: each task packs the documents of its input split and
    holds at most POOL remainders, so no group of equal keys can meet anywhere. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession, 256)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer), Packer(TaskContext.get().partitionId())
        for b in batches(it):
            texts = b.column(1).cast(pa.binary()).to_pylist()
            for doc_id, ids in zip(b.column(0).to_pylist(), encode(texts)):
                packer.add(doc_id, ids)
            yield packer.ready()
        packer.pack()
        yield packer.ready()

    return texts_of(docs).mapInArrow(run, PIECES)
