"""SentencePiece encoding and decoding by streaming Viterbi."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stargrain.llm.common import batches, bounded_batches, texts_of

SPACE = "▁"
#: distinct chunks whose ids a worker remembers
CACHE_CHUNKS = 500_000
#: characters of a chunk that is segmented in one go and remembered
SHORT = 64

_CODECS: dict[str, Codec] = {}


class Codec:
    """Best segmentation of a text into pieces: the highest sum of scores, among equal sums the one whose
    last piece is longest, boundary by boundary from the end.

    As in the model file, a text gets a leading space, and spaces are U+2581. A character without a
    piece becomes its UTF-8 bytes and scores ten below the worst piece; so does a U+2581 that the text
    itself holds, which keeps decoding exact.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes = [b""] * model.get_piece_size()
        self.byte_ids = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.scores[piece], self.ids[piece] = model.get_score(i), i
                self.bytes[i] = piece.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.scores))
        #: every beginning of a piece, with the score where it is one itself
        self.beginnings: dict[str, float | None] = {p[:k]: None for p in self.scores for k in range(1, len(p))}
        self.beginnings.update(self.scores)
        self.no_piece = min(self.scores.values()) - 10
        # no piece goes on after a space or across a line end: every path has a boundary there
        assert not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.scores)
        self.chunks = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+")
        self.packed = {p: np.array([i], "<i4").tobytes() for p, i in self.ids.items()}
        self.known: dict[str, bytes] = {}

    def _ids(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.byte_ids[x] for x in piece.encode()]

    def _packed(self, piece: str) -> bytes:
        return np.array(self._ids(piece), "<i4").tobytes()

    def segment(self, text: str) -> Iterator[str]:
        """Pieces of a text of any length, as soon as they are certain.

        Forward over the characters. A window keeps the scores of the last `longest` boundaries: no
        later piece can start before them. Whenever the backpointer paths of all those boundaries
        meet in one, the pieces up to it are committed and forgotten.
        """
        score, back, base = [0.0], [0], 0  # of boundaries base, base + 1, ...
        scores, longest, check = self.scores, self.longest, 2 * self.longest
        for end in range(1, len(text) + 1):
            low = max(base, end - longest)
            best, start = score[end - 1 - base] + self.no_piece, end - 1
            for at in range(end - 1, low - 1, -1):
                s = scores.get(text[at:end])
                if s is not None and score[at - base] + s >= best:
                    best, start = score[at - base] + s, at
            score.append(best)
            back.append(start)
            if end - base >= check:
                alive = set(range(max(base, end - longest + 1), end + 1))
                while len(alive) > 1:
                    last = max(alive)
                    alive.discard(last)
                    alive.add(max(back[last - base], base))
                meet = alive.pop()
                if meet > base:
                    yield from self._path(text, back, base, meet)
                    score, back, base = score[meet - base:], back[meet - base:], meet
                    check = 2 * longest
                else:
                    check += longest
        yield from self._path(text, back, base, len(text))

    def _whole(self, text: str) -> list[str]:
        """The same pieces for a short text, whose window holds all of it: forward, as far as pieces reach."""
        n, beginnings, no_piece = len(text), self.beginnings, self.no_piece
        score, back = [0.0] + [-1e300] * n, [0] * (n + 1)
        for start in range(n):
            own = score[start]
            if own + no_piece > score[start + 1]:
                score[start + 1], back[start + 1] = own + no_piece, start
            for end in range(start + 1, n + 1):
                s = beginnings.get(text[start:end], False)
                if s is False:
                    break
                if s is not None and own + s > score[end]:
                    score[end], back[end] = own + s, start
        return self._path(text, back, 0, n)

    @staticmethod
    def _path(text: str, back: list[int], base: int, end: int) -> list[str]:
        out = []
        while end > base:
            start = back[end - base]
            out.append(text[start:end])
            end = start
        return out[::-1]

    def _chunk(self, chunk: str) -> bytes:
        short = len(chunk) <= SHORT
        ids = b"".join([self.packed.get(p) or self._packed(p) for p in (self._whole(chunk) if short else self.segment(chunk))])
        if short:
            if len(self.known) >= CACHE_CHUNKS:
                self.known.clear()
            self.known[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers; none for an empty text."""
        if not text:
            return b""
        known, own = self.known.get, self._chunk
        if SPACE in text:  # the text's own U+2581 goes by bytes
            mark = np.array([self.byte_ids[x] for x in SPACE.encode()], "<i4").tobytes()
            parts = [b"".join([known(c) or own(c) for c in self.chunks.findall(p.replace(" ", SPACE))])
                     for p in (" " + text).split(SPACE)]
            return mark.join(parts)
        return b"".join([known(c) or own(c) for c in self.chunks.findall(SPACE + text.replace(" ", SPACE))])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; control ids and ids beyond the vocabulary give nothing."""
        table = self.bytes
        if len(ids) and (ids.min() < 0 or ids.max() >= len(table)):
            ids = ids[(ids >= 0) & (ids < len(table))]
        raw = b"".join(map(table.__getitem__, ids.tolist()))
        return raw[1:].decode(errors="replace") if raw[:1] == b" " else raw.decode(errors="replace")


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _lists(parts: list[bytes]) -> pa.Array:
    sizes = np.array([len(p) // 4 for p in parts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, n_ids, round_trip) of every row: the ids of the text and whether they decode to it.

    `model` is a path that executors can read. A null text is an empty one, which has no ids; repeated rows and
    rows without doc_id are encoded like any other. Nothing is shuffled.
    """
    bounded_batches(docs.sparkSession, 500)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for b in batches(it):
            texts = b.column(1).to_pylist()
            parts = [own.encode(t) for t in texts]
            sound = [own.decode(np.frombuffer(p, "<i4")) == t for p, t in zip(parts, texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _lists(parts), pa.array([len(p) // 4 for p in parts], pa.int64()), pa.array(sound)],
                ["doc_id", "ids", "n_ids", "round_trip"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>, n_ids long, round_trip boolean")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids, and null among them, give nothing."""
    bounded_batches(encoded.sparkSession, 500)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for b in batches(it):
            texts = [own.decode(np.array([i for i in ids or [] if i is not None], np.int64)) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
