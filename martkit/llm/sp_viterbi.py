"""SentencePiece encoding by streaming Viterbi, and decoding.

A text's ids are the pieces of its best segmentation: the one with the largest
sum of piece scores (ties: the longer last piece).  The search reads characters
in order.  Scores are kept for the positions that a piece may still start from,
at most the longest piece behind the reader; back-pointers are kept since the
last committed boundary.  Whenever every surviving path passes one boundary,
the pieces before it are final: they are committed and forgotten.  That is
seen at once where no piece spans a position, and otherwise by tracing the
surviving positions back to their last common ancestor.

Where the vocabulary has no piece that continues over a space mark (or holds a
line feed), such a place always is a common boundary.  The text is cut there
and the ids of each distinct cut are remembered in a bounded table.  New cuts of
at most ``LANE`` characters, whose ends are boundaries that all paths meet at,
are searched many at a time: the same search reads one character of each in
step, over the tree as arrays.  Longer ones are streamed one by one.

The scores are log-probabilities.  A vocabulary of byte-pair merges holds ranks
instead (its scores are -1, -2, -3 and so on); sums of ranks have no meaning, so
they are turned into log-probabilities by Zipf's law: the piece of rank r has
probability proportional to 1 / (r + 2).

The encoding is lossless.  Spaces are the space mark and one is put in front,
as the vocabulary expects; a character that no piece has becomes the pieces of
its UTF-8 bytes, as does a literal space mark; of the pieces without a score
(runs of spaces) only single characters are used, at the cost of an unknown one.  Decoding joins the pieces' bytes and takes the first
space off.

Edge cases: null and empty texts have no ids and decode to an empty text; a
text of any length without a space is read in the same bounded way; rows are
independent, so repeated rows get equal results; null ids stay; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import KnownChunks, in_runs
from .common import keyed_text

MARK = "▁"
#: Stands for a literal space mark; no text has a lone surrogate.
_LITERAL = "\ud800"
_NO_SCORE = -1e8
_UNKNOWN_PENALTY = 10.0
_TRACE_EVERY = 16
_STEPS = 1 << 20
#: Characters of a cut, and cuts, that are searched in step.
LANE, LANES = 32, 8192


def log_probabilities(scores: list[float]) -> list[float]:
    """The scores of pieces as log-probabilities: as they are, unless they are
    the ranks of merges (distinct whole numbers from 0 down, some of which may
    be missing)."""
    if not all(x <= 0 and x == int(x) for x in scores) or len(set(scores)) < len(scores):
        return scores
    whole = math.log(sum(1 / (2 - x) for x in scores))
    return [-math.log(2 - x) - whole for x in scores]


class Pieces:
    """A vocabulary as a tree of characters; a node's piece is at key ``""``."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        self.tree: dict = {}
        self.alone: dict[str, int] = {}  # characters whose piece has no score
        self.longest, self.mark_inside, self.feed_inside = 1, False, False
        scored: list[tuple[str, float, int]] = []
        for i in range(sp.vocab_size()):
            piece, score = sp.id_to_piece(i), sp.get_score(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
                continue
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
                continue
            self.bytes_of.append(piece.replace(MARK, " ").encode("utf-8"))
            if score > _NO_SCORE:
                scored.append((piece, score, i))
            elif len(piece) == 1:
                self.alone[piece] = i
        # In whole steps sums are exact, so ties do not depend on where a text is cut.
        logs = [round(x * _STEPS) / _STEPS for x in log_probabilities([x for _, x, _ in scored])]
        for (piece, _, i), score in zip(scored, logs):
            node = self.tree
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = (score, i)
            self.longest = max(self.longest, len(piece))
            self.mark_inside |= MARK in piece[1:]
            self.feed_inside |= "\n" in piece and len(piece) > 1
        self.unknown = min(logs, default=0.0) - _UNKNOWN_PENALTY

    def _ids(self, token) -> list[int]:
        if type(token) is int:
            return [token]
        if token in self.alone:
            return [self.alone[token]]
        return [self.byte_ids[b] for b in (MARK if token == _LITERAL else token).encode("utf-8")]

    def segments(self, chars: Sequence[str]) -> Iterator[list]:
        """Committed runs of the best segmentation: ids, or characters that
        become bytes.  ``chars`` is read once, from left to right."""
        tree, unknown, n = self.tree, self.unknown, len(chars)
        done = 0  # the last committed boundary
        best: dict[int, float] = {0: 0.0}
        back: dict[int, tuple] = {}
        reach = 0  # the farthest position that a path has come to
        for i in range(n):
            here = best.pop(i, None)
            if here is not None:
                node, j, single = tree, i, False
                while j < n and (node := node.get(chars[j])) is not None:
                    j += 1
                    if (hit := node.get("")) is not None:
                        single |= j == i + 1
                        if (known := best.get(j)) is None or here + hit[0] > known:
                            best[j] = here + hit[0]
                            back[j] = (i, hit[1])
                            if j > reach:
                                reach = j
                if not single:
                    j = i + 1
                    if (known := best.get(j)) is None or here + unknown > known:
                        best[j] = here + unknown
                        back[j] = (i, chars[i])
                        if j > reach:
                            reach = j
            at = 0
            if reach == i + 1:  # nothing spans this boundary
                at = reach
            elif (i - done) % _TRACE_EVERY == _TRACE_EVERY - 1:
                at = self._meeting(best, back, done)
            if at > done:
                out, p = [], at
                while p > done:
                    p, token = back.pop(p)
                    out.append(token)
                yield out[::-1]
                done = at
                if reach == at:
                    back.clear()

    @staticmethod
    def _meeting(best: dict, back: dict, done: int) -> int:
        """The last boundary that all surviving paths pass."""
        front = set(best)
        while len(front) > 1:
            last = max(front)
            front.remove(last)
            front.add(back[last][0])
        at = front.pop()
        return at if at > done and at in back else done

    def encode(self, text: str) -> list[int]:
        """The ids of a text (with its space mark in front) as a whole."""
        return [i for run in self.segments(text) for token in run for i in self._ids(token)]

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids)).removeprefix(b" ")

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


#: Stands between two cuts of a text; no UTF-8 text has this byte.
_CUT = b"\xff"


class Lanes:
    """The search over many short cuts in step, with the tree as arrays: nodes
    are numbers, and an edge is found by hashing (node, character)."""

    _FREE, _MULTIPLIER = -1, 0x9E3779B97F4A7C15

    def __init__(self, pieces: Pieces, dtype):
        self.dtype = dtype
        edges, self.piece, self.score, chars = [], [-1], [0.0], {}
        ahead = [(pieces.tree, 0)]
        for node, number in ahead:
            for c, below in node.items():
                if c == "":
                    self.score[number], self.piece[number] = below
                    continue
                child = len(self.piece)
                edges.append((number, chars.setdefault(c, len(chars) + 1), child))
                self.piece.append(-1)
                self.score.append(0.0)
                ahead.append((below, child))
        self.piece, self.score, self.unknown = np.array(self.piece, np.int32), np.array(self.score), pieces.unknown
        self.of_char = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.of_char[[ord(c) for c in chars]] = list(chars.values())
        self.width = len(chars) + 1
        bits = max(4, (4 * len(edges)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.child = np.full(1 << bits, self._FREE, np.int64), np.zeros(1 << bits, np.int32)
        node, char, child = np.array(edges, np.int64).reshape(-1, 3).T
        key = node * self.width + char
        slot = self._slots(key)
        while len(key):
            first = np.unique(slot, return_index=True)[1]
            first = first[self.keys[slot[first]] == self._FREE]
            self.keys[slot[first]], self.child[slot[first]] = key[first], child[first]
            rest = np.ones(len(key), bool)
            rest[first] = False
            key, child, slot = key[rest], child[rest], (slot[rest] + 1) & self.last

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(self._MULTIPLIER)) >> self.shift).astype(np.int64)

    def _step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The child of each node along a character, -1 where there is none."""
        key = node.astype(np.int64) * self.width + char
        slot = self._slots(key)
        out, open_ = np.full(len(key), -1, np.int32), np.arange(len(key))
        while len(open_):
            held = self.keys[slot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.child[slot[open_[hit]]]
            open_ = open_[~hit & (held != self._FREE)]
            slot[open_] = (slot[open_] + 1) & self.last
        return out

    def search(self, cuts: list[str]) -> list[bytes | None]:
        """The ids of each cut as bytes; None where a character is in no piece."""
        out: list = [None] * len(cuts)
        order = sorted(range(len(cuts)), key=lambda i: -len(cuts[i]))
        for lo in range(0, len(order), LANES):
            lanes = order[lo : lo + LANES]
            for lane, ids in zip(lanes, self._together([cuts[i] for i in lanes])):
                out[lane] = ids
        return out

    def _together(self, cuts: list[str]) -> list[bytes | None]:
        """``cuts`` by falling length."""
        size = np.fromiter(map(len, cuts), np.int64, len(cuts))
        n, most = len(cuts), int(size[0])
        chars = np.zeros((most, n), np.int32)
        flat = self.of_char[np.frombuffer("".join(cuts).encode("utf-32-le", "surrogatepass"), "<u4")]
        chars.T[np.arange(most) < size[:, None]] = flat
        best = np.full((most + 1, n), -np.inf)
        best[0] = 0
        back, token = np.zeros((most + 1, n), np.int32), np.full((most + 1, n), -1, np.int32)
        for i in range(most):
            live = int(np.searchsorted(-size, -i))  # the lanes that are longer than i
            lane, node = np.arange(live), np.zeros(live, np.int32)
            single = np.zeros(live, bool)
            for j in range(i + 1, most + 1):
                node = self._step(node, chars[j - 1, lane])
                alive = node >= 0
                lane, node = lane[alive], node[alive]
                if not len(lane):
                    break
                ends = self.piece[node] >= 0
                at, here = lane[ends], node[ends]
                if j == i + 1:
                    single[at] = True
                reached = best[i, at] + self.score[here]
                better = reached > best[j, at]
                at, here = at[better], here[better]
                best[j, at], back[j, at], token[j, at] = reached[better], i, self.piece[here]
            at = np.flatnonzero(~single)
            at = at[best[i, at] + self.unknown > best[i + 1, at]]
            best[i + 1, at], back[i + 1, at], token[i + 1, at] = best[i, at] + self.unknown, i, -1
        ids, count, place = np.zeros((n, most), self.dtype), np.zeros(n, np.int64), size.copy()
        whole, lane = np.ones(n, bool), np.flatnonzero(size)
        while len(lane):
            found = token[place[lane], lane]
            whole[lane[found < 0]] = False
            count[lane] += 1
            ids[lane, most - count[lane]] = np.maximum(found, 0)
            place[lane] = back[place[lane], lane]
            lane = lane[place[lane] > 0]
        raw, wide, row = ids.tobytes(), ids.itemsize, most * ids.itemsize
        return [raw[(i + 1) * row - k * wide : (i + 1) * row] if ok else None for i, (k, ok) in enumerate(zip(count.tolist(), whole.tolist()))]


#: Stands between two cuts of a text; no UTF-8 text has this byte.
_CUT = b"\xff"


class Encoder:
    """Ids of texts, given as UTF-8 bytes."""

    def __init__(self, model: str):
        self.pieces = Pieces(model)
        self.dtype = np.uint16 if len(self.pieces.bytes_of) <= 1 << 16 else np.uint32
        self.lanes = Lanes(self.pieces, self.dtype)
        self.cut_marks = not self.pieces.mark_inside
        self.cut_feeds = self.cut_marks and not self.pieces.feed_inside
        self.known = KnownChunks(self._encode, self.dtype)
        self.is_byte = np.zeros(len(self.pieces.bytes_of), bool)
        self.is_byte[self.pieces.byte_ids] = True
        self.piece_bytes = pa.array(self.pieces.bytes_of, pa.binary())

    def _encode(self, cuts: list[bytes]) -> list[bytes]:
        texts = [cut.decode("utf-8").replace(MARK, _LITERAL).replace(" ", MARK) for cut in cuts]
        short = [i for i, t in enumerate(texts) if len(t) <= LANE]
        found: list = [None] * len(texts)
        for i, ids in zip(short, self.lanes.search([texts[i] for i in short])):
            found[i] = ids
        return [np.array(self.pieces.encode(t), self.dtype).tobytes() if ids is None else ids for t, ids in zip(texts, found)]

    def _cuts(self, texts: list[bytes]) -> pa.ListArray:
        raw = pa.array([b" " + t if t else b"" for t in texts], pa.binary())
        if not self.cut_marks:
            return pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32), raw)
        raw = pc.replace_substring(raw, pattern=b" ", replacement=_CUT + b" ")
        if self.cut_feeds:
            raw = pc.replace_substring(raw, pattern=b"\n", replacement=_CUT + b"\n" + _CUT)
        return pc.split_pattern(raw, pattern=_CUT)

    def all_ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in a row, where each text's ids end)."""
        return self.known.ids(self._cuts(texts))

    def ids(self, raw: bytes) -> np.ndarray:
        return self.all_ids([raw])[0]

    def decoded(self, flat: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The texts that runs of ids stand for."""
        pieces = self.piece_bytes.take(pa.array(flat)).cast(pa.large_binary())
        at = np.asarray(pieces.buffers()[1]).view(np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        data = memoryview(pieces.buffers()[2] or b"")
        stops = at[ends].tolist()
        return [bytes(data[a:b]).removeprefix(b" ") for a, b in zip([int(at[0]), *stops], stops)]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(model: str) -> Encoder:
    if model not in _ENCODERS:
        _ENCODERS[model] = Encoder(model)
    return _ENCODERS[model]


def _path(model: str | None) -> str:
    return model or public_tokenizers.path("piece_bpe_32k.model")


_SCHEMA = "doc_id bigint, ids array<int>, n_tokens bigint, n_byte_tokens bigint, round_trip boolean"


def _encoded(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    enc = _encoder(model)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lo, hi in in_runs(texts):
            flat, ends = enc.all_ids(texts[lo:hi])
            offsets = np.concatenate([[0], ends])
            n_bytes = np.concatenate([[0], np.cumsum(enc.is_byte[flat])])[offsets]
            same = [x == t for x, t in zip(enc.decoded(flat, ends), texts[lo:hi], strict=True)]
            columns = [
                batch.column("doc_id").slice(lo, hi - lo),
                pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(flat.astype(np.int32))),
                pa.array(np.diff(offsets)),
                pa.array(np.diff(n_bytes)),
                pa.array(same, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [x.split(" ")[0] for x in _SCHEMA.split(", ")])


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, n_byte_tokens, round_trip) of every document;
    ``round_trip`` says whether the ids decode to the text."""
    path = _path(model)
    return keyed_text(docs, id_col, text_col).mapInArrow(lambda it: _encoded(it, path), _SCHEMA)


def decode(ids: Column, model: str | None = None) -> Column:
    """The text of each array of ids."""
    path = _path(model)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = _encoder(path).pieces
        for arrays in batches:
            yield pd.Series(["" if a is None else pieces.decode(a) for a in arrays], dtype=object)

    return decoded(ids)
