"""Token ids of white-space-delimited chunks, remembered between texts.

No token of the vocabularies used here spans a chunk boundary, so the ids of
a text are the ids of its chunks in a row.  A ``ChunkTable`` gives each
distinct chunk a number and holds its ids; a text becomes an array of chunk
numbers and its ids are gathered from one flat array.  The table is emptied
when it holds ``limit`` chunks or ``flat_limit`` ids, which bounds a
worker's memory and changes no result.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa


class _Numbers(dict):
    """chunk -> number; a new chunk gets the next number and is noted."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, chunk):
        self.new.append(chunk)
        self[chunk] = n = len(self)
        return n


class _Growing:
    """A numpy array that is appended to."""

    def __init__(self, dtype, width: int | None = None):
        self.width = width
        self.a = np.empty((1024,) if width is None else (1024, width), dtype)
        self.n = 0

    def extend(self, values) -> None:
        need = self.n + len(values)
        if need > len(self.a):
            grown = np.empty((max(need, 2 * len(self.a)), *self.a.shape[1:]), self.a.dtype)
            grown[: self.n] = self.a[: self.n]
            self.a = grown
        self.a[self.n : need] = values
        self.n = need


class ChunkTable:
    """``encode`` gives the ids of each chunk of a list; ``extra`` gives a
    row of ``extra_width`` further numbers for each."""

    def __init__(
        self,
        encode: Callable[[list], Iterable[Sequence[int]]],
        dtype=np.int32,
        extra: Callable[[list], np.ndarray] | None = None,
        extra_width: int = 0,
        limit: int = 250_000,
        flat_limit: int = 8_000_000,
    ):
        self.encode, self.dtype, self.extra, self.extra_width = encode, dtype, extra, extra_width
        self.limit, self.flat_limit = limit, flat_limit
        self._empty()

    def _empty(self) -> None:
        self.numbers = _Numbers()
        self.start, self.size = _Growing(np.int64), _Growing(np.int64)
        self.flat = _Growing(self.dtype)
        self.more = _Growing(np.float32, self.extra_width) if self.extra else None

    def of(self, texts: list[list]) -> list[np.ndarray]:
        """The chunk numbers of each text; valid until the next call."""
        if len(self.numbers) >= self.limit or self.flat.n >= self.flat_limit:
            self._empty()
        get = self.numbers.__getitem__
        out = [np.fromiter(map(get, chunks), np.int64, len(chunks)) for chunks in texts]
        if new := self.numbers.new:
            self.numbers.new = []
            ids = [np.asarray(x, self.dtype) for x in self.encode(new)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self.start.extend(self.flat.n + np.cumsum(sizes) - sizes)
            self.size.extend(sizes)
            self.flat.extend(np.concatenate(ids) if ids else np.empty(0, self.dtype))
            if self.extra:
                self.more.extend(self.extra(new))
        return out

    def sizes(self, numbers: np.ndarray) -> np.ndarray:
        return self.size.a[numbers]

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """The token ids of a text."""
        n = self.size.a[numbers]
        total = int(n.sum())
        at = np.repeat(self.start.a[numbers] - (np.cumsum(n) - n), n)
        return self.flat.a[at + np.arange(total)]


class Remembered(dict):
    """chunk -> its ids as bytes; a new chunk is encoded when it is met.

    When ``limit`` chunks are held, those of the time before are forgotten;
    the last ``limit`` stay known for as long again.
    """

    def __init__(self, encode: Callable[[bytes], bytes], limit: int = 150_000):
        self.encode, self.limit, self.before = encode, limit, {}

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        self[chunk] = ids
        return ids

    def joined(self, chunks: Iterable[bytes]) -> bytes:
        """The ids of chunks in a row."""
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, chunks))


class KnownChunks:
    """Ids of chunks of many texts at a time.

    The chunks of a run of texts are numbered in Arrow, so each distinct one is
    looked up once a run; those not known yet are encoded together (``encode``:
    chunks to their ids as bytes).  When ``limit`` chunks are held, those of the
    time before are forgotten; the last ``limit`` stay known for as long again.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], dtype, limit: int = 250_000):
        self.encode, self.dtype, self.limit = encode, np.dtype(dtype), limit
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _of(self, distinct: list[bytes]) -> list[bytes]:
        if len(self.known) >= self.limit:
            self.before, self.known = self.known, {}
        found = list(map(self.known.get, distinct))
        missing = [i for i, x in enumerate(found) if x is None]
        for i in missing:
            found[i] = self.before.get(distinct[i])
        new = [i for i in missing if found[i] is None]
        for i, ids in zip(new, self.encode([distinct[i] for i in new]), strict=True):
            found[i] = ids
        self.known.update((distinct[i], found[i]) for i in missing)
        return found

    def ids(self, chunks: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in a row, where each text's ids end), from
        the chunks of each text."""
        offsets = np.asarray(chunks.offsets)
        coded = chunks.flatten().dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False)
        found = self._of(coded.dictionary.cast(pa.binary()).to_pylist())
        flat = np.frombuffer(b"".join(found), self.dtype)
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        n = size[numbers]
        ends = np.concatenate([[0], np.cumsum(n)])
        # Places in ``flat``; a run of texts has far fewer than 2**31 ids.
        at = np.repeat(((np.cumsum(size) - size)[numbers] - ends[:-1]).astype(np.int32), n)
        at += np.arange(ends[-1], dtype=np.int32)
        return flat[at], ends[offsets[1:] - offsets[0]]


_HELD: dict = {}


def kept_alone(key, make: Callable[[], object]):
    """What a worker keeps from task to task, made when it is first asked for.
    Only the operator that ran last keeps anything, so the memories of a
    pipeline's stages do not add up."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def give_back() -> None:
    """Return freed memory to the machine at the end of a task: a worker that
    waits for its next one would hold on to the most it ever used."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def in_runs(values: Sequence, weight: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Slices of ``values`` (strings) of about ``weight`` characters, which
    bound what one step holds."""
    lo, held = 0, 0
    for i, v in enumerate(values):
        held += len(v)
        if held >= weight:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(values):
        yield lo, len(values)
