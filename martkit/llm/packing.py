"""Packing along a space-filling curve.

A document's tokens are hashed and summed into a vector, projected to ``DIMS``
dimensions (each token's hash is its own random projection, so this is the
projection of the hashed token counts), scaled to unit length and quantised;
the Hilbert key of that cell is its place on the curve.  Documents are
range-sorted by (key, id) and their tokens laid end to end along the curve:
token g of the whole run is token ``g % length`` of sequence ``g // length``.
So neighbours on the curve share sequences, every sequence but the last is
full, and a document is cut only where a sequence ends.

The running total over the sorted rows needs no task that sees them all: rows
(without their tokens) are range-partitioned and written once, each
partition's sum is one row, and a partition's rows add up from there.  Equal
keys are no hot spot, as the id splits them.

Token ids: the tokenizer's for the text, then one closing id.  No token spans
ASCII white space, so a worker remembers the ids of white-space-delimited
chunks (a bounded table) and each distinct chunk is encoded once.

Edge cases: a null or empty text has the closing id only; null ids sort
first; rows that repeat an id are ordered by a row number that is written
once; texts of any length are cut into as many pieces as needed; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import KnownChunks, give_back, in_runs, kept_alone
from .common import written

LENGTH = 2048
CLOSING_ID = 1
DIMS, BITS = 4, 10


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The Hilbert index of each row of non-negative cell numbers.

    Works bit plane by bit plane from the highest: each plane's bits, seen in
    the axes of the current sub-cube, are Gray-decoded into the next digit of
    the index, which then says how the axes of that sub-cube are turned.
    """
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    # Undo the turns of all coarser planes on the finer bits.
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            set_ = (x[:, i] & q) != 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[:, n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def _directions(vocabulary: int) -> np.ndarray:
    """A random direction for each token id, from its hash."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(i.to_bytes(4, "little")) for i in range(vocabulary)), np.uint64, vocabulary)
    return h.view(np.int16).reshape(-1, 4)[:, :DIMS].astype(np.float32) / 32768


def _cells(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(norm == 0, 1, norm)
    return np.clip(((unit + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)


class Encoder:
    """Ids and curve keys of texts under one tokenizer file.

    A new chunk that is one Latin word, with or without a run of ASCII
    punctuation behind it, goes to the tokenizer's model directly: of its
    normaliser only lower case applies, and its splitter parts the word from
    the run and leaves both whole.  Any other chunk goes through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tokenize = self.tok.model.tokenize
        size = self.tok.get_vocab_size()
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        self.code = "H" if size <= 1 << 16 else "I"
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # Letters below U+0250 whose lower case is one letter there too.
        letters = [c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1 and ord(c.lower()) < 0x250]
        self.bytes_of = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        self.marks = lru_cache(10_000)(lambda run: tuple(self.tok.encode(run, add_special_tokens=False).ids))
        self.latin = re.compile(f"[{''.join(letters)}]+").fullmatch
        self.plain = True
        self.plain = self._agrees()
        self.known = KnownChunks(self._encode, self.dtype)
        self.directions = _directions(size)

    def _agrees(self) -> bool:
        """Whether the direct way gives the tokenizer's own ids on a probe."""
        probe = ["word", "Straße.", "été,", "Unbelievably", "Ñandú", "word***", "was'!?", "é..."]
        own = [self.tok.encode(x, add_special_tokens=False).ids for x in probe]
        return [self._ids(x.encode("utf-8").lower().decode("utf-8")) for x in probe] == own

    def _ids(self, text: str) -> list[int]:
        word = text.rstrip(string.punctuation)
        if self.plain and word.isalpha():
            marks = self.marks(text[len(word) :]) if len(word) < len(text) else ()
            if word.isascii():
                return [*[t.id for t in self.tokenize(word.lower())], *marks]
            if self.latin(word):
                return [*[t.id for t in self.tokenize(word.lower().translate(self.bytes_of))], *marks]
        return self.tok.encode(text, add_special_tokens=False).ids

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        flat, ends = [], [0]
        for chunk in chunks:
            flat += self._ids(chunk.decode("utf-8"))
            ends.append(len(flat))
        raw, width = array(self.code, flat).tobytes(), array(self.code).itemsize
        return [raw[a * width : b * width] for a, b in zip(ends, ends[1:])]

    def _chunks(self, texts: list[str]) -> pa.ListArray:
        raw = pa.array(texts, pa.string())
        if self.plain:  # the tokenizer lower-cases all but its special tokens
            raw = pc.if_else(pc.match_substring(raw, "<|"), raw, pc.ascii_lower(raw))
        return pc.ascii_split_whitespace(raw)

    def encode(self, texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """The ids of each text, as bytes, and its curve key."""
        out, vectors = [], np.zeros((len(texts), DIMS))
        for lo, hi in in_runs(texts):
            ids, ends = self.known.ids(self._chunks(texts[lo:hi]))
            for i, (a, b) in enumerate(zip([0, *ends.tolist()], ends.tolist()), lo):
                out.append(ids[a:b].tobytes())
                vectors[i] = self.directions[ids[a:b]].sum(axis=0, dtype=np.float64)
        return out, hilbert_keys(_cells(vectors))


def _encoded(text: Column, path: str, closing_id: int) -> Column:
    @F.pandas_udf("key bigint, n bigint, ids binary")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = kept_alone(("packing", path), lambda: Encoder(path))
        for texts in batches:
            t = ["" if x is None else x for x in texts]
            ids, keys = enc.encode(t)
            close = np.array([closing_id], enc.dtype).tobytes()
            width = len(close)
            yield pd.DataFrame({"key": keys, "n": [len(x) // width + 1 for x in ids], "ids": [x + close for x in ids]})
        give_back()

    return encoded(text.cast("string"))


def running_totals(rows: DataFrame, order: list[str], value: str) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over all earlier rows."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = written(
        sorted_rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "curve-order"
    )
    sums = kept.groupBy("_part").agg(F.sum(value).alias("_sum"))  # one row per partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return (
        kept.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, "_part")
        .withColumn("before", F.col("_start") + F.col("_inside"))
        .drop("_part", "_at", "_sum", "_start", "_inside")
    )


_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, curve_key bigint"
)


def _cut(batches: Iterator[pd.DataFrame], dtype, length: int, with_ids: bool) -> Iterator[pd.DataFrame]:
    """The pieces of each document: it is cut where a sequence ends."""
    for batch in batches:
        rows = []
        for doc, key, before, raw in zip(batch["doc_id"].array, batch["key"], batch["before"], batch["ids"], strict=True):
            ids = np.frombuffer(raw, dtype).astype("<u4")
            at, n = 0, len(ids)
            while at < n:
                sequence, offset = divmod(int(before) + at, length)
                size = min(n - at, length - offset)
                piece = ids[at : at + size]
                rows.append((doc, at, size, zlib.crc32(piece.tobytes()), n, sequence, offset, key) + ((piece.astype(np.int32),) if with_ids else ()))
                at += size
        columns = [x.split(" ")[0] for x in _PIECES.split(", ")] + ["ids"] * with_ids
        out = pd.DataFrame(rows, columns=columns)
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    length: int = LENGTH,
    closing_id: int = CLOSING_ID,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents; ``with_ids`` adds their token ids."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    dtype = Encoder(path).dtype
    coded = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), _encoded(F.col(text_col), path, closing_id).alias("e"))
    rows = written(coded.select(F.monotonically_increasing_id().alias("row"), "doc_id", "e.*"), "token-rows")
    totals = running_totals(rows.select("row", "doc_id", "key", "n"), ["key", "doc_id", "row"], "n")
    placed = rows.select("row", "doc_id", "key", "ids").join(totals.select("row", "before"), "row")
    schema = _PIECES + (", ids array<int>" if with_ids else "")
    return placed.select("doc_id", "key", "before", "ids").mapInPandas(lambda it: _cut(it, dtype, length, with_ids), schema)
