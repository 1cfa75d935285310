"""Language identification as inference of a mixture of languages.

A text is a bag of n-grams (``ORDER`` bytes of its lower-cased letters, hashed
into ``BUCKETS``) drawn from a mixture of the languages' n-gram distributions.
Expectation-maximisation estimates the proportions of a set of languages, and
the set itself is grown from the best single language as long as the penalised
likelihood rises: one more language must raise the log-likelihood, divided by
``ORDER`` because neighbouring n-grams overlap, by ``PENALTY`` times half the
logarithm of the number of (non-overlapping) n-grams.  The next candidate is
the language with the steepest gradient; as the log-likelihood is concave in
the proportions, a gradient g bounds what any further set can gain by n log g,
so most texts need no iteration at all.  The predicted language is the one
with the largest proportion, and that proportion is the score.

The n-gram counts cover every learning row and are summed in Spark; the model
that is sent to the tasks holds ``BUCKETS`` numbers per language, whatever the
size of the corpus.

Edge cases: a null text, a text without a letter, or a model that has learned
no language gives ``und`` and score 0; a null language is not learned from, any
other value of it is a language; rows are predicted one by one, so repeated
rows and ids get equal results; very long texts are read whole, in slices;
equal proportions go to the first language in UTF-8 order; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 4
BUCKETS = 1 << 16
#: Added to every count, so that no n-gram is impossible in a language.
ADDED = 0.5
PENALTY = 4.0
MOST_ROUNDS, SETTLED = 100, 1e-4
SLICE = 1 << 22
UNKNOWN = "und"

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_RESULT = "lang string, score double, languages map<string,double>"


def n_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of a whole text; none without a letter."""
    if not any(map(str.isalpha, text)):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    low = np.frombuffer(low.ljust(ORDER), np.uint8)
    if len(low) <= BUCKETS:
        return np.unique(_buckets(low), return_counts=True)
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, len(low) - ORDER + 1, SLICE):
        counts += np.bincount(_buckets(low[lo : lo + SLICE + ORDER - 1]), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _buckets(low: np.ndarray) -> np.ndarray:
    code = np.zeros(len(low) - ORDER + 1, np.uint32)
    for i in range(ORDER):
        code |= low[i : len(low) - ORDER + 1 + i].astype(np.uint32) << np.uint32(8 * i)
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


@dataclass
class Model:
    """``share[b, l]``: probability of an n-gram of bucket b in language l."""

    langs: list[str]
    share: np.ndarray

    def __post_init__(self):
        self.log = np.log(self.share)


def proportions(counts: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """(proportions of the languages of ``share``'s columns, log-likelihood)
    of n-grams that occur ``counts`` times, by expectation-maximisation."""
    n = counts.sum()
    part = np.full(share.shape[1], 1 / share.shape[1])
    mixed = share @ part
    at = counts @ np.log(mixed)
    for _ in range(MOST_ROUNDS):
        part = part * (share.T @ (counts / mixed)) / n
        mixed = share @ part
        before, at = at, counts @ np.log(mixed)
        if at - before < SETTLED:
            break
    return part, at


def mixture(text: str | None, model: Model) -> dict[int, float]:
    """Languages (columns of the model) of a text with their proportions."""
    buckets, counts = n_grams(text) if text else (np.empty(0), np.empty(0))
    if not len(counts) or not model.langs:
        return {}
    share = model.share[buckets]
    alone = counts @ model.log[buckets]
    best = int(alone.argmax())
    chosen, part, at, mixed = [best], np.ones(1), alone[best], share[:, best]
    n = counts.sum()
    cost = ORDER * PENALTY * 0.5 * np.log(max(n / ORDER, 2.0))
    while len(chosen) < len(model.langs):
        slope = (counts / mixed) @ share / n
        slope[chosen] = 0
        if n * np.log(max(slope.max(), 1.0)) <= cost:
            break
        tried = [*chosen, int(slope.argmax())]
        found, reached = proportions(counts, share[:, tried])
        if reached - at <= cost:
            break
        chosen, part, at, mixed = tried, found, reached, share[:, tried] @ found
    return {lang: float(p) for lang, p in zip(chosen, part)}


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The languages' n-gram distributions, from every row with a language."""

    def count(batches):
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                buckets, counts = n_grams(text.as_py())
                if len(counts):
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[buckets] += counts
        for lang, held in sums.items():
            found = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(held[found], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = rows.dropna().mapInArrow(count, "lang string, bucket int, n bigint")
    # At most BUCKETS rows a language.
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = table.column("lang").to_pylist()
    langs = sorted(set(names), key=str.encode)
    place = {lang: i for i, lang in enumerate(langs)}
    counts = np.full((BUCKETS, len(langs)), ADDED)
    np.add.at(counts, (table.column("bucket").to_numpy(), np.array([place[x] for x in names], np.int64)), table.column("n").to_numpy())
    return Model(langs, counts / counts.sum(axis=0))


def identify(text: Column, model: Model, spark) -> Column:
    """(lang, score, languages) of a text; ``languages`` holds the proportion
    of every language of the chosen set."""
    sent = spark.sparkContext.broadcast((model.langs, model.share))
    held: list[Model] = []

    @F.pandas_udf(_RESULT)
    def named(texts: pd.Series) -> pd.DataFrame:
        if not held:
            held.append(Model(*sent.value))
        langs, out = held[0].langs, []
        for text in texts:
            found = mixture(text, held[0])
            top = min(found, key=lambda lang: (-found[lang], lang), default=None)
            out.append((UNKNOWN, 0.0, {}) if top is None else (langs[top], min(found[top], 1.0), {langs[x]: p for x, p in found.items()}))
        return pd.DataFrame(out, columns=["lang", "score", "languages"])

    return named(text)


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning; a row without an id is neither learned from
    nor held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def predicted(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) of every document,
    learned from those that are not held out."""
    spark = docs.sparkSession
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        identify(F.col("text"), model, spark).alias("x"),
    ).select("doc_id", "held_out", F.col("x.lang").alias("lang_pred"), F.col("x.score").alias("score"), F.col("x.languages").alias("languages"))
