"""Toxicity by a chain of linear classifiers.

Features of a text are its words and their first 3 to 8 letters, so that
unseen forms of a known stem count.  Evidence features are those that a bounded
labelled sample finds in toxic documents far oftener than in clean ones.  The
chain predicts three categories in order: ``early`` (toxic with evidence among
its first ``EARLY`` words), ``spread`` (toxic with evidence in both halves) and
``toxic`` (the label).  Where evidence stands is not among the inputs: every
model is a logistic regression over which evidence a text has, in how many
words and at what share of them.  A later one also sees the earlier categories'
probabilities.  In training these are out-of-fold predictions, so that a later
model learns how far to trust an earlier one on unseen documents; the evidence
of such a model is chosen without its fold, too.

Fitting takes at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled rows (those with
the smallest id hash) and keeps at most ``MAX_FEATURES`` features; these three
bounds are parameters, and what the driver holds depends on them alone.  All
documents are then scored over their whole texts.

Edge cases: null and empty texts have no features and get the chain's bias;
without toxic labels the chain predicts 0; labels that are null, or whose
document is missing, are ignored; ids labelled twice count once, toxic if any
row says so; of several texts of one labelled id the one with the smallest hash
is learned from; repeated rows get equal scores; an empty table gives an empty
result; other columns are untouched.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkTable, in_runs
from .common import written

CATEGORIES = ("early", "spread", "toxic")
MAX_TOXIC, MAX_CLEAN, MAX_FEATURES = 4000, 8000, 4000
EARLY = 50
PREFIXES = (3, 4, 5, 6, 7, 8)
FOLDS = 5
THRESHOLD = 0.5
#: A feature is evidence if so many more toxic than clean documents have it
#: (log-odds), and chance would do that this rarely.
LEAST_LIFT, MOST_CHANCE = 3.0, 2e-5

_WORD = re.compile(r"[^\W\d_]+")


def features(chunk: str) -> list[str]:
    """The features of the words in a piece of text, word by word."""
    out = []
    for w in _WORD.findall(chunk.lower()):
        out.append(w)
        out += [w[:k] + "*" for k in PREFIXES if len(w) > k]
    return out


def _chunks(text: str) -> list[bytes]:
    return text.encode("utf-8").split()


# --- the sample ------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_toxic: int, max_clean: int) -> DataFrame:
    """(doc_id, text, y) of at most ``max_toxic`` + ``max_clean`` labelled rows."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
        .filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    )
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = known.filter("y = 1").orderBy(*order).limit(max_toxic).unionByName(known.filter("y = 0").orderBy(*order).limit(max_clean))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = rows.join(F.broadcast(chosen), "doc_id")  # bounded by the two limits
    one = found.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("th"), "text")).alias("t"))
    return written(one.select("doc_id", "t.text", "y"), "toxicity-sample")


def fold_column() -> Column:
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS).cast("int")


def fold_of(ids: np.ndarray) -> np.ndarray:
    """The fold of each id, as ``fold_column`` has it."""
    return np.array([zlib.crc32(str(int(i)).encode()) % FOLDS for i in ids], np.int64)


def _feature_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with each feature, by fold and label; one row per feature,
    fold and task."""
    counts: dict[tuple[int, int], Counter] = {}
    for batch in batches:
        for text, y, fold in zip(batch["text"], batch["y"], batch["fold"], strict=True):
            counts.setdefault((int(fold), int(y)), Counter()).update(set(features(text)))
    for (fold, y), c in counts.items():
        n = list(c.values())
        yield pd.DataFrame({"feature": list(c), "fold": fold, "toxic": n if y else 0, "clean": 0 if y else n})


def evidence(sample: DataFrame, max_features: int) -> list[list[str]]:
    """The features that tell toxic documents, the surest first: without each
    fold in turn, and last from all rows."""
    folded = sample.withColumn("fold", fold_column())
    totals = {(r["fold"], r["y"]): r["n"] for r in folded.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    counted = folded.mapInPandas(_feature_counts, "feature string, fold int, toxic bigint, clean bigint")
    without = [*range(FOLDS), -1]
    sums = counted.groupBy("feature").agg(*[
        F.sum(F.when(F.col("fold") != k, F.col(kind)).otherwise(0)).alias(f"{kind}{k}") for k in without for kind in ("toxic", "clean")])
    sums = written(sums, "toxicity-features")
    return [_surest(sums, k, *(sum(n for (f, y), n in totals.items() if f != k and y == label) for label in (1, 0)), max_features) for k in without]


def _surest(sums: DataFrame, k: int, n_toxic: int, n_clean: int, max_features: int) -> list[str]:
    if not n_toxic or not n_clean:
        return []
    rows = sums.select("feature", F.col(f"toxic{k}").alias("t"), F.col(f"clean{k}").alias("c")).filter("t > 0")
    lift = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("c") + 0.5) / (n_clean + 1))
    share = n_toxic / (n_toxic + n_clean)
    # Chernoff bound of drawing that many toxic documents among t + c.
    q = F.col("t") / (F.col("t") + F.col("c"))
    divergence = q * F.log(q / share) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - share))).otherwise(0.0)
    surprise = (F.col("t") + F.col("c")) * divergence
    sure = rows.filter((lift >= LEAST_LIFT) & (surprise >= -math.log(MOST_CHANCE)))
    return [r["feature"] for r in sure.orderBy(F.desc(surprise), "feature").limit(max_features).select("feature").collect()]


# --- per document ----------------------------------------------------------


class Reader:
    """The evidence in texts: which features, in how many words."""

    def __init__(self, names: list[str]):
        self.number = {f: i for i, f in enumerate(names)}
        self.table = ChunkTable(self._encode, np.int32)

    def _encode(self, new: list[bytes]) -> Iterator[list[int]]:
        """Per chunk: the number of its words with evidence, then the features."""
        number = self.number
        for chunk in new:
            hits, places = [], 0
            for w in _WORD.findall(chunk.decode("utf-8").lower()):
                found = [number[f] for f in (w, *[w[:k] + "*" for k in PREFIXES if len(w) > k]) if f in number]
                places += bool(found)
                hits += found
            yield [-places, *hits] if hits else []

    def read(self, texts: list[str]) -> list[tuple[np.ndarray, int, int, int, int]]:
        """(distinct features, distinct words with evidence, words, first and
        last place of evidence or -1) of each text."""
        out = []
        for numbers in self.table.of([_chunks(t) for t in texts]):
            at = np.flatnonzero(self.table.sizes(numbers) > 0)
            ids = self.table.ids(np.unique(numbers[at]))
            marks = ids < 0
            first, last = (int(at[0]), int(at[-1])) if len(at) else (-1, -1)
            # Feature 0 is a hit like any other; marks are negative counts.
            out.append((np.unique(ids[~marks]), int(-ids[marks].sum()), len(numbers), first, last))
        return out


def counts_of(places: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The dense inputs of a document."""
    share = np.maximum(places - 1, 0) / np.maximum(words, 1)  # one place in a short text is not dense
    return np.stack([np.log1p(places), np.minimum(share * 20, 3.0)], axis=1)


class Model:
    """Logistic regression over a document's evidence and counts."""

    def __init__(self, n_features: int, n_dense: int):
        self.w = np.zeros(n_features)
        self.v = np.zeros(n_dense)
        self.b = 0.0

    def margins(self, owner: np.ndarray, feature: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return np.bincount(owner, self.w[feature], len(dense)) + dense @ self.v + self.b

    def predict(self, owner, feature, dense) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(owner, feature, dense), -30, 30)))

    def fit(self, owner, feature, dense, y, l2: float = 1.0, steps: int = 400) -> Model:
        """Adam on the penalised likelihood; deterministic."""
        n = len(y)
        if not n or y.min() == y.max():
            self.b = 30.0 if n and y.min() == 1 else -30.0
            return self
        params = [self.w, self.v, np.array([math.log(y.mean() / (1 - y.mean()))])]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for t in range(1, steps + 1):
            self.b = float(params[2][0])
            gap = self.predict(owner, feature, dense) - y
            grads = [
                np.bincount(feature, gap[owner], len(self.w)) + l2 * self.w,
                gap @ dense + 0.1 * l2 * self.v,
                np.array([gap.sum()]),
            ]
            for p, g, m, s in zip(params, grads, first, second, strict=True):
                g = g / n
                m *= 0.9
                m += 0.1 * g
                s *= 0.999
                s += 0.001 * g * g
                p -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-9)
        self.b = float(params[2][0])
        return self


def _part(owner, feature, rows: np.ndarray):
    """The evidence of some documents, renumbered."""
    place = np.full(int(max(owner.max(initial=-1), rows.max(initial=-1))) + 1, -1)
    place[rows] = np.arange(len(rows))
    keep = place[owner] >= 0
    return place[owner[keep]], feature[keep]


class Chain:
    """The models of ``CATEGORIES`` in order."""

    def __init__(self, names: list[str]):
        self.names = names
        self.models: list[Model] = []

    def fit(self, fold: np.ndarray, views: list[tuple], words: np.ndarray, targets: list[np.ndarray]) -> Chain:
        """``views``: (features, owner, feature, places) of the rows under the
        evidence chosen without each fold, and last under all evidence;
        ``targets``: the categories of the rows, in order."""
        earlier = np.empty((len(words), 0))
        for y in (t.astype(float) for t in targets):
            unseen = np.zeros(len(y))
            for k in range(FOLDS):
                size, owner, feature, places = views[k]
                dense = np.column_stack([counts_of(places, words), earlier])
                train, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
                m = Model(size, dense.shape[1]).fit(*_part(owner, feature, train), dense[train], y[train])
                unseen[test] = m.predict(*_part(owner, feature, test), dense[test])
            size, owner, feature, places = views[-1]
            dense = np.column_stack([counts_of(places, words), earlier])
            self.models.append(Model(size, dense.shape[1]).fit(owner, feature, dense, y))
            earlier = np.column_stack([earlier, unseen])
        return self

    def predict(self, owner, feature, places, words) -> list[np.ndarray]:
        dense, out = counts_of(places, words), []
        for m in self.models:
            out.append(m.predict(owner, feature, dense))
            dense = np.column_stack([dense, out[-1]])
        return out



def _read(texts: list[str], reader: Reader):
    found = reader.read(texts)
    owner = np.repeat(np.arange(len(found)), [len(r[0]) for r in found])
    feature = np.concatenate([r[0] for r in found] or [np.empty(0, np.int32)]).astype(np.int64)
    return owner, feature, np.array([r[1] for r in found], np.int64), np.array([r[2] for r in found], np.int64)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    max_features: int = MAX_FEATURES,
) -> Chain:
    sample = labelled_sample(docs, labels, id_col, text_col, max_toxic, max_clean)
    sets = evidence(sample, max_features)

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        readers = [Reader(names) for names in sets]
        for b in batches:
            texts = b["text"].tolist()
            found = [r.read(texts) for r in readers]
            words, first, last = (np.array([r[k] for r in found[-1]], np.int64) for k in (2, 3, 4))
            halves = (first >= 0) & (2 * first < words) & (2 * last >= words)
            yield pd.DataFrame({
                "doc_id": b["doc_id"].to_numpy(), "y": b["y"].to_numpy(), "words": words, "early": (first >= 0) & (first < EARLY), "spread": halves,
                "f": [[f[i][0].tolist() for f in found] for i in range(len(texts))], "places": [[f[i][1] for f in found] for i in range(len(texts))],
            })

    schema = "doc_id bigint, y int, words bigint, early boolean, spread boolean, f array<array<int>>, places array<bigint>"
    rows = sample.mapInPandas(hits, schema).orderBy("doc_id").collect()  # the sample is bounded
    y, words, early, spread = (np.array([r[c] for r in rows], np.int64) for c in ("y", "words", "early", "spread"))
    views = []
    for k, names in enumerate(sets):
        owner = np.repeat(np.arange(len(rows)), [len(r["f"][k]) for r in rows]).astype(np.int64)
        feature = np.array([f for r in rows for f in r["f"][k]], np.int64)
        views.append((len(names), owner, feature, np.array([r["places"][k] for r in rows], np.int64)))
    return Chain(sets[-1]).fit(fold_of([r["doc_id"] for r in rows]), views, words, [y * early, y * spread, y])


def score(text: Column, chain: Chain, threshold: float = THRESHOLD) -> Column:
    """A struct of the verdict, its score, the categories and the evidence."""

    @F.pandas_udf("toxic boolean, score double, p_early double, p_spread double, categories string, n_evidence bigint, n_words bigint")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(chain.names)
        for texts in batches:
            t = ["" if x is None else x for x in texts]
            parts = []
            for lo, hi in in_runs(t):
                owner, feature, places, words = _read(t[lo:hi], reader)
                p = chain.predict(owner, feature, places, words)
                named = [",".join(c for c, x in zip(CATEGORIES, row, strict=True) if x >= threshold) for row in zip(*p, strict=True)]
                parts.append(
                    pd.DataFrame({"toxic": p[2] >= threshold, "score": p[2], "p_early": p[0], "p_spread": p[1], "categories": named, "n_evidence": places, "n_words": words})
                )
            columns = ["toxic", "score", "p_early", "p_spread", "categories", "n_evidence", "n_words"]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=columns)

    return scored(text.cast("string"))
