"""Quality rules from tokeniser fertility.

A public vocabulary with byte fallback is measured on every word of a text:
characters per token, the share of tokens that are byte fallbacks, and the
entropy of the text's own token distribution.  Each has a band per language
(or, where the language is unknown, per script); a text outside a band is
rejected, and that is the verdict.

The entropy is the one of order two, -log2 of the chance that two tokens of the
text, drawn without replacement, are equal.  That chance (``repeat_share``) has
the same mean at every length, and a few tokens that stand very often move it
more than Shannon's entropy, which grows with the length of a text.

A text must lie in two bands.  ``BANDS`` are fixed and wide: running prose lies
well inside.  ``judged`` adds bands from the corpus: aggregations over all
documents give each measure's quartiles per language, and the quartiles of its
distance from the median times the square root of the text's tokens.  The
first are the spread between texts and the second the chance spread within
one, so a text of n tokens may lie ``FENCE`` times (spread + chance spread /
sqrt(n)) beyond the quartiles.  One rule holds for texts and languages of every
size.  Copies count once in the spread, so that a text that stands often cannot
narrow the bands; spreads are at least ``LEAST_SPREAD``.  Measures are rounded
for it, so quartiles are exact, repeatable and made from a bounded number of
values.

The base rule (a least number of words, words in repeated 5-word windows) is no
part of the method and rejects by itself.  Symbols are counted and reported as
``symbol_share``; they decide nothing.  Words are ``[^\\x20\\x09-\\x0D]+``.

Edge cases: a null or empty text has no words, fails the base rule and has
null measures; a text in which no token repeats has no entropy and repeat
share 0; an unknown or null language uses the band of the script that most of
its letters have; equal texts of one language get equal verdicts; the only text
of a language lies in the corpus's band; other columns are untouched (the
result is one struct column).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkTable, give_back, in_runs, kept_alone
from .common import written

SYMBOLS = "#*$%&|<>"
WINDOW = 5
FENCE = 2.0
#: Least spread: of characters per token and of the repeat share as a share of
#: the median, of the byte share as it is.
LEAST_SPREAD = (0.01, 0.004, 0.01)

#: Least and most characters per token, most byte-fallback share, least entropy
#: in bits.  Languages of one script share its limits except where their words
#: are cut differently.
BANDS = {
    "en": (1.3, 6.0, 0.02, 3.5),
    "de": (1.3, 6.0, 0.02, 3.5),
    "fr": (1.2, 6.0, 0.02, 3.5),
    "es": (1.1, 6.0, 0.02, 3.5),
    "latin": (1.0, 6.5, 0.05, 3.0),
    "cyrillic": (0.9, 6.0, 0.10, 3.0),
    "greek": (0.6, 4.0, 0.40, 2.5),
    "hebrew_arabic": (0.6, 4.0, 0.40, 2.5),
    "cjk": (0.3, 2.5, 0.80, 2.5),
    "other": (0.2, 7.0, 0.95, 2.0),
}

#: First and last letter of the scripts told apart.
SCRIPTS = {
    "latin": "A-Za-zÀ-ɏ",
    "greek": "Ͱ-Ͽ",
    "cyrillic": "Ѐ-ԯ",
    "hebrew_arabic": "֐-ۿ",
    "cjk": "぀-ヿ㐀-鿿가-힯",
}

_SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_tokens bigint, chars_per_token double, byte_share double, repeat_share double, token_entropy double, symbol_share double, band string, "
    "base_failed boolean, kept boolean"
)

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    w = words.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n, np.uint64)
    for i in range(window):
        h += w[i : i + n] * _MIX[i]
    h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    cover[at] += 1
    np.subtract.at(cover, at + window, 1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


_LETTERS = {name: re.compile(f"[{r}]") for name, r in SCRIPTS.items()}


def band_of(lang: str | None, text: str, bands: dict) -> str:
    if lang in bands:
        return lang
    counts = {name: len(p.findall(text)) for name, p in _LETTERS.items()}
    best = max(counts, key=counts.__getitem__)
    return best if counts[best] and best in bands else "other"


def _measure(model: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    is_byte = np.array([sp.is_byte(i) for i in range(sp.vocab_size())])
    table = ChunkTable(lambda new: sp.encode([w.decode("utf-8") for w in new], num_threads=1), limit=100_000)
    return is_byte, table


def measures(texts: list[str], langs: list, model: str, bands: dict) -> list[tuple]:
    """One row of ``_SCHEMA`` per text, with the verdict of the fixed bands."""
    is_byte, table = kept_alone(("fertility", model), lambda: _measure(model))
    split = [t.encode("utf-8").split() for t in texts]
    rows = []
    for text, lang, numbers in zip(texts, langs, table.of(split), strict=True):
        n = len(numbers)
        chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
        repeated = repeated_words(numbers)
        base_failed = n < 10 or 100 * repeated > 20 * n
        ids = table.ids(numbers)
        band = band_of(lang, text, bands)
        cpt = share = again = entropy = None
        if tokens := len(ids):
            counts = np.bincount(ids).astype(np.int64)
            again = int((counts * (counts - 1)).sum()) / max(tokens * (tokens - 1), 1)
            cpt, share = chars / tokens, float(is_byte[ids].mean())
            entropy = float(-np.log2(again)) if again else None
        symbols = sum(map(text.count, SYMBOLS))
        low, high, bytes_most, entropy_least = bands[band]
        inside = cpt is not None and low <= cpt <= high and share <= bytes_most and again <= 2**-entropy_least
        rows.append((n, chars, symbols, repeated_lines(text), repeated, tokens, cpt, share, again, entropy, symbols / chars if chars else None, band, base_failed, not base_failed and inside))
    return rows


def fertility(text: Column, lang: Column, model: str | None = None, bands: dict | None = None) -> Column:
    """A struct of the counts, measures and verdict of each text.

    ``model`` is the path of a SentencePiece vocabulary, which every executor
    reads for itself.
    """
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    use = bands or BANDS
    names = [x.strip().split(" ")[0] for x in _SCHEMA.split(",")]

    @F.pandas_udf(_SCHEMA)
    def measured(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, langs in batches:
            t, g = ["" if x is None else x for x in texts], list(langs)
            rows = [r for lo, hi in in_runs(t, 1_000_000) for r in measures(t[lo:hi], g[lo:hi], path, use)]
            yield pd.DataFrame(rows, columns=names)
        give_back()

    return measured(text.cast("string"), lang.cast("string"))


# --- bands from the corpus ---------------------------------------------------

#: Why a text is rejected, one flag each.
REASONS = ("base", "chars", "bytes", "entropy")
_MEASURES = {"chars": ("chars_per_token", 3), "bytes": ("byte_share", 3), "entropy": ("repeat_share", 4)}


def _significant(x: Column) -> Column:
    """Three significant digits."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - 2)
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x / unit) * unit)


def limits(measured: DataFrame) -> DataFrame:
    """(band, and for each measure its first and third quartile, spread and
    chance spread), one row a language or script, from all rows (``m``:
    measures, ``h``: hash of the text) that pass the base rule."""
    rows = measured.filter(~F.col("m.base_failed") & (F.col("m.n_tokens") > 0)).select(
        F.col("m.band").alias("band"), "h", F.col("m.n_tokens").cast("double").alias("n"),
        *[F.round(F.col(f"m.{c}"), digits).alias(name) for name, (c, digits) in _MEASURES.items()],
    ).distinct()
    points = F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75)])
    between = rows.groupBy("band").agg(*[F.percentile(name, points).alias(f"q_{name}") for name in _MEASURES])
    off = rows.join(between, "band").select(
        "band", *[_significant((F.col(name) - F.col(f"q_{name}")[1]) * F.sqrt("n")).alias(name) for name in _MEASURES])
    within = off.groupBy("band").agg(*[F.percentile(name, points).alias(f"r_{name}") for name in _MEASURES])

    def spread(name: str, least: float) -> Column:
        q = F.col(f"q_{name}")
        floor = F.lit(least) if name == "bytes" else least * q[1]
        return F.greatest(q[2] - q[0], floor)

    columns = []
    for name, least in zip(_MEASURES, LEAST_SPREAD):
        q, r = F.col(f"q_{name}"), F.col(f"r_{name}")
        columns += [q[0].alias(f"{name}_low"), q[2].alias(f"{name}_high"), spread(name, least).alias(f"{name}_spread"), (r[2] - r[0]).alias(f"{name}_chance")]
    return between.join(within, "band").select("band", *columns)


def judged(docs: DataFrame, keep: list[str], model: str | None = None, bands: dict | None = None) -> DataFrame:
    """(row, m, out): a struct of the columns ``keep``, the measures with the
    verdict, and a struct of the flags ``REASONS``.

    Texts are measured once, in a written table; all passes read that.
    """
    use = bands or BANDS
    measured = written(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
            fertility(F.col("text"), F.col("lang"), model, use).alias("m"),
            F.xxhash64(F.col("text").cast("string")).alias("h"),
        ),
        "fertility-measures",
    )
    # One row a band, of which ``bands`` names all.
    known = F.broadcast(limits(measured).select(F.col("band").alias("at"), F.struct("*").alias("l")))
    rows = measured.join(known, F.col("m.band") == F.col("at"), "left")

    def fixed(at: int) -> Column:
        return F.create_map(*[F.lit(x) for name, b in use.items() for x in (name, float(b[at]))])[F.col("m.band")]

    def beyond(name: str, x: Column, both: bool = True) -> Column:
        width = FENCE * (F.col(f"l.{name}_spread") + F.col(f"l.{name}_chance") / F.sqrt(F.greatest(F.col("m.n_tokens"), F.lit(1))))
        over = x > F.col(f"l.{name}_high") + width
        return over | (x < F.col(f"l.{name}_low") - width) if both else over

    cpt, share, again = (F.col(f"m.{c}") for c, _ in _MEASURES.values())
    out = {
        "base": F.col("m.base_failed"),
        "chars": cpt.isNull() | (cpt < fixed(0)) | (cpt > fixed(1)) | beyond("chars", cpt),
        "bytes": (share > fixed(2)) | beyond("bytes", share, both=False),
        "entropy": (again > F.pow(F.lit(2.0), -fixed(3))) | beyond("entropy", again),
    }
    flags = F.struct(*[F.coalesce(out[r], F.lit(False)).alias(r) for r in REASONS])
    kept = ~F.exists(F.array(*[F.col(f"out.{r}") for r in REASONS]), lambda x: x)
    return rows.withColumn("out", flags).select("row", F.col("m").withField("kept", kept).alias("m"), "out")


def report(judgement: DataFrame) -> DataFrame:
    """One row: documents, those rejected, and for each reason how many
    documents it rejects (``n_``) and how many it rejects alone (``alone_``)."""
    flags = {r: F.col(f"out.{r}") for r in REASONS}
    hits = sum(f.cast("int") for f in flags.values())
    return judgement.agg(
        F.count("*").alias("documents"),
        F.count_if(~F.col("m.kept")).alias("rejected"),
        *[F.count_if(f).alias(f"n_{r}") for r, f in flags.items()],
        *[F.count_if(f & (hits == 1)).alias(f"alone_{r}") for r, f in flags.items()],
    )
