"""Secret scans: fixed patterns, and probabilistic automata of credentials.

Three fixed kinds are found by pattern (``assign``, ``access``, ``hex``).  The
automata add spans that no pattern names: ALERGIA grammar inference builds the
prefix tree of labelled credentials over character classes, merges states
whose outgoing frequencies agree within a Hoeffding bound, and so learns one
probabilistic automaton of credentials and one of ordinary long tokens
(identifiers, paths, numbers, words).  Every token of a text that is as long as
the shortest labelled format is scored by the difference of its log-likelihoods per character; candidates at
or above ``MARGIN`` become ``format`` spans.  Base spans always stay.

The labelled strings are drawn, with a fixed seed, from the public formats
listed below, ``SAMPLES`` a format; training takes about a second, once a
worker, and does not depend on the data scanned.

Spans are code point offsets, end exclusive.  Edge cases: a null text is an
empty one and has no span; texts of any length are scanned whole; spans of
different kinds may overlap and are all reported (a redaction merges them);
a token inside one base span is not scored, one that reaches beyond it is; rows are independent, so
repeated rows get equal results; other columns are untouched.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
_KEYWORD = re.compile(r"(?ai:password|passwd|secret|token|api_?key)")

SAMPLES = 300
MARGIN = 0.35
#: Confidence of the Hoeffding test that keeps two states apart.
ALPHA = 0.05

_B62 = string.ascii_letters + string.digits
_UPPER = string.ascii_uppercase + string.digits
_HEXDIGITS = "0123456789abcdef"
_B64 = _B62 + "+/"
_URL = _B62 + "_-"

# Public credential formats as (prefix, alphabet, least length,
# most length) of what follows the prefix.
FORMATS = [
    ("AKIA", _UPPER, 16, 16),
    ("ASIA", _UPPER, 16, 16),
    ("ghp_", _B62, 36, 36),
    ("gho_", _B62, 36, 36),
    ("github_pat_", _B62, 22, 59),
    ("glpat-", _URL, 20, 20),
    ("sk_live_", _B62, 24, 34),
    ("pk_live_", _B62, 24, 34),
    ("sk-", _B62, 32, 48),
    ("xoxb-", string.digits, 11, 13),
    ("AIza", _URL, 35, 35),
    ("ya29.", _URL, 40, 60),
    ("SG.", _URL, 22, 43),
    ("npm_", _B62, 36, 36),
    ("eyJ", _URL, 30, 60),
    ("", _B64, 40, 44),
    ("", _B62, 24, 40),
    ("", _HEXDIGITS, 32, 40),
    ("", "0123456789ABCDEF", 32, 40),
]

#: A candidate is a token as long as the shortest format, with the prefix of a
#: format that has a dot in it, and with long parts that follow after dots.
LEAST_CHARS = min(len(p) + lo for p, _, lo, _ in FORMATS)
_DOTTED = "|".join(re.escape(p) for p, *_ in FORMATS if "." in p)
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])(?:{_DOTTED})?[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}(?:\.[A-Za-z0-9+/_=-]{{10,}})*")

#: Parts of long words in several languages, for tokens that are no credentials.
_PARTS = (
    "the and ing tion ment ness able ship less ful over under inter trans counter ent con dis pre st ble ther "
    "ver ge be sch lich keit heit ung chen schaft zu auf ein nicht und sicht stadt recht "
    "eur eux elle que aire ique oire eau anti ción dad mente ado idad amiento"
).split()


def labelled_credentials(samples: int = SAMPLES, seed: int = 11) -> list[str]:
    g = random.Random(seed)
    return [p + "".join(g.choice(a) for _ in range(g.randint(lo, hi))) for p, a, lo, hi in FORMATS for _ in range(samples)]


def labelled_tokens(samples: int = SAMPLES, seed: int = 12) -> list[str]:
    """Long tokens that are no credentials."""
    g = random.Random(seed)
    syllables = [c + v for c in "bcdfghklmnprstvw" for v in "aeiou"] + ["ing", "tion", "er", "an", "str", "qu"]

    def word():
        return "".join(g.choice(syllables) for _ in range(g.randint(1, 4)))

    def long_word():
        w = ""
        while len(w) < LEAST_CHARS:
            w += g.choice(_PARTS)
        return w

    makers = [
        lambda: word() + word() + word() + word() + word(),
        lambda: "_".join(word() for _ in range(g.randint(3, 6))) + g.choice(["", str(g.randint(0, 99))]),
        lambda: "-".join(word() for _ in range(g.randint(3, 6))) + g.choice(["", "-" + str(g.randint(0, 2030))]),
        lambda: "/".join(word() for _ in range(g.randint(3, 6))) + g.choice(["", "/" + str(g.randint(0, 2030))]),
        lambda: word() + "".join(word().capitalize() for _ in range(g.randint(2, 5))) + g.choice(["", str(g.randint(0, 99))]),
        lambda: "_".join(word().upper() for _ in range(g.randint(3, 5))) + g.choice(["", "_" + str(g.randint(0, 99))]),
        lambda: "".join(g.choice(string.digits) for _ in range(g.randint(20, 30))),
        lambda: "-".join(str(g.randint(1, 9999)) for _ in range(g.randint(4, 7))),
        lambda: f"{g.randint(1990, 2030)}-{g.randint(1, 12):02d}-{g.randint(1, 28):02d}T" + "-".join(f"{g.randint(0, 59):02d}" for _ in range(4)),
        lambda: word() + g.choice("=-_+/") * g.randint(12, 30) + word(),
        lambda: word() + str(g.randint(0, 999)) + word() + word() + word() + word(),
        lambda: long_word(),
        lambda: long_word().capitalize(),
        lambda: long_word().upper(),
    ]
    return [m() for m in makers for _ in range(2 * samples)]


# --- grammar inference -----------------------------------------------------

#: Character classes: hex letters, other consonants, other vowels, digits, marks.
_CLASS = {
    **dict.fromkeys("bcdf", "h"),
    **dict.fromkeys("ae", "v"),
    **dict.fromkeys("ghjklmnpqrstvwxyz", "c"),
    **dict.fromkeys("iou", "w"),
    **dict.fromkeys("BCDF", "H"),
    **dict.fromkeys("AE", "V"),
    **dict.fromkeys("GHJKLMNPQRSTVWXYZ", "C"),
    **dict.fromkeys("IOU", "W"),
    **dict.fromkeys(string.digits, "0"),
    **{m: m for m in "+/_=.-"},
}
_END = "$"
#: Characters in each class, for likelihoods per character.
_MEMBERS = {s: sum(v == s for v in _CLASS.values()) for s in set(_CLASS.values())}


class Automaton:
    """A probabilistic deterministic automaton over character classes."""

    def __init__(self, counts: list[dict[str, int]], moves: list[dict[str, int]]):
        symbols = len(_MEMBERS) + 1
        self.moves = moves
        self.logs = []
        for c in counts:
            total = sum(c.values()) + 0.5 * symbols
            self.logs.append({s: math.log((c.get(s, 0) + 0.5) / total / _MEMBERS.get(s, 1)) for s in (*_MEMBERS, _END)})

    def score(self, text: str) -> float:
        """Log-likelihood per character; an unseen move goes to the start."""
        state, total = 0, 0.0
        for c in text:
            s = _CLASS.get(c, "_")
            total += self.logs[state][s]
            state = self.moves[state].get(s, 0)
        return (total + self.logs[state][_END]) / (len(text) + 1)


def infer(strings: list[str], alpha: float = ALPHA) -> Automaton:
    """ALERGIA: the prefix tree of ``strings`` with compatible states merged."""
    counts: list[dict[str, int]] = [{}]
    moves: list[dict[str, int]] = [{}]
    for x in strings:
        at = 0
        for c in x:
            s = _CLASS.get(c, "_")
            counts[at][s] = counts[at].get(s, 0) + 1
            if s not in moves[at]:
                moves[at][s] = len(moves)
                moves.append({})
                counts.append({})
            at = moves[at][s]
        counts[at][_END] = counts[at].get(_END, 0) + 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def agree(a: int, b: int, steps: int = 6) -> bool:
        na, nb = sum(counts[a].values()), sum(counts[b].values())
        if not na or not nb:
            return True
        room = bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
        for s in counts[a].keys() | counts[b].keys():
            if abs(counts[a].get(s, 0) / na - counts[b].get(s, 0) / nb) > room:
                return False
        return steps == 0 or all(agree(moves[a][s], moves[b][s], steps - 1) for s in moves[a].keys() & moves[b].keys())

    def fold(a: int, b: int) -> None:
        """Add the tree below ``b`` to state ``a``."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            for s, n in counts[b].items():
                counts[a][s] = counts[a].get(s, 0) + n
            for s, to in moves[b].items():
                if s in moves[a]:
                    stack.append((moves[a][s], to))
                else:
                    moves[a][s] = to

    red, blue = [0], [(0, s) for s in sorted(moves[0])]
    seen = {0}
    while blue:
        parent, s = blue.pop(0)
        b = moves[parent][s]
        if b in seen:
            continue
        for r in red:
            if agree(r, b):
                moves[parent][s] = r
                fold(r, b)
                break
        else:
            red.append(b)
            seen.add(b)
        # Folding may have given any red state new moves to unseen states.
        blue = [(r, t) for r in red for t in sorted(moves[r]) if moves[r][t] not in seen]
    number = {r: i for i, r in enumerate(red)}
    return Automaton([counts[r] for r in red], [{s: number[to] for s, to in moves[r].items()} for r in red])


_MODELS: list[Automaton] = []


def _models() -> list[Automaton]:
    if not _MODELS:
        _MODELS.extend((infer(labelled_credentials()), infer(labelled_tokens())))
    return _MODELS


def likelihood_ratio(token: str) -> float:
    """How much likelier, per character, a credential is than another token."""
    secret, other = _models()
    return secret.score(token) - other.score(token)


# --- scanning --------------------------------------------------------------


def spans(text: str, margin: float = MARGIN) -> list[tuple[int, str, int]]:
    """(start, kind, end) by start, then kind as listed in ``KINDS``; the
    patterns' spans whatever their likelihood, other candidates from ``margin`` on."""
    found = []
    if _KEYWORD.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base, k, reach = sorted((a, b) for a, _, b in found), 0, 0
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        while k < len(base) and base[k][0] <= a:
            reach = max(reach, base[k][1])
            k += 1
        # a place inside a base span is known
        if b > reach and likelihood_ratio(m[0]) >= margin:
            found.append((a, 3, b))
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def redact(text: str, found: list[tuple[int, str, int]]) -> str:
    """``text`` with every span, overlapping ones as one, replaced."""
    out, at, merged = [], 0, []
    for a, kind, b in found:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[at:a], f"[SECRET:{kind}]"]
        at = b
    return "".join([*out, text[at:]])


_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+$")


def format_score(text: str, start: int, end: int) -> float:
    """The likelihood ratio of the token that ends a span."""
    return likelihood_ratio(_TOKEN.search(text, start, end)[0])


_SCHEMA = (
    "n_assign bigint, n_access bigint, n_hex bigint, n_format bigint, base_sha256 string, spans string, scores string, redacted string"
)


def scan(text: Column, with_text: bool = False, margin: float = MARGIN) -> Column:
    """A struct of counts, digests, spans, their scores (joined in the same
    order) and, on request, the redacted text (null where nothing was found)."""

    @F.pandas_udf(_SCHEMA)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                t = t or ""
                found = spans(t, margin)
                n = [sum(k == kind for _, k, _ in found) for kind in KINDS]
                base = ",".join(f"{k}:{a}:{b}" for a, k, b in found if k != "format")
                every = ",".join(f"{k}:{a}:{b}" for a, k, b in found)
                scores = ",".join(f"{format_score(t, a, b):.3f}" for a, _, b in found)
                rows.append((*n, hashlib.sha256(base.encode()).hexdigest(), every, scores, redact(t, found) if with_text and found else None))
            yield pd.DataFrame(rows, columns=[x.split(" ")[0] for x in _SCHEMA.split(", ")])

    return scanned(text.cast("string"))
