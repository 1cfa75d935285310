"""Conversation trie, source audit and language mixtures, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martkit.llm import conv_trie, lang_mix, source_audit

CONV = "conv_id bigint, turn bigint, role string, text string, key string, band int, depth string"


# ---------------------------------------------------------------- trie


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = turns.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
        whole[c] = tuple(base[:h] + mine[h:])
    members = defaultdict(list)
    for c, p in sorted(whole.items()):
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        words = len(re.findall(rb"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(m) - 1) * words
    return sorted(
        (m[0], len(k), members[k[:-1]][0] if k else -1, len(m), kids[k], leaves[k], saved[k],
         hashlib.sha256(",".join(str(c) for c in m if len(whole[c]) == len(k)).encode()).hexdigest())
        for k, m in members.items()
    )


def spark_trie(spark, rows):
    df = spark.createDataFrame([(*r, "k", 1, "d") for r in rows], CONV).repartition(3)
    got = conv_trie.trie(conv_trie.rebuilt_paths(df)).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got)


def conversations(seed, longest):
    g = random.Random(seed)
    say = ["a b", "", None, "c", " d\t e\n", "ü x"]
    rows = []
    for c in [*range(0, 45), -3, -21, 1000, 5003]:
        if c == 20:
            continue  # its block has no first conversation
        for t in range(g.choice([1, 1, 2, 3, longest])):
            rows.append((c, t, g.choice(["user", None]), say[t % 6] if g.random() < 0.9 else g.choice(say)))
    rows += [(7, None, "user", "c"), (7, 0, "user", "a b"), (7, 0, "user", "a b"), (7, 0, None, "z"), (None, 1, "user", "nobody")]
    return rows


@pytest.mark.parametrize("seed, longest, height", [(1, 7, 16), (2, 30, 3), (3, 90, 4), (4, 40, 2)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, longest, height):
    """Heights that need one to six levels of bands, nulls, ties, repeated
    rows, missing first conversations and ids below zero."""
    monkeypatch.setattr(conv_trie, "HEIGHT", height)
    rows = conversations(seed, longest)
    assert spark_trie(spark, rows) == brute_trie(rows)


def test_trie_of_one_long_conversation_and_many_equal_ones(spark, monkeypatch):
    """A conversation with a third of all rows, a first turn that all share,
    many conversations that end at one node (several blocks of ids)."""
    monkeypatch.setattr(conv_trie, "ID_BLOCK", 16)
    rows = [(1, t, "user", f"turn {t % 7}") for t in range(600)]
    rows += [(c, t, "user", f"turn {t}") for c in range(40, 340) for t in range(2)]
    assert spark_trie(spark, rows) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert spark_trie(spark, []) == []


def test_parents_with_many_children_are_few_and_split(spark, sf):
    """Only parents of over a thousandth of all nodes are broadcast."""
    rows = [(c, t, "user", f"{c % 4} {t}" if t else "first") for c in range(400) for t in range(4)]
    df = spark.createDataFrame([(*r, "k", 1, "d") for r in rows], CONV)
    plan = conv_trie.trie(conv_trie.rebuilt_paths(df))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# ---------------------------------------------------------------- audit


def brute_audit(docs):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in docs]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, ts in mine for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= 3)
        counts = {s: Counter() for _, s, _ in mine}
        for _, s, ts in mine:
            counts[s].update(t for t in ts if df[t] >= 3)
        total = sum(counts.values(), Counter())
        v = len(kept)

        def share(c):
            return {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(total)
        for s in counts:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in counts if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:top]
                out += [(lang, s, part, item, value, r) for r, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def spark_audit(df, **options):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in source_audit.audit(df, **options).collect())


def test_audit_of_edge_rows(spark, edge, edge_df, empty_df):
    assert spark_audit(edge_df) == brute_audit([(r[1], r[2], r[3]) for r in edge])
    assert spark_audit(empty_df) == []
    assert source_audit.audit(empty_df).columns == ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("columns, block, tile", [(1024, 4096, 256), (8, 16, 4), (1, 5, 1)])
def test_audit_in_any_blocks_and_tiles(spark, monkeypatch, columns, block, tile):
    """Products of a few columns, blocks of a few terms, tiles of a few
    sources give the same numbers; one source holds most rows."""
    monkeypatch.setattr(source_audit, "BLOCK", block)
    monkeypatch.setattr(source_audit, "TILE", tile)
    g = random.Random(7)
    vocabulary = ["w" + "abcdefghij"[i % 10] * (1 + i // 10) for i in range(60)] + ["été", "ÉTÉ", "日本"]
    docs = [
        (" ".join(g.choice(vocabulary[: g.choice([5, 30, 63])]).upper() if g.random() < 0.2 else g.choice(vocabulary) for _ in range(g.randint(0, 60))),
         g.choice(["en", "en", "de", None]), "hot" if g.random() < 0.5 else f"s{g.randrange(12)}")
        for _ in range(150)
    ] + [("only here", "xx", "a"), (None, "xx", "b"), ("", "en", "empty")]
    assert spark_audit(spark.createDataFrame(docs, "text string, lang string, source string"), columns=columns, run=100 * block) == brute_audit(docs)


def test_terms_of_a_long_text_are_whole(monkeypatch):
    text = ("Word9Other éÀ_x " * 5000).encode()
    whole = Counter(t for ts in source_audit.terms_of(text) for t in ts)
    monkeypatch.setattr(source_audit, "SLICE", 37)
    assert Counter(t for ts in source_audit.terms_of(text) for t in ts) == whole
    assert whole == Counter({t.encode(): 5000 for t in ("word", "other", "éÀ", "x")})


# ---------------------------------------------------------------- languages


def speaker(seed):
    """A made-up language: words of its own syllables."""
    g = random.Random(seed)
    parts = ["".join(g.choice("abcdefghijklmnopqrstuvwxyzäéñ") for _ in range(g.randint(2, 4))) for _ in range(60)]
    return lambda g, n: " ".join("".join(g.choice(parts) for _ in range(g.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def languages(spark):
    g, speak = random.Random(3), {lang: speaker(lang) for lang in ("aa", "bb", "cc", "dd")}
    rows = [(i, speak[lang](g, g.randint(20, 120)), lang) for i in range(400) for lang in [g.choice(sorted(speak))]]
    return rows, speak, spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)


def brute_counts(text):
    low = b" " + b" ".join(re.findall(rb"[a-z\x80-\xff]+", text.lower().encode())) + b" "
    low = low.ljust(4)
    grams = [low[i : i + 4] for i in range(len(low) - 3)]
    return Counter(((int.from_bytes(x, "little") * 2654435761) % 2**32) >> 16 for x in grams)


def test_n_grams_and_model_equal_plain_counts(monkeypatch, languages):
    rows, _, df = languages
    for text in ("a", "Ä", "Some Words, 12 of them", "x" * 100, rows[0][1]):
        assert dict(zip(*(x.tolist() for x in lang_mix.n_grams(text)))) == brute_counts(text)
    long = rows[0][1] * 400
    whole = dict(zip(*(x.tolist() for x in lang_mix.n_grams(long))))
    assert whole == brute_counts(long)
    monkeypatch.setattr(lang_mix, "SLICE", 1000)
    assert dict(zip(*(x.tolist() for x in lang_mix.n_grams(long)))) == whole
    model = lang_mix.fit(df)
    assert model.langs == ["aa", "bb", "cc", "dd"]
    for k, lang in enumerate(model.langs):
        c = sum((brute_counts(t) for _, t, x in rows if x == lang), Counter())
        want = np.array([c[b] + lang_mix.ADDED for b in range(lang_mix.BUCKETS)])
        assert np.allclose(model.share[:, k], want / want.sum())


def test_expectation_maximisation_finds_the_best_proportions(languages):
    """Against a grid over all proportions of two languages."""
    rows, speak, df = languages
    model, g = lang_mix.fit(df), random.Random(9)
    text = speak["aa"](g, 70) + " " + speak["cc"](g, 30)
    buckets, counts = lang_mix.n_grams(text)
    share = model.share[buckets][:, [0, 2]]
    part, at = lang_mix.proportions(counts, share)
    grid = [(counts @ np.log(share @ np.array([x, 1 - x])), x) for x in np.linspace(0.001, 0.999, 999)]
    best, x = max(grid)
    assert at >= best - 0.01 and abs(part[0] - x) < 0.02


def test_language_sets_of_mixed_texts(languages):
    rows, speak, df = languages
    model, g, right = lang_mix.fit(df), random.Random(5), 0
    for _ in range(100):
        langs = g.sample(model.langs, g.choice([1, 2, 3]))
        text = " ".join(speak[x](g, 60) for x in langs)
        found = {model.langs[k]: p for k, p in lang_mix.mixture(text, model).items()}
        right += set(found) == set(langs) and abs(sum(found.values()) - 1) < 1e-6
    assert right >= 95


def test_unseen_documents_are_named(languages):
    rows, _, df = languages
    got = {r.doc_id: r for r in lang_mix.predicted(df).collect()}
    truth = {i: lang for i, _, lang in rows}
    assert {i for i, r in got.items() if r.held_out} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    unseen = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].lang_pred == truth[i] for i in unseen) >= 0.99 * len(unseen)


def test_nothing_of_held_out_rows_is_learned(spark, languages):
    rows, _, df = languages
    other = df.withColumn("lang", F.when(lang_mix.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    other = other.withColumn("source", F.lit("s"))
    assert {r.doc_id: (r.lang_pred, r.score) for r in lang_mix.predicted(other).collect()} == {r.doc_id: (r.lang_pred, r.score) for r in lang_mix.predicted(df).collect()}


def test_languages_of_edge_rows(spark, edge, edge_df, empty_df):
    got = lang_mix.predicted(edge_df).collect()
    assert len(got) == len(edge) and all(0 <= r.score <= 1 for r in got)
    texts = defaultdict(set)
    for r in edge:
        texts[r[0]].add(r[1])
    for r in got:
        silent = {t is None or not any(map(str.isalpha, t)) for t in texts[r.doc_id]}
        assert (r.lang_pred == "und") in silent and r.lang_pred in {"und", "en", "de", "fr"}
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert lang_mix.predicted(empty_df).collect() == []
    untaught = spark.createDataFrame([(1, "some words", None)], "doc_id bigint, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lang_mix.predicted(untaught).collect()] == [("und", 0.0)]
