"""Operators written in DataFrame functions only: license scans, sketches,
line dedup, sharding; each against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from martkit.llm import doc_sketch, license_scan, line_dedup, queries, sharding
from martkit.llm.license_rules import BASE, Rule, rules

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@pytest.mark.parametrize("name", ["op1_signatures", "op2_scaled_sketch", "op6_site_spread", "op8_virtual_slots"])
def test_no_python_in_native_plans(spark, sf, name):
    plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- license scans -----------------------------------------------------------


def brute_licenses(text, table):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, UPPER.lower())))
    joined = " " + " ".join(w) + " "
    base = [(k, label) for phrase, label in BASE.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
    found = []
    for k, r in enumerate(table):
        if r.keyword in joined:
            for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", joined):
                a = joined[: m.start()].count(" ") - 1
                found.append((a, a + m[0].count(" "), r.priority, k, r.label))

    def covers(y, x):
        return y[0] <= x[0] and x[1] <= y[1] and y[2] >= x[2] and (y[0], -y[1], -y[2], y[3]) < (x[0], -x[1], -x[2], x[3])

    kept = [x for x in found if not any(covers(y, x) for y in found)]
    labels = {label for _, label in base}
    places = [k for k, _ in base]
    return (
        len(w), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
        ",".join(sorted(labels | {x[4] for x in kept})), len(found) - len(kept),
    )


def license_rows(df, table=None):
    cols = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "n_suppressed"]
    return Counter((r["doc_id"], *[r[c] for c in cols]) for r in license_scan.licenses(df, table=table).collect())


def test_licenses_equal_brute_force(spark, edge, edge_df):
    assert license_rows(edge_df) == Counter((r[0], *brute_licenses(r[1], rules())) for r in edge)


def test_every_name_clause_and_clue_rule_can_fire(spark):
    def example(p):  # the shortest plain text that a rule's pattern has
        p = re.sub(r"\.\{1,80\}\?", "x", p)
        while (q := re.sub(r"\((?:\?:)?([^()|]*)(?:\|[^()]*)?\)\?\??", "", p)) != p or (q := re.sub(r"\((?:\?:)?([^()|]*)(?:\|[^()]*)?\)(?:\{[^}]*\}\??)?", r"\1", p)) != p:
            p = q
        p = re.sub(r"\(?\[([^\]])[^\]]*\](?:\+|\{2\})?", lambda m: m[1] * 2 if "{2}" in m[0] else m[1], p)
        return re.sub(r" +", " ", re.sub(r"\w\?", "", p).split("|")[0]).strip()

    table = [r for r in rules() if re.fullmatch(r.pattern, example(r.pattern)) and r.keyword in f" {example(r.pattern)} "]
    assert len(table) > 200
    df = spark.createDataFrame([(i, f"start {example(r.pattern)} end") for i, r in enumerate(table)], "doc_id bigint, text string")
    _, each = license_scan.scan(df, table=table)
    rows = license_scan.scan(df, table=table)[0].select("row", "doc_id").collect()
    assert len(rows) == len(table)
    hit = {(r["doc_id"], r["label"]) for r in license_scan.licenses(df, table=table).select("doc_id", F.explode(F.split("labels", ",")).alias("label")).collect()}
    missed = [r for i, r in enumerate(table) if not any((i, x.label) in hit for x in table if x.label == r.label or x.priority >= r.priority)]
    assert not missed
    assert each.count() >= len(table)


def drawn(g, tree):
    """A random text that a parsed pattern matches."""
    out = ""
    for op, a in tree:
        match str(op):
            case "LITERAL":
                out += chr(a)
            case "BRANCH":
                out += drawn(g, g.choice(a[1]))
            case "SUBPATTERN":
                out += drawn(g, a[3])
            case "MAX_REPEAT" | "MIN_REPEAT":
                out += "".join(drawn(g, a[2]) for _ in range(g.randint(a[0], min(int(a[1]), a[0] + 2))))
            case "IN":
                kind, value = g.choice(a)
                out += chr(value if str(kind) == "LITERAL" else g.randint(*value))
            case "ANY":
                out += "x"
            case _:
                raise ValueError(op)
    return out


def test_gates_lose_no_match(spark):
    """The keyword and stem gates change nothing: equal to all patterns tried on every text."""
    g, texts = random.Random(4), []
    for r in rules():
        tree = re._parser.parse(r.pattern)
        for x in sorted({drawn(g, tree) for _ in range(300)}):
            assert re.fullmatch(r.pattern, x) and r.keyword in f" {x} " and any(s in f" {x} " for s in license_scan.STEMS), (r, x)
        texts += [f"q {drawn(g, tree)} q" for _ in range(2)]
    texts += ["see copying file", "See the COPYING.txt", "WTFPL", "psf license version 2", "Common Development and Distribution License, version 1.0", "for personal use only", "released under the foo licence"]
    ungated = [r._replace(keyword=" ") for r in rules()]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = license_rows(df)
    assert got == Counter((i, *brute_licenses(t, ungated)) for i, t in rows)
    assert all(r[6] for r in got)


def test_clauses_in_the_licenses_own_words(spark):
    """Passages as the licenses print them, with their line breaks and marks."""
    passages = {
        "gpl": "This program is free software; you can redistribute it and/or modify\n it under the terms of the GNU General Public License",
        "gpl-2.0-or-later": "GNU General Public License as published by the Free Software Foundation; either version 2\nof the License, or (at your option) any later version.",
        "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file',
        "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software")',
        "mit-or-x11": "IN NO EVENT SHALL THE\nAUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER IN AN ACTION OF CONTRACT",
        "bsd": "* Redistributions of source code must retain the above copyright notice, this\n  list of conditions and the following disclaimer.",
        "bsd-3-clause": "Neither the name of the copyright holder nor the names of its\n contributors may be used to endorse or promote products derived from",
        "bsd-4-clause": "3. All advertising materials mentioning features or use of this software\n   must display the following acknowledgement:\n   This product includes software",
        "isc": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above",
        "zlib": "The origin of this software must not be misrepresented; you must not\n   claim that you wrote the original software.",
        "boost-1.0": "Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by",
        "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\n  License, v. 2.0. If a copy of the MPL was not",
        "epl-2.0": "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0",
        "unlicense": "This is free and unencumbered software released into the public domain.",
        "ofl-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
        "openssl": "This product includes software developed by the OpenSSL Project\n for use in the OpenSSL Toolkit",
    }
    df = spark.createDataFrame(list(passages.items()), "doc_id string, text string")
    for spelling in (df, df.withColumn("text", F.replace("text", F.lit("acknowledgement"), F.lit("acknowledgment")))):
        got = {r["doc_id"]: set(r["labels"].split(",")) for r in license_scan.licenses(spelling).collect()}
        assert {k: k in v for k, v in got.items()} == dict.fromkeys(passages, True)


def test_overlaps_by_priority_and_containment(spark):
    table = [Rule("wide", 2, "apache", "the apache license text"), Rule("narrow", 3, "apache", "apache license"), Rule("same", 2, "apache", "the apache license text"), Rule("clue", 1, "apache", "license text")]
    df = spark.createDataFrame([(1, "see the Apache License text")], "doc_id int, text string")
    r = license_scan.licenses(df, table=table).first()
    assert r["labels"] == "apache,narrow,wide" and r["n_suppressed"] == 2 and r["n_base"] == 1


# --- sketches ---------------------------------------------------------------------


def shingles(text, n=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    n = min(n, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def pairs_of(df):
    p = doc_sketch.edited_pairs(df)
    return p.select(
        "doc_id", "n_chars", "edited", doc_sketch.printed(F.col("sketch")).alias("fp"),
        doc_sketch.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        doc_sketch.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    ).collect()


def test_edited_texts_and_likeness(spark, edge, edge_df):
    unique = {}
    for r in edge:  # one text an id here: what a successor is, is then plain
        unique.setdefault(r[0], r[1] or "")
    ids = sorted(unique, key=lambda i: (i is not None, i))
    df = spark.createDataFrame([(i, unique[i], "x") for i in ids], "doc_id bigint, text string, key string").repartition(4)
    got = {r["doc_id"]: r for r in pairs_of(df)}
    assert len(got) == len(ids)
    for k, i in enumerate(ids):
        t, then = unique[i], unique[ids[(k + 1) % len(ids)]]
        edited = t[: len(t) - len(t) // 4] + then[: len(t) // 4]
        assert got[i]["n_chars"] == len(t) and got[i]["edited"] == edited
        assert got[i]["near_edited"] == pytest.approx(jaccard(shingles(t), shingles(edited)), abs=0.1)
        assert got[i]["near_next"] == pytest.approx(jaccard(shingles(t), shingles(then)), abs=0.1)
    assert got[20]["fp"] == got[21]["fp"] and got[20]["near_next"] == 1.0


def test_repeated_ids_and_single_rows(spark, edge, edge_df, empty_df):
    assert len(pairs_of(edge_df)) == len(edge)
    assert pairs_of(empty_df) == []
    one = spark.createDataFrame([(7, "a b c d e f g h")], "doc_id int, text string")
    assert pairs_of(one)[0]["edited"] == "a b c d e f a b"
    assert pairs_of(one)[0]["near_next"] == 1.0


def test_containment_and_merge(spark):
    big = " ".join(f"w{i}" for i in range(3000))
    part = " ".join(f"w{i}" for i in range(1000, 1600))
    df = spark.createDataFrame([(big, part, big + " " + part)], "a string, b string, c string")
    df = doc_sketch.with_sketch(doc_sketch.with_sketch(df, "a", "sa"), "b", "sb")
    r = df.select(
        doc_sketch.containment(F.col("sb"), F.col("sa")).alias("part_in_big"),
        doc_sketch.containment(F.col("sa"), F.col("sb")).alias("big_in_part"),
        (doc_sketch.merged(F.col("sa"), F.col("sb")) == F.col("sa")).alias("absorbed"),
        F.size("sa.hashes").alias("n"),
    ).first()
    assert r["part_in_big"] == 1.0 and r["big_in_part"] == pytest.approx(596 / 2996, abs=0.06) and r["absorbed"]
    assert r["n"] == pytest.approx(2996 / doc_sketch.SCALE, rel=0.25)


@pytest.mark.parametrize("whole_below", [0, 128, 10**6])
def test_sketches_on_both_sides_of_the_limit(spark, whole_below):
    """Texts of 126 to 130 shingles, and far from there: which hashes a
    sketch holds, and comparison and merging across the limit."""
    words = [f"w{i}" for i in range(700)]
    sizes = [1, 5, 126, 127, 128, 129, 130, 600]
    df = spark.createDataFrame([(n, " ".join(words[: n + 4])) for n in sizes], "n int, text string")
    sk = doc_sketch.with_sketch(doc_sketch.with_sketch(df, "text", "own", whole_below), "text", "every", 10**6)
    pairs = sk.alias("a").join(sk.alias("b"), F.col("a.n") <= F.col("b.n")).select(
        F.col("a.n").alias("x"), F.col("b.n").alias("y"), F.col("a.own").alias("own"), F.col("a.every").alias("every"),
        doc_sketch.containment(F.col("a.own"), F.col("b.own")).alias("within"), doc_sketch.merged(F.col("a.own"), F.col("b.own")).alias("both"),
        F.col("b.own").alias("other"))
    for r in pairs.collect():
        limit = 2**64 // doc_sketch.SCALE
        low = [h for h in r["every"]["hashes"] if h % 2**64 < limit]
        assert len(r["every"]["hashes"]) == r["x"] and r["own"]["scale"] == (1 if r["x"] < whole_below else doc_sketch.SCALE)
        assert r["own"]["hashes"] == (r["every"]["hashes"] if r["x"] < whole_below else low)
        assert r["within"] in (1.0, None) and r["both"] == r["other"]  # the shorter text begins the longer one


def test_containment_of_short_texts_in_long_ones(spark):
    """A contained text is never "not contained": all of it, or unknown."""
    w = [f"w{i}" for i in range(3000)]
    for n, unknown in ((5, 0.51), (10, 0.26), (20, 0.07)):
        rows = [(" ".join(w[k : k + n + 4]), " ".join(w)) for k in range(0, 2900, 15)]
        df = spark.createDataFrame(rows, "a string, b string").repartition(4)
        df = doc_sketch.with_sketch(doc_sketch.with_sketch(df, "a", "sa"), "b", "sb")
        got = [r[0] for r in df.select(doc_sketch.containment(F.col("sa"), F.col("sb"))).collect()]
        assert set(got) == {None, 1.0} and got.count(None) / len(got) == pytest.approx(unknown, abs=0.12)
    ends = spark.createDataFrame([("", ""), ("", "a b"), ("a b", ""), ("a b", "a b")], "a string, b string")
    ends = doc_sketch.with_sketch(doc_sketch.with_sketch(ends, "a", "sa"), "b", "sb")
    assert [r[0] for r in ends.select(doc_sketch.containment(F.col("sa"), F.col("sb"))).collect()] == [1.0, 0.0, 0.0, 1.0]


# --- line dedup --------------------------------------------------------------------


def brute_lines(rows, min_sites, min_chars):
    sites, first = defaultdict(set), {}
    for i, t, _, s, *_ in rows:
        for k, line in enumerate((t or "").split("\n") if t is not None else []):
            x = line.strip(" ")
            if len(x) >= min_chars:
                sites[x].add(s)
                first.setdefault(x, []).append((i, t, k))
    gone = {x for x, s in sites.items() if len(s) >= min_sites}
    out = Counter()
    for i, t, *_ in rows:
        kept = None if t is None else [x for x in t.split("\n") if x.strip(" ") not in gone]
        out[i, t] += 1
        yield i, t, kept, gone


@pytest.mark.parametrize("band", [0.1, 5.0])
def test_lines_equal_brute_force(spark, edge, edge_df, band):
    got = line_dedup.remove_boilerplate(edge_df, band=band).select("row.doc_id", "row.text", "row.clean", "n_lines", "n_removed", F.col("clean").alias("new"))
    by = defaultdict(list)
    for r in got.collect():
        by[r["doc_id"], r["text"]].append(r)
    assert sum(map(len, by.values())) == len(edge)
    shared, survivors = "the same line of words on many sites", 0
    for i, t, kept, gone in brute_lines(edge, line_dedup.MIN_SITES, line_dedup.MIN_CHARS):
        assert gone == {shared}
        r = by[i, t][0]
        assert len({(x["new"], x["n_removed"]) for x in by[i, t]}) == 1
        if t is None:
            assert r["new"] is None and r["n_removed"] == 0
            continue
        here = [x for x in r["new"].split("\n") if x.strip(" ") == shared] if r["new"] else []
        survivors += len(here)
        assert len(here) <= 1 and r["n_lines"] == len(t.split("\n"))
        assert [x for x in r["new"].split("\n") if x.strip(" ") != shared] == kept or (not kept and r["new"] == "") or (not kept and r["new"] == shared)
        assert r["n_removed"] == len(t.split("\n")) - len(kept) - len(here)
    assert survivors == 1


def test_lines_of_an_empty_table(empty_df):
    assert line_dedup.remove_boilerplate(empty_df).collect() == []


# --- sharding -----------------------------------------------------------------------


def test_shards_equal_brute_force(edge, edge_df):
    placed, path = sharding.assign(edge_df, 5)
    rows = placed.collect()
    before, after = (sharding.load_map(edge_df.sparkSession, path, v) for v in (0, 1))
    raw = [(r[1] or "").encode() for r in edge]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((r[0], len(t) + 16, zlib.crc32(t)) for r, t in zip(edge, raw, strict=True))
    held = defaultdict(list)
    for r in rows:
        assert after[r["virtual_slot"]] == r["shard"]
        held[r["shard"]].append(r["slot_in_shard"])
    assert all(sorted(v) == list(range(len(v))) for v in held.values())
    assert len(before) == len(after) == sharding.N_SLOTS


def test_shard_sizes_near_equal(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") * 7919 % 1000).cast("int")).alias("text"))
    placed, path = sharding.assign(df, 40)
    before, after = sharding.load_map(spark, path, 0), sharding.load_map(spark, path)
    sizes = [r["b"] for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 40 and max(sizes) < 1.002 * min(sizes)
    assert sum(a != b for a, b in zip(before, after, strict=True)) < 0.2 * len(after)  # an edit, not a new map


@pytest.mark.parametrize("repeated", ["null", "id", "row"])
def test_shard_sizes_with_a_hot_id(spark, repeated):
    """A third of the rows without an id, under one id, or equal."""
    hot = F.col("id") % 3 == 0
    own = F.repeat(F.lit("x"), (F.col("id") * 7919 % 100).cast("int"))
    df = spark.range(200_000).select(
        F.when(~hot, F.col("id")).otherwise(F.lit(None if repeated == "null" else 3).cast("bigint")).alias("doc_id"),
        F.when(hot & F.lit(repeated == "row"), F.lit("x" * 50)).otherwise(own).alias("text"))
    placed, _ = sharding.assign(df, 40)
    per = placed.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot_in_shard").alias("top"), F.countDistinct("slot_in_shard").alias("d"))
    rows = per.collect()
    assert len(rows) == 40 and max(r["b"] for r in rows) < 1.01 * min(r["b"] for r in rows)
    assert all(r["n"] == r["d"] == r["top"] + 1 for r in rows) and sum(r["n"] for r in rows) == 200_000
    assert placed.groupBy("virtual_slot").count().agg(F.max("count")).first()[0] < 10 * 200_000 / sharding.N_SLOTS


def test_the_stored_map_is_edited(spark, tmp_path):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    path = str(tmp_path / "slots")
    first = {r["doc_id"]: r["shard"] for r in sharding.assign(df, 8, map_path=path)[0].collect()}
    again = {r["doc_id"]: r["shard"] for r in sharding.assign(df, 8, map_path=path)[0].collect()}
    assert sharding.saved_versions(spark, path) == [0, 1, 2]
    assert sum(first[k] != again[k] for k in first) < 0.02 * len(first)  # already near equal
    more = df.unionByName(spark.range(5000, 6000).select(F.col("id").alias("doc_id"), F.lit("x" * 500).alias("text")))
    later = {r["doc_id"]: r["shard"] for r in sharding.assign(more, 8, map_path=path)[0].collect()}
    assert sum(again[k] != later[k] for k in again) < 0.5 * len(again)


def test_slot_map_versions(spark, tmp_path, empty_df):
    path = str(tmp_path / "map")
    first = sharding.initial_map(3, 12)
    second = sharding.rebalance(first, {0: 90, 3: 90, 6: 90, 1: 10}, 3)
    sharding.save_map(spark, path, 0, first)
    sharding.save_map(spark, path, 1, second)
    assert sharding.load_map(spark, path, 0) == first and sharding.load_map(spark, path) == second
    loads = Counter()
    for slot, size in {0: 90, 3: 90, 6: 90, 1: 10}.items():
        loads[second[slot]] += size
    assert sorted(loads.values()) == [90, 90, 100]
    assert sharding.assign(empty_df, 4)[0].collect() == []


def test_base_sha(spark, sf):
    r = queries.QUERIES["op2_scaled_sketch"](spark, sf).orderBy("doc_id").first()
    docs = [x["text"] for x in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(2).collect()]
    t, then = docs
    assert r["edited_sha256"] == hashlib.sha256((t[: len(t) - len(t) // 4] + then[: len(t) // 4]).encode()).hexdigest()
