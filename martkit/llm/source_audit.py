"""Divergence of the sources of each language, by one-hot level products.

A term's price for a pair of sources depends on nothing but its two counts, so
the price of all terms is a sum over the pair's joint table of counts.  Every
(source, count) that occurs is a *level* and an indicator column over the terms;
the product of the columns' transpose with the columns holds all joint tables
at once.  The products are taken in blocks of terms, exactly (each entry is a
number of terms of the block, far below the 2**24 that a 32-bit float counts
to), priced with integers, and summed over the blocks.

Count zero has no column.  With f the price, c and d the counts, D the change
of the price against both counts being zero,

    sum f(c, d) = V f(0, 0) + sum over c > 0 of f(c, 0) - f(0, 0)
                + sum over d > 0 of f(0, d) - f(0, 0)
                + sum over c, d > 0 of f(c, d) - f(c, 0) - f(0, d) + f(0, 0)

where the second and third sum follow from the diagonal of the product.

Documents are counted in Arrow per run of texts, one row per (language,
source, term) of the run leaves a task, and everything else is joins and sums.
A block holds about ``BLOCK`` terms and the sources of at most two tiles of
about ``TILE`` sources, so a block's memory does not grow with the input; more
sources make more tiles.  The result itself has a row per pair of sources.

Edge cases: null texts, languages and sources are empty ones, a source without
kept terms still has its rows, repeated rows count again, an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import in_runs
from .common import written

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
BLOCK, TILE = 4096, 256
#: Columns of one product; bytes of text that a task counts at a time, and bytes of a very long text.
COLUMNS = 1024
RUN, SLICE = 8_000_000, 1 << 20

# Terms are runs of letters A-Z, a-z and of characters beyond ASCII; as all
# bytes of the latter are over 127, bytes can be cut without decoding.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes):
    """The terms of a UTF-8 text, in lists of about ``SLICE`` bytes."""
    low = text.translate(_LOWER)
    at = 0
    while at < len(low):
        end = low.find(b" ", at + SLICE)
        end = len(low) if end < 0 else end
        yield low[at:end].split()
        at = end


def _counted(group, texts: list[bytes]):
    """(group, term, n, docs) of a run of texts, as arrays."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    low = pa.array([t.translate(_LOWER) for t in texts], pa.binary()).view(pa.string())
    words = pc.ascii_split_whitespace(low)
    coded = words.flatten().dictionary_encode()
    terms, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    wide = max(len(terms), 1)
    here = np.sort(np.repeat(np.arange(len(texts)), np.diff(np.asarray(words.offsets))) * wide + code)
    first = np.flatnonzero(np.diff(here, prepend=-1))  # a text and a term of it
    n = np.diff(first, append=len(here))
    key = np.asarray(group, np.int64)[here[first] // wide] * wide + here[first] % wide
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    start = np.flatnonzero(np.diff(key, prepend=-1))
    n, docs, key = np.add.reduceat(n, start) if len(start) else n, np.diff(start, append=len(key)), key[start]
    word = terms.take(pa.array(key % wide))
    held = pc.not_equal(word, "").to_numpy(zero_copy_only=False)
    return key[held] // wide, word.filter(pa.array(held)).view(pa.binary()), n[held], docs[held]


def _count(batches, run: int):
    import numpy as np
    import pyarrow as pa

    def out(names, group, terms, n, docs):
        lang, source = (pa.array([x[k] for x in names], pa.string()).take(pa.array(group, pa.int64())) for k in (0, 1))
        return pa.RecordBatch.from_arrays([lang, source, terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
        texts = batch.column("text").to_pylist()
        for lo, hi in in_runs(texts, run):
            if len(texts[hi - 1]) > run:  # a very long text, in slices
                hi -= 1
                n = Counter()
                for terms in terms_of(texts[hi]):
                    n.update(terms)
                yield out(names[hi : hi + 1], [0] * len(n), pa.array(list(n), pa.binary()), list(n.values()), [1] * len(n))
            if hi > lo:
                places = {x: i for i, x in enumerate(dict.fromkeys(names[lo:hi]))}
                yield out(list(places), *_counted(np.array([places[x] for x in names[lo:hi]]), texts[lo:hi]))


def term_vectors(docs: DataFrame, least_docs: int = LEAST_DOCS, run: int = RUN) -> DataFrame:
    """(lang, term, total, counts): each language's terms in at least
    ``least_docs`` of its documents, with their count per source."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    counted = rows.mapInArrow(lambda batches: _count(batches, run), "lang string, source string, term binary, n bigint, docs bigint")
    # One shuffle: rows of a term in one language lie together for both sums.
    counted = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (
        counted.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))
        .filter(F.col("docs") >= least_docs)
        .select("lang", F.col("term").cast("string").alias("term"), "total", "counts")
    )


def _share(count, size):
    """1 + floor(SCALE * (count + 1) / size), exactly."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + 1 AS DECIMAL(19, 0))) div CAST({size} AS DECIMAL(20, 0))")


def _block_sums(key, left, right, columns: int):
    """What a block of terms adds to the price of each pair of sources."""
    import numpy as np
    import pyarrow as pa

    lang, _, a, b = (k.as_py() for k in key)
    names = right.column("source").to_pylist()
    tile = np.array(right.column("tile").to_pylist(), np.int64)
    size = right.column("size").to_pylist()
    at = {s: i for i, s in enumerate(names)}
    p0 = np.array([1 + SCALE // m for m in size], np.int64)
    out = np.zeros((len(names), len(names)), np.int64)

    left = left.sort_by("total")  # terms of like counts share levels
    lists = left.column("counts").combine_chunks()
    ends = np.asarray(lists.offsets)
    flat = lists.flatten()
    group = np.array([at[s] for s in flat.field("source").to_pylist()], np.int64)
    count = flat.field("n").to_numpy(zero_copy_only=False)
    starts, row = ends[:-1] - ends[0], np.repeat(np.arange(len(ends) - 1), np.diff(ends))

    def price(p, q):
        return (p - q) ** 2 // q

    def product(lo: int, hi: int) -> None:
        here = slice(starts[lo], starts[hi] if hi < len(starts) else len(row))
        levels, column = np.unique(count[here] * len(names) + group[here], return_inverse=True)
        if len(levels) > columns and hi - lo > 1:
            product(lo, (lo + hi) // 2)
            product((lo + hi) // 2, hi)
            return
        g = levels % len(names)
        p = np.array([1 + SCALE * (n + 1) // size[s] for s, n in zip(g.tolist(), (levels // len(names)).tolist())], np.int64)
        x = np.zeros((hi - lo, len(g)), np.float32)
        x[row[here] - lo, column] = 1
        joint = x.T @ x
        i, j = np.nonzero(joint)
        apart = g[i] != g[j]
        i, j = i[apart], j[apart]
        zi, zj = p0[g[i]], p0[g[j]]
        change = price(p[i], p[j]) - price(p[i], zj) - price(zi, p[j]) + price(zi, zj)
        np.add.at(out, (g[i], g[j]), joint[i, j].astype(np.int64) * change)
        alone = np.diag(joint).astype(np.int64)[:, None]
        none = price(p0[g][:, None], p0[None, :])
        np.add.at(out, g, alone * (price(p[:, None], p0[None, :]) - none))
        none = price(p0[None, :], p0[g][:, None])
        np.add.at(out.T, g, alone * (price(p0[None, :], p[:, None]) - none))

    if len(starts):
        product(0, len(starts))
    mine = tile[:, None] != tile[None, :] if a != b else ~np.eye(len(names), dtype=bool)
    i, j = np.nonzero(mine)
    named = np.array(names, object)
    return pa.table({
        "lang": pa.array([lang] * len(i), pa.string()), "source": pa.array(named[i], pa.string()),
        "item": pa.array(named[j], pa.string()), "value": pa.array(out[i, j], pa.int64()),
    })


def _tile(name):
    return F.pmod(F.xxhash64(name), F.col("tiles")).cast("int")


def pair_prices(vectors: DataFrame, groups: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of a language's
    sources.  ``groups``: (lang, source, size, kept, tiles, blocks)."""
    of_lang = groups.groupBy("lang").agg(F.max("tiles").alias("tiles"), F.max("blocks").alias("blocks"))
    pairs = F.expr("flatten(transform(sequence(0, tiles - 1), a -> transform(sequence(a, tiles - 1), b -> struct(a, b))))")
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    left = (
        vectors.join(of_lang, "lang")
        .select("lang", block.alias("block"), "total", "tiles", "counts", F.explode(pairs).alias("t"))
        .withColumn("counts", F.filter("counts", lambda x: _tile(x["source"]).isin(F.col("t.a"), F.col("t.b"))))
        .filter(F.size("counts") > 0)
        .select("lang", "block", F.col("t.a").alias("a"), F.col("t.b").alias("b"), "total", "counts")
    )
    right = (
        groups.filter("kept > 0").withColumn("tile", _tile("source"))
        .withColumn("t", F.explode(pairs))
        .filter((F.col("tile") == F.col("t.a")) | (F.col("tile") == F.col("t.b")))
        .withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("lang", "block", F.col("t.a").alias("a"), F.col("t.b").alias("b"), "source", "tile", "size")
    )
    keys = ["lang", "block", "a", "b"]

    def sums_of(key, rows, sources):
        return _block_sums(key, rows, sources, columns)

    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(sums_of, "lang string, source string, item string, value bigint")
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    zero = groups.select("lang", "source", "kept", F.when(F.col("kept") > 0, _share("0", "size")).alias("p"))
    other = zero.select("lang", F.col("source").alias("item"), F.col("p").alias("q"))
    every = zero.join(other, "lang").filter(F.col("source") != F.col("item"))  # the rows of the result
    base = F.when(F.col("kept") > 0, F.expr("kept * ((p - q) * (p - q) div q)")).otherwise(F.lit(0).cast("bigint"))
    return every.withColumn("base", base).join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", (F.col("base") + F.coalesce("value", F.lit(0).cast("bigint"))).alias("value"))


def audit(docs: DataFrame, top_terms: int = TOP_TERMS, columns: int = COLUMNS, run: int = RUN) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source lies from
    the other sources of its language, and its most overused terms."""
    vectors = written(term_vectors(docs, run=run), "audit-vectors")
    of_lang = vectors.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_n"))
    held = vectors.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("n"))
    names = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")
    ).distinct()
    sources = names.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    zero = F.lit(0).cast("bigint")
    groups = (
        names.join(held, ["lang", "source"], "left").join(of_lang, "lang", "left").join(sources, "lang")
        .select(
            "lang", "source",
            F.coalesce("kept", zero).alias("kept"),
            (F.coalesce("n", zero) + F.coalesce("kept", zero)).alias("size"),
            (F.coalesce("lang_n", zero) + F.coalesce("kept", zero)).alias("lang_size"),
            F.ceil(F.col("sources") / TILE).cast("int").alias("tiles"),
            F.greatest(F.ceil(F.coalesce("kept", zero) / BLOCK), F.lit(1).cast("bigint")).alias("blocks"),
        )
    )
    groups = written(groups, "audit-groups")

    terms = (
        vectors.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", "c.source", "term", "total", "c.n")
        .join(groups.select("lang", "source", "size", "lang_size"), ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), _share("n", "size").alias("p"), _share("total", "lang_size").alias("q"))
        .filter("p > q")
        .select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    terms = terms.withColumn("rank", rank).filter(F.col("rank") <= top_terms)
    pairs = pair_prices(vectors, groups, columns).withColumn("rank", rank)
    return (
        pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
        .select("lang", "source", "part", "item", "value", "rank")
    )


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST_DOCS}),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + {SCALE} * (coalesce(c.c, 0) + 1) // (g.n + l.v) AS p,
    1 + {SCALE} * (k.total + 1) // (l.n + l.v) AS q
  FROM g JOIN l USING (lang) JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
found AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
