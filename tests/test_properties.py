"""Property tests: Spark operators against brute-force Python on random
small inputs."""

from decimal import ROUND_HALF_UP, Decimal

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martkit.functions import text as tx
from martkit.functions.numeric import div_round
from martkit.operators.keys import dense_keys, keep_first

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_div_round_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.q for r in df.select(div_round("n", "d").alias("q")).collect()]
    want = [int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert got == want


@SETTINGS
@given(st.sets(st.tuples(st.integers(0, 50), st.text("abc", max_size=3)), min_size=1, max_size=60),
       st.integers(1, 6), st.integers(1, 1000))
def test_dense_keys_match_sorted_enumeration(spark, rows, parts, start):
    df = spark.createDataFrame(sorted(rows, key=hash), "a int, b string")
    got = {(r.a, r.b): r.k for r in dense_keys(df, ["a", "b"], "k", start=start, num_partitions=parts).collect()}
    assert got == {row: start + i for i, row in enumerate(sorted(rows))}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 100), st.integers(0, 100)), min_size=1, max_size=60))
def test_keep_first_matches_python_min(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    got = {r.k: (r.o, r.v) for r in keep_first(df, ["k"], ["o", "v"]).collect()}
    want = {}
    for k, o, v in rows:
        want[k] = min(want.get(k, (o, v)), (o, v))
    assert got == want


_WORD = st.text("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", min_size=1, max_size=6)
_NAME = st.builds(
    lambda pre, words, suf: " ".join(([pre] if pre else []) + words + ([suf] if suf else [])),
    st.sampled_from([None, *tx.PREFIX_TITLES]), st.lists(_WORD, min_size=1, max_size=3),
    st.sampled_from([None, *tx.SUFFIX_TITLES]),
)


def _py_parse(n):
    """Take titles off the ends of the word list, then read what is left."""
    words, opening, closing = n.split(), None, None
    if len(words) > 1 and words[0] in tx.PREFIX_TITLES:
        opening = words.pop(0)
    if len(words) > 1 and words[-1] in tx.SUFFIX_TITLES:
        closing = words.pop()
    family = words[-1] if closing or len(words) == 1 else words[1]
    return opening or closing, words[0], family


@SETTINGS
@given(st.lists(_NAME, min_size=1, max_size=30))
def test_person_parser_matches_python_and_oracle(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [(r.t, r.f, r.l) for r in df.select(
        tx.person_title("n").alias("t"), tx.first_name("n").alias("f"), tx.last_name("n").alias("l")).collect()]
    assert got == [_py_parse(n) for n in names]
    sql = ", ".join(parse("n") for parse in (tx.sql_person_title, tx.sql_first_name, tx.sql_last_name))
    rows = duckdb.connect().execute(f"SELECT {sql} FROM (SELECT unnest(?) AS n)", [names]).fetchall()
    assert rows == got
