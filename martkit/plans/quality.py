"""Quality rules and dense surrogate keys on the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.keys import dense_keys
from ..sources.tables import table

# Allowed codes of the TPC-H-style tables and of the events.
ORDER_STATUS = ["F", "O", "P"]
RETURN_FLAG = ["A", "N", "R"]
LINE_STATUS = ["F", "O"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
EVENT_TYPES = ["view", "click", "signup", "purchase", "error"]
NAME_MAX = 25
# Customers that ordered before this date already have keys.
KEYED_BEFORE = "1998-01-01"

FOREIGN_KEYS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]
DOMAINS = [
    ("orders", "o_orderstatus", ORDER_STATUS),
    ("lineitem", "l_returnflag", RETURN_FLAG),
    ("lineitem", "l_linestatus", LINE_STATUS),
    ("customer", "c_mktsegment", SEGMENTS),
    ("events", "event_type", EVENT_TYPES),
]
NOT_NULL_TABLES = ["orders", "lineitem", "customer"]


def foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    """(rule, severity, n_bad) of all references, every table read once."""
    references = [(f"fk {c}.{fk} -> {p}.{pk}", c, fk, p, pk) for c, fk, p, pk in FOREIGN_KEYS]
    tables = {t: table(spark, d, t) for r in references for t in (r[1], r[3])}
    return q.reference_counts(references, tables).select("rule", F.lit(q.ERROR).alias("severity"), "n_bad")


def _bad_domain(col: str, allowed: list[str]) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(*allowed)


def _bad_bound(ok: Column) -> Column:
    """Null counts as a violation."""
    return ~F.coalesce(ok, F.lit(False))


def domain_rules() -> list[tuple[str, str, str, Column]]:
    """(table, rule, severity, column that is true for a bad row)."""
    return [(t, f"domain {t}.{c}", q.WARNING, _bad_domain(c, vals)) for t, c, vals in DOMAINS]


def bound_rules() -> list[tuple[str, str, str, Column]]:
    return [
        ("lineitem", "bounds lineitem.l_discount in [0, 0.1]", q.WARNING, _bad_bound(F.col("l_discount").between(0, 0.1))),
        ("lineitem", "bounds lineitem.l_quantity in [1, 50]", q.WARNING, _bad_bound(F.col("l_quantity").between(1, 50))),
        ("customer", f"bounds customer.c_name length <= {NAME_MAX}", q.WARNING, _bad_bound(F.length("c_name") <= NAME_MAX)),
        ("lineitem", "bounds lineitem.l_extendedprice fits decimal(9,2)", q.WARNING, _bad_bound(q.fits_decimal("l_extendedprice", 9, 2))),
        ("part", "bounds part.p_retailprice fits decimal(6,2)", q.WARNING, _bad_bound(q.fits_decimal("p_retailprice", 6, 2))),
    ]


def not_null_rules(spark: SparkSession, d: str) -> list[tuple[str, str, str, Column]]:
    out = []
    for t in NOT_NULL_TABLES:
        bad = F.lit(False)
        for c in table(spark, d, t).columns:
            bad = bad | F.col(c).isNull()
        out.append((t, f"not null {t}", q.ERROR, bad))
    return out


def row_rules(spark: SparkSession, d: str, rules: list[tuple[str, str, str, Column]]) -> DataFrame:
    """The counts of row rules: each table is scanned once for all of its own."""
    out = None
    for t in dict.fromkeys(r[0] for r in rules):
        part = q.count_rows(table(spark, d, t), [r[1:] for r in rules if r[0] == t])
        out = part if out is None else out.unionByName(part)
    return out


def unique_rules(spark: SparkSession, d: str):
    return [
        ("unique lineitem(l_orderkey, l_linenumber)", q.ERROR,
         q.unique_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])),
        ("unique orders(o_orderkey)", q.ERROR, q.unique_violations(table(spark, d, "orders"), ["o_orderkey"])),
        ("unique customer(c_custkey)", q.ERROR, q.unique_violations(table(spark, d, "customer"), ["c_custkey"])),
    ]


def not_null(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for t in NOT_NULL_TABLES:
        part = q.null_counts(table(spark, d, t)).select(F.lit(t).alias("table_name"), "column_name", "null_count")
        out = part if out is None else out.unionByName(part)
    return out


def dq_report(spark: SparkSession, d: str) -> DataFrame:
    """References share one pass, the row rules of a table one scan."""
    row = not_null_rules(spark, d) + domain_rules() + bound_rules()
    return q.summarize(unique_rules(spark, d)).unionByName(foreign_keys(spark, d)).unionByName(row_rules(spark, d, row))


def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Dense customer keys in name order; customers that ordered before
    ``KEYED_BEFORE`` were keyed first, the rest continue after the maximum."""
    cust = table(spark, d, "customer").select("c_custkey", "c_name")
    early = table(spark, d, "orders").filter(F.col("o_orderdate") < F.lit(KEYED_BEFORE).cast("timestamp_ntz"))
    old = cust.join(early.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    keyed = dense_keys(old, ["c_name", "c_custkey"], "customer_key")
    top = keyed.agg(F.max("customer_key")).first()[0] or 0
    new = dense_keys(cust.join(old, "c_custkey", "left_anti"), ["c_name", "c_custkey"], "customer_key", start=top + 1)
    return keyed.unionByName(new).select("customer_key", "c_custkey", "c_name")


QUERIES = {
    "surrogate_keys": surrogate_keys,
    "dq_unique": lambda sp, d: q.unique_violations(table(sp, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "dq_foreign_key": foreign_keys,
    "dq_not_null": not_null,
    "dq_domain": lambda sp, d: row_rules(sp, d, domain_rules()),
    "dq_bounds": lambda sp, d: row_rules(sp, d, bound_rules()),
    "dq_report": dq_report,
}

# ---------------------------------------------------------------- oracle


def _in(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def _fk_sql(sev: bool = False) -> list[str]:
    s = ", 'ERROR' AS severity" if sev else ""
    return [
        f"SELECT 'fk {c}.{fk} -> {p}.{pk}' AS rule{s}, count(*) AS n_bad FROM {c} WHERE {fk} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{pk} = {c}.{fk})"
        for c, fk, p, pk in FOREIGN_KEYS
    ]


def _domain_sql(sev: bool = False) -> list[str]:
    s = ", 'WARNING' AS severity" if sev else ""
    return [
        f"SELECT 'domain {t}.{c}' AS rule{s}, count(*) AS n_bad FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN ({_in(v)})"
        for t, c, v in DOMAINS
    ]


def _bounds_sql(sev: bool = False) -> list[str]:
    s = ", 'WARNING' AS severity" if sev else ""
    return [
        f"SELECT 'bounds lineitem.l_discount in [0, 0.1]' AS rule{s}, count(*) AS n_bad FROM lineitem WHERE NOT coalesce(l_discount BETWEEN 0 AND 0.1, false)",
        f"SELECT 'bounds lineitem.l_quantity in [1, 50]'{s}, count(*) FROM lineitem WHERE NOT coalesce(l_quantity BETWEEN 1 AND 50, false)",
        f"SELECT 'bounds customer.c_name length <= {NAME_MAX}'{s}, count(*) FROM customer WHERE NOT coalesce(length(c_name) <= {NAME_MAX}, false)",
        f"SELECT 'bounds lineitem.l_extendedprice fits decimal(9,2)'{s}, count(*) FROM lineitem WHERE NOT (l_extendedprice IS NULL OR TRY_CAST(l_extendedprice AS DECIMAL(9,2)) IS NOT NULL)",
        f"SELECT 'bounds part.p_retailprice fits decimal(6,2)'{s}, count(*) FROM part WHERE NOT (p_retailprice IS NULL OR TRY_CAST(p_retailprice AS DECIMAL(6,2)) IS NOT NULL)",
    ]


_NN = {
    "orders": "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
    "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate",
    "customer": "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment",
}


def _nn_sql() -> str:
    parts = []
    for t, cols in _NN.items():
        for c in cols.split(", "):
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {t}")
    return "\nUNION ALL ".join(parts)


def _nn_report() -> list[str]:
    return [
        f"SELECT 'not null {t}' AS rule, 'ERROR' AS severity, count(*) AS n_bad FROM {t} WHERE "
        + " OR ".join(f"{c} IS NULL" for c in cols.split(", "))
        for t, cols in _NN.items()
    ]


_UNIQUE_REPORT = [
    "SELECT 'unique lineitem(l_orderkey, l_linenumber)' AS rule, 'ERROR' AS severity, count(*) AS n_bad FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)",
    "SELECT 'unique orders(o_orderkey)', 'ERROR', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY ALL HAVING count(*) > 1)",
    "SELECT 'unique customer(c_custkey)', 'ERROR', count(*) FROM (SELECT c_custkey FROM customer GROUP BY ALL HAVING count(*) > 1)",
]

ORACLE = {
    "surrogate_keys": f"""WITH old AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
  (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{KEYED_BEFORE} 00:00:00')),
k AS (SELECT CAST(row_number() OVER (ORDER BY c_name, c_custkey) AS BIGINT) AS customer_key, c_custkey, c_name FROM old)
SELECT * FROM k UNION ALL
SELECT CAST((SELECT coalesce(max(customer_key), 0) FROM k) + row_number() OVER (ORDER BY c_name, c_custkey) AS BIGINT), c_custkey, c_name
FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM old)""",
    "dq_unique": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "dq_foreign_key": "\nUNION ALL ".join(_fk_sql(True)),
    "dq_not_null": _nn_sql(),
    "dq_domain": "\nUNION ALL ".join(_domain_sql(True)),
    "dq_bounds": "\nUNION ALL ".join(_bounds_sql(True)),
    "dq_report": "\nUNION ALL ".join(_UNIQUE_REPORT + _fk_sql(True) + _nn_report() + _domain_sql(True) + _bounds_sql(True)),
}
