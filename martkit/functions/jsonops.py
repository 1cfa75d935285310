"""JSON document operators on string columns, from built-ins only.

* ``has_key``    - ``j ? 'k'``
* ``member``     - ``j -> 'k'`` (the member's JSON text)
* ``each_text``  - ``jsonb_each_text(j)``: one row per (key, value text)
* ``nest``       - rows (section, item, price) back to one JSON object

An object whose members have different types is parsed as
``map<string,string>`` (nested objects stay JSON text), because a typed
``map<string,map<...>>`` turns a mixed document into null as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def has_key(j: Column | str, key: str) -> Column:
    return F.array_contains(F.json_object_keys(_c(j)), key)


def member(j: Column | str, key: str) -> Column:
    return F.get_json_object(_c(j), _path(key))


def as_text_map(j: Column | str) -> Column:
    return F.from_json(_c(j), "map<string,string>")


def each_text(df: DataFrame, j: Column | str, key_col: str = "jk", value_col: str = "jv") -> DataFrame:
    """Lateral ``jsonb_each_text``: inner semantics (null/empty -> no rows)."""
    return df.select("*", F.explode(as_text_map(j)).alias(key_col, value_col))


def nest(rows: DataFrame, group: list[str], key_col: str, value_col: str, out: str) -> DataFrame:
    """Inverse of ``each_text`` for one level: rows -> JSON object text."""
    return rows.groupBy(*group).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct(key_col, value_col)))).alias(out)
    )
