"""Increment bookkeeping for marts fed by a high-water mark.

* ``read_mark``        - ``coalesce(max(load_dttm), floor)`` as one scalar
* ``changed_rows``     - rows whose own load time, or a referenced
  dimension row's load time, is newer than the mark, found in one scan of
  the fact against the changed keys
* ``split_keys``       - affected keys -> existing / new (semi / anti join)
* ``next_mark``        - greatest of the delta's load times; unchanged
  when the delta is empty (a clock value would skip late rows)
* ``apply_keyed``      - new table state: untouched rows + recomputed rows
  (known ones keep their ids, new ones continue after the maximum)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeutil import ntz
from .keys import dense_keys

MARK_FLOOR = dt.datetime(1900, 1, 1)


def read_mark(marks: DataFrame | None, col: str = "load_dttm") -> dt.datetime:
    if marks is None:
        return MARK_FLOOR
    v = marks.agg(F.max(col)).first()[0]
    return v or MARK_FLOOR


def changed_rows(
    fact: DataFrame,
    fact_load: str,
    mark: dt.datetime,
    dims: Sequence[tuple[DataFrame, str, str]],
    joined: bool = False,
) -> DataFrame:
    """Fact rows newer than ``mark`` or pointing at a dimension row newer
    than ``mark``.  ``dims`` = (dimension, its unique key column, load column).

    One scan of the fact: each dimension's changed keys (one column, a part
    of the dimension) mark the rows by a left join, and one filter follows.
    ``joined``: the rows come with the columns of their dimension rows, and
    rows that lack one are left out; one join per dimension then serves both
    (its load column needs a name of its own).
    """
    m = ntz(mark)
    if joined:
        out, changed = fact, F.col(fact_load) > m
        for dim, key, load in dims:
            out, changed = out.join(dim, key), changed | (F.col(load) > m)
        return out.filter(changed)
    out, changed = fact, F.col(fact_load) > m
    for i, (dim, key, load) in enumerate(dims):
        flag = f"_changed{i}"
        out = out.join(dim.filter(F.col(load) > m).select(key, F.lit(True).alias(flag)), key, "left")
        changed = changed | F.col(flag).isNotNull()
    return out.filter(changed).select(*fact.columns)


def split_keys(affected: DataFrame, existing: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    ek = existing.select(*keys)
    return affected.join(ek, list(keys), "left_semi"), affected.join(ek, list(keys), "left_anti")


def next_mark(delta: DataFrame, load_cols: Sequence[str], current: dt.datetime) -> dt.datetime:
    row = delta.agg(*[F.max(c).alias(c) for c in load_cols]).first()
    vals = [row[c] for c in load_cols if row[c] is not None]
    return max(vals) if vals else current


def with_known_id(rows: DataFrame, table: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """``rows`` with the id that ``table`` has for their key, else null."""
    return rows.join(table.select(*keys, id_col), list(keys), "left")


def apply_keyed(table: DataFrame, rows: DataFrame, keys: Sequence[str], id_col: str, last: int) -> DataFrame:
    """One new version of a keyed table (read the old, write the new).
    ``rows`` carry their known id or null (``with_known_id``); new ids go on
    after ``last``."""
    cols = table.columns
    untouched = table.join(rows.select(*keys), list(keys), "left_anti")
    top = last
    new = rows.filter(F.col(id_col).isNull()).drop(id_col)
    inserted = dense_keys(new, list(keys), id_col, start=top + 1)
    updated = rows.filter(F.col(id_col).isNotNull())
    return untouched.select(*cols).unionByName(updated.select(*cols)).unionByName(inserted.select(*cols))
