"""Tables whose parts are replaced all at once.

``Versions`` keeps a group of Parquet tables below one folder.  Every commit
writes the parts it replaces (one per period, say) to folders of its own and
then puts one small pointer file in place, which names the folder of every part
of every table and a few notes (the last key, the last batch).  Readers resolve
the newest pointer once and read the folders it names, so they see all of a
commit or nothing of it, and parts that a commit does not touch are referenced,
not copied.  A commit that fails leaves the pointer as it is; two commits upon
the same version conflict, and the second fails.  Nothing is overwritten;
``remove_old`` deletes what the newest pointers no longer name.

The pointer has one entry per table and part; parts are periods, so it is as
long as the calendar.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import TABLE_CODEC

_PART = "_version_part"
#: Most shuffle partitions of a write by parts, before small ones are merged.
DEALT = 500


class Conflict(RuntimeError):
    """Another commit was made upon the same version."""


@dataclass
class Pointer:
    """One committed state: folders by table and part, and notes."""

    version: int = -1
    folders: dict[str, dict[str, str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ pointers

    def _at(self, place: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _place(self, *parts: str):
        return self._at("/".join([self.root, *parts]))

    def _pointers(self) -> list[int]:
        fs, path = self._place("pointers")
        if not fs.exists(path):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def at(self, version: int) -> Pointer:
        fs, path = self._place("pointers", f"{version:010d}.json")
        stream = fs.open(path)
        try:
            raw = bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        return Pointer(**json.loads(raw.decode("utf-8")))

    def current(self) -> Pointer:
        known = self._pointers()
        return self.at(known[-1]) if known else Pointer()

    # ------------------------------------------------------------ reading

    def read(self, table: str, schema, parts: Iterable[str] | None = None, pointer: Pointer | None = None) -> DataFrame:
        """The rows of a table, or of some of its parts, in one state."""
        folders = (pointer or self.current()).folders.get(table, {})
        wanted = folders if parts is None else {p: folders[p] for p in parts if p in folders}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*wanted.values())

    @staticmethod
    def changed_parts(table: str, before: Pointer, after: Pointer) -> list[str]:
        """The parts that differ between two states."""
        old, new = before.folders.get(table, {}), after.folders.get(table, {})
        return sorted(p for p in {*old, *new} if old.get(p) != new.get(p))

    # ------------------------------------------------------------ writing

    def stage(self, upon: Pointer, tables: dict[str, tuple[DataFrame, Column]], parts: Iterable[str]) -> Pointer:
        """Write ``parts`` of the tables; ``tables`` gives for each its rows in
        these parts and the column that names a row's part.  The returned
        state can be read, but is no version before ``publish``."""
        parts = list(parts)
        folders = {t: dict(f) for t, f in upon.folders.items()}
        for name, (rows, part) in tables.items():
            place = f"{self.root}/data/{name}/{upon.version + 1:010d}-{uuid.uuid4().hex[:8]}"
            # A part is one file, or as many as its size asks for.
            dealt = min(DEALT, 4 * max(1, len(parts)))
            rows.withColumn(_PART, part).hint("rebalance", dealt, F.col(_PART)).write.partitionBy(_PART).parquet(place, compression=TABLE_CODEC)
            fs, path = self._at(place)
            found = {f.getPath().getName().partition("=")[2]: f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()}
            held = folders.setdefault(name, {})
            for p in parts:
                held.pop(p, None)
            if extra := set(found) - set(parts):
                raise ValueError(f"{name} has rows in parts that the commit does not name: {sorted(extra)[:3]}")
            held.update({p: f"{place}/{folder}" for p, folder in found.items()})
        return Pointer(upon.version + 1, folders, dict(upon.notes))

    def commit(self, upon: Pointer, tables: dict[str, tuple[DataFrame, Column]], parts: Iterable[str], notes: dict | None = None) -> Pointer:
        staged = self.stage(upon, tables, parts)
        staged.notes.update(notes or {})
        return self.publish(staged)

    def publish(self, pointer: Pointer) -> Pointer:
        """Make a staged state the newest version: its pointer file appears
        whole or not at all, and only once."""
        fs, draft = self._place("pointers", f".draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(vars(pointer)).encode("utf-8")))
        out.close()
        _, path = self._place("pointers", f"{pointer.version:010d}.json")
        if fs.exists(path) or not fs.rename(draft, path):
            fs.delete(draft, False)
            raise Conflict(f"version {pointer.version} of {self.root} is there already")
        return pointer

    def fork(self, root: str, pointer: Pointer) -> Versions:
        """A group of its own that starts from a state of this one."""
        other = Versions(self.spark, root)
        other.publish(pointer)
        return other

    def remove_old(self, keep: int = 1) -> list[str]:
        """Delete the folders that none of the ``keep`` newest pointers names,
        and the older pointers; returns the folders."""
        known = self._pointers()
        named = {f for v in known[-keep:] for t in self.at(v).folders.values() for f in t.values()}
        older = {f for v in known[:-keep] for t in self.at(v).folders.values() for f in t.values()}
        for v in known[:-keep]:
            fs, path = self._place("pointers", f"{v:010d}.json")
            fs.delete(path, False)
        gone = sorted(f for f in older - named if f.startswith(f"{self.root}/"))  # not those of a group it was forked from
        for folder in gone:
            fs, path = self._at(folder)
            fs.delete(path, True)
        return gone


def parts_of(rows: DataFrame, part: Column) -> list[str]:
    """The parts that rows lie in: one value per period, as many as the
    calendar has."""
    return sorted(r[0] for r in rows.select(part.cast("string").alias("p")).distinct().collect() if r[0] is not None)
