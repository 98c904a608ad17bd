"""A table of rows by id that takes additions, replacements and deletions.

Every change is a Parquet folder of its own and becomes part of the collection by a row in the
table of commits, which is written last. What was written before a failure and not committed is
never read. Reading puts the changes since the last compaction over the rows compacted then, by
joins on the id; the compacted rows are not shuffled while the changed ids are few enough for
Spark to broadcast.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators import gates
from reviewloom.operators.dedupe import keep_one
from reviewloom.sources import tables

BASE, ADDED, DELETED = "base", "added", "deleted"


class Commit(NamedTuple):
    number: int
    kind: str
    folder: str


class Collection:
    """Rows by ``key`` below ``path``, a folder that all executors share. One writer at a time;
    readers at any time."""

    def __init__(self, spark: SparkSession, path: str, key: str = "review_id") -> None:
        self.spark, self.path, self.key = spark, path, key

    def commits(self) -> list[Commit]:
        """The commits that count: the last compaction and what came after. Compacting keeps them few."""
        table = tables.read_if_there(self.spark, f"{self.path}/commits")
        if table is None:
            return []
        last = table.where(F.col("kind") == BASE).agg(F.max("number")).first()[0]
        rows = table if last is None else table.where(F.col("number") >= last)
        return sorted(Commit(*r) for r in rows.select("number", "kind", "folder").collect())

    def add(self, rows: DataFrame) -> None:
        """Add rows; one whose id is there replaces the row there. Of rows of one id the first in
        the order of their columns is taken. A null id is an error, and nothing is added."""
        order = [c for c in rows.columns if c != self.key]
        self._commit(ADDED, keep_one(rows, [self.key], order or [self.key]))

    def delete(self, ids: DataFrame) -> None:
        """Delete the rows of these ids; ids that are not there are passed over."""
        self._commit(DELETED, ids.select(self.key).distinct())

    def compact(self) -> None:
        """Put all changes into one table. Folders before it are left for readers; ``expired``
        names them."""
        rows = self.rows()
        if rows is not None:
            self._commit(BASE, rows)

    def rows(self) -> DataFrame | None:
        """The rows as of now, or None where nothing was ever added."""
        commits = self.commits()
        read = {c: tables.read_table(self.spark, c.folder) for c in commits}
        held = [c for c in commits if c.kind != DELETED]
        if not held:
            return None
        base = next((read[c] for c in held if c.kind == BASE), None)
        changes = [c for c in commits if c.kind != BASE]
        if not changes:
            return base
        last = None
        for c in changes:
            ids = read[c].select(self.key, F.lit(c.number).alias("number"), F.lit(c.kind == DELETED).alias("gone"))
            last = ids if last is None else last.unionAll(ids)
        last = last.groupBy(self.key).agg(F.max("number").alias("number"), F.max_by("gone", "number").alias("gone"))
        live = last.where("NOT gone").drop("gone")
        out = None if base is None else base.join(last, self.key, "left_anti")
        for c in changes:
            if c.kind == ADDED:
                now = read[c].join(live.where(F.col("number") == c.number).select(self.key), self.key, "left_semi")
                out = now if out is None else out.unionByName(now, allowMissingColumns=True)
        return out

    def expired(self) -> list[str]:
        """Folders of commits that no reader needs who starts now."""
        table = tables.read_if_there(self.spark, f"{self.path}/commits")
        if table is None:
            return []
        now = {c.folder for c in self.commits()}
        return sorted(r.folder for r in table.select("folder").collect() if r.folder not in now)

    def _commit(self, kind: str, rows: DataFrame) -> None:
        """Write rows, look at what was written, and only then make it count."""
        before = self.commits()
        folder = f"{self.path}/rows/{uuid.uuid4().hex}"
        tables.write_table(rows, folder)
        if not tables.read_table(self.spark, folder).where(F.col(self.key).isNull()).isEmpty():
            raise gates.GateError(f"{self.key} is null in rows to be {kind}")
        number = before[-1].number + 1 if before else 0
        row = self.spark.createDataFrame([Commit(number, kind, folder)], "number long, kind string, folder string")
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
