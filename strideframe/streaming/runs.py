"""Tables of a streaming job whose rows can be merged: one run of files a batch, folded into larger runs.

`FAN` runs of one level become one run of the next, so a table of n batches has at most (FAN - 1) runs of each of log(n) levels and a
row is rewritten once a level. A batch reads the runs it folds and nothing else. What the table is made of stands in a
manifest for each batch, written last by one rename: after a crash at any point a reader sees the manifest before, and the batch
that runs again writes the same runs over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.sources.objects import ObjectStore

FAN = 8
KEPT = 2                    # manifests, and the runs they name, that stay for readers that have opened them


class Runs:
    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN):
        self.spark, self.path, self.schema, self.merge, self.fan = spark, path, schema, merge, fan
        self.store = ObjectStore(spark, path)

    def _manifests(self) -> list[int]:
        return sorted(int(k.split("/")[1].removesuffix(".json")) for k in self.store.keys("manifests") if k.endswith(".json"))

    def _runs(self, before: int | None = None) -> list:
        """[level, first batch, last batch] of each run in the newest manifest (of an earlier batch than `before`)."""
        known = [n for n in self._manifests() if before is None or n < before]
        return self.store.read_json(f"manifests/{known[-1]:09d}.json") if known else []

    def _name(self, run) -> str:
        return f"{self.path}/runs/{run[1]:09d}-{run[2]:09d}"

    def _cast(self, rows: DataFrame) -> DataFrame:
        want = self.spark.createDataFrame([], self.schema).schema
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in want.fields])

    def _open(self, runs) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._name(r) for r in runs])

    def rows(self) -> DataFrame:
        """Rows of all live runs; `merge` of them is the table."""
        return self._open(self._runs())

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Store a batch and fold runs. A batch that is in the table already is left as it is."""
        done = self._manifests()
        if done and done[-1] >= batch_id:
            return
        runs = self._runs(batch_id)
        new = [0, batch_id, batch_id]
        self._cast(rows).write.mode("overwrite").parquet(self._name(new))
        runs.append(new)
        made = [new]
        while len(runs) >= self.fan and len({r[0] for r in runs[-self.fan:]}) == 1:
            group = runs[-self.fan:]
            whole = [group[0][0] + 1, group[0][1], group[-1][2]]
            self._cast(self.merge(self._open(group))).write.mode("overwrite").parquet(self._name(whole))
            runs = [*runs[:-self.fan], whole]
            made.append(whole)
        self.store.put_json(f"manifests/{batch_id:09d}.json", runs)
        for r in made:
            if r not in runs:                           # folded at once, so no manifest names it
                self.store.delete(self._name(r).removeprefix(f"{self.path}/"))
        self._clean(batch_id)

    def _clean(self, batch_id: int) -> None:
        """Remove manifests that no reader has open any more, and the runs that only they name."""
        known = self._manifests()
        live, old = known[-KEPT:], known[:-KEPT]
        named = lambda ns: {tuple(r[1:]) for n in ns for r in self.store.read_json(f"manifests/{n:09d}.json")}
        for first, last in named(old) - named(live):
            self.store.delete(f"runs/{first:09d}-{last:09d}")
        for n in old:
            self.store.delete(f"manifests/{n:09d}.json")
