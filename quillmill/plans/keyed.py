"""A result table by key: rows lie in hash buckets, and a merge rewrites only the buckets it touches.

Each state of the table is a manifest, which names the folder of every bucket, the last batch of every writer and how many rows were merged so far. A merge writes
new folders and then one manifest more, by a rename; readers see the state before or after it, and what a failed job has left is named by
no manifest. A batch that a writer has merged before changes nothing, so a job or a stream may repeat its last one. Of several rows of a key the best
stays, by columns of the caller's: the newest, or the one with more results, so that a retry that did worse does not replace what it retried.

A key's rows are reduced where they are before they are shuffled, keys are spread over buckets by hash, and the driver holds no more than a manifest of so many buckets.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import store
from .incremental import newest

BUCKET = "_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """better: columns of the rows, the most telling first, by which a key's best row is chosen; rows that tie in all are told apart by a hash of their contents."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    better: tuple[str, ...] = ()
    buckets: int = 64

    def state(self) -> dict:
        """The last manifest; of a table that is not there yet, an empty one."""
        found = [n for n in store.names(self.spark, f"{self.path}/_manifest") if not n.startswith(".")]
        if not found:
            return {"version": 0, "schema": None, "n_buckets": self.buckets, "buckets": {}, "writers": {}, "n_merged": 0}
        return json.loads(store.read_text(self.spark, f"{self.path}/_manifest/{found[-1]}"))

    def read(self, state: dict | None = None, only: set[str] | None = None) -> DataFrame:
        """The table's rows; of some buckets only, if asked for."""
        state = state or self.state()
        if state["schema"] is None:
            raise FileNotFoundError(f"no table at {self.path}")
        schema = T.StructType.fromJson(state["schema"])
        paths = [f"{self.path}/{p}" for b, p in sorted(state["buckets"].items()) if only is None or b in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _best(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in sorted(rows.columns) if c not in self.keys]
        order: list[Column] = [*map(F.col, self.better), F.xxhash64(F.to_json(F.struct(*rest)))] if rest else [F.lit(0)]
        return newest(rows, list(self.keys), order) if rest else rows.distinct()

    def _written(self, rows: DataFrame, folder: str) -> dict[str, str]:
        """One folder for each bucket that rows touch."""
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        return {n.partition("=")[2]: f"{folder}/{n}" for n in store.names(self.spark, f"{self.path}/{folder}") if n.startswith(f"{BUCKET}=")}

    def merge(self, rows: DataFrame, writer: str | None = None, batch: int | None = None) -> int:
        """Merges rows and gives how many there were; none if this writer has merged this batch, or a later one, before."""
        state = self.state()
        if writer is not None and state["writers"].get(writer, -1) >= batch:
            return 0
        seen, new = Observation(), f"data-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(state["n_buckets"])).cast("int")
        fresh = self._best(rows.observe(seen, F.count(F.lit(1)).alias("n"))).withColumn(BUCKET, bucket)
        columns = [c for c in fresh.columns if c != BUCKET]
        if state["schema"] is None:
            touched = self._written(fresh, new)
        else:
            draft = f"draft-{uuid.uuid4().hex}"
            came = self._written(fresh, draft)
            if came:
                both = self.spark.read.schema(fresh.select(columns).schema).parquet(*(f"{self.path}/{p}" for p in came.values())).unionByName(self.read(state, set(came)), allowMissingColumns=True)
                touched = self._written(self._best(both).withColumn(BUCKET, bucket), new)
            else:
                touched = {}
            store.remove(self.spark, f"{self.path}/{draft}")
        held = {T.StructField(f.name, f.dataType, True) for f in fresh.select(columns).schema} | set(() if state["schema"] is None else T.StructType.fromJson(state["schema"]))
        schema = T.StructType(sorted(held, key=lambda f: f.name))
        n = seen.get["n"]
        after = {**state, "version": state["version"] + 1, "schema": schema.jsonValue(), "buckets": {**state["buckets"], **touched}, "n_merged": state["n_merged"] + n}
        after["writers"] = {**state["writers"], **({} if writer is None else {writer: batch})}
        if not store.create(self.spark, f"{self.path}/_manifest/{after['version']:020d}.json", json.dumps(after)):
            store.remove(self.spark, f"{self.path}/{new}")
            raise RuntimeError(f"another writer has changed {self.path} meanwhile; merge again")
        return n

    def vacuum(self) -> None:
        """Removes older manifests and the folders that the last does not name; not while others read older states."""
        state = self.state()
        live = {p.partition("/")[0] for p in state["buckets"].values()}
        for n in store.names(self.spark, self.path):
            if n.startswith(("data-", "draft-")) and n not in live:
                store.remove(self.spark, f"{self.path}/{n}")
        for n in store.names(self.spark, f"{self.path}/_manifest"):
            if n != f"{state['version']:020d}.json":
                store.remove(self.spark, f"{self.path}/_manifest/{n}")
