"""Versioned tables with undo. A commit writes new versions of some tables, then one pointer file
that names every table's version; readers follow the pointer, so a commit is seen whole or not at
all, and undoing is a new pointer. Versions are counted, not timed."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

UNDO_DEPTH = 20


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/pointers"))
        self._cached: dict[tuple[str, int], DataFrame] = {}

    def _pointers(self) -> list[int]:
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.path}/pointers")))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _load(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.path}/pointers/{number:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def state(self) -> dict:
        """What the last pointer says: tables (name to version), next, note, undo (earlier pointers)."""
        numbers = self._pointers()
        return self._load(numbers[-1]) if numbers else {"tables": {}, "next": 1, "note": "", "undo": []}

    def _publish(self, state: dict) -> None:
        numbers = self._pointers()
        number = (numbers[-1] if numbers else 0) + 1
        temp, final = (self._path(f"{self.path}/pointers/{p}{number:08d}.json") for p in (".", ""))
        out = self._fs.create(temp, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not self._fs.rename(temp, final):
            raise RuntimeError("another commit came first")

    def read(self, table: str, cached: bool = False) -> DataFrame:
        version = self.state()["tables"][table]
        df = self.spark.read.parquet(f"{self.path}/{table}/v={version}")
        if not cached:
            return df
        if (table, version) not in self._cached:
            for key in [k for k in self._cached if k[0] == table]:
                self._cached.pop(key).unpersist()
            self._cached[table, version] = df.cache()
        return self._cached[table, version]

    def commit(self, tables: dict[str, DataFrame], note: str) -> int:
        state, numbers = self.state(), self._pointers()
        version = state["next"]
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.path}/{name}/v={version}")
        undo = [*state["undo"], numbers[-1]][-UNDO_DEPTH:] if numbers else []
        self._publish({"tables": state["tables"] | dict.fromkeys(tables, version), "next": version + 1, "note": note, "undo": undo})
        return version

    def undo(self) -> str:
        """Goes back to the state before the last commit; what that commit's note was."""
        state = self.state()
        if not state["undo"]:
            raise LookupError("nothing to undo")
        before = self._load(state["undo"][-1])
        self._publish(before | {"next": state["next"]})
        return state["note"]

    def prune(self) -> int:
        """Deletes versions that neither the state nor an undo step names; how many."""
        state = self.state()
        keep = {(t, v) for s in [state, *map(self._load, state["undo"])] for t, v in s["tables"].items()}
        gone = 0
        for t in {t for t, _ in keep}:
            for entry in self._fs.listStatus(self._path(f"{self.path}/{t}")):
                name = entry.getPath().getName()
                if name.startswith("v=") and (t, int(name[2:])) not in keep:
                    self._fs.delete(entry.getPath(), True)
                    gone += 1
        return gone
