"""Tables that grow by epochs, with compaction.

A table is a folder of ``epoch=N`` folders; each epoch writes its rows into its
own folder, replacing what an earlier attempt of that epoch left.  Many small
epochs are merged by ``compact``: it writes the rows of all epochs up to one
into fresh folders, and then publishes them with one manifest file, created by
a rename.  Readers look for the newest manifest they may use and read its
folders plus the epochs after it, so they see either the old files or the new
ones, never both and never neither:

* a compaction that stops before the rename leaves folders that nobody reads;
* one that stops after it leaves epochs that nobody reads any more;
* of two at once, the first rename holds.

``vacuum`` deletes what no manifest needs.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class EpochTables:
    """The tables below ``root``; ``by`` names a table's partition columns."""

    def __init__(self, spark: SparkSession, root: str, by: Mapping[str, Sequence[str]]):
        self.spark, self.root, self.by = spark, root.rstrip("/"), {k: list(v) for k, v in by.items()}
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _list(self, folder: str, pattern: str) -> dict[int, str]:
        """number -> name of the entries of ``folder`` that match."""
        p = self._path(f"{self.root}/{folder}")
        if not self._fs.exists(p):
            return {}
        names = [f.getPath().getName() for f in self._fs.listStatus(p)]
        return {int(m[1]): n for n in names if (m := re.fullmatch(pattern, n))}

    def epochs(self, name: str) -> list[int]:
        return sorted(self._list(name, r"epoch=(-?\d+)"))

    def write(self, name: str, rows: DataFrame, epoch: int) -> None:
        """Store the rows of an epoch; a repeated attempt replaces them."""
        if self.by[name]:
            rows = rows.repartition(*self.by[name])  # one file per folder
        rows.write.mode("overwrite").partitionBy(*self.by[name]).parquet(f"{self.root}/{name}/epoch={epoch}")

    def _manifest(self, before: int | None) -> dict:
        """The newest manifest of epochs below ``before``."""
        found = {n: f for n, f in self._list("_manifest", r"(-?\d+)\.json").items() if before is None or n < before}
        if not found:
            return {"upto": None, "folders": {}}
        line = self.spark.read.text(f"{self.root}/_manifest/{found[max(found)]}").first()
        return json.loads(line[0])

    def read(self, name: str, before: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The rows of all epochs (below ``before``).  ``schema`` is needed
        where every epoch may be empty."""
        m = self._manifest(before)
        own = [e for e in self.epochs(name) if (m["upto"] is None or e > m["upto"]) and (before is None or e < before)]
        folders = ([m["folders"][name]] if name in m["folders"] else []) + [f"{name}/epoch={e}" for e in own]
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        out = None
        for group in (folders[:len(folders) - len(own)], folders[len(folders) - len(own):]):
            if group:
                base = f"{self.root}/{name}" if group[0].startswith(f"{name}/") else f"{self.root}/{group[0]}"
                part = reader.option("basePath", base).parquet(*[f"{self.root}/{g}" for g in group]).drop("epoch")
                out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], schema) if out is None and schema is not None else out

    def compact(self, upto: int, merge: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
                schemas: Mapping[str, T.StructType] | None = None) -> bool:
        """Merge the epochs up to ``upto``, all of them complete, into one
        folder a table; ``merge`` may reduce a table's rows.  False if another
        compaction had published the same state first."""
        folders, run = {}, uuid.uuid4().hex[:12]
        for name, by in self.by.items():
            rows = self.read(name, upto + 1, (schemas or {}).get(name))
            rows = (merge or {}).get(name, lambda df: df)(rows)
            # One task per partition value, or at most one per shuffle partition, instead of one file per epoch and task;
            # the small files of the epochs are read together, so the rows need not move.
            rows = rows.repartition(*by) if by else rows.coalesce(int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            folders[name] = f"_compact/{run}/{name}"
            rows.write.partitionBy(*by).parquet(f"{self.root}/{folders[name]}")
        return self._publish(upto, {"upto": upto, "folders": folders})

    def _publish(self, upto: int, manifest: dict) -> bool:
        draft = f"{self.root}/_manifest/draft-{uuid.uuid4().hex[:12]}"
        final = self._path(f"{self.root}/_manifest/{upto}.json")
        if self._fs.exists(final):
            return False
        out = self._fs.create(self._path(draft), False)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        done = self._fs.rename(self._path(draft), final)
        if not done:
            self._fs.delete(self._path(draft), False)
        return done

    def vacuum(self) -> None:
        """Delete epochs, folders and manifests that the newest manifest has
        replaced.  No reader of an older state may still run."""
        m = self._manifest(None)
        if m["upto"] is None:
            return
        keep = {f.split("/")[1] for f in m["folders"].values()}
        gone = [f"{t}/epoch={e}" for t in self.by for e in self.epochs(t) if e <= m["upto"]]
        gone += [f"_manifest/{f}" for n, f in self._list("_manifest", r"(-?\d+)\.json").items() if n < m["upto"]]
        runs = self._path(f"{self.root}/_compact")
        gone += [f"_compact/{n}" for n in (f.getPath().getName() for f in self._fs.listStatus(runs)) if n not in keep]
        for g in gone:
            self._fs.delete(self._path(f"{self.root}/{g}"), True)
