"""Tables in versioned folders: a reader sees a whole version, whatever becomes of the writer.

A table is a folder with data folders, each written once by a Spark job, and
numbered manifests that say which data folders make up a version. A version counts from the moment
its manifest is written, which happens after its data are complete; a writer that is lost before that
leaves a folder nobody names. ``KEPT`` versions stay readable for frames that
still use them.

Two kinds of change: ``replace`` puts new rows in the place of all, ``upsert`` adds rows that
win over earlier rows of their key. Rows added are a run of their own; a run that is not much smaller than the one before
it is merged with it, so there are about as many runs as the number of rows has binary digits, and each row is rewritten as
often. What a reader reads thus grows with the rows, not with the number of changes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators.ordered import first_per_group
from larkspur.sources.files import Files

#: Versions whose data are kept.
KEPT = 8
#: A run is merged with newer ones that have at least a half of its rows together.
MERGE_FROM = 2
SEQUENCE = "_seq"


class Stored:
    """A stored table. ``keys`` names a row in an upserted table; ``newest`` orders rows of one key, the winner first, where the last write should not decide."""

    def __init__(self, spark: SparkSession, folder: str, keys=(), newest=()):
        self.spark, self.folder, self.keys, self.newest = spark, folder.rstrip("/"), list(keys), list(newest)
        self.files = Files(spark, folder)

    # --- versions

    def _versions(self) -> list[str]:
        return [n for n in self.files.names("log") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self) -> dict | None:
        """The newest complete manifest; one that was cut short does not count."""
        for name in reversed(self._versions()):
            try:
                return json.loads(self.files.read_text(f"log/{name}"))
            except ValueError:
                continue
        return None

    def _commit(self, before: dict | None, runs: list[dict], schema: T.StructType, writers: dict) -> dict:
        manifest = {"version": (before or {"version": 0})["version"] + 1, "runs": runs, "schema": json.loads(schema.json()), "writers": writers}
        now, taken = self.manifest(), self._versions()
        # the number of a manifest that was cut short is not used again
        manifest["version"] = max([manifest["version"], *(int(n[:-5]) + 1 for n in taken[-1:])])
        same = (now or {}).get("version") == (before or {}).get("version")
        if not same or not self.files.write_new(f"log/{manifest['version']:020d}.json", json.dumps(manifest)):
            raise RuntimeError(f"{self.folder} was changed by somebody else; read it again")
        self._forget()
        return manifest

    def _forget(self) -> None:
        """Drop manifests beyond KEPT and the data that none of the kept ones names but an older one did."""
        names = self._versions()
        old, kept = names[:-KEPT], names[-KEPT:]

        def folders(name):
            try:
                return {r["path"] for r in json.loads(self.files.read_text(f"log/{name}"))["runs"]}
            except ValueError:
                return set()

        if old:
            used = set().union(*map(folders, kept))
            for path in set().union(*map(folders, old)) - used:
                self.files.delete(path)
            for name in old:
                self.files.delete(f"log/{name}")

    # --- rows

    def _write(self, df: DataFrame) -> dict | None:
        """A run: rows in a folder of their own. Of a table with keys it says how many, which upserts go by, and there is none for no rows."""
        path = f"data/{uuid.uuid4()}"
        df.write.parquet(f"{self.folder}/{path}")
        if not self.keys:
            return {"path": path}
        rows = self.spark.read.schema(df.schema).parquet(f"{self.folder}/{path}").count()  # from the files' footers
        return {"path": path, "rows": rows} if rows else None

    def _rows(self, runs: list[dict], schema: T.StructType) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{r['path']}" for r in runs])

    def _settled(self, df: DataFrame) -> DataFrame:
        """The winning row of each key."""
        return first_per_group(df, self.keys, [*self.newest, f"-{SEQUENCE}"])

    def exists(self) -> bool:
        return self.manifest() is not None

    def read(self) -> DataFrame:
        """Current rows."""
        manifest = self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"{self.folder} holds no table")
        rows = self._rows(manifest["runs"], T.StructType.fromJson(manifest["schema"]))
        if SEQUENCE not in rows.columns:
            return rows
        return (self._settled(rows) if len(manifest["runs"]) > 1 else rows).drop(SEQUENCE)

    def replace(self, df: DataFrame) -> DataFrame:
        """Put ``df``, which may be made from this table's rows, in the place of all rows; returns the stored rows."""
        before = self.manifest()
        if self.keys:
            df = df.withColumn(SEQUENCE, F.lit(0).cast("long"))
        run = self._write(df)
        self._commit(before, [run] if run else [], df.schema, (before or {}).get("writers", {}))
        return self.read()

    def change(self, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Replace the rows by what ``make`` makes of them."""
        return self.replace(make(self.read()))

    def upsert(self, df: DataFrame, writer: str = "", number: int | None = None) -> bool:
        """Add rows, at most one a key unless ``newest`` tells them apart.

        ``writer`` numbers its changes in ascending order; one that is here already changes nothing, and the answer is False.
        """
        if not self.keys:
            raise ValueError("upsert needs keys")
        before = self.manifest()
        writers = dict((before or {}).get("writers", {}))
        if number is not None and writers.get(writer, -1) >= number:
            return False
        seq = (before or {"version": 0})["version"] + 1
        if self.newest:
            df = first_per_group(df, self.keys, self.newest)
        df = df.withColumn(SEQUENCE, F.lit(seq).cast("long"))
        run = self._write(df)
        runs = list((before or {}).get("runs", [])) + ([run] if run else [])
        at, rows = len(runs) - 1, runs[-1]["rows"] if runs else 0
        while run and at > 0 and runs[at - 1]["rows"] <= MERGE_FROM * rows:
            at -= 1
            rows += runs[at]["rows"]
        if run and at < len(runs) - 1:
            merged = self._write(self._settled(self._rows(runs[at:], df.schema)))
            runs = [*runs[:at], merged]
        if number is not None:
            writers[writer] = number
        self._commit(before, runs, df.schema, writers)
        return True
