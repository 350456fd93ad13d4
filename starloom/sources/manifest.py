"""Tables whose current files are listed: a manifest for every version.

A version is a list of folders, each one partition value as one write left it. A
write adds folders and changes none, the manifest that lists them is written once,
and replacing the view over it shows all of them together. So a writer may die at
any step and leaves files that nothing lists; a reader keeps the version it began
with. A partition may consist of several folders, so rows can be added to it, or
all its folders exchanged for a new one, without touching any other.

The view names the folders in a condition on the folder names alone. Spark answers
it while it lists files, and a condition on the partition column prunes as usual.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable
from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starloom.session import new_path
from starloom.sources.sinks import write_version

ROOT, VERSION = "starloom.root", "starloom.version"
PART = "starloom_part"
_SCHEMA = "kind string, part long, value string, rows long, number int, batch string, digest string"


class Entry(NamedTuple):
    """A folder of rows (its partition value as text), or a note that a version keeps."""

    kind: str
    part: int
    value: str
    rows: int | None = None
    number: int | None = None
    batch: str | None = None
    digest: str | None = None


ROWS = "rows"


def digest_of(columns: list[str]) -> Column:
    """Aggregate that tells sets of rows apart, whatever their order; sums over parts add up."""
    return F.sum(F.xxhash64(*sorted(columns)).cast("decimal(38,0)"))


class ManifestTable:
    """The table ``table`` (a view), in folders by ``partition``."""

    def __init__(self, spark: SparkSession, table: str, partition: str, digests: bool = False):
        self.spark, self.table, self.partition, self.digests = spark, table, partition, digests

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def properties(self) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").collect()
        return {r["key"]: r["value"] for r in rows}

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def entries(self) -> list[Entry]:
        """What the shown version lists, one entry for each folder."""
        known = self.properties()
        listed = self.spark.read.schema(_SCHEMA).parquet(f"{known[ROOT]}/manifests/{known[VERSION]}")
        return sorted(Entry(**r.asDict()) for r in listed.collect())

    def create(self, df: DataFrame, properties: dict[str, str] | None = None) -> None:
        """First version. One that died before it was shown left files that nothing lists."""
        if self.exists():
            raise ValueError(f"{self.table} is there already")
        if "." in self.table:
            layer = self.table.rpartition(".")[0]
            if not self.spark.catalog.databaseExists(layer):
                self.spark.sql(f"CREATE DATABASE {layer} LOCATION '{new_path(self.spark, layer)}'")
        root = new_path(self.spark, self.table.replace(".", "-"))
        self.publish(self.write(df, root), properties or {}, root, df.schema)

    def write(self, df: DataFrame, root: str | None = None, place: Callable[[DataFrame], DataFrame] | None = None) -> list[Entry]:
        """Write rows into folders of their own; nothing shows them yet."""
        part = uuid.uuid4().int >> 66
        path = f"{root or self.properties()[ROOT]}/rows/{PART}={part}"
        write_version(place(df) if place else df, path, [self.partition])
        written = self.spark.read.schema(df.schema).parquet(path)
        digest = digest_of(df.columns) if self.digests else F.lit(None)
        # without digests this reads the files' footers only
        found = written.groupBy(self.partition).agg(
            F.count(F.lit(1)).alias("rows"), digest.cast("string").alias("digest")
        )
        found = found.select(F.col(self.partition).cast("string").alias("value"), "rows", "digest").collect()
        if any(r["value"] is None for r in found):
            raise ValueError(f"{self.table}: rows without {self.partition}")
        return [Entry(ROWS, part, r["value"], r["rows"], digest=r["digest"]) for r in found]

    def folder(self, kind: str, part: int) -> str:
        """Where further files that a version keeps are to be written."""
        return f"{self.properties()[ROOT]}/{kind}/{part}"

    def versions(self) -> list[tuple[str, float]]:
        """Every version with a manifest, the shown one last, and when it was written."""
        known = self.properties()
        made = sorted((when, name) for name, when in self._folders(f"{known[ROOT]}/manifests"))
        shown = known[VERSION]
        # a version that died before it was shown may be younger than the shown one
        return [(n, t) for t, n in made if n != shown] + [(n, t) for t, n in made if n == shown]

    def vacuum(self, keep: int = 1, grace: timedelta = timedelta(days=1)) -> list[str]:
        """Remove folders that none of the last ``keep`` versions list; those removed.

        A version that was shown within ``grace`` is kept for its readers, and a folder
        written within it for its writer, who may not have shown it yet.
        """
        known, limit = self.properties(), time.time() - grace.total_seconds()
        versions = self.versions()
        ends = [t for _, t in versions[1:]] + [math.inf]
        kept = {n for i, (n, _) in enumerate(versions) if i >= len(versions) - max(keep, 1) or ends[i] > limit}
        listed: set[tuple[str, str]] = set()
        for name in kept:
            rows = self.spark.read.schema(_SCHEMA).parquet(f"{known[ROOT]}/manifests/{name}").select("kind", "part")
            listed |= {(r["kind"], f"{PART}={r['part']}" if r["kind"] == ROWS else str(r["part"])) for r in rows.collect()}
        removed = []
        for kind, _ in self._folders(known[ROOT]):
            for name, written in self._folders(f"{known[ROOT]}/{kind}"):
                spare = name in kept if kind == "manifests" else (kind, name) in listed
                if not spare and written < limit:
                    self._remove(f"{known[ROOT]}/{kind}/{name}")
                    removed.append(f"{kind}/{name}")
        return sorted(removed)

    def _files(self, path: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self, path: str) -> list[tuple[str, float]]:
        """Folders in a folder with the time of their last change, in seconds."""
        where, files = self._files(path)
        found = [f for f in files.listStatus(where) if f.isDirectory()]
        return [(f.getPath().getName(), f.getModificationTime() / 1000) for f in found]

    def _remove(self, path: str) -> None:
        where, files = self._files(path)
        files.delete(where, True)

    def publish(
        self, entries: list[Entry], properties: dict[str, str], root: str | None = None, schema: T.StructType | None = None
    ) -> None:
        """Show these folders. ``root`` and ``schema`` are those shown already, but for a first version."""
        known = {} if root else self.properties()
        root, schema, version = root or known[ROOT], schema or self.read().schema, uuid.uuid4().hex
        manifest = self.spark.createDataFrame(entries, _SCHEMA).coalesce(1)
        manifest.write.mode("error").parquet(f"{root}/manifests/{version}")
        kept = {k: v for k, v in known.items() if k.startswith("starloom.")} | properties | {ROOT: root, VERSION: version}
        stated = ", ".join(f"'{k}' = '{v}'" for k, v in kept.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.table} TBLPROPERTIES ({stated}) AS {self._select(entries, root, schema)}")

    def _select(self, entries: list[Entry], root: str, schema: T.StructType) -> str:
        folders = ", ".join(f"'{e.part}/{e.value}'" for e in entries if e.kind == ROWS and e.rows)
        kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
        if not folders:
            return "SELECT " + ", ".join(f"CAST(NULL AS {k}) AS `{c}`" for c, k in kinds.items()) + " WHERE false"
        columns = ", ".join(f"CAST(`{c}` AS {k}) AS `{c}`" for c, k in kinds.items())
        place = f"concat_ws('/', CAST({PART} AS STRING), CAST(`{self.partition}` AS STRING))"
        return f"SELECT {columns} FROM parquet.`{root}/rows` WHERE {place} IN ({folders})"
