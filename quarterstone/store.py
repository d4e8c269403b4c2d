"""Named tables under one shared folder that never show a half-written state.

A plain table is a series of full versions; readers take the newest committed one. A keyed table
is kept in a fixed number of hash partitions of its key, each one bucket; a change writes only the
partitions it touches and then a manifest, the list of every partition's folder. The newest
committed manifest is the table, so a lost job leaves the last one in force and a repeated one
does no harm. Keyed tables of one key type and number of buckets join on it without an exchange.
One job at a time writes a table.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "_part"  # hash partition of a keyed table, equal to Spark's bucket number
MANIFEST = "part int, path string, source string, key string, buckets int, columns string"

_OPENING = threading.Lock()  # jobs that refresh reports side by side open the same tables


def _stamp() -> str:
    """Names that sort by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


class Folders:
    """Listing and removing folders on whatever file system holds them."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        """Names in a folder, ascending; none if there is no such folder."""
        path = self.path(folder)
        return sorted(str(f.getPath().getName()) for f in self.files.listStatus(path)) if self.files.exists(path) else []

    def committed(self, folder: str) -> list[str]:
        return [name for name in self.names(folder) if self.files.exists(self.path(f"{folder}/{name}/_SUCCESS"))]

    def remove(self, folder: str) -> None:
        self.files.delete(self.path(folder), True)


class Manifest:
    """The folders of a keyed table's partitions, with the sources that each was made from."""

    def __init__(self, path: str, rows: list):
        self.path = path
        self.key, self.buckets, self.columns = rows[0]["key"], rows[0]["buckets"], rows[0]["columns"]
        self.parts = {r["part"]: r["path"] for r in rows if r["path"] is not None}
        self.sources = {r["part"]: r["source"] for r in rows if r["part"] is not None}


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @cached_property
    def folders(self) -> Folders:
        return Folders(self.spark, self.root)

    # ---- reading -----------------------------------------------------------------
    def _newest(self, name: str) -> str | None:
        """Folder of the newest version whose write was committed."""
        versions = self.folders.committed(f"{self.root}/{name}")
        return f"{self.root}/{name}/{versions[-1]}" if versions else None

    def manifest(self, name: str) -> Manifest | None:
        newest = self._newest(f"{name}/manifests")
        return newest and Manifest(newest, self.spark.read.schema(MANIFEST).parquet(newest).collect())

    def read(self, name: str) -> DataFrame | None:
        """A table's newest state; a keyed one keeps its buckets."""
        found = self.manifest(name)
        if found:
            return self._opened(name, found).drop(PART)
        newest = self._newest(name)
        return newest and self.spark.read.parquet(newest)

    def need(self, name: str) -> DataFrame:
        rows = self.read(name)
        if rows is None:
            raise LookupError(f"the store has no {name!r} yet; load it first")
        return rows

    def parts(self, name: str, parts: list[int]) -> DataFrame:
        """Only some partitions of a keyed table; no file of another is opened."""
        found = self.manifest(name)
        if found is None:
            raise LookupError(f"the store has no keyed {name!r} yet; load it first")
        return self._opened(name, found).where(F.col(PART).isin(parts)).drop(PART)

    def _opened(self, name: str, manifest: Manifest) -> DataFrame:
        """The partitions of a manifest as a bucketed table of the session's catalog."""
        table = "stored_" + hashlib.md5(manifest.path.encode()).hexdigest()
        with _OPENING:
            if not self.spark.catalog.tableExists(table):
                self.spark.sql(
                    f"CREATE TABLE {table} ({manifest.columns}, {PART} INT) USING parquet PARTITIONED BY ({PART}) "
                    f"CLUSTERED BY (`{manifest.key}`) SORTED BY (`{manifest.key}`) INTO {manifest.buckets} BUCKETS "
                    f"LOCATION '{self.root}/{name}/data'")
                parts = [f"PARTITION ({PART}={part}) LOCATION '{path}'" for part, path in sorted(manifest.parts.items())]
                for start in range(0, len(parts), 500):
                    self.spark.sql(f"ALTER TABLE {table} ADD {' '.join(parts[start:start + 500])}")
        return self.spark.table(table)

    # ---- full versions -----------------------------------------------------------
    def publish(self, name: str, rows: DataFrame) -> None:
        """Full refresh of a plain table; it counts once Spark has committed it."""
        rows.write.parquet(f"{self.root}/{name}/{_stamp()}")

    def replaced(self, name: str, rows: DataFrame) -> DataFrame:
        self.publish(name, rows)
        return self.need(name)

    # ---- keyed tables ------------------------------------------------------------
    @property
    def _buckets(self) -> int:
        """Buckets of a new keyed table; a table keeps its number."""
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def part_of(self, key: str, buckets: int) -> Column:
        return F.pmod(F.hash(F.col(f"`{key}`")), F.lit(buckets)).cast("int")

    def upsert(self, name: str, rows: DataFrame, key: str = "code") -> None:
        """All delivered rows, and the stored rows of keys that are not delivered. Only the partitions
        that hold a delivered key are read and written anew."""
        found = self.manifest(name)
        if found is None:
            self.replace(name, rows, key)
        else:
            self._merge(name, found, rows, keep=True)

    def remove(self, name: str, keys: DataFrame) -> None:
        """Drop all rows of some keys (the first column of ``keys``)."""
        found = self.manifest(name)
        if found is not None:
            self._merge(name, found, keys.select(F.col(f"`{keys.columns[0]}`").alias(found.key)).distinct(), keep=False)

    def _merge(self, name: str, found: Manifest, rows: DataFrame, keep: bool) -> None:
        key, stored = f"`{found.key}`", self._opened(name, found)
        kind = dict(stored.dtypes)[found.key]
        rows = rows.withColumn(found.key, F.col(key).cast(kind)).withColumn(PART, self.part_of(found.key, found.buckets))
        # the delivery is used three times: for its partitions, for its keys and as rows. Dealt out by key first, a
        # partition is one file; otherwise each task would write one for every partition, all listed by the driver
        staged = f"{self.root}/{name}/staged/{_stamp()}"
        rows.repartition(found.buckets, F.col(key)).write.partitionBy(PART).parquet(staged)
        parts = self._part_names(staged)
        if not parts:
            return
        delivered = self.spark.read.schema(rows.schema).parquet(staged)
        kept = (stored.where(F.col(PART).isin(list(parts)))
                .join(delivered.select(found.key).distinct(), found.key, "left_anti"))
        if keep:
            kept = kept.unionByName(delivered.repartition(found.buckets, F.col(key)))
        written = self._written(name, kept, found.key, found.buckets)
        self._commit(name, found.key, found.buckets, found.columns,
                     {p: path for p, path in found.parts.items() if p not in parts} | written)
        self.folders.remove(staged)

    def replace(self, name: str, rows: DataFrame, key: str = "code") -> None:
        """All rows of a keyed table anew."""
        buckets = self._buckets
        placed = rows.withColumn(PART, self.part_of(key, buckets)).repartition(buckets, F.col(f"`{key}`"))
        self._commit(name, key, buckets, rows._jdf.schema().toDDL(), self._written(name, placed, key, buckets))

    def replace_parts(self, name: str, rows: DataFrame, key: str, buckets: int, sources: dict[int, str]) -> None:
        """The rows of some partitions anew, with what each was made from; the others stay, if the
        table has the same key, columns and number of buckets, and go otherwise."""
        found, columns = self.manifest(name), rows._jdf.schema().toDDL()
        if found is not None and (found.key, found.buckets, found.columns) != (key, buckets, columns):
            found = None
        written = self._written(name, rows.withColumn(PART, self.part_of(key, buckets)), key, buckets)
        left = {p: path for p, path in found.parts.items() if p not in sources} if found else {}
        old = {p: s for p, s in found.sources.items() if p not in sources} if found else {}
        self._commit(name, key, buckets, columns, left | written, old | sources)

    def _written(self, name: str, rows: DataFrame, key: str, buckets: int) -> dict[int, str]:
        """Write rows bucketed by key, a folder for each partition; the folders."""
        path, table = f"{self.root}/{name}/data/{_stamp()}", f"writing_{uuid.uuid4().hex}"
        (rows.write.option("path", path).partitionBy(PART).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table))
        self.spark.sql(f"DROP TABLE {table}")
        return self._part_names(path)

    def _part_names(self, path: str) -> dict[int, str]:
        return {int(f.split("=")[1]): f"{path}/{f}" for f in self.folders.names(path) if f.startswith(f"{PART}=")}

    def _commit(self, name: str, key: str, buckets: int, columns: str, parts: dict[int, str], sources: dict[int, str] | None = None) -> None:
        sources = sources or {}
        rows = [(p, parts.get(p), sources.get(p), key, buckets, columns) for p in sorted({*parts, *sources})]
        rows = rows or [(None, None, None, key, buckets, columns)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{self.root}/{name}/manifests/{_stamp()}")

    # ---- rejects, staging, clean-up ----------------------------------------------
    def staging(self, name: str) -> str:
        """A new folder for rows that a job reads more than once."""
        return f"{self.root}/staging_{name}/{_stamp()}"

    def drop_staged(self, name: str) -> None:
        self.folders.remove(f"{self.root}/staging_{name}")

    def reject(self, name: str, rows: DataFrame) -> None:
        """Keep rejected payloads with their reason beside the store's tables, a repeated one once."""
        path = f"{self.root}/rejects_{name}"
        rows = rows.withColumn("reject_id", F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in rows.columns])).dropDuplicates(["reject_id"])
        if self.folders.names(path):
            rows = rows.join(self.spark.read.parquet(path).select("reject_id"), "reject_id", "left_anti")
        rows.withColumn("rejected", F.current_timestamp()).write.mode("append").parquet(path)

    def tables(self) -> list[str]:
        return [name for name in self.folders.names(self.root) if not name.startswith(("rejects_", "staging_")) and name != "quotes"]

    def expire(self, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` states of every table, and what lost jobs left before the newest.

        Readers of an older state lose its files: keep as many states as the longest of them may
        outlast. A partition's folder stays as long as a kept manifest names it; folders younger than the newest
        state belong to a running job and stay.
        """
        if keep < 1:
            raise ValueError("at least one state must stay")
        for name in self.tables():
            folder = f"{self.root}/{name}"
            if self.folders.names(f"{folder}/manifests"):
                self._expire_keyed(folder, keep)
            else:
                self._expire_versions(folder, keep)
        for name in self.folders.names(self.root):
            if name.startswith("staging_"):
                self._expire_versions(f"{self.root}/{name}", 1)

    def _expire_versions(self, folder: str, keep: int) -> list[str]:
        """Remove old versions; names of those that stay."""
        committed = self.folders.committed(folder)
        kept, newest = set(committed[-keep:]), committed[-1] if committed else ""
        for version in self.folders.names(folder):
            if version not in kept and version < newest:
                self.folders.remove(f"{folder}/{version}")
        return sorted(kept)

    def _expire_keyed(self, folder: str, keep: int) -> None:
        kept = self._expire_versions(f"{folder}/manifests", keep)
        if not kept:
            return
        used = {path for m in kept for path in
                Manifest(m, self.spark.read.schema(MANIFEST).parquet(f"{folder}/manifests/{m}").collect()).parts.values()}
        used = {"/".join(path.split("/")[-2:]) for path in used}
        for version in self.folders.names(f"{folder}/data"):
            parts = [p for p in self.folders.names(f"{folder}/data/{version}") if p.startswith(f"{PART}=")]
            unused = [p for p in parts if f"{version}/{p}" not in used]
            if version < kept[-1]:
                for part in unused if len(unused) < len(parts) else [""]:
                    self.folders.remove(f"{folder}/data/{version}/{part}".rstrip("/"))
        for version in self.folders.names(f"{folder}/staged"):
            if version < kept[-1]:
                self.folders.remove(f"{folder}/staged/{version}")
