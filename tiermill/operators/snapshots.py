"""Snapshots (backup / restore) and table operations on stored tables.

A table is a directory of folders, each of which is one Spark write.  A folder
counts once it holds the ``_SUCCESS`` marker, which is created, empty, after the write has
ended and its rows have been checked; the newest one that counts is the table, and the folder's name holds the operation that wrote it.
So a job that dies half-way leaves the table as it was, and a table can be
replaced from a query that reads it.

A table with a ``key`` is partitioned by a hash of the key.  Upsert and delete
first find the partitions that they touch, and Spark's dynamic partition overwrite
replaces only those; the files of all others stay as they are.

Snapshots are written as ``<root>/backups/<table>/<yyyyMMdd_HHmmss>-<id>/`` with a
manifest row (table, ts, path, format, rows) appended per backup.
"""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.writers import write_table

# The manifest's columns, the keys of the backup and restore results
# and the form of the stamp.
MANIFEST = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("made_at_ns", T.LongType()),
])

class SnapshotNotFound(LookupError):
    pass


def _now_stamp() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")


def stamp_of(as_of: str | None) -> str:
    """``yyyyMMdd_HHmmss`` of ``as_of`` (read as UTC), or of now."""
    if as_of is None:
        return _now_stamp()
    return dt.datetime.fromisoformat(as_of).strftime("%Y%m%d_%H%M%S")


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its path object (works for any
    scheme the cluster's shared folder uses)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _file_system(spark, path)
    return fs.exists(hpath)


def snapshot_format(spark: SparkSession, preferred: str = "avro") -> str:
    """``preferred`` when its data source is on the classpath, else parquet."""
    if preferred == "parquet":
        return preferred
    try:
        spark.read.format(preferred).load("/nonexistent-tiermill-probe")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return preferred
        return "parquet"
    except Exception:  # noqa: BLE001 -- any other failure: fall back
        return "parquet"
    return preferred


def _one_row(spark: SparkSession, values: dict, schema: T.StructType) -> DataFrame:
    """A one-row frame of literals (built in the JVM, no Python data)."""
    return spark.range(1).select(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name)
                                   for f in schema.fields])


def _count_written(spark: SparkSession, path: str, fmt: str) -> int:
    """Rows of a written directory (parquet answers from footers)."""
    return spark.read.format(fmt).load(path).count()


#: Partitions of a table that is kept by key.
KEY_PARTS = 64
MARKER, PART = "_SUCCESS", "_part"


class StoredTable:
    """A named table under ``<root>/tables/<name>``.  With ``key`` it is partitioned
    by a hash of that column into ``parts``; rows with a null key are dealt out by
    their other columns."""

    def __init__(self, spark: SparkSession, root: str, name: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                 schema: T.StructType | None = None, key: str | None = None, parts: int = KEY_PARTS):
        self.spark, self.name, self.fmt, self.schema, self.key, self.parts = spark, name, fmt, schema, key, parts
        self.partition_by = [PART] if key else partition_by
        self.location = os.path.join(root, "tables", name)

    def versions(self) -> list[str]:
        """Folders that count, oldest first: two listings, no Spark job."""
        fs, hpath = _file_system(self.spark, self.location)
        if not fs.exists(hpath):
            return []
        names = sorted(x.getPath().getName() for x in fs.listStatus(hpath))
        return [p for p in (os.path.join(self.location, n) for n in names if n.startswith("v")) if _exists(self.spark, os.path.join(p, MARKER))]

    def history(self) -> list[tuple[str, str]]:
        """(operation, folder) of the versions, oldest first."""
        return [(os.path.basename(p).split("-")[1], p) for p in self.versions()]

    def current(self) -> str | None:
        found = self.versions()
        return found[-1] if found else None

    def stored(self) -> DataFrame:
        """The table as it is stored, partition columns included."""
        path = self.current()
        if path is None:
            raise LookupError(f"table {self.name} has no version")
        reader = self.spark.read.format(self.fmt)
        return (reader.schema(self.schema) if self.schema is not None else reader).load(path)

    def read(self) -> DataFrame:
        return self.stored().drop(PART) if self.key else self.stored()

    def parted(self, df: DataFrame) -> DataFrame:
        """``df`` with the partition column of a table with a key."""
        if not self.key:
            return df
        of = F.when(F.col(self.key).isNull(), F.xxhash64(*[F.col(c) for c in df.columns])).otherwise(F.xxhash64(self.key))
        return df.withColumn(PART, F.pmod(of, F.lit(self.parts)).cast("int"))

    def replace(self, df: DataFrame, operation: str = "overwrite", expect_rows: int | None = None) -> dict:
        """Write ``df`` as the table's next version, made by ``operation``.  Raises, and leaves the table as
        it was, if the rows written are not ``expect_rows``."""
        path = os.path.join(self.location, f"v{time.time_ns():020d}-{operation}-{uuid.uuid4().hex[:8]}")
        out = self.parted(df)
        writer = (out.hint("rebalance", PART) if self.key else out).write.format(self.fmt).mode("errorifexists")
        writer = writer.option("compression", "snappy").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).save(path)
        reader = self.spark.read.format(self.fmt).schema(out.schema)
        rows = reader.load(path).count()
        if expect_rows is not None and rows != expect_rows:
            raise RuntimeError(f"{self.name}: wrote {rows} rows, expected {expect_rows}")
        fs, marker = _file_system(self.spark, os.path.join(path, MARKER))
        fs.create(marker, False).close()
        return {"path": path, "rows": rows}

    def replace_parts(self, df: DataFrame) -> None:
        """Replace the partitions that ``df`` has rows of, in the current version."""
        (df.hint("rebalance", PART).write.format(self.fmt).option("compression", "snappy").mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(PART).save(self.current()))


# -- operations ---------------------------------------------------------------

def overwrite(table: StoredTable, df: DataFrame) -> dict:
    return table.replace(df)


def append(table: StoredTable, df: DataFrame, schema: T.StructType | None = None) -> None:
    """Add rows to the current version (a plain Spark append).  The columns
    must be those of ``schema`` (by default of the table) in name, order and
    type.  Not idempotent: appending twice adds the rows twice."""
    want = schema if schema is not None else table.read().schema
    if [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in want]:
        raise ValueError(f"append to {table.name}: {df.schema.simpleString()} is not {want.simpleString()}")
    write_table(table.parted(df), table.current(), table.fmt, mode="append", partition_by=table.partition_by)


def delete_where(table: StoredTable, predicate: Column) -> None:
    """Remove rows where ``predicate`` is true (null counts as false, as in
    ``DELETE ... WHERE``).  Of a table with a key only the partitions that hold
    such rows are written again."""
    hit = F.coalesce(predicate, F.lit(False))
    if not table.key:
        table.replace(table.read().filter(~hit), "delete")
        return
    rows = table.stored()
    # one row a partition: bounded by the table's number of partitions
    touched = rows.groupBy(PART).agg(F.count_if(hit).alias("gone"), F.count(F.lit(1)).alias("all")).filter("gone > 0").collect()
    some = [r[PART] for r in touched if r["gone"] < r["all"]]
    if some:
        table.replace_parts(rows.filter(F.col(PART).isin(some) & ~hit))
    for r in touched:
        if r["gone"] == r["all"]:
            fs, path = _file_system(table.spark, os.path.join(table.current(), f"{PART}={r[PART]}"))
            fs.delete(path, True)


def truncate(table: StoredTable) -> None:
    table.replace(table.spark.createDataFrame([], table.read().schema), "truncate")


def latest_per_key(batch: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """One row per non-null ``key``: the row with the greatest ``order_by``.
    A grouped ``max_by`` (partial aggregate on the map side) instead of a
    window, so a key holding a large share of the batch is not sorted in one
    task."""
    cols = batch.columns
    newest = (batch.filter(F.col(key).isNotNull()).groupBy(key)
              .agg(F.max_by(F.struct(*cols), F.struct(*order_by)).alias("_r")))
    return newest.select("_r.*")


def upsert(table: StoredTable, batch: DataFrame, order_by: list[str]) -> list[int]:
    """Insert-or-replace by the table's key: the newest batch row per key replaces
    the table's rows with that key.  Batch rows with a null key match nothing and
    could not be told from their own repetition, so they are left out; running a
    batch twice gives the same table as running it once.

    The batch is evaluated once, into a folder of the table's own; its keys give
    the partitions that are touched (at most the table's number of them), and only those are
    read and written.  Returns their numbers."""
    key, columns = table.key, table.read().columns
    batch = batch.select(*columns, *[c for c in order_by if c not in columns])
    staged = os.path.join(table.location, "_staged", uuid.uuid4().hex)
    write_table(table.parted(latest_per_key(batch, key, order_by).select(*columns)), staged, mode="errorifexists")
    newest = table.spark.read.parquet(staged)
    touched = [r[0] for r in newest.select(PART).distinct().collect()]
    if touched:
        old = table.stored().filter(F.col(PART).isin(touched))
        # the partition is part of the join key: rows with a null key, which match nothing, stay spread
        kept = old.join(newest.select(PART, key), [PART, key], "left_anti").select(*columns, PART)
        table.replace_parts(kept.unionByName(newest.select(*columns, PART)))
    fs, path = _file_system(table.spark, staged)
    fs.delete(path, True)
    return touched


# -- snapshots ----------------------------------------------------------------

def manifest_path(root: str) -> str:
    return os.path.join(root, "backups", "_manifest")


def backup(df: DataFrame, root: str, table: str, as_of: str | None = None,
           fmt: str | None = None) -> dict:
    """Write a snapshot of ``df`` and record it in the manifest."""
    spark = df.sparkSession
    fmt = fmt or snapshot_format(spark)
    ts = stamp_of(as_of)
    path = os.path.join(root, "backups", table, f"{ts}-{uuid.uuid4().hex[:8]}")
    write_table(df, path, fmt, mode="errorifexists")
    rows = _count_written(spark, path, fmt)
    entry = {"table": table, "ts": ts, "path": path, "format": fmt, "rows": rows, "made_at_ns": time.time_ns()}
    _one_row(spark, entry, MANIFEST).write.mode("append").parquet(manifest_path(root))
    return {"status": "success", "table": table, "backup_uri": path, "timestamp": ts,
            "rows_backed_up": rows}


def manifest(spark: SparkSession, root: str) -> DataFrame:
    if not _exists(spark, manifest_path(root)):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(manifest_path(root))


def latest_snapshots(manifest_df: DataFrame) -> DataFrame:
    """Newest snapshot per table: by stamp, then by the time it was made."""
    return (manifest_df.groupBy("table")
            .agg(F.max_by(F.struct("ts", "path", "format", "rows"), F.struct("ts", "made_at_ns")).alias("s"))
            .select("table", "s.ts", "s.path", "s.format", "s.rows"))


def find_snapshot(spark: SparkSession, root: str, table: str, ts: str | None = None) -> dict:
    m = manifest(spark, root).filter(F.col("table") == table)
    if ts is not None:
        m = m.filter(F.col("ts") == ts)
    rows = latest_snapshots(m).collect()
    if not rows:
        raise SnapshotNotFound(f"Backup not found: {table} {ts or '(latest)'}")
    return rows[0].asDict()


def restore(target: StoredTable, root: str, ts: str | None = None,
            schema: T.StructType | None = None) -> dict:
    """Replace ``target`` with a snapshot (its schema enforced), as a new
    version; the row count is checked against the manifest before it counts."""
    snap = find_snapshot(target.spark, root, target.name, ts)
    reader = target.spark.read.format(snap["format"])
    if schema is not None:
        reader = reader.schema(schema)
    entry = target.replace(reader.load(snap["path"]), "restore", expect_rows=snap["rows"])
    return {"status": "success", "table": target.name, "restored_from": snap["path"],
            "rows_restored": entry["rows"]}
