"""Writers for the layers.  Every write goes to a directory that the job
owns (overwrite of its own output only), so a retried task or job rewrites
the same files instead of adding duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header; text is written verbatim (Spark's writer would
    otherwise strip leading/trailing spaces)."""
    (df.write.mode(mode).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: list[str] | None = None) -> str:
    """Newline-delimited JSON (null fields are left out of each line)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)
    return path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, compression: str = "snappy") -> str:
    writer = df.write.mode(mode).format(fmt).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path
