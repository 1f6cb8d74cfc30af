"""Readers for the raw layer.

All readers take an explicit schema: inference would turn ``datetime`` into a
timestamp (losing the text the quarantine quotes) and costs an extra pass
over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | list[str], table: str | None = None,
             schema: T.StructType | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header row; ``path`` may be a glob or a list of files.

    ``infer=True`` samples the files for types (like a warehouse autodetect);
    by default the table's raw schema is applied."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if infer:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema or schemas.RAW[table])
    return reader.csv(path)


def read_json_records(spark: SparkSession, path: str | list[str], schema: T.StructType,
                      strict: bool = False) -> DataFrame:
    """Newline-delimited JSON.  ``strict`` fails on the first malformed line
    (zero bad records); otherwise malformed lines are kept in
    ``_corrupt_record`` so that they can be routed to the dead-letter sink."""
    reader = spark.read.schema(schema if strict else
                               T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]))
    reader = reader.option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if not strict:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def read_table(spark: SparkSession, location: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """A stored table: a catalog name (``db.table``) or a directory."""
    if "/" not in location and fmt == "parquet" and schema is None:
        return spark.table(location)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(location)


def testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_layer(spark: SparkSession, root: str, infer: bool = False) -> dict[str, DataFrame]:
    """The raw tables from ``<root>/<table>/*.csv`` (many files per table)."""
    return {t: read_csv(spark, f"{root.rstrip('/')}/{t}/*.csv", t, infer=infer)
            for t in schemas.TABLES}
