"""Column types of CSV text by a type lattice.

Each value is of one kind; the kinds of a column are a set of bits, so those of
two files merge by ``bit_or``, in any order.  The narrowest type that holds a set
follows from it: empty < bigint < double < string and empty < timestamp < string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bit and form of each kind (anything else is text).
INTEGER, DECIMAL, TIMESTAMP, TEXT = 1, 2, 4, 8
FORMS = {
    INTEGER: r"^[+-]?[0-9]{1,18}$",
    DECIMAL: r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    TIMESTAMP: r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}Z?)?$",
}


def kind(text: Column) -> Column:
    """The kind bit of a value; null and blank text have none."""
    t = F.trim(text)
    of = F.when(t.isNull() | (t == ""), 0)
    for bit, form in FORMS.items():
        of = of.when(t.rlike(form), bit)
    return of.otherwise(TEXT)


def type_of(kinds: Column) -> Column:
    """The narrowest type of a set of kinds."""
    return (F.when(kinds == 0, "empty").when(kinds == INTEGER, "bigint").when(kinds.isin(DECIMAL, INTEGER | DECIMAL), "double")
            .when(kinds == TIMESTAMP, "timestamp").otherwise("string"))


def column_kinds(text: DataFrame, columns: list[str], source: Column | None = None) -> DataFrame:
    """(source, column, kinds): the set of kinds of each column in each source, by
    default each file; one scan, one row a source after the partial aggregate."""
    source = F.input_file_name() if source is None else source
    sets = text.groupBy(source.alias("source")).agg(*[F.bit_or(kind(F.col(c))).alias(c) for c in columns])
    return sets.unpivot("source", columns, "column", "kinds")


def column_types(kinds: DataFrame) -> DataFrame:
    """(column, type): the narrowest type that holds all sources."""
    return kinds.groupBy("column").agg(type_of(F.bit_or("kinds")).alias("type"))


def type_conflicts(kinds: DataFrame) -> DataFrame:
    """(source, column, file_type, table_type, widens): ``widens`` marks a source
    without which the column would have a narrower type.

    Whether the other sources have a kind follows from the number of sources that
    have it, so no source is compared with another."""
    bits = [INTEGER, DECIMAL, TIMESTAMP, TEXT]
    counts = kinds.groupBy("column").agg(*[F.count_if(F.col("kinds").bitwiseAND(b) != 0).alias(f"n_{b}") for b in bits])
    both = kinds.join(counts, "column")
    everything = reduce(Column.bitwiseOR, [F.when(F.col(f"n_{b}") > 0, b).otherwise(0) for b in bits])
    others = reduce(Column.bitwiseOR, [
        F.when(F.col(f"n_{b}") > F.when(F.col("kinds").bitwiseAND(b) != 0, 1).otherwise(0), b).otherwise(0) for b in bits])
    return both.select("source", "column", type_of(F.col("kinds")).alias("file_type"), type_of(everything).alias("table_type"),
                       (type_of(others) != type_of(everything)).alias("widens"))
