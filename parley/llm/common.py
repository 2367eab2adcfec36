"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import staged, unstaged  # noqa: F401  (a stage table: cuts the lineage, and its consumers share one result)

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that only Spark has to be able to open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Exactly the named columns, cast to the given types. Further columns, whatever their names,
    are gone and so cannot clash with the names an operator uses inside."""
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types.items()))


def whole_row(df: DataFrame) -> Column:
    """The input row as one struct column, for operators that hand all columns through."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))
