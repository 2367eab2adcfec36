"""Ordered windows over a key of any size: a scan in blocks with carries.

A window partitioned by a call puts the call into one task. Here rows are counted by key first. Where
no key holds more than ``most`` rows, that bounds the plain window, which is used. Otherwise the rows
of the keys that do are dealt into ranges of (key, order) of about ``most`` rows, written (range
borders are drawn from a sample, so they have to be drawn once), and every row has a ``block``. Work
goes by (key, block); a block is reduced to a small carry (count, sum, first and last value); a
window over the carries, one row a block, gives what each block has to add; and the carries are
joined back on (key, block). No task holds more of a key than a block.

Rows that are equal in key and order stay together in one block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.session import staged

#: Rows of one key that a task may hold.
MOST_ROWS = 1 << 20
BLOCK = "_block"


@dataclass(frozen=True)
class Blocks:
    rows: DataFrame      # with a block where ``split``
    key: str
    order: list[str]
    split: bool

    def window(self):
        """The rows of a key (of a block of it), in order."""
        return Window.partitionBy(self.key, *([BLOCK] if self.split else [])).orderBy(*self.order)

    def over_blocks(self):
        """The blocks of a key, in order; for carries."""
        return Window.partitionBy(self.key).orderBy(BLOCK)

    def carried(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        """The rows with the columns of their block's carry. Keys may be null."""
        c = carry.withColumnsRenamed({self.key: "_ckey", BLOCK: "_cblock"})
        same = F.col(self.key).eqNullSafe(F.col("_ckey")) & (F.col(BLOCK) == F.col("_cblock"))
        return df.join(c, same).drop("_ckey", "_cblock")


def before(value: Column, window) -> Column:
    """Sum over the blocks before."""
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def in_blocks(df: DataFrame, key: str, order: list[str], most: int | None = None) -> Blocks:
    """Deal the rows of keys with more than ``most`` rows into blocks."""
    most = most or MOST_ROWS
    hot = df.groupBy(key).count().where(F.col("count") > most)
    n = hot.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    if not n:
        return Blocks(df, key, order, False)
    # less than rows / most keys are hot
    hot = hot.select(F.col(key).alias("_hot"))
    same = F.col(key).eqNullSafe(F.col("_hot"))
    dealt = df.join(hot, same, "left_semi").repartitionByRange(-(-n // most), key, *order)
    dealt = staged(dealt.withColumn(BLOCK, F.spark_partition_id()), "ranges")
    rest = df.join(hot, same, "left_anti").withColumn(BLOCK, F.lit(0))
    return Blocks(rest.unionByName(dealt), key, order, True)


def numbered(b: Blocks, name: str) -> DataFrame:
    """The rows with their number in order within the key, from 0."""
    d = b.rows.withColumn(name, F.row_number().over(b.window()) - 1)
    if not b.split:
        return d
    carry = b.rows.groupBy(b.key, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    carry = carry.select(b.key, BLOCK, before(F.col("_n"), b.over_blocks()).alias("_before"))
    return b.carried(d, carry).withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_before")
