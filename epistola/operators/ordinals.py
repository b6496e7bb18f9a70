"""Places of rows in their key's order, and windows over them, where one key may hold more rows than a task should.

A key of at most BLOCK rows is a plain window's. Is any key larger, rows are parted by ranges of (key, order), which parts a large key too: a row's place is its place in
its range and the rows of its key in the ranges before. Windows then run over blocks of BLOCK places, into which the last rows of the block before are copied as far as
a frame reaches back. Both ways give the same rows. `order` should tell all rows of a key apart; equal ones are taken in any order, and lie in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import settle

#: Rows of a key that one task reads in order.
BLOCK = 1 << 22


def has_large_key(rows: DataFrame, by: str, block: int = BLOCK) -> bool:
    """Whether a key has more rows than a block, from counts that are partial before they are shuffled."""
    most = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return (most or 0) > block


def placed(rows: DataFrame, by: str, *order: str) -> DataFrame:
    """rows with `n`, the place of each among the rows of its key, from 1, by ranges."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, by, *order).sortWithinPartitions(by, *order)
    ranged = settle(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranges")  # written, as a range read again may end elsewhere
    counts = ranged.groupBy(F.col(by).alias("_by"), F.col("_part").alias("_p")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))  # a row for each key and range
    ahead = Window.partitionBy("_by").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_by", "_p", (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    joined = ranged.join(starts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_p")))
    return joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("n"))


def numbered(rows: DataFrame, by: str, *order: str, block: int = BLOCK) -> DataFrame:
    """rows with their place `n` by key."""
    if has_large_key(rows, by, block):
        return placed(rows, by, *order)
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("long"))


def _blocks(rows: DataFrame, by: str, order: tuple[str, ...], back: int, block: int) -> DataFrame:
    """The placed rows with their `_block`; rows that the next block looks back at are in it too, marked `_copy`."""
    at = F.col("n") - 1
    own = F.floor(at / F.lit(block)).cast("long")
    here, there = (F.struct((own + i).alias("block"), F.lit(bool(i)).alias("copy")) for i in (0, 1))
    looked_at = at % F.lit(block) >= block - back
    shown = placed(rows, by, *order).withColumn("_b", F.explode(F.when(looked_at, F.array(here, there)).otherwise(F.array(here))))
    return shown.withColumns({"_block": F.col("_b.block"), "_copy": F.col("_b.copy")}).drop("_b")


def over_last(rows: DataFrame, by: str, order: tuple[str, ...], column: str, value: Column, frame: int, block: int = BLOCK) -> DataFrame:
    """rows with an aggregate `value` over the last `frame` rows of each row's key, this one included; frame - 1 at most `block`."""
    if not has_large_key(rows, by, block):
        return rows.withColumn(column, value.over(Window.partitionBy(by).orderBy(*order).rowsBetween(1 - frame, 0)))
    if frame - 1 > block:
        raise ValueError("a frame that is larger than a block")
    w = Window.partitionBy(by, "_block").orderBy("n").rowsBetween(1 - frame, 0)
    return _blocks(rows, by, order, frame - 1, block).withColumn(column, value.over(w)).where("not _copy").select(*rows.columns, column)


def run_places(rows: DataFrame, by: str, order: tuple[str, ...], column: str, state: str, block: int = BLOCK) -> DataFrame:
    """rows with the place of each in its run of equal `state`, from 1."""
    if not has_large_key(rows, by, block):
        w = Window.partitionBy(by).orderBy(*order)
        turned = rows.withColumns({"_n": F.row_number().over(w), "_new": ~F.col(state).eqNullSafe(F.lag(state).over(w))})
        begun = F.max(F.when(F.col("_new") | (F.col("_n") == 1), F.col("_n"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
        return turned.withColumn(column, (F.col("_n") - begun + 1).cast("long")).select(*rows.columns, column)
    w = Window.partitionBy(by, "_block").orderBy("n")
    shown = _blocks(rows, by, order, 1, block).withColumn("_new", (F.col("n") == 1) | ~F.col(state).eqNullSafe(F.lag(state).over(w))).where("not _copy")
    shown = settle(shown.withColumn("_begun", F.max(F.when(F.col("_new"), F.col("n"))).over(w.rowsBetween(Window.unboundedPreceding, 0))), "runs")
    last = shown.groupBy(F.col(by).alias("_by"), F.col("_block").alias("_of")).agg(F.max("_begun").alias("_last"))  # a row for each block
    before = Window.partitionBy("_by").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    open_run = last.select("_by", "_of", F.max("_last").over(before).alias("_open"))
    joined = shown.join(open_run, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_block") == F.col("_of")))
    return joined.withColumn(column, F.col("n") - F.coalesce("_begun", "_open") + 1).select(*rows.columns, column)
