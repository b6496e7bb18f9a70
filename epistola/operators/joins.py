"""Lookups between mails, stored results and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import ordinals


def unseen(rows: DataFrame, stored: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys aren't stored yet."""
    return rows.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def with_cache(files: DataFrame, cache: DataFrame, *keys: str) -> DataFrame:
    """Files with their cached text; `hit` tells what must be extracted."""
    return files.join(cache.withColumn("hit", F.lit(True)), list(keys), "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def date_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every day of a range, ends included."""
    if first > last:
        raise ValueError("the range ends before it begins")
    return spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS day")


def on_spine(spine: DataFrame, results: DataFrame) -> DataFrame:
    """A row for each day of the spine, with its results or none."""
    return spine.join(results.withColumn("found", F.lit(True)), "day", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def best_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key, by `order`: what a lookup of that key would take, so that no lookup multiplies rows."""
    return rows.groupBy(*keys).agg(F.min(order).alias(order))


def first_of(left: DataFrame, tables, rules: list[list[str]], value: str) -> DataFrame:
    """left with `value` and the number of the first rule whose table has it; rows that no rule finds are left out."""
    for n, (found, keys) in enumerate(zip(tables, rules, strict=True)):
        left = left.join(found.withColumnRenamed(value, f"{value}_{n}"), keys, "left")
    hits = [F.col(f"{value}_{n}") for n in range(len(rules))]
    rule = F.coalesce(*[F.when(h.isNotNull(), F.lit(n)) for n, h in enumerate(hits)])
    return left.withColumns({"rule": rule, value: F.coalesce(*hits)}).where("rule is not null")


numbered = ordinals.numbered


def limited(rows: DataFrame, by: str, most: int | None, *order) -> DataFrame:
    """The first `most` rows of each group; all without a limit. Spark keeps no more than that of a group in each task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("long")
    return rows if most is None else rows.withColumn("n", place).where(F.col("n") <= most)
