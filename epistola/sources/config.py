"""Prompts and providers, read once on the driver: small files that people write."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROVIDER = "provider string, priority int, retry_seconds double, failures_to_skip int, has_key boolean, active boolean"
#: What holds for a provider whose settings leave it open.
RETRY_SECONDS, FAILURES_TO_SKIP = 5.0, 3


def _whole(spark: SparkSession, path: str) -> str | None:
    """A small text file, from any store that Spark reads; None without the file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.text(path, wholetext=True).first()["value"]


def prompt(spark: SparkSession, path: str) -> str:
    """A prompt's text, trimmed. A prompt that is missing is an error: an answer to an error message would be taken for an answer."""
    text = _whole(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    return text.strip()


def providers(spark: SparkSession, path: str, keys: dict[str, str | None], default: tuple[str, ...] = ()) -> DataFrame:
    """A row for each provider of a JSON file {provider_order, provider_settings}, by priority, then by the order given.

    A provider is active if `keys` has a key for it. Without the file, or if it isn't JSON, the default order holds and settings are the usual ones;
    a provider without a priority comes after those that have one.
    """
    try:
        held = json.loads(_whole(spark, path) or "{}")
    except json.JSONDecodeError:
        held = {}
    names, settings = list(dict.fromkeys(held.get("provider_order", default))), held.get("provider_settings", {})
    rows = []
    for name in names:
        said = settings.get(name, {})
        has = bool(keys.get(name))
        rows.append((name, said.get("priority", len(names) + 1), float(said.get("retry_delay_seconds", RETRY_SECONDS)), said.get("max_failures_before_skip", FAILURES_TO_SKIP), has, has))
    return spark.createDataFrame(sorted(rows, key=lambda r: r[1]), PROVIDER)


def usable(failures: Column) -> Column:
    """Whether a provider's row is active and its failures in a row are fewer than those that take it out."""
    return F.col("active") & (F.coalesce(failures, F.lit(0)) < F.col("failures_to_skip"))
