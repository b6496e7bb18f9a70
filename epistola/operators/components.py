"""Tables in the shared folder, and connected components by alternating star contractions, each round such a table."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Links that one task finishes at once (16 bytes each); above it the contractions go on until nothing changes.
SMALL = 1 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which executors share. Only a local session, whose executors share its disk, may do without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='epistola-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df to the shared folder and reads it again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the files of a settled table that nothing will read again."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of links (u, v), and the smallest node that each reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        hooked = label.copy()
        for end in (a, b):
            np.minimum.at(hooked, label[end], low)
            np.minimum.at(hooked, end, low)
        while (hooked[hooked] != hooked).any():
            hooked = hooked[hooked]
        if (hooked == label).all():
            return nodes, nodes[label]
        label = hooked


def _finish(batches):
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if parts:
        nodes, roots = least_reached(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        apart = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(roots[apart])], names=["node", "root"])


def _minima(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m"))


def components(links: DataFrame, small: int = SMALL) -> DataFrame:
    """(node, root) of each node of `links` (a, b, longs) that isn't the smallest of its component: root is the smallest that it reaches.

    Each round replaces links by links to smaller nodes and is a table, and the one before it is deleted. At most `small` links are
    finished by one task, as that is less work than a round; with more the rounds go on until two checksums tell that nothing changes. A node's links
    meet only as partial minima, and the join that hands the minima out is one that AQE can split.
    """
    pairs = settle(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now[0] <= small:
            return settle(pairs.coalesce(1).mapInArrow(_finish, "node long, root long"), "roots")
        if now == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, last = now, pairs
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_minima(both), "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = _minima(large)
        low = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = settle(low.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        forget(last)
