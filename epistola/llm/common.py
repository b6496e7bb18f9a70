"""Shared helpers of the training-data operators: tables, work folders, Arrow batches."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import forget, settle  # noqa: F401  (the operators of this subpackage take them from here)
from ..operators.components import shared_path as work_dir  # noqa: F401
from ..shipping import ship

#: Bytes of text handled at once inside a Python worker; bounds its memory whatever the partition size (Spark itself ends an Arrow batch at 64 MB).
CHUNK_BYTES = 1 << 20


#: Rows of an Arrow batch that the queries ask a session for: a batch of Spark's own size, 64 MB of texts, costs an executor several times that beside its heap.
BATCH = 1024


def prepared(query):
    """A query that first asks its session for Arrow batches of at most BATCH rows. Operators leave sessions as they are, and give the same rows with any."""

    @functools.wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
        return query(spark, *rest)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """A text as a string; a null one is empty."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so that extra or clashing columns never reach an operator; a null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))


def digest(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text, as columns d1 and d2: two texts meet in both with a chance of 2 to the power -128."""
    return [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit("second"), text).alias("d2")]


def renamed(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """docs with its columns named c0, c1, ..., so that no name clashes, and the new name of its text."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), f"c{docs.columns.index(text_col)}"


#: Bits of a filter for each key and probes of a key; bits of a filter, at least and at most (32 MB).
SPREAD, PROBES, SMALLEST, LARGEST = 16, 4, 1 << 12, 1 << 28


def _probes(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), key), F.lit(bits)) for k in range(PROBES)]


def bit_filter(keys: DataFrame, column: str, spread: int = SPREAD) -> DataFrame:
    """One row with a bit filter of the keys, as an array of longs, of which LARGEST bits at most: what `passed` needs, and what is broadcast, is bounded.

    With more keys than the bits are for, the filter only lets more strangers pass.
    """
    n = keys.count()
    bits = min(LARGEST, max(SMALLEST, 1 << (spread * n).bit_length()))
    marks = keys.select(F.explode(F.array(*_probes(F.col(column), bits))).alias("at"))
    words = marks.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63).cast("long")).cast("int"))).alias("value")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("value").to_numpy()
    return keys.sparkSession.createDataFrame(pa.table({"bits": pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), pa.array(table))}))


def passed(rows: DataFrame, found: DataFrame, column: str, by: bool = True) -> DataFrame:
    """The rows whose key may be among the filter's keys; with by=False those whose key surely isn't. Nothing is shuffled."""
    size = F.size("bits").cast("long") * 64
    hit = F.lit(True)
    for k in range(PROBES):
        at = F.pmod(F.xxhash64(F.lit(k), F.col(column)), size)
        hit = hit & (F.bit_get(F.get("bits", F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1)
    return rows.join(F.broadcast(found), hit, "left_semi" if by else "left_anti")


def without(rows: DataFrame, gone: DataFrame, names: list[str], column: str) -> DataFrame:
    """The rows whose `names` aren't in the settled table `gone`. Only rows that pass a bit filter of `column` are joined, so the others aren't shuffled."""
    found = bit_filter(gone, column)
    return passed(rows, found, column, False).unionByName(passed(rows, found, column).join(gone, names, "left_anti"))


def bounded_batches(batches, limit: int = CHUNK_BYTES):
    """Record batches cut so that the text (column 1) of each holds about `limit` bytes, one document at least."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < n:
            base = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def raw_text(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one array, and the n + 1 offsets of its rows, without a copy."""
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def crc_mod(id_col, m: int):
    """crc32 of the id written as text, modulo m: the fold of a document."""
    return F.crc32(id_col.cast("string").cast("binary")) % m


def parts_of(df: DataFrame, size: int = 16 << 20, most: int = 1 << 14) -> int:
    """Parts of about `size` bytes to deal rows into, by Spark's estimate of the input's size, for which nothing runs; at least one a core, `most` at most."""
    spark = df.sparkSession
    size_in_bytes = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(most, max(spark.sparkContext.defaultParallelism, -(-size_in_bytes // size)))


def within(sizes: list[int], budget: int) -> list[int]:
    """The places, in order, of the sizes that add up to at most `budget`; one over an eighth of it is passed over."""
    kept, used = [], 0
    for i, size in enumerate(sizes):
        if size <= budget // 8 and used + size <= budget:
            kept.append(i)
            used += size
    return kept


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, held_out: int, limit: int, budget: int) -> DataFrame:
    """(doc_id, text, label) of at most `limit` labelled documents outside the held-out fold, of at most `budget` bytes of text (see `within`).

    The sample goes by the smallest hashes of the ids, so it doesn't depend on partitioning. Repeated or contradictory label rows count once, by their
    largest label; of a repeated id's texts the one with the smallest hash is taken, once. Only ids below a hash that gives four times as many as
    asked for are grouped, all if that isn't enough.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
    rows = rows.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), folds) != held_out))
    order, share = F.xxhash64("doc_id"), min(1.0, 4 * limit / max(1, rows.count()))
    while True:
        low = rows if share >= 1 else rows.where(order < F.lit(int(-(2**63) + share * 2**64)))
        picked = low.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(order, "doc_id").limit(limit)
        ids = picked.collect()  # at most `limit` pairs of numbers
        if len(ids) == limit or share >= 1:
            break
        share = min(1.0, 16 * share)
    spark, plain = docs.sparkSession, texts(docs)
    asked = F.broadcast(spark.createDataFrame([tuple(r) for r in ids], "doc_id long, label int"))  # at most `limit` rows
    sized = plain.join(asked, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"))).alias("t"))
    place = {r["doc_id"]: i for i, r in enumerate(ids)}
    found = sorted(sized.collect(), key=lambda r: place[r["doc_id"]])  # a row of numbers for each
    kept = [(found[i]["doc_id"], found[i]["label"], found[i]["t"]["h"]) for i in within([r["t"]["size"] for r in found], budget)]
    chosen = F.broadcast(spark.createDataFrame(kept, "doc_id long, label int, h long"))  # at most `limit` rows
    return plain.withColumn("h", F.xxhash64("text")).join(chosen, ["doc_id", "h"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "label")


def filter_rows(docs: DataFrame, passes, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text passes, all columns kept whatever their names, without a shuffle.

    passes(column) gives a boolean array for an Arrow column of texts, in which a null is an empty string.
    """
    plain, name = renamed(docs, text_col)
    names, text = plain.columns, whole(name)
    schema = ", ".join(f"{n} {kind}" for n, kind in plain.dtypes)

    def run(batches):
        for batch in bounded_batches(batches):
            kept = pa.RecordBatch.from_arrays(batch.columns[2:], names=names).filter(pa.array(passes(batch.column(1))))
            if kept.num_rows:
                yield kept

    return plain.select(F.lit(0).alias("pad"), text.alias("checked"), *names).mapInArrow(run, schema).toDF(*docs.columns)
