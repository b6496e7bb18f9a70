"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the k smallest distinct 64-bit hashes of a text's word shingles. Sketches of parts merge into that of
the whole: the k smallest of both. Where a sketch has fewer than k hashes it holds them all, and estimates are exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_of, texts

#: Hashes kept, and words of a shingle. The standard error of a resemblance is at most 0.5 / sqrt(K).
K, WORDS = 128, 5


#: Bytes of input for a bucket of documents, and buckets, at most.
BUCKET, BUCKETS = 4 << 20, 1 << 13


def words(text: Column) -> Column:
    """Lower-case words; an empty text has none. (`lower` takes half the time of a translation of A to Z alone.)"""
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(hashes: Column, n: int = WORDS) -> Column:
    """Hashes of runs of n words, given the array of the words' hashes; a shorter text is one shingle, no words none."""
    size = F.size(hashes)
    runs = F.transform(F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(n)]))
    whole = F.array(F.aggregate(hashes, F.lit(n).cast("long"), lambda acc, x: F.xxhash64(acc, x)))
    return F.when(size >= n, runs).when(size > 0, whole).otherwise(F.array().cast("array<bigint>"))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together; null counts as empty."""
    empty = F.array().cast("array<bigint>")
    return bottom(F.concat(F.coalesce(a, empty), F.coalesce(b, empty)), k)


def merged(sketches: Column, k: int = K) -> Column:
    """Of an aggregation's collected sketches, where the caller knows that a group is small; large groups use `merge_groups`."""
    return bottom(F.flatten(sketches), k)


def merge_groups(parts: DataFrame, keys: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch for each group, however large: hashes are deduplicated and ranked in salted parts before the groups meet.

    Each of the 64 parts of a group keeps its own k smallest hashes, so that at most 64 k rows of a group meet in one task.
    """
    rows = parts.select(*keys, F.explode(sketch).alias("h")).distinct()
    salted = Window.partitionBy(*keys, F.pmod("h", F.lit(64))).orderBy("h")
    few = rows.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= k)
    return few.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list("h")), 1, k).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of two shingle sets: the share of the union's k smallest hashes that both hold; 1 for two empty sets."""
    both = F.array_intersect(a, b)
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    hits = F.size(F.array_intersect(union, both))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(hits / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k hashes, else (k - 1) over the k-th smallest hash's share of the range."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b also has, from the resemblance and the sizes; 1 if a is empty."""
    r, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r / (1 + r) * (na + nb) / na))


def as_text(sketch: Column) -> Column:
    """16 hexadecimal digits for each hash, in order; empty for no shingles."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def sketch_texts(docs: DataFrame, text: str, into: str, n: int = WORDS, k: int = K) -> DataFrame:
    """Adds the sketch of column `text` as column `into`, in two steps so that the words are hashed once."""
    hashed = docs.withColumn(f"{into}_h", F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
    return hashed.withColumn(into, bottom(shingle_hashes(F.col(f"{into}_h"), n), k)).drop(f"{into}_h")


def bucket_of(cuts: list[int], value: Column) -> Column:
    """The number of cuts (descending) at or above a value, less one, by looking through every n-th cut and then through the n from there."""
    n = max(1, math.isqrt(len(cuts)))
    longs = lambda xs: F.array(*[F.lit(c).cast("long") for c in xs])
    above = lambda some: F.size(F.filter(some, lambda c: c >= value))
    coarse = F.greatest(above(longs(cuts[::n])) - 1, F.lit(0))
    return coarse * n + above(F.get(F.array(*[longs(cuts[i : i + n]) for i in range(0, len(cuts), n)]), coarse)) - 1


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch) of every row, next by descending doc_id (null ids last, equal ids by text); the last's next is the first.

    Rows go to buckets between quantiles of doc_id, which are ids that exist; the first row of a bucket is also sent to the bucket
    before it, where it stands behind the others. So texts are shuffled once, each bucket is a partition of its own, and no task sees more than a bucket.
    A single row is its own next; a null text is to be given as empty; an empty table gives no rows.
    """
    ids = docs.where("doc_id is not null")
    asked = [i / parts for i in range(1, parts)] + [1.0]
    found = ids.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, asked)), 10 * max(1000, parts))).first()[0]
    cuts = sorted(set(found or [0]), reverse=True)  # the largest id first; at most `parts` values reach the driver
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) - 1)).otherwise(bucket_of(cuts, F.col("doc_id")))
    # the bucket that this row may be the first of is its own, if its id is the bucket's cut
    is_head = F.get(F.array(*[F.lit(c).cast("long") for c in cuts]), bucket) == F.col("doc_id")
    before = F.when(is_head, F.when(bucket == 0, F.lit(len(cuts) - 1)).otherwise(bucket - 1))
    one = F.struct(bucket.cast("int").alias("b"), F.lit(False).alias("ghost"))
    rows = docs.select("doc_id", "text", F.explode(F.when(before.isNotNull(), F.array(one, F.struct(before.cast("int").alias("b"), F.lit(True).alias("ghost")))).otherwise(F.array(one))).alias("at"))
    if not found:  # ids are null throughout or there are no rows: the first row by text follows the last
        first = docs.select("doc_id", "text").orderBy("text").limit(1).select("doc_id", "text", F.struct(F.lit(0).alias("b"), F.lit(True).alias("ghost")).alias("at"))
        rows = rows.unionByName(first)
    rows = sketch_texts(rows.select("doc_id", "text", "at.b", "at.ghost").repartitionById(len(cuts), F.col("b")), "text", "sketch")
    order = Window.partitionBy("b").orderBy("ghost", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    found = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order))
    return found.where(~F.col("ghost")).select("doc_id", "text", "sketch", "next_text", "next_sketch")


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/3) code points replaced by the first as many, or all, of the following text."""
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def compare(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles, within_edited) of every row of docs.

    Null texts are empty, and two texts without words are alike; rows with a null id come after the others, and rows of equal ids in the order of their
    texts, so repeated rows follow each other. A single row follows itself, an empty table gives no rows, other columns are ignored.
    """
    plain = texts(docs)
    rows = with_next(plain, parts_of(plain, BUCKET, BUCKETS))
    rows = sketch_texts(rows.withColumn("edited", edited(F.col("text"), F.col("next_text"))), "edited", "edited_sketch")
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("n_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("within_edited"),
    )
