"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words: the hash of the words at its 1s ignores the words at its 0s, so a substituted word breaks
only the seeds that look at it. The seed hashes of the benchmark are a table; so are those of the documents, which each task first looks up in
a bit filter of the benchmark's seeds (at most LARGEST bits, so its broadcast is bounded), keeping the few positions that may match with the words around
them. Spark joins the two tables by hash. A joined pair fixes an alignment of an item with a document, and each distinct alignment is verified once:
a document is contaminated where at least RATIO of the words in some window of WINDOW words (the whole item, if shorter) agree. Every such window
holds a seed, so nothing outside the kept words can add one. Items of fewer than six words are matched by masks over the whole item, at the same share.

Equal texts are told by a digest and handled once. A hash that many documents share is parted by salt where the benchmark's table is too large to broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, digest, raw_text, renamed, settle, texts, whole, without
from .vector import LETTERS, hashes, mix, spans

#: Masks, five words each; every window with four of five words intact, in whatever pattern, holds one of them within a few words.
MASKS = ["111101", "101111", "110111", "11100101", "11010011"]
#: More masks for items that the five don't cover, by the item's words: whole items up to four, all but any one word of five or six.
SHORT = {1: ["1"], 2: ["11"], 3: ["111"], 4: ["1111"], 5: ["1111", "10111", "11011", "11101"], 6: ["11111", "111011"]}
_ALL = list(dict.fromkeys(MASKS + [m for some in SHORT.values() for m in some]))
#: Words of the window that is verified, and the share of them that must agree; words from which an item has the five masks.
WINDOW, RATIO, LEAST = 20, 0.8, 6
#: Bits of the filter for each seed, bits of it at least and at most (64 MB), and probes of a seed. A fuller filter lets more positions through to the join.
SPREAD, SMALLEST, LARGEST, PROBES = 64, 1 << 16, 1 << 29, 4
#: Benchmark seeds up to which their table (24 bytes each) is broadcast; beyond, each is sent to SALTS parts.
BROADCAST, SALTS = 1 << 20, 8

_INSIDE = LETTERS.copy()
_INSIDE[48:58] = True
_FACTORS = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_U = np.uint64


def seeds(h: np.ndarray, mask: int) -> np.ndarray:
    """The hash of each position's mask, for the positions at which the mask fits into h."""
    places = [i for i, c in enumerate(_ALL[mask]) if c == "1"]
    n = max(0, len(h) - len(_ALL[mask]) + 1)
    key = np.full(n, mask, np.uint64)
    for j, i in enumerate(places):
        key += h[i : i + n] * _FACTORS[j]
    return key


def masks_of(n: int) -> list[int]:
    """The masks that find an item of n words."""
    return [_ALL.index(m) for m in (MASKS if n >= LEAST else []) + SHORT.get(n, [])]


def probe(keys: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th bit of each key in a filter of `bits` bits, a power of two."""
    m = mix(keys)
    return ((m & _U(0xFFFFFFFF)) + _U(k) * (m >> _U(32) | _U(1))) & _U(bits - 1)


def lone_characters(data: np.ndarray) -> np.ndarray:
    """The edges of the characters of scripts without spaces (Thai, Lao, Burmese, Khmer, kana, Han), each of which is a word."""
    at = np.flatnonzero(data >= 0xE0)
    a, b = data[at], data[at + 1]
    south = (a == 0xE0) & (b >= 0xB8) & (b <= 0xBB) | (a == 0xE1) & ((b >= 0x80) & (b <= 0x82) | (b == 0x9E) | (b == 0x9F))
    east = (a == 0xE2) & (b >= 0xBA) | (a >= 0xE3) & (a <= 0xE9) | (a == 0xEF) & ((b >= 0xA4) & (b <= 0xAB) | (b == 0xBC) | (b == 0xBD))
    alone = south | east | (a == 0xF0) & (b >= 0xA0)
    at, size = at[alone], np.where(a[alone] == 0xF0, 4, 3)
    return np.concatenate([at, at + size])


def word_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a column of texts, and the words before each text."""
    data, offsets = raw_text(column)
    starts, ends, _ = spans(data, np.union1d(offsets, lone_characters(data)), _INSIDE)
    return hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(parts) if parts else np.zeros(0), kind))


class Benchmark:
    """The benchmark's items (k, item_id, words) and seeds (key, k, place) as settled tables, the number of seeds and the masks in use."""

    def __init__(self, benchmark: DataFrame):
        def hashed(batches):
            for batch in bounded_batches(batches):
                h, before = word_hashes(batch.column(1))
                words = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), words], names=["item_id", "words"])

        rows = texts(benchmark, "item_id").mapInArrow(hashed, "item_id long, words array<long>").where("size(words) > 0")
        self.items = settle(rows.withColumn("k", F.monotonically_increasing_id()), "decontam-items")  # written once, so that an item keeps its number
        sizes = self.items.select(F.least(F.size("words"), F.lit(LEAST + 1)).alias("n")).distinct().collect()  # at most LEAST + 1 rows
        self.masks = sorted({m for r in sizes for m in masks_of(r["n"])})

        def planted(batches):
            for batch in batches:
                for k, words in zip(batch.column(0).to_numpy(), batch.column(1), strict=True):
                    h = words.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                    found = [seeds(h, m) for m in masks_of(len(h))]
                    place = np.concatenate([np.arange(len(x)) for x in found])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.full(len(place), k)), pa.array(place.astype(np.int32))], names=["key", "k", "place"])

        self.seeds = settle(self.items.select("k", "words").mapInArrow(planted, "key long, k long, place int"), "decontam-seeds")
        self.n = self.seeds.count()

    def filter(self) -> np.ndarray:
        """The bit filter of the seeds, as bytes: tasks set bits, Spark joins them word by word, and LARGEST bits at most reach the driver."""
        bits = min(LARGEST, max(SMALLEST, 1 << (SPREAD * self.n - 1).bit_length() if self.n else 0))

        def mark(batches):
            for batch in batches:
                keys = np.unique(batch.column(0).to_numpy()).view(np.uint64)
                at = np.unique(np.concatenate([probe(keys, k, bits) for k in range(PROBES)]))
                word, first = np.unique(at >> _U(6), return_index=True)
                value = np.bitwise_or.reduceat(_U(1) << (at & _U(63)), first) if len(at) else at
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(value.view(np.int64))], names=["word", "value"])

        marked = self.seeds.select("key").mapInArrow(mark, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
        out = np.zeros(bits // 64, np.int64)
        out[marked.column("word").to_numpy()] = marked.column("value").to_numpy()
        return out.view(np.uint8)


def stretches(docs: DataFrame, bench: Benchmark) -> DataFrame:
    """(d1, d2, lo, words, hits) of every stretch of a text at whose positions the filter lets seeds through, settled, once for equal texts.

    words: hashes from WINDOW words before the first of its positions to WINDOW words after the last; lo: the place of the first of them
    in the text; hits: (at, key) by place in the text. Positions further apart than that are in stretches of their own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bench.filter())  # at most LARGEST bits
    masks, longest = bench.masks, max(map(len, _ALL))

    def look(h: np.ndarray, before: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places, keys = [], []
        for m in masks:
            key = seeds(h, m)
            at = np.arange(len(key))
            for k in range(PROBES):
                bit = probe(key[at], k, 8 * len(table))
                at = at[(table[(bit >> _U(3)).astype(np.int64)] >> (bit & _U(7)).astype(np.uint8)) & 1 == 1]
            whole_ = at + len(_ALL[m]) <= before[np.searchsorted(before, at, "right")] if len(at) else at > 0  # not across two texts
            places.append(at[whole_])
            keys.append(key[at[whole_]])
        place, key = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, keys))
        order = np.argsort(place, kind="stable")
        return place[order], key[order]

    def run(batches):
        table = shared.value
        for batch in bounded_batches(batches):
            h, before = word_hashes(batch.column(1))
            place, key = look(h, before, table)
            if not len(place):
                continue
            text = np.searchsorted(before, place, "right") - 1
            cut = np.flatnonzero(np.concatenate([[True], (np.diff(place) > 2 * WINDOW + longest) | (np.diff(text) > 0), [True]]))
            lo = np.maximum(before[text[cut[:-1]]], place[cut[:-1]] - WINDOW)
            hi = np.minimum(before[text[cut[:-1]] + 1], place[cut[1:] - 1] + longest + WINDOW)
            owner = text[cut[:-1]]
            spot = np.repeat(before[owner], np.diff(cut))
            edges = pa.array(cut.astype(np.int32))
            hits = pa.StructArray.from_arrays([pa.array((place - spot).astype(np.int32)), pa.array(key.view(np.int64))], names=["at", "key"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).take(pa.array(owner)), batch.column(3).take(pa.array(owner)), pa.array((lo - before[owner]).astype(np.int32)), _lists([h[a:b].view(np.int64) for a, b in zip(lo, hi, strict=True)], pa.int64()), pa.ListArray.from_arrays(edges, hits)],
                names=["d1", "d2", "lo", "words", "hits"],
            )

    rows = texts(docs).select("doc_id", "text", *digest(F.col("text")))
    found = rows.mapInArrow(run, "d1 long, d2 long, lo int, words array<long>, hits array<struct<at:int,key:long>>")
    return settle(found.dropDuplicates(["d1", "d2", "lo"]), "decontam-stretches")


def _verify(batches):
    """(d1, d2, item_id, share) of the alignments that hold: words a of the text beside words b of the item, which has `size` words in all."""
    for batch in batches:
        a, b = batch.column(3), batch.column(4)
        size = batch.column(5).to_numpy()
        kept, share = [], []
        for i in range(batch.num_rows):
            same = a[i].values.to_numpy(zero_copy_only=False) == b[i].values.to_numpy(zero_copy_only=False)
            w = min(int(size[i]), WINDOW)
            total = np.concatenate([[0], np.cumsum(same)])
            best = (total[w:] - total[:-w]).max() if len(same) >= w else total[-1]
            if best >= RATIO * w:
                kept.append(i)
                share.append(float(best / w))
        yield pa.RecordBatch.from_arrays([batch.column(j).take(pa.array(kept, pa.int64())) for j in range(3)] + [pa.array(share, pa.float64())], names=["d1", "d2", "item_id", "share"])


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(d1, d2, item_ids, overlap) by digest of every contaminated text of docs, settled."""
    bench = Benchmark(benchmark)
    parts = stretches(docs, bench)
    hits = parts.select("d1", "d2", "lo", F.explode("hits").alias("hit")).select("d1", "d2", "lo", "hit.at", "hit.key")
    if bench.n <= BROADCAST:
        joined = hits.join(F.broadcast(bench.seeds), "key")
    else:
        every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        joined = hits.withColumn("salt", F.pmod("d1", F.lit(SALTS)).cast("int")).join(bench.seeds.select("*", every), ["key", "salt"])
    aligned = joined.select("d1", "d2", "lo", "k", (F.col("at") - F.col("place")).alias("start")).distinct()
    both = aligned.join(parts.select("d1", "d2", "lo", "words"), ["d1", "d2", "lo"]).join(bench.items.select("k", "item_id", F.col("words").alias("item")), "k")
    begin = F.greatest(F.col("start") - F.col("lo"), F.lit(0))
    skip = F.greatest(F.col("lo") - F.col("start"), F.lit(0))
    n = F.least(F.size("words") - begin, F.size("item") - skip)
    beside = both.select("d1", "d2", "item_id", F.slice("words", begin + 1, n).alias("a"), F.slice("item", skip + 1, n).alias("b"), F.size("item").alias("size"))
    shares = beside.mapInArrow(_verify, "d1 long, d2 long, item_id long, share double")
    return settle(shares.groupBy("d1", "d2").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("overlap")), "decontam-found")


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, overlap) of every row of docs.

    item_ids: sorted distinct ids of the items found (one without an id contaminates, but isn't listed); overlap: the largest share of agreeing
    words in a window, 0 without one. Null and empty texts are clean, and so is everything beside an empty benchmark; null, empty and wordless items match
    nothing; repeated rows stay repeated; other columns are ignored; an empty table gives no rows.
    """
    rows = texts(docs)
    found = rows.select("doc_id", *digest(F.col("text"))).join(overlaps(docs, benchmark), ["d1", "d2"], "left")
    ids = F.coalesce("item_ids", F.array().cast("array<long>"))
    return found.select("doc_id", F.col("overlap").isNotNull().alias("contaminated"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), F.coalesce("overlap", F.lit(0.0)).alias("overlap"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a verified overlap, all columns; null and empty texts stay."""
    plain, text = renamed(docs)
    found = overlaps(docs, benchmark).select("d1", "d2")
    return without(plain.select("*", *digest(whole(text))), found, ["d1", "d2"], "d1").select(*plain.columns).toDF(*docs.columns)
