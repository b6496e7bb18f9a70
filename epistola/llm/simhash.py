"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints at most D bits apart agree on at least one of the choices of m - D among m blocks of bits. For each choice, fingerprints
go to shards by the top bits of the chosen blocks; a shard too large for one task is dealt into chunks, each chunk and each pair of chunks being
a group of its own, so nothing is capped. Inside a group the fingerprints are sorted by Gray rank, which brings alike patterns together,
and every 16 neighbours, then every 16 groups, share an upper node with the bits on which all below agree. A search adds up the
differences on those shared bits from the root down, counting at each node only the bits new to it, and drops a node with all below it
as soon as the sum exceeds D. A group returns a spanning forest of the links that it finds, never all pairs, and the forests are joined into
components by alternating star contractions, whose state is a table in the shared folder.

Near copies (`keep_one`) take the same index with a wide radius. Texts of a Jaccard similarity of LEAST or more in their sets of five-word shingles
lie about 20 of 128 bits apart and at most WIDE, which is too far for blocks to agree for certain; shards are then random choices of bits, as many as let RECALL of the
pairs at the very threshold meet in one, and more of those that are closer. Near pairs of a shard are only candidates: a link is a pair whose texts pass when compared
shingle by shingle. A forest of the candidates of a few choices is compared first, which joins large groups at a link or two for each text; then texts that have
a candidate outside their group in any shard are brought there, and all such candidates are compared until none is left between two groups. A pair
counts as a candidate only if its sizes and sketches (`sketches`) leave room for LEAST, which refuses no pair that would pass: else the texts of a large family that are
too far from all others for a link would be compared with every one of it, shingle by shingle.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import bit_filter, bounded_batches, digest, passed, raw_text, renamed, settle, texts, whole, without
from .vector import NOT_SPACE, hashes, mix, spans

BITS, SEED, WORDS, MAX_DIFF = 64, 42, 4, 4
#: Fingerprints that a group should index, and the size from which a shard is dealt into chunks; children of an index node.
SHARD, LARGE, FAN = 8192, 8192, 16
#: Candidate pairs held at once while searching.
PAIRS = 1 << 21
#: Near copies: words of a shingle, similarity, bits of a fingerprint, bits that near copies differ in at most, and the radii at which the
#: first round takes candidates, near ones first; share of the pairs at the threshold that meet in a shard, fingerprints of a shard, choices of the
#: first round; shingles of a chunk, from which on a shard is dealt into chunks too.
SHINGLE, LEAST, WIDE_BITS, WIDE, STEPS = 5, 0.8, 128, 32, (8, 16, 24, 32)
RECALL, BUCKET, FIRST, HEAVY = 0.99, 1024, 2, 1 << 21
#: Words of 64 bits of a sketch that goes with a fingerprint, and of one made in a group, at most; pairs whose sketches are compared at once.
SKETCH, LONGEST, PORTION = 4, 256, 1 << 16
_U = np.uint64


def fingerprint(text: str, n: int = WORDS) -> int:
    """The signed 64-bit SimHash of a text's n-word shingles, repeats included."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    flat = b" ".join(w)
    if len(w) <= n:
        hashed = np.array([xxhash.xxh64_intdigest(flat, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest_ = xxhash.xxh64_intdigest
        hashed = np.fromiter([digest_(flat[a:b], SEED) for a, b in zip(starts[: len(w) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)], np.uint64, len(w) - n + 1)
    return int(majority(hashed).view(np.int64))


def majority(h: np.ndarray) -> np.uint64:
    """The bits that are set in over half of the hashes."""
    count = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 14):
        count += np.unpackbits(h[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0]


def fingerprints(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """(doc_id, fp) of every row; null, empty and blank texts have fingerprint 0."""

    def run(batches):
        for batch in bounded_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t, n) for t in batch.column(1).to_pylist()], pa.int64())], names=["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


# index -------------------------------------------------------------------------------------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> _U(step)
    return rank


def gray_order(codes: np.ndarray) -> np.ndarray:
    """The order of codes (n, words) in the reflected Gray sequence of all their bits, the first word's first."""
    ranks, odd = [], np.zeros(len(codes), bool)
    for word in codes.T:
        rank = np.where(odd, ~gray_rank(word), gray_rank(word))
        odd = (rank & _U(1)).astype(bool)
        ranks.append(rank)
    return np.lexsort(ranks[::-1])


class GrayIndex:
    """Levels of (pattern, mask of the bits that the parent does not share), leaves first; codes (n, words) in Gray order."""

    def __init__(self, codes: np.ndarray, fan: int = FAN):
        self.order = gray_order(codes)
        self.codes, self.fan = codes[self.order], fan
        pattern, mask = self.codes, np.full(codes.shape, ~_U(0))
        self.levels = []
        while len(pattern) > fan:
            heads = np.arange(0, len(pattern), fan)
            same = np.bitwise_and.reduceat(mask, heads)
            ones = np.bitwise_and.reduceat(pattern, heads)
            zeros = np.bitwise_and.reduceat(~pattern, heads)
            up_mask = same & (ones | zeros)
            self.levels.append((pattern, mask & ~np.repeat(up_mask, fan, axis=0)[: len(pattern)]))
            pattern, mask = ones & up_mask, up_mask
        self.levels.append((pattern, mask))

    def search(self, queries: np.ndarray, most: int, after: int = 0):
        """(query, place) index arrays of all codes at most `most` bits from a query, in portions of bounded size; places before `after` may be left out."""
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        stack = [(top, np.repeat(np.arange(len(queries)), n), np.tile(np.arange(n), len(queries)), np.zeros(len(queries) * n, np.uint16))]
        while stack:
            level, q, node, acc = stack.pop()
            pattern, fresh = self.levels[level]
            for w in range(queries.shape[1]):
                acc = acc + np.bitwise_count((queries[q, w] ^ pattern[node, w]) & fresh[node, w])
            near = acc <= most
            q, node, acc = q[near], node[near], acc[near]
            if not len(q):
                continue
            if level == 0:
                yield q, node
                continue
            below, span = len(self.levels[level - 1][0]), self.fan ** (level - 1)
            for at in range(0, len(q), PAIRS // self.fan):
                part = slice(at, at + PAIRS // self.fan)
                child = (node[part, None] * self.fan + np.arange(self.fan)).ravel()
                real = (child < below) & ((child + 1) * span > after)
                stack.append((level - 1, np.repeat(q[part], self.fan)[real], child[real], np.repeat(acc[part], self.fan)[real]))


def near(codes: np.ndarray, most: int, second: np.ndarray | None = None):
    """Places (a, b) of all pairs of codes at most `most` bits apart, in portions; with `second` only pairs of a marked and an unmarked code."""
    held = np.arange(len(codes)) if second is None else np.flatnonzero(~second)
    asked = held if second is None else np.flatnonzero(second)
    if not len(held) or not len(asked):
        return
    index = GrayIndex(codes[held])
    held = held[index.order]
    asked = held if second is None else asked[gray_order(codes[asked])]
    for at in range(0, len(asked), 256):
        some = asked[at : at + 256]
        for q, node in index.search(codes[some], most, at if second is None else 0):
            yield some[q], held[node]


class Groups:
    """Labels of places that grow together, pair by pair."""

    def __init__(self, label: np.ndarray):
        self.label = np.unique(label, return_inverse=True)[1]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.label[a] != self.label[b]

    def join(self, a: np.ndarray, b: np.ndarray, passes=None) -> list[int]:
        """Joins the groups of each pair (that passes, if its groups are still apart), and tells which pairs joined two groups."""
        parent: dict[int, int] = {}

        def root(x):
            while (p := parent.get(x, x)) != x:
                x = p
            return x

        done = []
        for i, (x, y) in enumerate(zip(self.label[a].tolist(), self.label[b].tolist(), strict=True)):
            x, y = root(x), root(y)
            if x != y and (passes is None or passes(i)):
                parent[max(x, y)] = min(x, y)
                done.append(i)
        if done:
            to = np.arange(self.label.max() + 1)
            moved = np.array(sorted(parent), np.int64)
            to[moved] = [root(x) for x in moved.tolist()]
            self.label = to[self.label]
        return done


def forest(codes: np.ndarray, radii=(MAX_DIFF,), label: np.ndarray | None = None, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of links of at most radii[-1] bits that join all that such links can join, near links first.

    label: codes with equal labels are joined already. second: marks codes that are compared with the unmarked ones only.
    """
    groups, out = Groups(np.arange(len(codes)) if label is None else label), []
    for most in radii:
        for a, b in near(codes, most, second):
            apart = groups.apart(a, b)
            if apart.any():
                a, b = a[apart], b[apart]
                x, y = groups.label[a], groups.label[b]
                first = np.unique(np.minimum(x, y) * (len(codes) + 1) + np.maximum(x, y), return_index=True)[1]
                done = groups.join(a[first], b[first])
                out.append(np.stack([a[first][done], b[first][done]]))
    a, b = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    return a, b


# links -------------------------------------------------------------------------------------------------------------------------------


def block_choices(n: int, most: int = MAX_DIFF, bits: int = BITS, shard: int = SHARD) -> list[list[int]]:
    """Lists of bit positions; two codes at most `most` apart agree on all bits of one list at least. More blocks, and so longer keys, for more codes."""
    for m in range(most + 1, bits + 1):
        edges = [round(i * bits / m) for i in range(m + 1)]
        blocks = [list(range(edges[i], edges[i + 1])) for i in range(m)]
        choices = [sum((blocks[i] for i in chosen), []) for chosen in itertools.combinations(range(m), m - most)]
        if n >> min(len(c) for c in choices) <= shard or m - most >= 4:
            return choices
    raise ValueError("most must be less than bits")


def random_choices(n: int, least: float = LEAST, recall: float = RECALL, bucket: int = BUCKET, bits: int = WIDE_BITS) -> list[list[int]]:
    """Lists of bit positions such that two sets of similarity `least` and equal size agree on all bits of one list with a chance of `recall`.

    Their shares cosine is 2 s / (1 + s), and a bit differs with the angle's share of a half turn. A list is as long as parts n codes into buckets.
    """
    agree = 1 - math.acos(2 * least / (1 + least)) / math.pi
    size = min(bits, max(1, math.ceil(math.log2(max(2, n / bucket)))))
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree**size)))
    r = np.random.Generator(np.random.PCG64(19))
    return [sorted(r.choice(bits, size, replace=False).tolist()) for _ in range(tables)]


_GROUP = ["part", "choice", "key", "i", "j"]


def deal(codes: DataFrame, n: int, choices: list[list[int]], shard: int = SHARD, large: int = LARGE) -> tuple[DataFrame, int]:
    """The rows of codes (node, joined, size, fp0, fp1, ...) in every group that they are searched in, and the number of parts that the groups are dealt to.
    Where codes have sketches (mark0, mark1, ...), the rows keep these and their size.

    A group is a shard, or of a shard with more than `large` rows or HEAVY sizes a chunk (i = j) or a pair of chunks, of which `own` is the row's.
    """
    words, marks = ([c for c in codes.columns if c.startswith(kind)] for kind in ("fp", "mark"))
    depth = max(0, math.ceil(math.log2(max(1, n / shard))))
    keys = []
    for positions in choices:
        key = F.lit(0).cast("long")
        for i, p in enumerate(positions[: min(depth, len(positions))]):
            key = key + F.shiftleft(F.shiftrightunsigned(words[p // 64], p % 64).bitwiseAND(F.lit(1).cast("long")), i)
        keys.append(key)
    dealt = codes.select("node", "joined", "size", *words, *marks, F.posexplode(F.array(*keys)).alias("choice", "key"))
    counts = dealt.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("all"))
    counts = counts.where((F.col("n") > large) | (F.col("all") > HEAVY)).select("choice", "key", F.greatest(F.ceil(F.col("n") / (large // 2)), F.ceil(F.col("all") / HEAVY)).cast("int").alias("chunks"))
    counts = settle(counts, "simhash-chunked")  # of the large shards only; Spark sees its size, and broadcasts it if it is small
    chunked = dealt.join(counts, ["choice", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(F.least(o, own).alias("i"), F.greatest(o, own).alias("j")))
    parts = max(1, math.ceil(n * len(choices) / SHARD))
    number = F.col("choice") * F.lit(1 << min(depth, 30)) + F.col("key")
    part = F.pmod(F.when(F.col("chunks") == 1, number).otherwise(F.xxhash64("choice", "key", "tile.i", "tile.j")), F.lit(parts)).cast("int")
    return chunked.select("*", F.explode(tiles).alias("tile")).select(part.alias("part"), "choice", "key", "tile.i", "tile.j", own.alias("own"), "node", "joined", *words, *(["size", *marks] if marks else [])), parts


def _codes(table: pa.Table) -> tuple[np.ndarray, np.ndarray | None]:
    """The fingerprints of a group's rows, and marks of the second chunk where two meet."""
    code = np.stack([table.column(c).to_numpy() for c in table.column_names if c.startswith("fp")], axis=1).view(np.uint64)
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    return code, table.column("own").to_numpy() == j if i != j else None


def links(codes: DataFrame, n: int, choices: list[list[int]], radii=(MAX_DIFF,), shard: int = SHARD, large: int = LARGE) -> DataFrame:
    """(a, b): links between nodes, near enough by radii, whose components are those of all such links in the shards of the choices.

    codes: (node, joined, size, fp0, fp1, ...), n distinct nodes, 64 bits to a word; rows with equal `joined` need no link.
    """
    tiled, parts = deal(codes, n, choices, shard, large)

    def find(table: pa.Table) -> pa.Table:
        code, second = _codes(table)
        node = table.column("node").to_numpy()
        a, b = forest(code, radii, table.column("joined").to_numpy(), second)
        return pa.table({"a": node[a], "b": node[b]})

    return tiled.repartitionById(parts, F.col("part")).groupBy(*_GROUP).applyInArrow(find, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, most: int = MAX_DIFF, n: int = WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of docs.

    component_id is the smallest doc_id among all rows whose fingerprints are linked, by steps of at most `most` bits, to this row's.
    Blank and null texts share fingerprint 0 and are linked like others; rows with a null id take part, but can't name a component (null
    if all its ids are null). Repeated rows stay repeated; other columns are ignored; an empty table gives no rows.
    """
    found = settle(fingerprints(docs, n), "simhash-fingerprints")
    distinct = settle(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    size = distinct.count()
    codes = distinct.select(F.col("fp").alias("node"), F.col("fp").alias("joined"), F.lit(0).alias("size"), F.col("fp").alias("fp0"))
    roots = components(links(codes, size, block_choices(size, most), (most,)))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(names, "root").select("fp", "component_id")
    return found.join(named, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# near copies -------------------------------------------------------------------------------------------------------------------------

_PLACES = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 62, SHINGLE + 1, dtype=np.uint64) * _U(2) + _U(1)


_MARKS = [f"mark{i}" for i in range(SKETCH)]


def shingles(h: np.ndarray) -> np.ndarray:
    """The sorted set of shingle hashes of a text's word hashes; a shorter text is one shingle, no words none."""
    n = len(h) - SHINGLE + 1
    if n < 1:
        h, n = np.concatenate([h, np.full(SHINGLE - len(h), len(h), np.uint64)]), min(1, len(h))
    key = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        key += h[i : i + n] * _PLACES[i]
    return np.unique(mix(key))


def sets(column) -> list[np.ndarray]:
    """The shingle sets of a column of texts; words are compared without regard to the case of A to Z."""
    data, offsets = raw_text(column)
    starts, ends, before = spans(data, offsets, NOT_SPACE)
    h = hashes(data, starts, ends)
    return [shingles(h[a:b]) for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True)]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return both / (len(a) + len(b) - both)


def sketches(held: list[np.ndarray], words: int) -> np.ndarray:
    """(sets, words) of 64 bits, `words` a power of 2: each bit tells whether an odd number of a set's hashes falls on it.

    What two sets share cancels out, so their sketches differ in no more bits than the sets in hashes.
    """
    out, shift = np.zeros((len(held), words), np.uint64), _U(64 - (64 * words - 1).bit_length())
    for row, s in zip(out, held, strict=True):
        row[:] = np.packbits((np.bincount((s >> shift).astype(np.int64), minlength=64 * words) & 1).astype(np.uint8), bitorder="little").view("<u8")
    return out


def alike(a: np.ndarray, b: np.ndarray, size: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Which pairs of places may have a similarity of LEAST, by their sets' sizes and sketches: all that have it, and some that don't.

    Sets of that similarity differ in (1 - LEAST) / (1 + LEAST) of their sizes' sum at most.
    """
    x, y = size[a], size[b]
    may = np.flatnonzero(np.minimum(x, y) >= LEAST * np.maximum(x, y))
    a, b, most, apart = a[may], b[may], (x + y)[may] * ((1 - LEAST) / (1 + LEAST)) + 1e-6, np.zeros(len(may), np.int32)
    for mark in marks.T:
        apart = apart + np.bitwise_count(mark[a] ^ mark[b])
        near_ = apart <= most
        may, a, b, most, apart = may[near_], a[near_], b[near_], most[near_], apart[near_]
    return may


def _sign(batches):
    for batch in bounded_batches(batches):
        found = sets(batch.column(1))
        node = [mix(s * _PLACES[1]).sum(dtype=np.uint64) + _U(len(s)) for s in found]
        low, high = ([majority(x) for x in some] for some in (found, [mix(s ^ _PLACES[0]) for s in found]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), batch.column(3), batch.column(4), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (node, low, high, *sketches(found, SKETCH).T)), pa.array([len(s) for s in found], pa.int32())],
            names=["first_id", "d1", "d2", "node", "fp0", "fp1", *_MARKS, "size"],
        )


def _compare(batches):
    for batch in batches:
        kept = []
        for at in range(0, batch.num_rows, 64):
            a, b = (sets(batch.column(c).slice(at, 64)) for c in (2, 3))
            kept += [at + i for i, (x, y) in enumerate(zip(a, b, strict=True)) if similarity(x, y) >= LEAST]
        rows = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])


def _outside(table: pa.Table) -> pa.Table:
    """The rows of a group that have a candidate in another joined group, without sizes and sketches."""
    code, second = _codes(table)
    size, marks = table.column("size").to_numpy().astype(np.int64), np.stack([table.column(c).to_numpy() for c in _MARKS], axis=1).view(np.uint64)
    groups, found = Groups(table.column("joined").to_numpy()), np.zeros(len(code), bool)
    for all_a, all_b in near(code, WIDE, second):
        for at in range(0, len(all_a), PORTION):
            a, b = all_a[at : at + PORTION], all_b[at : at + PORTION]
            asked = groups.apart(a, b) & ~(found[a] & found[b])
            a, b = a[asked], b[asked]
            may = alike(a, b, size, marks)
            found[a[may]] = found[b[may]] = True
    return table.drop_columns(["size", *_MARKS]).filter(pa.array(found))


def _compare_all(table: pa.Table) -> pa.Table:
    """Links (a, b) that join all rows of a group that candidates which pass can join."""
    code, second = _codes(table)
    node, held = table.column("node").to_numpy(), []
    for chunk in table.column("text").chunks:
        held += sets(chunk)
    size = np.array([len(s) for s in held])
    marks = sketches(held, min(LONGEST, max(SKETCH, 1 << (int(np.median(size)) // 32).bit_length())))  # two bits for a shingle of the middle text
    groups, out = Groups(table.column("joined").to_numpy()), []
    for all_a, all_b in near(code, WIDE, second):
        for at in range(0, len(all_a), PORTION):
            a, b = all_a[at : at + PORTION], all_b[at : at + PORTION]
            apart = groups.apart(a, b)
            a, b = a[apart], b[apart]
            may = alike(a, b, size, marks)
            a, b = a[may], b[may]
            done = groups.join(a, b, lambda i, a=a, b=b: similarity(held[a[i]], held[b[i]]) >= LEAST)
            out.append(np.stack([node[a[done]], node[b[done]]]))
    a, b = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    return pa.table({"a": a, "b": b})


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs without the near copies, all columns: of each group of rows linked by a similarity of LEAST or more one stays.

    It is the row with the smallest id, a null id being the largest; where an id is repeated, the row whose text has the smallest digest, once.
    Texts without words are copies of each other; null texts count as empty. Texts with equal sets of shingles always meet, and of the other pairs at the
    very threshold a share of RECALL; a pair that meets is linked. An empty table gives no rows.
    """
    plain, text = renamed(docs)
    number = F.col(plain.columns[docs.columns.index("doc_id")]).cast("long")
    key = [F.struct(number.isNull().alias("none"), F.coalesce(number, F.lit(0)).alias("id")).alias("first_id"), *digest(whole(text))]
    rows = plain.select(F.lit(0).alias("pad"), whole(text).alias("text"), *key)
    kind = "first_id struct<none:boolean,id:long>, d1 long, d2 long"
    signed = settle(rows.mapInArrow(_sign, f"{kind}, node long, fp0 long, fp1 long, {''.join(f'{c} long, ' for c in _MARKS)}size int"), "copies-signed")
    first = [F.min(F.struct("first_id", "d1", "d2")).alias("first"), *(F.min(c).alias(c) for c in ("fp0", "fp1", *_MARKS, "size"))]  # of equal sets all of these are equal
    nodes = settle(signed.groupBy("node").agg(*first), "copies-nodes")
    n = nodes.count()
    choices = random_choices(n)

    def with_texts(wanted: DataFrame) -> DataFrame:
        named = settle(wanted.select("node").distinct().join(nodes, "node").select("node", "first.*"), "copies-wanted")  # a table, so that Spark sees its size
        may = passed(rows, bit_filter(named, "d1"), "d1").select("first_id", "d1", "d2", "text")
        return settle(may.join(named, ["first_id", "d1", "d2"]).select("node", "text").dropDuplicates(["node"]), "copies-texts")

    candidates = settle(links(nodes.select("node", F.col("node").alias("joined"), "size", "fp0", "fp1"), n, choices[:FIRST], STEPS, shard=BUCKET), "copies-candidates")
    given = with_texts(candidates.select(F.explode(F.array("a", "b")).alias("node")))
    both = candidates.join(given.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(given.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    linked = settle(both.select("a", "b", "x", "y").mapInArrow(_compare, "a long, b long"), "copies-links")

    codes = nodes.join(components(linked), "node", "left").select("node", F.coalesce("root", "node").alias("joined"), "size", "fp0", "fp1", *_MARKS)
    tiled, parts = deal(codes, n, choices, BUCKET)
    searched = tiled.repartitionById(parts, F.col("part")).groupBy(*_GROUP).applyInArrow(_outside, tiled.drop("size", *_MARKS).schema)
    outside = settle(searched, "copies-outside")
    compared = outside.join(with_texts(outside), "node").select(*outside.columns, "text").repartitionById(parts, F.col("part")).groupBy(*_GROUP).applyInArrow(_compare_all, "a long, b long")
    roots = components(linked.unionByName(compared))

    group = nodes.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "first")
    stays = group.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    names = ["first_id", "d1", "d2"]
    rows_of = signed.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    goes = settle(rows_of.join(stays, names, "left_anti").select(*names), "copies-go")
    again = settle(rows_of.where("n > 1").join(stays, names, "left_semi").select(*names), "copies-again")
    named = without(plain.select("*", *key), goes, names, "d1")
    if again.head(1):  # rows of one id and one text, of which one stays
        same = passed(named, bit_filter(again, "d1"), "d1").join(again, names, "left_semi").dropDuplicates(names)
        named = without(named, again, names, "d1").unionByName(same)
    return named.select(*plain.columns).toDF(*docs.columns)
