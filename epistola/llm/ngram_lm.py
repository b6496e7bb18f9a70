"""Language-model scoring by an Elias-Fano n-gram trie.

Counting. Training texts are tokenised and hashed in whole batches; each task counts its own n-grams first, and packs them, sorted and
delta-coded, into one blob for each shard, so a frequent word or pair crosses the network once a task. Shards are ranges of the n-grams' sorted
keys; a word with more than its share of the tokens has shards of its own, parted by successor. Words get ids in order of their hashes. All n-grams
are kept; a caller may prune those below a count (`least`), whose mass then goes to the back-off, and a trigram is only counted where both its bigrams stay.

Trie. Each shard's level is one file in the shared folder, memory-mapped by every worker: a monotone sequence of (context, successor) keys in
Elias-Fano form (low bits packed at their exact width; for the high bits a monotone pointer for every run of about 16 keys
instead of unary code, which numpy can follow without a scan), and discounted log probabilities and back-off weights in steps of 1/5000,
as 16-bit codes. A bigram's context is a word; its first successor is kept as a monotone pointer. A trigram's context is the place of its first
bigram, and its last word is written as the place of the second bigram relative to the first successor of the middle word: a query finds both
bigrams and from them the trigram without looking at words again.

Model. Interpolated absolute discounting: p(w|uv) = a(uvw) + b(uv) (a(vw) + b(v) p(w)); p(w) = (c - D) / N, and what the discounts take is the
probability of the one unknown token. Codes are rounded down, so that probabilities of a context sum to one at most.
Scoring reads each document once, shuffles nothing, and needs the files of the shards that its texts touch only.
"""

from __future__ import annotations

import collections
import json
import mmap

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, crc_mod, parts_of, raw_text, texts, work_dir
from .vector import NOT_SPACE, hash_words, hashes, spans

FOLDS, HELD_OUT = 10, 0
#: Smoothing of the base score; discount of bigrams and trigrams; least count of a bigram or trigram in the trie, 1 for all.
ALPHA, DISCOUNT, LEAST = 0.1, 0.75, 1
#: Steps of a decade in quantised logarithms; keys in a run of the high bits; bytes of a chunk of text; n-grams that a task holds before it packs them.
STEPS, RUN, CHUNK, HELD = 5000, 16, 4 << 20, 3 << 20
#: Bytes of files that a worker holds where they can't be mapped; the one used longest ago goes first.
CACHE = 256 << 20
#: The hash of the end token, which can't be a word as it holds a space.
END = hash_words([" end"])[0]
_U = np.uint64


# files -------------------------------------------------------------------------------------------------------------------------------


def _open_store(path: str):
    return fs.FileSystem.from_uri(path)


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Writes named arrays as one file, whole or not at all: a retried or doubled task replaces it by an equal one."""
    head, at, body = {}, 0, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head[name] = [a.dtype.str, len(a), at]
        raw += b"\0" * (-len(raw) % 8)
        body.append(raw)
        at += len(raw)
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 8)
    store, place = _open_store(path)
    part = f"{place}.{np.random.SeedSequence().entropy:x}"
    with store.open_output_stream(part) as f:
        f.write(len(text).to_bytes(8, "little") + text + b"".join(body))
    store.move(part, place)


def load(path: str) -> tuple[dict[str, np.ndarray], int]:
    """A file's arrays, and the bytes of memory that they take: none if it is mapped straight from a shared file system, else all of it."""
    store, place = _open_store(path)
    if isinstance(store, fs.LocalFileSystem):
        with open(place, "rb") as f:
            raw, held = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), np.uint8), 0  # keeps no file open, however many shards there are
    else:
        with store.open_input_stream(place) as f:
            raw = np.frombuffer(f.read(), np.uint8)
        held = len(raw)
    n = int(raw[:8].view("<u8")[0])
    head = json.loads(raw[8 : 8 + n].tobytes())
    return {k: raw[8 + n + at : 8 + n + at + np.dtype(kind).itemsize * size].view(kind) for k, (kind, size, at) in head.items()}, held


class Cache:
    """Files of the last model that this process used; a worker process serves many tasks. Files in memory are held up to CACHE bytes."""

    def __init__(self):
        self.path, self.held, self.used = "", collections.OrderedDict(), 0

    def get(self, path: str, name: str):
        if path != self.path:
            self.path, self.used = path, 0
            self.held.clear()
        if name not in self.held:
            arrays, size = load(f"{path}/{name}")
            self.used += size
            while self.used > CACHE and self.held:
                self.used -= self.held.popitem(last=False)[1][2]
            self.held[name] = EliasFano(arrays, "seq"), arrays, size
        self.held.move_to_end(name)
        return self.held[name]


_FILES = Cache()


# Elias-Fano --------------------------------------------------------------------------------------------------------------------------


def ef_pack(values: np.ndarray, top: int, name: str) -> dict[str, np.ndarray]:
    """A sorted array of distinct values below `top` as packed low bits and pointers by high bits."""
    n = len(values)
    width = min(63, max(0, int(max(1, top) * RUN // max(1, n)).bit_length() - 1))
    high = (values >> _U(width)).astype(np.int64)
    size = (int(top) >> width) + 2
    pointers = np.searchsorted(high, np.arange(size)).astype(np.uint32 if n < 1 << 32 else np.uint64)
    packed = np.zeros((n * width + 7) // 8 + 16, np.uint8)
    for at in range(0, n, 1 << 16):  # 1 << 16 values fill whole bytes, whatever the width
        low = values[at : at + (1 << 16)]
        bits = ((low[:, None] >> np.arange(width, dtype=np.uint64)) & _U(1)).astype(np.uint8)
        some = np.packbits(bits.ravel(), bitorder="little")
        packed[at * width // 8 : at * width // 8 + len(some)] = some
    packed = packed[: len(packed) // 8 * 8]
    return {f"{name}_low": packed.view("<u8"), f"{name}_ptr": pointers, f"{name}_dim": np.array([n, width], np.int64)}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.low, self.ptr = arrays[f"{name}_low"], arrays[f"{name}_ptr"]
        self.n, self.width = map(int, arrays[f"{name}_dim"])

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        # two shifts, as a shift by 64 is undefined
        value = (self.low[word] >> shift) | ((self.low[word + 1] << (_U(63) - shift)) << _U(1))
        return value & _U((1 << self.width) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1: the run of its high bits, then a binary search of the low bits in it."""
        out = np.full(len(keys), -1, np.int64)
        if not self.n or not len(keys):
            return out
        high = (keys >> _U(self.width)).astype(np.int64)
        inside = high < len(self.ptr) - 1
        high = np.where(inside, high, 0)
        lo = self.ptr[high].astype(np.int64)
        hi = np.where(inside, self.ptr[high + 1], lo).astype(np.int64)
        live = np.flatnonzero(lo < hi)
        lo, hi, want = lo[live], hi[live], keys[live] & _U((1 << self.width) - 1)
        while len(live):
            mid = (lo + hi) >> 1
            got = self._low(mid)
            hit = got == want
            out[live[hit]] = mid[hit]
            less = got < want
            lo = np.where(less, mid + 1, lo)
            hi = np.where(less, hi, mid)
            on = ~hit & (lo < hi)
            live, lo, hi, want = live[on], lo[on], hi[on], want[on]
        return out


def quantise(p: np.ndarray) -> np.ndarray:
    """Probabilities as steps below 1, rounded down in probability."""
    return np.minimum(np.ceil(-np.log10(np.maximum(p, 1e-300)) * STEPS), 65535).astype(np.uint16)


_VALUE = 10.0 ** (-np.arange(65536) / STEPS)


# blobs -------------------------------------------------------------------------------------------------------------------------------


def pack_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as gaps, byte plane by byte plane, and counts; compressed."""
    gaps = np.diff(keys, prepend=_U(0))
    wide = counts.astype("<u4") if len(counts) and counts.max() > 255 else counts.astype(np.uint8)
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T
    raw = len(keys).to_bytes(8, "little") + bytes([wide.itemsize]) + np.ascontiguousarray(planes).tobytes() + wide.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpack_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    n, size = int.from_bytes(raw[:8], "little"), raw[8]
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 9).reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64), np.frombuffer(raw, np.uint8 if size == 1 else "<u4", n, 9 + 8 * n).astype(np.int64)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


class Gatherer:
    """Counts of one task, given out as (shard, blob) whenever HELD distinct keys are held. shard_of(keys) must not fall as keys grow."""

    def __init__(self, shard_of):
        self.shard_of, self.parts, self.held = shard_of, [], 0

    def add(self, keys: np.ndarray):
        got = np.unique(keys, return_counts=True)
        self.parts.append(got)
        self.held += len(got[0])
        if self.held >= HELD:
            self.parts = [merge_counts(self.parts)]
            self.held = len(self.parts[0][0])
            if self.held >= HELD // 2:
                yield from self.flush()

    def flush(self):
        if self.parts:
            keys, counts = merge_counts(self.parts)
            self.parts, self.held = [], 0
            rows = [(s, pack_counts(keys[a:b], counts[a:b])) for s, a, b in runs(self.shard_of(keys))]
            for at in range(0, len(rows), 64):
                some = rows[at : at + 64]
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in some], pa.int64()), pa.array([b for _, b in some], pa.binary())], names=["shard", "blob"])


def merged_shard(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack_counts(b) for b in frame["blob"]]
    while len(parts) > 1:  # pairwise, so that no more than twice the shard is held
        parts = [merge_counts(parts[i : i + 8]) for i in range(0, len(parts), 8)]
    return parts[0]


# tokens ------------------------------------------------------------------------------------------------------------------------------


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column of texts, each text closed by the end token, and the tokens before each text."""
    data, offsets = raw_text(column)
    starts, ends, before = spans(data, offsets, NOT_SPACE)
    edges = before + np.arange(len(before))
    out = np.full(edges[-1], END, np.uint64)
    place = np.arange(len(starts)) + np.repeat(np.arange(len(before) - 1), np.diff(before))
    out[place] = hashes(data, starts, ends)
    return out, edges


def runs(sorted_values: np.ndarray):
    """(value, start, end) of each run of equal values: the shards that a batch touches, whatever their number."""
    edges = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1], [True]])) if len(sorted_values) else np.zeros(1, np.int64)
    return zip(sorted_values[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)


class Model:
    """The trie's files below `path`. Small facts travel with the object: shard sizes, frequent words, sums of the counts."""

    def __init__(self, path: str, bits: int):
        self.path, self.bits = path, bits  # 2 ** bits shards of the vocabulary
        self.total = self.words = self.ones = self.twos = 0
        self.bases = np.zeros((1 << bits) + 1, np.int64)
        self.hot = np.zeros(0, np.int64)
        self.hot_parts = np.zeros(0, np.int64)
        self.bigram_bases = np.zeros(1, np.int64)
        self.hot_backoff = np.zeros(0)
        self.bigram_level = "counted"  # the bigrams' files while trigrams are counted, then "bigrams"
        self.files: dict[str, np.ndarray] = {}  # by level: whether a shard has a file

    def mapped(self, level: str, shard: int):
        """A level's shard: its sequence and its other arrays; None if it has no file."""
        there = self.files.get(level)
        return _FILES.get(self.path, f"{level}-{shard}") if there is not None and there[shard] else None

    # level 1: words

    def word_shard(self, h: np.ndarray) -> np.ndarray:
        return (h >> _U(64 - self.bits)).astype(np.int64)

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and training counts of word hashes."""
        values, inverse = np.unique(h, return_inverse=True)
        ids, counts = np.full(len(values), -1, np.int64), np.zeros(len(values), np.int64)
        for s, a, b in runs(self.word_shard(values)):
            if m := self.mapped("words", s):
                at = m[0].find(values[a:b] & _U((1 << (64 - self.bits)) - 1))
                known = at >= 0
                ids[a:b] = np.where(known, at + self.bases[s], -1)
                counts[a:b][known] = m[1]["count"][at[known]]
        return ids[inverse], counts[inverse]

    def discount(self) -> float:
        return self.ones / (self.ones + 2 * self.twos) if self.ones else 0.5

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        d = self.discount()
        return np.where(counts > 0, np.maximum(counts - d, 0) / max(1, self.total), d * self.words / self.total if self.total else 1.0)

    # level 2: bigrams; keys are id << 32 | id

    def shards(self) -> int:
        return 1 << self.bits

    def first_shard(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first shard of each context word, and its number of shards."""
        s = u * self.shards() // max(1, self.words)
        n = np.ones(len(u), np.int64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, u), len(self.hot) - 1)
            is_hot = self.hot[at] == u
            s = np.where(is_hot, self.shards() + (np.cumsum(self.hot_parts) - self.hot_parts)[at], s)
            n = np.where(is_hot, self.hot_parts[at], n)
        return s, n

    def bigram_shard(self, keys: np.ndarray) -> np.ndarray:
        s, n = self.first_shard((keys >> _U(32)).astype(np.int64))
        return s + (keys & _U(0xFFFFFFFF)).astype(np.int64) * n // max(1, self.words)

    def _search(self, level: str, shard: np.ndarray, keys: np.ndarray, bases: np.ndarray, columns: list[str]):
        """Global places (-1: none) of keys in their shards, and the named codes at them."""
        place = np.full(len(keys), -1, np.int64)
        got = [np.zeros(len(keys), np.uint16) for _ in columns]
        order = np.argsort(shard, kind="stable")
        for s, a, b in runs(shard[order]):
            if m := self.mapped(level, s):
                which = order[a:b]
                at = m[0].find(keys[which] - m[1]["from"][0])
                hit = at >= 0
                place[which[hit]] = at[hit] + bases[s]
                for g, c in zip(got, columns, strict=True):
                    g[which[hit]] = m[1][c][at[hit]]
        return place, got

    def bigrams(self, u: np.ndarray, v: np.ndarray, columns: list[str]):
        """Of each pair of ids: place (-1: not in the trie) and the named codes."""
        out = np.full(len(u), -1, np.int64)
        codes = [np.zeros(len(u), np.uint16) for _ in columns]
        known = np.flatnonzero((u >= 0) & (v >= 0))
        if len(known) and len(self.bigram_bases) > 1:
            keys, inverse = np.unique(u[known].astype(np.uint64) << _U(32) | v[known].astype(np.uint64), return_inverse=True)
            place, got = self._search(self.bigram_level, self.bigram_shard(keys), keys, self.bigram_bases, columns)
            out[known] = place[inverse]
            for c, g in zip(codes, got, strict=True):
                c[known] = g[inverse]
        return out, codes

    def contexts(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word id: the place of its first successor, and its back-off weight (1 for a word without any)."""
        values, inverse = np.unique(u, return_inverse=True)
        first, back = np.zeros(len(values), np.int64), np.ones(len(values))
        known = np.flatnonzero(values >= 0)
        if len(known) and len(self.bigram_bases) > 1:
            s, n = self.first_shard(values[known])
            is_hot = s >= self.shards()
            if is_hot.any():
                first[known[is_hot]] = self.bigram_bases[s[is_hot]]
                back[known[is_hot]] = self.hot_backoff[np.searchsorted(self.hot, values[known[is_hot]])]
            plain = known[~is_hot]
            for shard, a, b in runs(s[~is_hot]):
                if m := self.mapped(self.bigram_level, shard):
                    which = plain[a:b]
                    at = values[which] - int(m[1]["from"][0] >> _U(32))
                    ok = (at >= 0) & (at < len(m[1]["first"]) - 1)
                    first[which[ok]] = m[1]["first"][at[ok]].astype(np.int64) + self.bigram_bases[shard]
                    back[which[ok]] = _VALUE[m[1]["context"][at[ok]]]
        return first[inverse], back[inverse]

    # level 3: trigrams; keys are place of the first bigram << 32 | place of the second among the successors of the middle word

    def trigram_keys(self, ids: np.ndarray, place: np.ndarray):
        """place[i]: of the bigram of tokens i and i + 1. Indices i at which tokens i, i + 1, i + 2 have both bigrams, and the keys."""
        at = np.flatnonzero((place[:-1] >= 0) & (place[1:] >= 0))
        first, _ = self.contexts(ids[at + 1])
        return at, place[at].astype(np.uint64) << _U(32) | (place[at + 1] - first).astype(np.uint64)

    def trigram_shard(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bigram_bases, (keys >> _U(32)).astype(np.int64), "right") - 1

    def score(self, column):
        """Per text: tokens, known tokens, base score, score."""
        h, edges = tokens(column)
        ids, counts = self.lookup(h)
        base = np.log10((counts + ALPHA) / (self.total + ALPHA * (self.words + 1)))
        p = self.unigram(counts)
        # the end token before each text is the first word's context: chains of end, words, end
        n = np.diff(edges)
        lead = edges[:-1] + np.arange(len(n))
        chain = np.empty(len(h) + len(n), np.int64)
        own = np.arange(len(h)) + np.repeat(np.arange(1, len(n) + 1), n)
        chain[own] = ids
        end_id = int(self.lookup(np.array([END], np.uint64))[0][0])
        chain[lead] = end_id
        u, v = chain[:-1].copy(), chain[1:]
        cross = np.zeros(len(chain), bool)
        cross[lead[1:]] = True  # from a text's end to the next text's lead
        u[cross[1:]] = -1
        place, (prob, back) = self.bigrams(u, v, ["prob", "backoff"])
        _, back1 = self.contexts(u)
        q = np.where(place >= 0, _VALUE[prob], 0.0)
        p_chain = np.empty(len(chain))
        p_chain[own] = p
        p_chain[lead] = 1.0
        p2 = q + back1 * p_chain[1:]  # of chain token i + 1
        p3 = p2.copy()
        inner = place[:-1] >= 0
        b2 = np.where(inner, _VALUE[back[:-1]], 1.0)
        p3[1:] *= b2
        at, keys = self.trigram_keys(chain, place)
        if len(at):
            _, (prob3,) = hit = self._search_trigrams(keys)
            p3[at + 1] += np.where(hit[0] >= 0, _VALUE[prob3], 0.0)
        logs = np.log10(np.maximum(p3, 1e-300))[own - 1]
        sum_of = lambda x: np.add.reduceat(x, edges[:-1]) if len(n) else np.zeros(0)
        return n, sum_of((counts > 0).astype(np.int64)), sum_of(base), sum_of(np.minimum(logs, 0.0))

    def _search_trigrams(self, keys: np.ndarray):
        values, inverse = np.unique(keys, return_inverse=True)
        place, got = self._search("trigrams", self.trigram_shard(values), values, np.zeros(len(self.bigram_bases), np.int64), ["prob"])
        return place[inverse], [g[inverse] for g in got]


# building ----------------------------------------------------------------------------------------------------------------------------


def train(docs: DataFrame, path: str, parts: int, least: int = LEAST) -> Model:
    """Builds the trie of all rows of docs (doc_id, text) in files below `path`. parts: tasks that the input should be merged by, at least;
    least: count from which a bigram or trigram is kept, 1 for all."""
    model = Model(path, max(3, (max(1, parts) - 1).bit_length()))
    store, place = _open_store(path)
    store.create_dir(place, recursive=True)

    def pieces(batches):
        for batch in bounded_batches(batches, CHUNK):
            yield batch.column(1)

    def shards(rows_of, shard_of):
        def run(batches):
            held = Gatherer(shard_of)
            for column in pieces(batches):
                yield from held.add(rows_of(column))
            yield from held.flush()

        return docs.mapInArrow(run, "shard long, blob binary").groupBy("shard")

    def write_words(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        keys, counts = merged_shard(frame)
        top = 1 << (64 - model.bits)
        save(f"{path}/words-{shard}", ef_pack(keys & _U(top - 1), top, "seq") | {"count": counts})
        return pd.DataFrame({"shard": [shard], "n": [len(keys)], "total": [int(counts.sum())], "ones": [int((counts == 1).sum())], "twos": [int((counts == 2).sum())]})

    spark = docs.sparkSession
    told = shards(lambda c: tokens(c)[0], model.word_shard).applyInPandas(write_words, "shard long, n long, total long, ones long, twos long").toPandas()  # five numbers for each shard
    sizes = np.zeros(1 << model.bits, np.int64)
    sizes[told["shard"]] = told["n"]
    model.files["words"] = sizes > 0
    model.bases = np.concatenate([[0], np.cumsum(sizes)])
    model.words, model.total, model.ones, model.twos = (int(told[k].sum()) for k in ("n", "total", "ones", "twos"))
    if not model.words:
        return model
    if model.words >= 1 << 32:
        raise OverflowError("word ids have 32 bits")
    share = 2 * max(1, model.total // model.shards())  # more tokens than this make a word frequent; fewer words than half the shards are

    def frequent(frames):
        for frame in frames:
            for shard in frame["id"]:
                if m := model.mapped("words", shard):
                    at = np.flatnonzero(m[1]["count"] > share)
                    yield pd.DataFrame({"word": at + model.bases[shard], "n": m[1]["count"][at].astype(np.int64)})

    hot = spark.range(model.shards()).mapInPandas(frequent, "word long, n long").toPandas().sort_values("word")
    model.hot = hot["word"].to_numpy(np.int64)
    model.hot_parts = -(-hot["n"].to_numpy(np.int64) // share)

    def chain(column, known):
        """Ids of all texts' tokens with the end token before each text, and whether a token and its successor are in one text."""
        h, edges = tokens(column)
        ids, counts = known.lookup(h)
        n = np.diff(edges)
        lead = edges[:-1] + np.arange(len(n))
        own = np.arange(len(h)) + np.repeat(np.arange(1, len(n) + 1), n)
        out, often = np.empty(len(h) + len(n), np.int64), np.empty(len(h) + len(n), np.int64)
        out[own], often[own] = ids, counts
        out[lead], often[lead] = ids[edges[1:] - 1], counts[edges[1:] - 1]
        joined = np.ones(len(out), bool)
        joined[lead[1:] - 1] = False
        return out, often, joined[:-1]

    def bigram_keys(column):
        ids, often, joined = chain(column, model)
        at = np.flatnonzero(joined & (often[:-1] >= least) & (often[1:] >= least))  # a bigram isn't more frequent than its words
        return ids[at].astype(np.uint64) << _U(32) | ids[at + 1].astype(np.uint64)

    def word_counts(ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        for s, a, b in runs(np.searchsorted(model.bases, ids, "right") - 1):
            out[a:b] = model.mapped("words", s)[1]["count"][ids[a:b] - model.bases[s]]
        return out

    def write_bigrams(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        keys, counts = merged_shard(frame)
        keys, counts = keys[counts >= least], counts[counts >= least]
        left = 0.0
        if len(keys):
            start = keys[0] >> _U(32) << _U(32)
            ctx = (keys >> _U(32)).astype(np.int64)
            distinct, index, n = np.unique(ctx, return_index=True, return_counts=True)
            size = word_counts(distinct)
            prob = (counts - DISCOUNT) / np.repeat(size, n)
            kept = np.add.reduceat(prob, index)
            left = float(kept.sum()) if shard >= model.shards() else 0.0
            first = np.searchsorted(ctx, np.arange(ctx[0], ctx[-1] + 2)).astype(np.uint32)
            context = np.zeros(ctx[-1] - ctx[0] + 1, np.uint16)  # code 0: weight 1, a word without successors
            context[distinct - ctx[0]] = quantise(1 - kept)
            rest = {"from": np.array([start], np.uint64), "count": counts.astype(np.uint32 if counts.max() < 1 << 32 else np.int64), "prob": quantise(prob), "first": first, "context": context}
            save(f"{path}/counted-{shard}", ef_pack(keys - start, int(keys[-1] - start) + 1, "seq") | rest)
        return pd.DataFrame({"shard": [shard], "n": [len(keys)], "kept": [left]})

    told = shards(bigram_keys, model.bigram_shard).applyInPandas(write_bigrams, "shard long, n long, kept double").toPandas()  # three numbers for each shard
    sizes = np.zeros(model.shards() + int(model.hot_parts.sum()), np.int64)
    kept = np.zeros(len(sizes))
    sizes[told["shard"]], kept[told["shard"]] = told["n"], told["kept"]
    model.bigram_bases = np.concatenate([[0], np.cumsum(sizes)])
    if model.bigram_bases[-1] >= 1 << 32:
        raise OverflowError("places of bigrams have 32 bits")
    bounds = np.concatenate([[0], np.cumsum(model.hot_parts)]) + model.shards()
    model.hot_backoff = np.array([max(1e-13, 1 - kept[a:b].sum()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
    model.files["counted"] = counted = sizes > 0

    def trigram_keys(column):
        ids, _, joined = chain(column, model)
        place, _ = model.bigrams(np.where(joined, ids[:-1], -1), ids[1:], [])
        return model.trigram_keys(ids, place)[1]

    def write_trigrams(frame: pd.DataFrame) -> pd.DataFrame:
        """The trigrams of one shard of contexts, and the shard of bigrams again, now with the back-off of each as a context."""
        shard = int(frame["shard"].iloc[0])
        parts = [b for b in frame["blob"] if b is not None]
        keys, counts = merged_shard(frame[frame["blob"].notna()]) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        keys, counts = keys[counts >= least], counts[counts >= least]
        bigrams = load(f"{path}/counted-{shard}")[0]
        often = bigrams.pop("count")
        backoff = np.zeros(len(often), np.uint16)
        if len(keys):
            ctx = (keys >> _U(32)).astype(np.int64) - model.bigram_bases[shard]
            distinct, index, n = np.unique(ctx, return_index=True, return_counts=True)
            prob = (counts - DISCOUNT) / np.repeat(often[distinct].astype(np.float64), n)
            backoff[distinct] = quantise(1 - np.add.reduceat(prob, index))
            start = keys[0] >> _U(32) << _U(32)
            save(f"{path}/trigrams-{shard}", ef_pack(keys - start, int(keys[-1] - start) + 1, "seq") | {"from": np.array([start], np.uint64), "prob": quantise(prob)})
        save(f"{path}/bigrams-{shard}", bigrams | {"backoff": backoff})
        return pd.DataFrame({"shard": [shard], "n": [len(keys)]})

    if counted.any():
        every = spark.createDataFrame(pd.DataFrame({"shard": np.flatnonzero(counted)})).select("shard", F.lit(None).cast("binary").alias("blob"))  # so that a shard without trigrams is finished too

        def run(batches):
            held = Gatherer(model.trigram_shard)
            for column in pieces(batches):
                yield from held.add(trigram_keys(column))
            yield from held.flush()

        told = docs.mapInArrow(run, "shard long, blob binary").unionByName(every).groupBy("shard").applyInPandas(write_trigrams, "shard long, n long").toPandas()
        for s in np.flatnonzero(counted):  # all have been written again as levels of the trie
            store.delete_file(f"{place}/counted-{s}")
        model.bigram_level = "bigrams"
        model.files = {"words": model.files["words"], "bigrams": counted, "trigrams": np.zeros(len(counted), bool)}
        model.files["trigrams"][told["shard"][told["n"] > 0]] = True
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of docs.

    A null, empty or blank text is its end token alone. A model of no tokens gives every token the same share. Repeated rows stay repeated, other
    columns are ignored, an empty table gives no rows; a text of any length is scored whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # shard sizes and frequent words, a few numbers for each shard

    def run(batches):
        m = shared.value
        for batch in bounded_batches(batches, CHUNK):
            n, known, base, got = m.score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(n), m.total), pa.int64()), pa.array(base, pa.float64()), pa.array(got, pa.float64())], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def is_held_out(id_col):
    """Rows of the held-out fold; a null id is not in it."""
    return F.coalesce(crc_mod(id_col, FOLDS) == HELD_OUT, F.lit(False))


def train_and_score(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Scores every row of docs by a model of those outside the held-out fold (crc32 of the id as text).

    Repeated rows count as often as they occur, and so do rows with a null id, which are never held out; null texts are learned as their end token.
    """
    learned = texts(docs).where(~is_held_out(F.col("doc_id")))
    model = train(learned, work_dir(docs.sparkSession, "ngram-trie"), parts_of(learned, 4 << 20, 1 << 21), least)
    return score(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
