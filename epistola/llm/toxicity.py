"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features are rates: lexicon words (plain and after undoing look-alike digits and symbols), their closeness to a second person,
capitals, punctuation, obfuscated words. Beside a fixed lexicon there is a learned one of words and stems that a part of the labelled
sample shows far more often in toxic documents, which covers languages that the fixed list lacks. All of a batch's texts are measured at
once by numpy. The trees are fitted on the driver, on a bounded sample of labelled documents (one part for the lexicon, one for
the trees, one for the calibration); scoring reads each document once and shuffles nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, filter_rows, labelled_sample, raw_text, settle, texts
from .vector import LETTERS, LOWER, NOT_SPACE, HashSet, hash_words, hashes, member, spans, sums

#: Labelled documents that the trees are fitted on and bytes of their text, at most (`common.within`); folds, and the one that is never learned from.
SAMPLE, SAMPLE_BYTES, FOLDS, HELD_OUT = 12000, 1 << 28, 5, 0
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
#: Bytes of the stems learned beside whole words; entries of the learned lexicon, at most; toxic documents that must have an entry (a
#: number and a share of them), and its log odds, at least.
STEMS, LEXICON, SUPPORT, SUPPORT_SHARE, LOG_ODDS = (4, 5, 6), 4000, 3, 0.01, 2.0

#: Abusive words by strength. Fixed values.
SEVERE = """scum vermin subhuman filth parasite parasites whore slut bastard bastards bitch bitches cunt motherfucker fuck fucker fucking
retard retarded degenerate degenerates maggot maggots abschaum missgeburt hurensohn ordure salope connard putain escoria hijueputa puta cabron""".split()
STRONG = """idiot idiots moron morons imbecile imbeciles stupid worthless pathetic disgusting loser losers asshole shit crap hate despise
idiota idiotas imbecil estupido estupida asqueroso inutil patetico idiote idiotes imbécile débile minable dégoûtant dummkopf trottel
idioten wertlos erbärmlich ekelhaft widerlich verlierer""".split()
MILD = """clown clowns trash garbage dumb fool fools ugly liar liars coward cowards shut useless ridiculous jerk jerks nonsense basura
payaso payasos tonto fea feo mentiroso cobarde poubelle clochard menteur lâche müll narr lügner feigling dumm""".split()
SECOND_PERSON = "you your yours yourself yourselves u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split()
#: Bytes of a look-alike spelling and the letters that they stand for; bytes left out of a word.
ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
NAMES = [
    "log_bytes", "log_words", "severe", "strong", "mild", "any_hits", "log_hits", "hits_max_line", "distinct_hits", "undone", "near_second", "second_person",
    "learned", "log_learned", "learned_weight", "capitals", "capital_words", "exclaim", "question", "stars", "symbols", "digits", "mixed_words", "punctuation", "non_ascii", "word_bytes",
]


def _fold() -> np.ndarray:
    t = LOWER.copy()
    for a, b in ALIKE.items():
        t[ord(a)] = ord(b)
    return t


def _class(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_LEX = [np.sort(hash_words(w)) for w in (SEVERE, STRONG, MILD)]
_ALL = np.sort(np.concatenate(_LEX))
_YOU = np.sort(hash_words(SECOND_PERSON))
_ALIKE_WORD = LETTERS | _class("".join(ALIKE))
_ALIKE_ONLY = _class("".join(ALIKE))
_UPPER, _DIGIT, _PUNCT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class(".,;:!?\"'()-")
_SYMBOL, _STAR = _class("#$%&@^~|<>{}[]=+_\\/"), _class("*")
#: Words on either side within which a second person counts as near.
NEAR = 5


def stems(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray):
    """(words' indices, hashes) of whole words and of each stem length, for the words longer than it."""
    yield np.arange(len(starts)), whole
    for n in STEMS:
        longer = np.flatnonzero(ends - starts > n)
        yield longer, hashes(data, starts[longer], starts[longer] + n) ^ np.uint64(n)


def features(data: np.ndarray, offsets: np.ndarray, lexicon: HashSet) -> np.ndarray:
    """(rows, len(NAMES)) for the texts data[offsets[i]:offsets[i + 1]], with a learned lexicon."""
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    starts, ends, before = spans(data, offsets, LETTERS)
    n = np.maximum(np.diff(before).astype(np.float64), 1)
    h = hashes(data, starts, ends)
    hit = [member(h, lex) for lex in _LEX]
    any_hit = hit[0] | hit[1] | hit[2]
    you = member(h, _YOU)
    count = [sums(x, before) for x in hit]
    total = count[0] + count[1] + count[2]
    weight = np.zeros(len(h))
    for which, key in stems(data, starts, ends, h):
        weight[which] = np.maximum(weight[which], lexicon.weigh(key))
    learned = sums(weight > 0, before)
    # distinct lexicon words of a text
    at = np.flatnonzero(any_hit)
    owner = np.searchsorted(before, at, "right") - 1
    kinds = np.unique(np.stack([owner, np.searchsorted(_ALL, h[at])]), axis=1)[0] if len(at) else np.zeros(0, np.int64)
    distinct = np.bincount(kinds, minlength=rows).astype(np.float64)
    # hits with a second person within NEAR words of the same text
    total_you = np.concatenate([[0], np.cumsum(you)])
    lo, hi = np.maximum(at - NEAR, before[owner] if len(at) else 0), np.minimum(at + NEAR + 1, before[owner + 1] if len(at) else 0)
    near = np.bincount(owner[(total_you[hi] - total_you[lo]) > 0], minlength=rows).astype(np.float64) if len(at) else np.zeros(rows)
    # most hits within any 50 words
    step = np.searchsorted(at, at + 50) - np.arange(len(at))
    dense = np.zeros(rows)
    np.maximum.at(dense, owner, np.minimum(step, np.searchsorted(owner, owner, "right") - np.arange(len(at))).astype(np.float64))
    # spelled with look-alikes: a word of letters and look-alikes, some of each, that is in the lexicon once undone
    s2, e2, _ = spans(data, offsets, _ALIKE_WORD)
    odd = sums(_ALIKE_ONLY[data], np.stack([s2, e2], 1).ravel())[::2] if len(s2) else np.zeros(0)
    look = np.flatnonzero((odd > 0) & (odd < e2 - s2))
    undone = look[member(hashes(data, s2[look], e2[look], _fold()), _ALL)] if len(look) else look
    undone = np.bincount(np.searchsorted(offsets, s2[undone], "right") - 1, minlength=rows).astype(np.float64)[:rows]
    # words by white space: all capitals, or with letters around other characters
    s3, e3, b3 = spans(data, offsets, NOT_SPACE)
    edges = np.stack([s3, e3], 1).ravel()
    per = lambda table: sums(table[data], edges)[::2] if len(s3) else np.zeros(0)
    capital, letter = per(_UPPER), per(LETTERS)
    shout = (capital >= 3) & (capital == letter)
    inside = (e3 - s3) - letter - np.array(~LETTERS[data[np.maximum(e3 - 1, 0)]], float) if len(s3) else np.zeros(0)
    n3 = np.maximum(np.diff(b3).astype(np.float64), 1)
    chars = np.maximum(size, 1)
    rate = lambda table: sums(table[data], offsets) / chars
    byte = lambda c: rate(_class(c))
    high = np.arange(256) >= 128
    return np.stack(
        [
            np.log1p(size), np.log1p(n), count[0] / n, count[1] / n, count[2] / n, (total > 0).astype(float), np.log1p(total), dense, distinct, undone / n, near / n, sums(you, before) / n,
            learned / n, np.log1p(learned), sums(weight, before) / np.maximum(learned, 1), rate(_UPPER), sums(shout, b3) / n3, byte("!"), byte("?"), rate(_STAR), rate(_SYMBOL), rate(_DIGIT), sums((inside > 0) & (letter > 1), b3) / n3, rate(_PUNCT), rate(high), size / n3,
        ],
        axis=1,
    )


class Boosted:
    """Gradient-boosted regression trees on the logistic loss, grown level by level on binned features."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, ridge: float = 1.0, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.cuts = [np.unique(np.quantile(c[c > c.min()] if (c > c.min()).any() else c, np.linspace(0, 1, self.bins)[:-1])) for c in x.T]
        self.cuts = [np.unique(np.concatenate([[c.min()], q])) for c, q in zip(x.T, self.cuts, strict=True)]
        z = self._bin(x)
        width = max(len(c) for c in self.cuts) + 1
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(mean / (1 - mean)))
        margin, self.grown = np.full(len(y), self.base), []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, w = y - p, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, width, np.int64)
            for level in range(self.depth):
                k, first = 2**level, 2**level - 1
                local = node - first
                best = np.full(k, 1e-9)
                for j in range(x.shape[1]):
                    at = local * width + z[:, j]
                    sg, sw = (np.bincount(at, v, k * width).reshape(k, width).cumsum(axis=1) for v in (g, w))
                    tg, tw = sg[:, -1:], sw[:, -1:]
                    gain = sg**2 / (sw + self.ridge) + (tg - sg) ** 2 / (tw - sw + self.ridge) - tg**2 / (tw + self.ridge)
                    gain[(sw < self.least) | (tw - sw < self.least)] = 0
                    to = gain.argmax(axis=1)
                    better = gain[np.arange(k), to] > best
                    best = np.where(better, gain[np.arange(k), to], best)
                    feature[first : first + k] = np.where(better, j, feature[first : first + k])
                    cut[first : first + k] = np.where(better, to, cut[first : first + k])
                node = 2 * node + 1 + (z[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, w, 2**self.depth) + self.ridge)
            margin = margin + value[leaf]
            self.grown.append((feature, cut, value))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        z, rows = self._bin(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, cut, value in self.grown:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (z[rows, feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out


class Isotonic:
    """The non-decreasing step function nearest to 0/1 labels, by pooling adjacent violators; linear between its steps."""

    def fit(self, score: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(score, kind="stable")
        blocks: list[list[float]] = []  # sum of labels, weight, sum of scores
        for s, t in zip(score[order].tolist(), y[order].tolist(), strict=True):
            blocks.append([t, 1.0, s])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
        total, weight, place = np.array(blocks).T
        self.x, self.y = place / weight, (total + 0.5 * (weight > 0) * (total / weight)) / (weight + 0.5)
        return self

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.x, self.y)


class Model:
    """Trees fitted on three quarters of the rows, calibrated on the rest. Without both labels the score is the share of label 1."""

    def __init__(self, x: np.ndarray, y: np.ndarray, lexicon: HashSet):
        self.lexicon = lexicon
        self.constant = float(y.mean()) if len(y) else 0.0
        self.trees = None
        if len(y) >= 20 and 0 < y.sum() < len(y):
            apart = np.arange(len(y)) % 4 == 0
            if not 0 < y[~apart].sum() < (~apart).sum() or not 0 < y[apart].sum() < apart.sum():
                apart = np.zeros(len(y), bool)
            self.trees = Boosted().fit(x[~apart], y[~apart])
            check = apart if apart.any() else ~apart
            self.calibrate = Isotonic().fit(self.trees.margin(x[check]), y[check])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.constant)
        return np.clip(self.calibrate(self.trees.margin(x)), 0.0, 1.0)


def learn_lexicon(sample: DataFrame, size: int = LEXICON) -> HashSet:
    """The words and stems of a labelled sample (doc_id, text, label) with the greatest log odds for label 1, weighted by them."""

    def count(batches):
        for batch in bounded_batches(batches):
            data, offsets = raw_text(batch.column(1))
            starts, ends, before = spans(data, offsets, LETTERS)
            owner = np.searchsorted(before, np.arange(len(starts)), "right") - 1
            got = [np.stack([key, owner[which].astype(np.uint64)]) for which, key in stems(data, starts, ends, hashes(data, starts, ends))]
            pairs = np.unique(np.concatenate(got, axis=1), axis=1)
            toxic = (batch.column(2).to_numpy() > 0)[pairs[1].astype(np.int64)]
            key, inverse = np.unique(pairs[0], return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.bincount(inverse, toxic, len(key)).astype(np.int64)), pa.array(np.bincount(inverse, minlength=len(key)))], names=["key", "hits", "n"])

    total, toxic = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not toxic or toxic == total:
        return HashSet(np.zeros(0, np.uint64))
    counts = sample.select("doc_id", "text", "label").mapInArrow(count, "key long, hits long, n long").groupBy("key").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    odds = F.log((F.col("hits") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("hits") + 0.5) / (total - toxic + 1))
    kept = counts.where(F.col("hits") >= max(SUPPORT, SUPPORT_SHARE * toxic)).withColumn("odds", odds).where(F.col("odds") >= LOG_ODDS)
    best = kept.orderBy(F.desc(F.col("odds") * F.sqrt("hits")), "key").limit(size).toArrow()
    return HashSet(best.column("key").to_numpy().view(np.uint64), best.column("odds").to_numpy().astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    """Learns labels.toxic from a bounded sample of labelled documents outside the held-out fold (crc32 of the id as text). Without both labels the
    model gives every text the share of label 1, 0 without any. The driver receives a row of features for each document of the sample, no texts."""
    chosen = settle(labelled_sample(docs, labels, "toxic", folds, held_out, sample, sample_bytes), "toxicity-sample")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5))
    lexicon = learn_lexicon(chosen.where(part < 2))

    def measure(batches):
        for batch in bounded_batches(batches):
            x = features(*raw_text(batch.column(1)), lexicon)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    rows = chosen.where(part >= 2).select("doc_id", "text", "label").mapInArrow(measure, "doc_id long, label int, x array<double>").toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(len(rows), len(NAMES))[order]
    y = (rows.column("label").to_numpy() > 0).astype(np.float64)[order]
    mixed = np.random.Generator(np.random.PCG64(7)).permutation(len(y))
    return Model(x[mixed], y[mixed], lexicon)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of docs; null texts count as empty, and empty ones are scored by their features, all 0. Repeated rows stay
    repeated, other columns are ignored, an empty table gives no rows; a text of any length is measured whole."""

    def run(batches):
        for batch in bounded_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(features(*raw_text(batch.column(1)), model.lexicon)))], names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score below the threshold, all columns; a null or empty text stays."""

    def passes(column):
        data, offsets = raw_text(column)
        return (model.score(features(data, offsets, model.lexicon)) < threshold) | (np.diff(offsets) == 0)

    return filter_rows(docs, passes)
