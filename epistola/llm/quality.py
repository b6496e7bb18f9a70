"""Quality: a linear-chain conditional random field labels each line of a text good or bad.

A line's features are rates of its characters and words, repeats within the line and of the line within the text, and the same rates of the
lines before and after it, each cut into bins. Only documents are labelled, and a bad one may be bad for a part of its lines, so the lines' labels are
hidden: all lines of a good document are good, and those of a bad one start as bad and are then labelled by the field itself, at least one staying
bad, and the field is fitted again. It is fitted on stretches of lines dealt into mixed sequences, so that it learns switches. Forward-backward gives every
line's marginal in the whole text; the marginals of good weighted by line length add up to the document's share of good text, and a logistic curve
fitted on the sample turns that share into the probability of label 1. Trained on the driver on a bounded sample; scoring reads each document once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import crf
from .common import bounded_batches, labelled_sample, raw_text, texts
from .vector import LETTERS, NOT_SPACE, hash_words, hashes, member, spans, sums

#: Labelled documents to learn from and bytes of their text, at most (`common.within`); folds, and the one that is never learned from.
SAMPLE, SAMPLE_BYTES, FOLDS, HELD_OUT = 3000, 8 << 20, 3, 1
BINS, ROUNDS, STEP, RIDGE = 13, 40, 0.3, 1e-5
#: Times that the hidden labels are worked out; lines of a stretch, at most, and stretches of a mixed sequence.
TURNS, STRETCH, MIXED = 3, 2, 6
#: Frequent function words of a few languages. Fixed values.
COMMON = """the of and to in a is that for it as was with be by on not he this are or his from at which but have an had they you were their
der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei
de la le et les des en un du une que est pour qui dans par sur au plus ne se pas ce el los las y del una con no su al lo como más""".split()
NAMES = ["bytes", "words", "capitals", "digits", "points", "bangs", "bars", "symbols", "word_bytes", "common", "echo", "again", "long_word"]
_COMMON = np.sort(hash_words(sorted(set(COMMON))))


def _class(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_UPPER, _DIGIT, _POINT, _BANG, _BAR, _SYMBOL = (_class(c) for c in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:?\"'()-", "!", "|\t", "#$%&*@^~<>{}[]=+_\\/"))
_LINE = np.ones(256, bool)
_LINE[10] = False


def lines(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the non-blank lines, lines before each text, and their features (lines, len(NAMES))."""
    starts, ends, _ = spans(data, offsets, _LINE)
    ws, we, _ = spans(data, offsets, NOT_SPACE)
    first = np.searchsorted(ws, starts)
    last = np.searchsorted(ws, ends)
    real = last > first
    starts, ends, first, last = starts[real], ends[real], first[real], last[real]
    before = np.searchsorted(starts, offsets)
    edges = np.stack([starts, ends], 1).ravel()
    per = lambda table: sums(table[data], edges)[::2] if len(starts) else np.zeros(0)
    size = (ends - starts).astype(np.float64)
    n = (last - first).astype(np.float64)
    by_word = lambda flags: sums(flags, np.stack([first, last], 1).ravel())[::2] if len(first) else np.zeros(0)
    ls, le, _ = spans(data, offsets, LETTERS)
    common = np.zeros(len(ws))
    if len(ls):
        hit = member(hashes(data, ls, le), _COMMON)
        at = np.searchsorted(ws, ls[hit], "right") - 1
        np.add.at(common, at, 1.0)
    wh = hashes(data, ws, we)
    echo = np.concatenate([[False], wh[1:] == wh[:-1]]) if len(wh) else np.zeros(0, bool)
    lh = hashes(data, starts, ends)
    text = np.searchsorted(before, np.arange(len(starts)), "right") - 1
    order = np.lexsort((lh, text))
    again = np.zeros(len(starts))
    if len(order) > 1:
        same = (lh[order][1:] == lh[order][:-1]) & (text[order][1:] == text[order][:-1])
        again[order[1:][same]] = 1
        again[order[:-1][same]] = 1
    longest = np.zeros(len(starts))
    if len(starts):
        np.maximum.at(longest, np.searchsorted(first, np.arange(len(ws)), "right") - 1, (we - ws).astype(np.float64))
    rate = lambda table: per(table) / size
    x = np.stack([np.log1p(size), np.log1p(n), rate(_UPPER), rate(_DIGIT), rate(_POINT), rate(_BANG), rate(_BAR), rate(_SYMBOL), size / n, by_word(common) / n, by_word(echo) / n, again, np.log1p(longest)], axis=1)
    return starts, ends, before, x


#: Quantiles at which a feature is cut, and parts of its range: a rate that is high in a few lines only shows in the latter.
QUANTILES, PARTS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98], [0.02, 0.1, 0.25, 0.5, 0.75]


def bin_edges(values: np.ndarray) -> np.ndarray:
    low, high = values.min(), values.max()
    return np.unique(np.concatenate([np.quantile(values, QUANTILES), low + (high - low) * np.array(PARTS)]))


class Model:
    """cuts: bin edges of each feature; weights (features x 3 places x bins, 2). Without both labels the score is the share of label 1."""

    def __init__(self, prior: float):
        self.prior, self.weights = prior, None

    def buckets(self, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Weight rows of each line: its own bins, those of the line before and of the line after (a bin of their own at the ends)."""
        own = np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], axis=1)
        width, f = BINS + 2, x.shape[1]
        prev, nxt = np.full_like(own, width - 1), np.full_like(own, width - 1)
        prev[1:], nxt[:-1] = own[:-1], own[1:]
        filled = np.diff(before) > 0
        prev[before[:-1][filled]] = width - 1
        nxt[before[1:][filled] - 1] = width - 1
        place = np.arange(f) * width
        return np.concatenate([own + place, prev + place + f * width, nxt + place + 2 * f * width], axis=1)

    def fit(self, data: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> Model:
        starts, ends, before, x = lines(data, offsets)
        if not len(x) or not 0 < y.sum() < len(y):
            return self
        self.cuts = [bin_edges(c) for c in x.T]
        size = np.diff(before)
        owner = np.repeat(np.arange(len(size)), size)
        good = y[owner] > 0
        state = good.astype(np.int64)
        # stretches of at most STRETCH lines of a text, dealt into sequences of MIXED
        place = np.arange(len(x)) - before[owner]
        heads = np.flatnonzero(place % STRETCH == 0)
        runs = np.split(np.arange(len(x)), heads[1:])
        deal = np.random.Generator(np.random.PCG64(13)).permutation(len(runs))
        line = np.concatenate([runs[i] for i in deal])
        edges = np.concatenate([[0], np.cumsum([len(runs[i]) for i in deal])])
        edges = edges[np.unique(np.append(np.arange(0, len(edges), MIXED), len(edges) - 1))]
        at = self.buckets(x[line], edges)
        rows = 3 * x.shape[1] * (BINS + 2)
        emit = lambda w: w[at].sum(axis=1)
        grad = lambda r: np.stack([np.bincount(at.ravel(), np.repeat(r[:, j], at.shape[1]), rows) for j in range(2)], axis=1)
        for turn in range(TURNS + 1):
            self.weights, self.trans, self.start = crf.fit(emit, grad, np.zeros((rows, 2)), state[line], edges, np.ones(len(line)), 2, ROUNDS, STEP, RIDGE)
            if turn < TURNS:
                marginal = self.marginals(before, x)
                worst = np.full(len(size), 2.0)
                np.minimum.at(worst, owner, marginal)
                state = (good | ((marginal > 0.5) & (marginal > worst[owner]))).astype(np.int64)
        share = self.share(starts, ends, before, x)
        filled = size > 0
        self.curve = logistic(_logit(share[filled]), y[filled])
        return self

    def marginals(self, before: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The probability of each line to be good, in its whole text."""
        return crf.forward_backward(self.weights[self.buckets(x, before)].sum(axis=1), before, self.trans, self.start)[:, 1]

    def share(self, starts, ends, before, x) -> np.ndarray:
        """The share of each text, by length, that the marginals give to good lines."""
        good = self.marginals(before, x)
        size = (ends - starts).astype(np.float64)
        return np.clip(sums(good * size, before) / np.maximum(sums(size, before), 1e-300), 0, 1)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and number of lines of each text; a text without a line has the prior."""
        starts, ends, before, x = lines(data, offsets)
        n = np.diff(before)
        if self.weights is None or not len(x):
            return np.full(len(n), self.prior), n
        slope, shift = self.curve
        return np.where(n > 0, 1 / (1 + np.exp(-(slope * _logit(self.share(starts, ends, before, x)) + shift))), self.prior), n


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def logistic(z: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the rising logistic curve that fits labels y at z, by Newton's method; (1, 0) where they can't tell one."""
    slope, shift = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30)))
        w, g = p * (1 - p), y - p
        a, b, c = (w * z * z).sum() + 1.0, (w * z).sum(), w.sum() + 1e-3  # the first with a ridge towards a slope of 1
        u, v = (g * z).sum() - (slope - 1.0), g.sum()
        det = a * c - b * b
        if not det > 1e-12:
            break
        slope, shift = slope + (c * u - b * v) / det, shift + (a * v - b * u) / det
    return (float(slope), float(shift)) if slope > 0 and np.isfinite(slope + shift) else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    """Learns labels.quality from a bounded sample of labelled documents outside the held-out fold (crc32 of the id as text)."""
    rows = labelled_sample(docs, labels, "quality", folds, held_out, sample, sample_bytes).toArrow()  # at most `sample_bytes` of text
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    raw = [rows.column("text")[int(i)].as_py().encode("utf-8", "surrogatepass") for i in order]
    y = (rows.column("label").to_numpy()[order] > 0).astype(np.float64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return Model(float(y.mean()) if len(y) else 0.5).fit(data, offsets, y)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, n_lines) of every row of docs.

    A null, empty or blank text has the sample's share of label 1 as its score (0.5 without labels), and so has every text if the sample lacks a
    label; repeated rows stay repeated, other columns are ignored, an empty table gives no rows. A line may be as long as its text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred weights

    def run(batches):
        m = shared.value
        for batch in bounded_batches(batches):
            s, n = m.score(*raw_text(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array(n)], names=["doc_id", "score", "n_lines"])

    return texts(docs).mapInArrow(run, "doc_id long, score double, n_lines long")
