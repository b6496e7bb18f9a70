"""Language identification by a linear-chain conditional random field over words.

A word's features are its prefixes and suffixes, its byte trigrams and the word itself, hashed into one weight table per language;
learned transitions say how readily one word's language follows another's. Forward-backward gives each word's language in its
whole text, which tells the parts of a code-switched text, and the marginals weighted by word length add up to the document's language.
The field is trained on the driver on a bounded sample of documents, cut into short stretches that are dealt into mixed sequences, so
that it sees switches. Prediction reads each document once and shuffles nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import crf
from .common import bounded_batches, crc_mod, filter_rows, raw_text, texts, whole, within
from .vector import BLOCK, LETTERS, LOWER, hashes, spans, sums

FOLDS, HELD_OUT = 5, 0
#: Documents of a language to learn from, at most, and bytes of their text, at most (`common.within`); the sample grows with the languages only.
SAMPLE, SAMPLE_BYTES = 750, 1 << 19
#: Words of a stretch in training, stretches of a mixed sequence; rows of the weight table.
STRETCH, MIXED, TABLE = 24, 4, 1 << 16
ROUNDS, STEP, RIDGE = 25, 0.4, 1e-7
#: A text is in no learned language if its words' mean margin, this many standard errors up, is below this share of what is usual in its language.
KNOWN, ERRORS = 0.4, 2.0
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_SHIFT = np.uint64(64 - 16)


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    return (((x.astype(np.uint64) << np.uint64(3)) + np.uint64(kind)) * _ODD[kind] >> _SHIFT).astype(np.int64)


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, 7) buckets of affixes and the word, and the buckets of all trigrams with the edges that part them by word."""
    low = LOWER[data].astype(np.int64)
    size = ends - starts
    at = lambda i: low[np.minimum(np.maximum(i, starts), ends - 1)]
    p = [at(starts), at(starts + 1), at(starts + 2)]
    s = [at(ends - 1), at(ends - 2), at(ends - 3)]
    fixed = np.stack(
        [
            _bucket(p[0], 0), _bucket(p[0] << 8 | p[1], 1), _bucket(p[0] << 16 | p[1] << 8 | p[2], 2),
            _bucket(s[0], 3), _bucket(s[0] << 8 | s[1], 4), _bucket(s[0] << 16 | s[1] << 8 | s[2], 5),
            (hashes(data, starts, ends) >> _SHIFT).astype(np.int64),
        ],
        axis=1,
    )
    many = np.maximum(size - 2, 0)
    edges = np.concatenate([[0], np.cumsum(many)])
    place = np.arange(edges[-1]) - np.repeat(edges[:-1], many) + np.repeat(starts, many)
    return fixed, _bucket(low[place] << 16 | low[place + 1] << 8 | low[place + 2], 6), edges


def emissions(weights: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(words, languages) scores, worked out in blocks of bounded size."""
    out = np.empty((len(starts), weights.shape[1]))
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        fixed, tri, edges = word_features(data[base : int(ends[to - 1])], starts[at:to] - base, ends[at:to] - base)
        total = weights[fixed[:, 0]]
        for j in range(1, fixed.shape[1]):
            total = total + weights[fixed[:, j]]
        run = np.zeros((len(tri) + 1, weights.shape[1]))
        np.cumsum(weights[tri], axis=0, out=run[1:])
        out[at:to] = total + run[edges[1:]] - run[edges[:-1]]
        at = to
    return out


def margins(scores: np.ndarray) -> np.ndarray:
    """By how much each word's best language leads the second: what tells languages, not which one, so that code-switched words count as known."""
    top = np.partition(scores, scores.shape[1] - 2, axis=1)
    return top[:, -1] - top[:, -2]


class Model:
    """languages: sorted; weights, trans, start as fitted. With fewer than two languages the only one is always the answer.

    usual, spread: each language's median of its stretches' mean margins, and its words' standard deviation of margins.
    """

    def __init__(self, langs: list[str], weights=None, trans=None, start=None, usual=None, spread=None):
        self.langs, self.weights, self.trans, self.start, self.usual, self.spread = langs, weights, trans, start, usual, spread

    def _read(self, data: np.ndarray, offsets: np.ndarray):
        """Word spans, words before each text, each word's language marginals, and its margin."""
        starts, ends, before = spans(data, offsets, LETTERS)
        if len(self.langs) < 2:
            return starts, ends, before, np.ones((len(starts), len(self.langs))), np.zeros(len(starts))
        scores = emissions(self.weights, data, starts, ends)
        return starts, ends, before, crf.forward_backward(scores, before, self.trans, self.start), margins(scores)

    def marginals(self, data: np.ndarray, offsets: np.ndarray):
        """Word spans, words before each text, and each word's language marginals."""
        return self._read(data, offsets)[:4]

    def familiar(self, best: np.ndarray, margin: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether each text's words part the learned languages as words of its best one do. Few words prove nothing, so short texts pass."""
        if self.usual is None:
            return np.ones(len(best), bool)
        n = np.maximum(np.diff(before), 1)
        return sums(margin, before) / n + ERRORS * self.spread[best] / np.sqrt(n) >= KNOWN * self.usual[best]

    def predict(self, data: np.ndarray, offsets: np.ndarray, strings) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, share of it, number of switches and familiarity of each text; strings(i) gives a text where its bytes don't show a letter."""
        rows = len(offsets) - 1
        if not self.langs:
            return ["und"] * rows, np.zeros(rows), np.zeros(rows, np.int64), np.zeros(rows, bool)
        starts, ends, before, gamma, margin = self._read(data, offsets)
        share = np.stack([sums(gamma[:, j] * (ends - starts), before) for j in range(len(self.langs))], axis=1)
        whole = share.sum(axis=1)
        best = share.argmax(axis=1)
        score = np.clip(share[np.arange(rows), best] / np.maximum(whole, 1e-300), 0, 1)
        state = gamma.argmax(axis=1)
        turn = np.concatenate([[False], state[1:] != state[:-1]]) if len(state) else np.zeros(0, bool)
        turn[before[:-1][np.diff(before) > 0]] = False
        plain = sums(LETTERS[data] & (data < 128), offsets) > 0 if len(data) else np.zeros(rows, bool)
        known = [bool(plain[i]) or (whole[i] > 0 and any(c.isalpha() for c in strings(i))) for i in range(rows)]
        return [self.langs[b] if k else "und" for b, k in zip(best.tolist(), known, strict=True)], np.where(known, score, 0.0), sums(turn, before).astype(np.int64), self.familiar(best, margin, before)


def labelled_texts(docs: DataFrame, sample: int, sample_bytes: int, folds: int, held_out: int) -> list[tuple[str, bytes]]:
    """(language, text) of each language's sample: rows outside the held-out fold with a language, each with its own text, by the smallest hashes of both
    id and text, equal texts of a language once. The driver receives numbers first and then the texts chosen.
    Where all texts of a language are too long for its bytes, its shortest is cut to them."""
    fold = crc_mod(F.col("doc_id").cast("long"), folds) != held_out
    rows = docs.where(F.col("lang").isNotNull() & fold).select(F.col("lang").cast("string").alias("lang"), F.xxhash64(F.col("doc_id").cast("long"), whole("text")).alias("h"), whole("text").alias("text"))
    counts = docs.where(F.col("lang").isNotNull() & fold).groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("all"))
    # only hashes below one that gives four times as many rows as asked for are ranked
    most = F.broadcast(counts.select("lang", F.when(F.col("all") <= 4 * sample, F.lit(2**63 - 1)).otherwise((F.lit(4.0 * sample) / F.col("all") - 0.5) * F.lit(2.0**64)).cast("long").alias("most")))  # a row for each language
    low = rows.join(most, "lang").where(F.col("h") <= F.col("most"))
    ranked = low.select("lang", "h", F.xxhash64("text").alias("d"), F.octet_length("text").alias("size"), F.row_number().over(Window.partitionBy("lang").orderBy("h")).alias("n"))
    kept: dict[str, dict[int, tuple[int, int]]] = {}
    for r in ranked.where(F.col("n") <= sample).orderBy("lang", "h").collect():  # at most `sample` rows of numbers for a language
        kept.setdefault(r["lang"], {}).setdefault(r["d"], (r["h"], r["size"]))
    chosen = []
    for lang, found in kept.items():
        some = list(found.values())
        fits = [some[i] for i in within([size for _, size in some], sample_bytes)]
        chosen += [(lang, h) for h, _ in fits or [min(some, key=lambda x: x[1])]]
    if len(kept) < 2:
        return [(lang, b"") for lang in kept]
    asked = F.broadcast(docs.sparkSession.createDataFrame(chosen, "lang string, h long"))  # at most `sample` rows for a language
    got = rows.join(asked, ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "h", F.encode(F.col("text"), "utf-8").alias("raw"))
    return [(lang, raw[:sample_bytes]) for lang, _, raw in sorted((r["lang"], r["h"], bytes(r["raw"])) for r in got.toLocalIterator())]


def fit(docs: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    """Learns from text and non-null lang of a bounded sample of each language outside the held-out fold, however rare the language is."""
    got = labelled_texts(docs, sample, sample_bytes, folds, held_out)
    langs = sorted({lang for lang, _ in got})
    if len(langs) < 2:
        return Model(langs)
    order = {c: i for i, c in enumerate(langs)}
    stretches, labels = [], []
    for lang, raw in got:
        w = raw.split()
        for at in range(0, len(w), STRETCH):
            stretches.append(b" ".join(w[at : at + STRETCH]))
            labels.append(order[lang])
    deal = np.random.Generator(np.random.PCG64(11)).permutation(len(stretches))
    data = np.frombuffer(b" ".join(stretches[i] for i in deal) + b" ", np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(stretches[i]) + 1 for i in deal])]).astype(np.int64)
    starts, ends, before = spans(data, edges, LETTERS)
    y = np.repeat(np.array(labels)[deal], np.diff(before))
    offsets = before[np.unique(np.append(np.arange(0, len(before), MIXED), len(before) - 1))]
    k = len(langs)
    fixed, tri, parts = word_features(data, starts, ends)
    owner = np.repeat(np.arange(len(starts)), np.diff(parts))
    flat = np.concatenate([fixed.ravel(), tri])
    word = np.concatenate([np.repeat(np.arange(len(starts)), fixed.shape[1]), owner])
    grad = lambda r: np.stack([np.bincount(flat, r[word, j], TABLE) for j in range(k)], axis=1)
    weights, trans, start = crf.fit(lambda w: emissions(w, data, starts, ends), grad, np.zeros((TABLE, k)), y, offsets, np.ones(len(y)), k, ROUNDS, STEP, RIDGE)
    margin = margins(emissions(weights, data, starts, ends))
    size = np.diff(before)
    of, mean = np.array(labels)[deal][size > 0], (sums(margin, before) / np.maximum(size, 1))[size > 0]
    usual = np.array([np.median(mean[of == j]) if (of == j).any() else 0.0 for j in range(k)])
    spread = np.array([margin[y == j].std() if (y == j).any() else 0.0 for j in range(k)])
    return Model(langs, weights, trans, start, usual, spread)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, n_switches) of every row of docs.

    score is the share of the text, by length of words, that the marginals give to lang_pred; `und` with score 0 if the text is null or
    has no letter, or if no language was learned. Equal shares go to the language first in order. A text of any length is read whole; repeated rows stay
    repeated, other columns are ignored, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: TABLE rows by the number of languages

    def run(batches):
        m = shared.value
        for batch in bounded_batches(batches):
            text = batch.column(1)
            langs, score, turns, _ = m.predict(*raw_text(text), lambda i, t=text: t[i].as_py())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(turns)], names=["doc_id", "lang_pred", "score", "n_switches"])

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, n_switches long")


def keep(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of docs with a language, at least `least` of whose text is in it, all columns.

    Null texts and texts without a letter go, and texts in a language that wasn't learned: those whose words hardly part the learned ones (`Model.familiar`), if there
    are two or more and the text has words enough to tell. A text that switches between learned languages is familiar."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def passes(column):
        langs, score, _, familiar = shared.value.predict(*raw_text(column), lambda i: column[i].as_py())
        return (np.array(langs) != "und") & (score >= least) & familiar

    return filter_rows(docs, passes)
