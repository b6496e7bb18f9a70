"""The training-data operators against brute force, exact round trips and held-out accuracy, and on odd tables."""

import base64
import collections
import hashlib
import itertools
import math
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from epistola.llm import bpe, crf, decontam, langid, licenses, ngram_lm, quality, registry, simhash, sketch, toxicity, url_reputation, vector
from epistola.llm.common import table, texts, work_dir

DOC = "doc_id long, text string"
rng = random.Random(3)
WORDS = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]


def prose(n, seed, words=WORDS):
    r = random.Random(seed)
    return " ".join(r.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank and repeated texts, a null id, a very long text, and columns with clashing names."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "the same words here again"), (4, "the same words here again"), (None, "no id at all"), (5, prose(30000, 1)), (6, "…—¡ 123 !!"), (7, "x" * 70000), (8, " " * 70000 + "a")]
    d = spark.createDataFrame(rows, DOC)
    return d.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "score": F.lit(1), "fp": F.lit("x"), "row_id": F.lit(0), "label": F.lit(2), "hash": F.lit("h")})


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


def test_every_operator_takes_odd_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, None), (2, ""), (3, prose(20, 77)), (None, "x")], "item_id long, text string")
    for d in (odd, odd.limit(0), odd.select("doc_id", F.lit(None).cast("string").alias("text"), "lang")):
        n = d.count()
        assert ngram_lm.train_and_score(d).count() == n
        assert sketch.with_next(texts(d), 3).count() == n
        assert len(simhash.near_duplicates(d).collect()) == n
        assert len(licenses.scan(d).collect()) == n
        assert toxicity.score(d, toxicity.fit(d, labels)).where("score between 0 and 1").count() == n
        assert toxicity.fit(d, labels.limit(0)).constant == 0.0
        assert decontam.find(d, bench).where("contaminated").count() == 0 and decontam.find(d, bench.limit(0)).count() == n
        assert bpe.encode_documents(d).count() == n
        assert langid.identify(d, langid.fit(d)).count() == n
        assert quality.score(d, quality.fit(d, labels)).where("score between 0 and 1").count() == n
        pages = d.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"))
        assert url_reputation.judge(pages, labels).count() == n


# op1


def _brute_lm(rows, least=1):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    tok = {i: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(low)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tok}
    c, pairs, triples = collections.Counter(), collections.Counter(), collections.Counter()
    for i, x in tok.items():
        if not held[i]:
            y = [None, *x]
            c.update(x)
            pairs.update(itertools.pairwise(y))
            triples.update(zip(y, y[1:], y[2:], strict=False))
    n, v = sum(c.values()), len(c)
    ones, twos = (sum(k == m for k in c.values()) for m in (1, 2))
    d1 = ones / (ones + 2 * twos) if ones else 0.5
    kept2, kept3 = ({k: m for k, m in x.items() if m >= least} for x in (pairs, triples))
    mass1, mass2 = collections.Counter(), collections.Counter()
    for (a, _), m in kept2.items():
        mass1[a] += (m - 0.75) / c[a]
    for (a, b, _), m in kept3.items():
        mass2[a, b] += (m - 0.75) / pairs[a, b]
    for i, x in tok.items():
        y, score = [None, *x], 0.0
        for j in range(1, len(y)):
            w, u = y[j], y[j - 1]
            p = (c[w] - d1) / n if w in c else d1 * v / n
            p = ((kept2[u, w] - 0.75) / c[u] if (u, w) in kept2 else 0) + (1 - mass1[u] if u in c else 1) * p
            if j > 1 and (y[j - 2], u) in kept2:
                p = ((kept3[y[j - 2], u, w] - 0.75) / pairs[y[j - 2], u] if (y[j - 2], u, w) in kept3 else 0) + (1 - mass2[y[j - 2], u]) * p
            score += math.log10(p)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        yield i, held[i], len(x), sum(w in c for w in x), n, base, score


def test_trie_scores_what_a_plain_model_scores(spark, sf, docs):
    got = {r["doc_id"]: r for r in registry.op1_ngram_trie(spark, sf).collect()}
    better = 0
    for i, held, n, known, total, base, score in _brute_lm([(r["doc_id"], r["text"]) for r in docs.collect()]):
        r = got.pop(i)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, abs=1e-3 * n)
        better += r["score"] - r["base_score"] if held else 0
    assert not got and better > 0


def test_elias_fano_finds_all_and_only_its_keys():
    r = np.random.default_rng(1)
    for n, top in ((0, 10), (1, 1 << 40), (5000, 5001), (5000, 1 << 50), (3000, 4000)):
        keys = np.sort(r.choice(top, n, replace=False) if top < 1 << 20 else np.unique(r.integers(0, top, n))).astype(np.uint64)
        ef = ngram_lm.EliasFano(ngram_lm.ef_pack(keys, top, "s"), "s")
        assert (ef.find(keys) == np.arange(len(keys))).all()
        other = np.setdiff1d(r.integers(0, top * 2, 1000).astype(np.uint64), keys)
        assert (ef.find(other) == -1).all()
    dense = np.concatenate([np.arange(20000), [1 << 45]]).astype(np.uint64)  # a long run of keys with equal high bits
    ef = ngram_lm.EliasFano(ngram_lm.ef_pack(dense, (1 << 45) + 1, "s"), "s")
    assert (ef.find(dense) == np.arange(len(dense))).all() and ef.find(np.array([20000], np.uint64))[0] == -1


def test_frequent_words_are_parted_by_successor(spark):
    rows = [(i, f"hot{'' if i % 2 else ' hot'} a{i % 50} hot b{i % 50} hot") for i in range(400)]
    model = ngram_lm.train(spark.createDataFrame(rows, DOC), work_dir(spark, "hot"), 16)
    assert len(model.hot) and model.hot_parts.max() > 1
    got = {r["doc_id"]: r["score"] for r in ngram_lm.train_and_score(spark.createDataFrame(rows, DOC)).collect()}
    for i, *_, score in _brute_lm(rows):
        assert got[i] == pytest.approx(score, abs=2e-2)


# op2


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _sketch(text, k=sketch.K, n=sketch.WORDS):
    w = [x for x in re.split(r"[ \t\n\x0B\f\r]+", text.lower()) if x]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]

    def chain(xs, seed):
        for x in xs:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", x), seed)
        return seed

    whole = 5
    for x in h:
        whole = chain([whole, x], 42)
    found = {chain(h[i : i + n], 42) for i in range(len(h) - n + 1)} if len(h) >= n else {whole} if h else set()
    return sorted(map(_signed, found))[:k], found


def test_sketches_and_edits(spark, sf, docs):
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in registry.op2_bottom_k_sketch(spark, sf).collect()}
    off = []
    for at, (i, text) in enumerate(rows):
        nxt = rows[(at + 1) % len(rows)][1]
        cut = len(text) // 3
        edit = text[: len(text) - cut] + nxt[:cut]
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        mine, all_mine = _sketch(text)
        theirs, all_theirs = _sketch(edit)
        assert r["fingerprint"] == "".join(f"{x & (1 << 64) - 1:016x}" for x in mine) and r["edited_fingerprint"] == "".join(f"{x & (1 << 64) - 1:016x}" for x in theirs)
        off.append(abs(r["near_edited"] - len(all_mine & all_theirs) / max(1, len(all_mine | all_theirs))))
        if text == nxt:
            assert r["near_next"] == 1.0
    assert np.mean(off) < 0.04 and max(off) < 0.2


def test_sketches_merge_and_estimate(spark):
    parts = spark.createDataFrame([(i, list(range(i * 500, i * 500 + 1000))) for i in range(4)], "g int, xs array<int>").select("g", F.transform("xs", lambda x: F.xxhash64(x)).alias("h"))
    each = parts.select("g", sketch.bottom(F.col("h")).alias("s"))
    whole = parts.agg(sketch.bottom(F.flatten(F.collect_list("h"))).alias("s")).first()["s"]
    assert each.agg(sketch.merged(F.collect_list("s")).alias("s")).first()["s"] == whole
    assert sketch.merge_groups(each.withColumn("all", F.lit(1)), ["all"], "s").first()["s"] == whole
    r = each.where("g = 0").select(F.col("s").alias("a")).crossJoin(each.where("g = 1").select(F.col("s").alias("b"))).select(sketch.resemblance(F.col("a"), F.col("b")).alias("r"), sketch.containment(F.col("a"), F.col("b")).alias("c"), sketch.distinct_shingles(F.col("a")).alias("n")).first()
    assert abs(r["r"] - 1 / 3) < 0.13 and abs(r["c"] - 0.5) < 0.2 and abs(r["n"] - 1000) < 300


# op3


def test_urls_and_rules(spark):
    urls = [None, "no scheme", "http://A.Example.org/es/x?q#f", "http://example.org/en/12", "http://notexample.org/es/", "https://x.com/fr/a", "https://com/de/", "http://b.org", "http://b.org?x", "ftp://h.net:80/p;a#b?c", "x://y://z/w"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_reputation.judge(pages, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()}
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[3][2:] == ("example.org/en/1", "block") and got[4][2:] == ("org/", "allow") and got[5][2:] == ("com/fr/", "allow") and got[6][2:] == ("com/de/", "block")
    assert got[7] == ("b.org", "", None, "allow") and got[8][0] == "b.org" and got[9][:2] == ("h.net:80", "/p;a") and got[10][:2] == ("y:", "//z/w")


def test_reputation_shrinks_and_blocks(spark):
    pages, labels = [], []
    for h in range(30):
        for _ in range(40 if h else 400):
            i = len(pages)
            pages.append((i, f"http://h{h}.d{h % 10}.net/p"))
            labels.append((i, int(h % 10 != 3 and i % 12 != 0), 0))
    pages += [(10**6, "http://new.d3.net/"), (10**6 + 1, "http://new.other.net/")]
    got = {r["page_id"]: r for r in url_reputation.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    verdict = {r["host"]: r["verdict"] for r in got.values()}
    assert {h for h, v in verdict.items() if v == "block"} >= {"h3.d3.net", "h13.d3.net", "h23.d3.net"} and verdict["h1.d1.net"] == "allow" and verdict["new.other.net"] == "allow"
    assert got[10**6]["reputation"] < got[10**6 + 1]["reputation"]
    assert all(0 <= r["reputation"] <= r["upper_bound"] <= 1 for r in got.values())


# op4


def _simhash(text):
    low = text.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    w = re.findall(rb"[^\x20\x09-\x0D]+", low)
    s = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(codes):
    label = list(range(len(codes)))
    for i, j in itertools.combinations(range(len(codes)), 2):
        if (codes[i] ^ codes[j]).bit_count() <= 4:
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    return label


def test_simhash_components(spark, sf, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in registry.op4_simhash_gray(spark, sf).collect()}
    codes = [_simhash(t) for _, t in rows]
    assert [got[i]["fingerprint"] for i, _ in rows] == [f"{c:016x}" for c in codes]
    label = _classes(codes)
    least = {}
    for (i, _), c in zip(rows, label, strict=True):
        least[c] = min(least.get(c, i), i)
    assert [got[i]["component_id"] for i, _ in rows] == [least[c] for c in label]


def _near_codes(n, centres, flips, seed):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(centres)]
    out = []
    for _ in range(n):
        c = r.choice(base)
        for b in r.sample(range(64), r.randint(0, flips)):
            c ^= 1 << b
        out.append(c)
    return sorted(set(out))


def test_gray_index_finds_all_pairs():
    codes = np.array(_near_codes(700, 40, 5, 5), np.uint64)[:, None]
    for c, most in ((codes, 4), (np.concatenate([codes, codes[::-1] >> np.uint64(3)], axis=1), 9)):
        index = simhash.GrayIndex(c)
        got = {(q, p) for qs, ps in index.search(index.codes, most) for q, p in zip(qs.tolist(), ps.tolist(), strict=True)}
        near = np.bitwise_count(index.codes[:, None] ^ index.codes[None, :]).sum(axis=2) <= most
        want = set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))
        assert got == want
        late = {(q, p) for qs, ps in index.search(index.codes, most, 300) for q, p in zip(qs.tolist(), ps.tolist(), strict=True)}
        assert {x for x in want if x[1] >= 300} <= late <= want


def test_gray_order_changes_one_bit_at_a_time():
    every = np.arange(256, dtype=np.uint64)
    two = np.stack([every >> np.uint64(4), (every & np.uint64(15)) << np.uint64(60)], axis=1)  # the words' ends that meet
    two = two[simhash.gray_order(two)]
    assert (np.bitwise_count(two[1:] ^ two[:-1]).sum(axis=1) == 1).all()
    assert (np.diff(simhash.gray_rank(np.sort(simhash.gray_rank(every)))[:0]) >= 0).all() and (simhash.gray_rank(every ^ (every >> np.uint64(1))) == every).all()


@pytest.mark.parametrize("shard,large", [(8192, 8192), (64, 8192), (64, 60)])
def test_links_of_split_shards_are_whole(spark, shard, large):
    codes = _near_codes(500, 25, 4, 9)
    frame = spark.createDataFrame([(_signed(c), _signed(c), 0, _signed(c)) for c in codes], "node long, joined long, size int, fp0 long")
    found = simhash.links(frame, len(codes), simhash.block_choices(len(codes), shard=shard), shard=shard, large=large)
    roots = {r["node"]: r["root"] for r in simhash.components(found).collect()}
    mine = collections.defaultdict(set)
    for c in codes:
        mine[roots.get(_signed(c), _signed(c))].add(c)
    want = collections.defaultdict(set)
    for c, x in zip(codes, _classes(codes), strict=True):
        want[x].add(c)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_block_choices_cover_every_difference():
    for n in (10, 10**7, 10**9):
        choices = simhash.block_choices(n)
        for diff in itertools.islice(itertools.combinations(range(0, 64, 3), 4), 500):
            assert any(not set(diff) & set(c) for c in choices)


def test_one_document_of_each_group_stays(spark, odd):
    again = odd.unionByName(odd.where("doc_id is null or doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    for d in (odd, again):  # copies without an id go, whether another has one or not
        kept = [(r["doc_id"], r["text"]) for r in simhash.keep_one(d).collect()]
        ids = [i for i, _ in kept]
        assert ids.count(4) == 1 and ids.count(None) == 1 and ids.count(5) == 1 and [i for i in ids if i in (1, 2, 3)] == [1]
    assert simhash.keep_one(odd).columns == odd.columns and simhash.keep_one(odd.limit(0)).count() == 0


# op5


def test_base_phrases_by_brute_force(spark):
    r = random.Random(2)
    vocab = "gnu general public license apache cc by mit é x1".split()
    rows = [(i, r.choice([" ", "-", ". ", "\n"]).join(r.choice([str.upper, str.title, str])(r.choice(vocab)) for _ in range(r.randint(0, 60)))) for i in range(300)]
    got = {x["doc_id"]: x for x in licenses.scan(spark.createDataFrame(rows, DOC)).collect()}
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t))
        at = [(k, label) for phrase, label in licenses.BASE.items() for p in [phrase.split()] for k in range(len(w)) if w[k : k + len(p)] == p]
        x = got[i]
        assert (x["n_words"], x["n_base"]) == (len(w), len(at))
        assert (x["first_word"], x["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert x["base_labels"] == ",".join(sorted({label for _, label in at})) and set(filter(None, x["base_labels"].split(","))) <= set(x["labels"].split(","))


def test_notices_with_insertions_and_noise(spark):
    notice = dict(reversed(licenses.NOTICES[2:3] + [licenses.NOTICES[7]]))
    long = notice["mit"].split()
    inserted = long[:6] + ["really"] + long[6:]
    rows = [(1, prose(50, 1) + " " + " ".join(inserted) + " " + prose(30, 2)), (2, " ".join(long[:6])), (3, prose(500, 4)), (4, "All Rights-Reserved. CC BY-NC 4.0")]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(spark.createDataFrame(rows, DOC)).collect()}
    assert got[1][0] == "mit" and got[1][1] >= licenses.COVER and got[2] == ("", 0.0) and got[3] == ("", 0.0)
    assert got[4] == ("cc-by,cc-by-nc,proprietary", 1.0)


# op6, op9, op10


def _labelled(spark, n=900):
    r, rows, labels = random.Random(8), [], []
    for i in range(n):
        toxic, good = int(i % 5 == 0), int(i % 4 != 0)
        w = prose(60, i).split()
        if toxic:
            for _ in range(3):
                w[r.randrange(60)] = r.choice(["idiot", "moron", "loser", "grumphish", "grumphoid", "grumphest"])
        lines = [" ".join(w[k : k + 12]) for k in range(0, 60, 12)]
        if not good:
            lines = [x.upper().replace(" ", "!! ") for x in lines]
        rows.append((i, "\n".join(lines), "en"))
        labels.append((i, good, toxic))
    return spark.createDataFrame(rows, DOC + ", lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = _labelled(spark)
    model = toxicity.fit(docs, labels)
    assert len(model.lexicon.values)
    got = toxicity.score(docs, model).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).collect()
    assert np.mean([(r["score"] >= 0.5) == (r["toxic"] == 1) for r in got]) > 0.95
    kept = toxicity.keep(docs.withColumn("extra", F.lit(1)), model)
    assert kept.columns == ["doc_id", "text", "lang", "extra"] and 0.7 * 900 < kept.count() < 0.9 * 900


def test_trees_and_calibration():
    r = np.random.default_rng(0)
    x = r.normal(size=(600, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = toxicity.Boosted().fit(x[:400], y[:400])
    assert ((trees.margin(x[400:]) > 0) == y[400:]).mean() > 0.9
    iso = toxicity.Isotonic().fit(trees.margin(x[:400]), y[:400])
    assert (np.diff(iso(np.linspace(-5, 5, 200))) >= -1e-12).all()
    f = lambda t: dict(zip(toxicity.NAMES, toxicity.features(*_raw([t]), vector.HashSet(np.zeros(0, np.uint64)))[0], strict=True))
    assert f("you m0r0n")["undone"] > 0 and f("you idiot")["near_second"] > 0 and f("idiot " + "a " * 30 + "you")["near_second"] == 0 and f("WHAT NOW")["capital_words"] == 1


def _raw(strings):
    data = [s.encode() for s in strings]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)


def test_forward_backward_by_enumeration():
    r = np.random.default_rng(4)
    lens, k = [3, 0, 5, 1, 4], 3
    offsets = np.concatenate([[0], np.cumsum(lens)])
    scores, trans, start = r.normal(size=(offsets[-1], k)), r.normal(size=(k, k)), r.normal(size=k)
    gamma, pairs, first = crf.forward_backward(scores, offsets, trans, start, pairs=True)
    want, want_pairs = np.zeros_like(gamma), np.zeros((k, k))
    for a, n in zip(offsets[:-1], lens, strict=True):
        if not n:
            continue
        paths = list(itertools.product(range(k), repeat=n))
        w = np.array([np.exp(start[p[0]] + sum(scores[a + i, s] for i, s in enumerate(p)) + sum(trans[x, y] for x, y in itertools.pairwise(p))) for p in paths])
        w /= w.sum()
        for p, q in zip(paths, w, strict=True):
            for i, s in enumerate(p):
                want[a + i, s] += q
            for x, y in itertools.pairwise(p):
                want_pairs[x, y] += q
    assert np.allclose(gamma, want) and np.allclose(pairs, want_pairs) and np.allclose(first, want[offsets[:-1][np.array(lens) > 0]].sum(0))


def test_languages_held_out_and_switched(spark, sf, docs):
    model = langid.fit(docs)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.9
    by = {r["lang"]: r["text"] for r in docs.where("n_chars > 800").collect()}
    half = lambda t: " ".join(t.split()[:60])
    mixed = half(by["en"]) + " " + half(by["es"])
    *_, before, gamma = model.marginals(*_raw([mixed]))
    en, es = model.langs.index("en"), model.langs.index("es")
    assert gamma[:40, en].mean() > 0.8 and gamma[-40:, es].mean() > 0.8
    odd = spark.createDataFrame([(1, None), (2, "12 …!"), (3, "—¡¿—"), (4, "é")], DOC)
    assert [r["lang_pred"] == "und" for r in langid.identify(odd, model).orderBy("doc_id").collect()] == [True, True, True, False]
    assert langid.keep(odd, model, 0.1).count() == 1


def test_quality_held_out(spark):
    docs, labels = _labelled(spark)
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).collect()
    assert np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in got]) > 0.95
    s, n = model.score(*_raw(["", "\n\n", "a b"]))
    assert s[0] == s[1] == model.prior and list(n) == [0, 0, 1]


def test_word_hashes_do_not_depend_on_place():
    words = [prose(1, i) for i in range(200)] + ["x" * (1 << 19), "é", "É"]
    text = "  ".join(words)
    data, offsets = _raw([text, text.upper()])
    starts, ends, before = vector.spans(data, offsets, vector.NOT_SPACE)
    h = vector.hashes(data, starts, ends)
    assert list(before) == [0, len(words), 2 * len(words)]
    assert (h[: len(words)] == vector.hash_words(words)).all()
    assert (h[:201] == h[len(words) : len(words) + 201]).all() and len(set(h.tolist())) == len(set(words))


# op7


def test_overlaps_with_substitutions(spark):
    items = [(i, prose(30 if i else 9, 1000 + i)) for i in range(5)]
    r = random.Random(6)

    def swap(words, every):
        return [f"swap{r.randrange(10**9)}" if i % every == every - 1 else w for i, w in enumerate(words)]

    rows, want = [], {}
    for i in range(60):
        body, item = prose(300, i).split(), items[i % 5]
        words = item[1].split()
        words = [words, swap(words, 5), swap(words, 2), words[5:] if i % 5 else words][i // 15]
        want[i] = i // 15 != 2
        rows.append((i, " ".join(body[:150] + words + body[150:])))
    rows.append((99, prose(5000, 123)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame(rows, DOC)
    got = {x["doc_id"]: x for x in decontam.find(d, bench).collect()}
    assert {i: got[i]["contaminated"] for i in want} == want and not got[99]["contaminated"]
    assert all(got[i]["item_ids"] == [i % 5] for i, hit in want.items() if hit)
    assert sorted(r["doc_id"] for r in decontam.keep_clean(d, bench).collect()) == sorted([i for i, hit in want.items() if not hit] + [99])
    with pytest.MonkeyPatch.context() as m:  # a salted join in place of a broadcast, and a filter that lets most positions through
        m.setattr(decontam, "BROADCAST", 0)
        m.setattr(decontam, "SMALLEST", 64)
        m.setattr(decontam, "SPREAD", 1)
        again = {x["doc_id"]: x for x in decontam.find(d.repartition(5), bench.repartition(3)).collect()}
    assert again == got


def _aligned(text, item):
    """The largest share of agreeing words of any window at any alignment, by trying all."""
    w, v = text.split(), item.split()
    n, best = min(len(v), decontam.WINDOW), 0.0
    for start in range(1 - len(v), len(w)):
        same = [int(w[start + i] == v[i]) for i in range(max(0, -start), min(len(v), len(w) - start))]
        best = max([best, *(sum(same[i : i + n]) / n for i in range(max(1, len(same) - n + 1)))])
    return best


def test_overlaps_by_trying_every_alignment(spark):
    r, few = random.Random(12), WORDS[:40]
    items = [(i, " ".join(r.choice(few) for _ in range(r.choice([2, 4, 5, 6, 7, 9, 15, 24, 40])))) for i in range(60)]
    rows = []
    for i in range(250):
        w = [r.choice(few) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            part = r.choice(items)[1].split()
            part = [r.choice(few) if r.random() < r.choice([0.0, 0.1, 0.3]) else x for x in part]
            at = r.randint(0, len(w))
            w[at:at] = part[: r.randint(1, len(part))] if r.random() < 0.3 else part
        rows.append((i, " ".join(w)))
    got = {x["doc_id"]: x for x in decontam.find(spark.createDataFrame(rows, DOC), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, text in rows:
        shares = {k: _aligned(text, item) for k, item in items}
        found = sorted(k for k, s in shares.items() if s >= decontam.RATIO)
        assert got[i]["item_ids"] == found and got[i]["overlap"] == pytest.approx(max((shares[k] for k in found), default=0.0))


def test_passages_do_not_reach_across_documents(spark):
    item = prose(24, 5)
    half = item.split()
    rows = [(1, " ".join(half[:12])), (2, " ".join(half[12:])), (3, "q q " + item)]
    got = {r["doc_id"]: r["overlap"] for r in decontam.find(spark.createDataFrame(rows, DOC).coalesce(1), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 1.0}


# op8


def test_ids_are_those_of_the_whole_text(spark):
    path, pattern = bpe.default_ranks()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(path, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(1)
    alphabet = [" ", "  ", "\n", "\u3000", "\xa0", "a", "Zz", "é", "中", "😀", "1", "!", "'s", "<|endoftext|>", "\x00", "\u0301"]
    strings = ["", None, " " * 500, *("".join(r.choice(alphabet) for _ in range(r.randint(1, 400))) for _ in range(150)), prose(40000, 2)]
    for t in strings[2:]:
        assert bpe.encode(enc, t, 16).tolist() == enc.encode_ordinary(t)
    got = {x["doc_id"]: x for x in bpe.digests(bpe.encode_documents(spark.createDataFrame(list(enumerate(strings)), DOC))).collect()}
    for i, t in enumerate(strings):
        ids = enc.encode_ordinary(t or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


# pipeline


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    docs, labels = _labelled(spark, 400)
    clean = docs.withColumn("text", F.lower(F.regexp_replace("text", "!!", "")))
    item = prose(30, 4242)
    extra = [(5000, clean.where("doc_id = 1").first()["text"], "en"), (5001, prose(40, 9) + " " + item + " " + prose(40, 10), "en"), (5002, "12 34", "en"), (5003, None, "en")]
    every = clean.unionByName(spark.createDataFrame(extra, DOC + ", lang string")).select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    sf = f"file://{tmp_path}"
    every.write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, every, sf).columns == every.columns
    kept = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    assert not set(kept) & {5000, 5001, 5002, 5003}
    assert len(set(kept) & toxic) <= 0.05 * len(toxic) and len(set(range(400)) - toxic - set(kept)) <= 4
    one = next(iter(kept.values()))
    assert one["n_tokens"] * 4 == len(one["token_ids"]) and one["decoded_sha256"] == hashlib.sha256(every.where(F.col("doc_id") == one["doc_id"]).first()["text"].encode()).hexdigest()


def test_arrow_offsets_of_sliced_batches():
    column = pa.array(["ab", "", "cde", None, "f"])
    from epistola.llm.common import raw_text

    data, offsets = raw_text(column.slice(1, 3))
    assert data.tobytes() == b"cde" and list(offsets) == [0, 0, 3, 3]
