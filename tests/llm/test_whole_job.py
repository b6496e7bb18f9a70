"""Places at which operators once did less than the whole job."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from epistola.llm import bpe, common, decontam, langid, licenses, ngram_lm, quality, registry, simhash, sketch, toxicity, vector
from epistola.llm.common import labelled_sample, within, work_dir
from tests.llm import test_llm_operators as brute
from tests.llm.test_llm_operators import DOC, prose


def _five(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


# pipeline


def _family(n, edits, words=150, seed=3):
    """Texts of one family, each with so many words of its own at random places."""
    r, base = random.Random(seed), prose(words, seed).split()
    rows = []
    for i in range(n):
        w = list(base)
        for k in range(edits(r)):
            w[r.randrange(len(w))] = f"own{i}x{k}"
        rows.append(" ".join(w))
    return rows


def test_a_family_too_far_apart_is_not_compared_pair_by_pair(monkeypatch):
    rows, compared = _family(400, lambda r: 6), []
    plain = pa.RecordBatch.from_arrays([pa.array([0] * len(rows)), pa.array(rows), *(pa.array(range(len(rows))) for _ in range(3))], names=["pad", "text", "first_id", "d1", "d2"])
    group = pa.Table.from_batches(simhash._sign([plain]))
    group = group.append_column("joined", group.column("node")).append_column("text", pa.array(rows))
    for name in ("i", "j", "own"):
        group = group.append_column(name, pa.array([0] * len(rows), pa.int32()))
    likeness = simhash.similarity
    monkeypatch.setattr(simhash, "similarity", lambda a, b: compared.append(1) or likeness(a, b))
    code = np.stack([group.column(c).to_numpy() for c in ("fp0", "fp1")], axis=1).view(np.uint64)
    assert sum(len(a) for a, _ in simhash.near(code, simhash.WIDE)) > 20 * len(rows)  # candidates by their fingerprints
    assert simhash._compare_all(group).num_rows == 0 and len(compared) < len(rows)
    assert simhash._outside(group).num_rows < len(rows) // 10  # the others' texts aren't fetched


def test_no_pair_that_passes_is_refused_by_its_sketch():
    r = np.random.Generator(np.random.PCG64(4))
    for n in (1, 4, 5, 9, 18, 146, 700, 5000):
        base, held = r.integers(0, 1 << 63, n, dtype=np.uint64), []
        for gone in range(0, n // 5 + 1, max(1, n // 40)):
            for new in (0, gone // 2, gone, n // 9):
                held.append(np.unique(np.concatenate([base[gone:], r.integers(0, 1 << 63, new, dtype=np.uint64)])))
        a, b = (x.ravel() for x in np.meshgrid(np.arange(len(held)), np.arange(len(held))))
        size, passes = np.array([len(s) for s in held]), np.array([simhash.similarity(held[x], held[y]) >= simhash.LEAST for x, y in zip(a, b, strict=True)])
        for words in (simhash.SKETCH, 64):
            kept = np.isin(np.arange(len(a)), simhash.alike(a, b, size, simhash.sketches(held, words)))
            assert passes.any() and kept[passes].all()


def test_a_large_graded_family_by_brute_force(spark):
    def edits(r):
        k = 1
        while r.random() < 0.7:
            k += 1
        return k

    rows = [*enumerate(_family(250, edits))]
    sets, root = [_five(t) for _, t in rows], [*range(len(rows))]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = {i for i, _ in rows if find(i) == i}
    assert 10 < len(want) < 200
    got = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, DOC)).collect()}
    assert want <= got and len(got - want) <= 2  # pairs at the very threshold meet in a shard with a chance of RECALL


def test_near_copies_by_jaccard_similarity(spark):
    rows = []
    for i in range(12):
        w = prose(200 + 40 * i, 500 + i).split()
        rows.append((10 * i, " ".join(w)))
        for k, every in enumerate((40, 60, 90, 25)):  # the last falls below 0.8
            rows.append((10 * i + k + 1, " ".join(f"swap{k}" if j % every == every - 1 else x for j, x in enumerate(w))))
    want, root = [], {i: i for i, _ in rows}
    sets = {i: _five(t) for i, t in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = sorted({find(i) for i in root})
    d = spark.createDataFrame(rows, DOC)
    before = simhash.near_duplicates(d).select("component_id").distinct().count()  # four bits of 64 link hardly any of these
    assert 12 < len(want) < before <= len(rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, d, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == want and kept.columns == d.columns


def test_repeated_ids_of_different_groups_both_stay(spark):
    a, b = prose(100, 1), prose(100, 2)
    d = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (1, a), (None, a), (None, None)], DOC)
    kept = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, d, "").collect() if r["doc_id"])
    assert kept == sorted([(1, a), (1, b)])


# op7


def test_short_and_unspaced_items_by_brute_force(spark):
    items = [(n, prose(n, 900 + n)) for n in range(1, 8)] + [(20, "今天天气很好我们一起去公园散步吧朋友们"), (21, "東京タワー"), (22, "สวัสดีครับผมชื่อสมชาย")]
    rows, want = [], {}
    for i, text in items:
        w = text.split() if i < 20 else list(text)
        glue = " " if i < 20 else ""
        for k in [None, *range(len(w))]:  # whole, and with one word replaced
            key = 1000 * i + (0 if k is None else k + 1)
            rows.append((key, prose(40, key) + " " + glue.join("zq" if j == k else x for j, x in enumerate(w)) + " " + prose(40, key + 7)))
            want[key] = k is None or len(w) - 1 >= 0.8 * min(len(w), 20)
    d, bench = spark.createDataFrame(rows, DOC), spark.createDataFrame([(i, f"{t}.") for i, t in items], "item_id long, text string")
    got = {r["doc_id"]: key in r["item_ids"] for r in decontam.find(d, bench).collect() for key in [r["doc_id"] // 1000]}
    assert got == want


def test_items_without_an_id_are_removed_too(spark):
    item = prose(20, 31)
    d = spark.createDataFrame([(1, prose(30, 1) + " " + item), (2, prose(30, 2))], DOC)
    bench = spark.createDataFrame([(None, item)], "item_id long, text string")
    assert [r["doc_id"] for r in decontam.keep_clean(d, bench).collect()] == [2]


# op1


def test_pruned_trie_backs_off(spark, sf):
    docs = registry.table(spark, sf, "documents").limit(60).cache()
    got = {r["doc_id"]: r["score"] for r in ngram_lm.train_and_score(docs, least=2).collect()}
    for i, _, n, *_, score in brute._brute_lm([(r["doc_id"], r["text"]) for r in docs.collect()], 2):
        assert got[i] == pytest.approx(score, abs=1e-3 * n)


def test_scoring_visits_the_shards_that_a_text_touches(spark):
    rows = [(i, prose(30, i)) for i in range(40)]
    few, many = (ngram_lm.train(spark.createDataFrame(rows, DOC), work_dir(spark, "shards"), parts) for parts in (16, 1 << 14))
    column = pa.array([prose(30, 1), "q", ""])
    asked = []
    with pytest.MonkeyPatch.context() as m:
        real = ngram_lm.Model.mapped
        m.setattr(ngram_lm.Model, "mapped", lambda self, level, shard: asked.append((level, shard)) or real(self, level, shard))
        again = many.score(column)
    assert len(set(asked)) <= 4 * 40 and all(np.allclose(x, y, atol=0.05) for x, y in zip(few.score(column), again, strict=True))


def test_files_in_memory_are_bounded(tmp_path):
    cache = ngram_lm.Cache()
    for k in range(6):
        ngram_lm.save(f"file://{tmp_path}/x-{k}", ngram_lm.ef_pack(np.arange(1000, dtype=np.uint64), 1000, "seq"))
    size = (tmp_path / "x-0").stat().st_size
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ngram_lm, "CACHE", 3 * size)
        m.setattr(ngram_lm.fs, "LocalFileSystem", type("Nothing", (), {}))  # as on a store that isn't mounted
        for k in (0, 1, 2, 0, 3, 4, 0):
            assert cache.get(f"file://{tmp_path}", f"x-{k}")[0].find(np.array([7], np.uint64))[0] == 7
    assert list(cache.held) == ["x-3", "x-4", "x-0"] and cache.used == 3 * size


# samples


def test_samples_are_bounded_and_whole(spark):
    docs = spark.createDataFrame([(i % 50, prose(5 + i, i)) for i in range(300)] + [(7, "again")] * 500 + [(None, "x")], DOC)
    labels = spark.createDataFrame([(i % 50, i % 2, 0) for i in range(2000)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    for limit, budget in ((20, 1 << 20), (1000, 1 << 20), (1000, 8000)):
        rows = labelled_sample(docs, labels, "quality", 3, 1, limit, budget).collect()
        held = {i for i in range(50) if zlib.crc32(str(i).encode()) % 3 == 1}
        ids = [r["doc_id"] for r in rows]
        assert len(set(ids)) == len(ids) and not set(ids) & held and sum(len(r["text"]) for r in rows) <= budget
        assert all(r["label"] == r["doc_id"] % 2 for r in rows)
        if budget > 8000:
            assert len(ids) == min(limit, 50 - len(held))
    assert within([5, 100, 40, 3, 9], 80) == [0, 3, 4] and within([], 8) == []


# op9


@pytest.fixture(scope="module")
def docs_01(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_each_row_teaches_its_own_language(spark):
    r = random.Random(4)
    fr, en, xx = (["".join(r.choice(c) for _ in range(r.randint(3, 8))) for _ in range(300)] for c in ("aeioulmn", "bcdfghk", "pqrstvwxyz"))
    text = lambda words, n: " ".join(r.choice(words) for _ in range(n))
    rows = [(1, text(fr if i % 2 else en, 30), "fr" if i % 2 else "en") for i in range(200)]  # all of one id
    rows += [(i, text(en, 30), "en") for i in range(1000, 7000)] + [(i, text(xx, 30), "xx") for i in (9001, 9002, 9004)]
    rows += [(8000, text(fr, 60000), "fr"), (None, text(fr, 3), "fr")]  # a text longer than the bytes of the sample
    docs = spark.createDataFrame(rows, DOC + ", lang string")
    model = langid.fit(docs)
    assert model.langs == ["en", "fr", "xx"]
    tests = [(i, text(w, 20)) for i, w in enumerate((fr, en, xx))]
    assert [x["lang_pred"] for x in langid.identify(spark.createDataFrame(tests, DOC), model).orderBy("doc_id").collect()] == ["fr", "en", "xx"]
    only = langid.fit(docs.where("lang = 'fr' and doc_id = 8000").unionByName(docs.where("lang = 'xx'")), sample_bytes=1000)  # too long: cut
    assert only.langs == ["fr", "xx"]


def test_texts_in_no_learned_language_go(spark, docs_01):
    model = langid.fit(docs_01)
    alien = [
        "Το γρήγορο αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και τρέχει μακριά στο δάσος όπου μένει με τα παιδιά της όλο τον χειμώνα", "Szybki brązowy lis przeskakuje nad leniwym psem i ucieka daleko do ciemnego lasu gdzie mieszka " * 20,
        "Быстрая коричневая лиса прыгает через ленивую собаку и убегает далеко в тёмный лес " * 3, "A gyors barna róka átugrik a lusta kutya felett és messzire fut az erdőbe ahol lakik " * 20,
    ]
    by = {r["lang"]: " ".join(r["text"].split()[:80]) for r in docs_01.where("n_chars > 800").collect()}
    switched = [" ".join(by.values()), by["de"] + " " + by["fr"]]
    rows = [(i, t) for i, t in enumerate(alien + switched + [by["es"], "Hola", "Ναι"])]  # one word proves nothing
    assert {r["doc_id"] for r in langid.keep(spark.createDataFrame(rows, DOC), model, 0.2).collect()} == set(range(4, 9))
    clean = docs_01.where("lang is not null and text rlike '[a-z]'")
    assert langid.keep(clean, model, 0.3).count() >= 0.998 * clean.count()


# op10


def test_lines_of_one_text_are_told_apart(spark):
    docs, labels = brute._labelled(spark)
    r, rows, marks = random.Random(5), [], []
    for i in range(2000, 2600):  # labelled bad for a part of their lines
        good = [prose(12, 10 * i + k) for k in range(r.randint(1, 4))]
        bad = [prose(12, 10 * i + 5 + k).upper().replace(" ", "!! ") for k in range(r.randint(1, 4))]
        rows.append((i, "\n".join(good + bad if i % 2 else bad + good), "en"))
        marks.append((i, 0, 0))
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    labels = labels.unionByName(spark.createDataFrame(marks, labels.schema))
    model = quality.fit(docs, labels)
    told = []
    for _, text, _ in rows[:100]:
        _, _, before, x = quality.lines(*brute._raw([text]))
        told += [(m > 0.5) == (line != line.upper()) for m, line in zip(model.marginals(before, x), text.split("\n"), strict=True)]
    assert np.mean(told) > 0.97
    got = quality.score(docs, model).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).collect()
    assert np.mean([(x["score"] >= 0.5) == (x["quality"] == 1) for x in got]) > 0.97


def test_line_features_by_a_plain_count():
    text = "The cat, THE cat!! 12|3\n\n  a a a $ b \nThe cat, THE cat!! 12|3"
    starts, ends, before, x = quality.lines(*brute._raw(["z\n", text]))
    raw = b"z\n" + text.encode()
    assert [raw[a:b].decode() for a, b in zip(starts, ends, strict=True)] == ["z", *[ln for ln in text.split("\n") if ln]] and list(before) == [0, 1, 4]
    common = set(quality.COMMON)
    for row, line, again in zip(x[1:], [ln for ln in text.split("\n") if ln], (1, 0, 1), strict=True):
        words, size = line.split(), len(line)
        rate = lambda chars: sum(c in chars for c in line) / size  # noqa: E731, B023
        want = {
            "bytes": math.log1p(size), "words": math.log1p(len(words)), "capitals": sum(c.isupper() for c in line) / size, "digits": sum(c.isdigit() for c in line) / size, "points": rate(".,;:?\"'()-"),
            "bangs": rate("!"), "bars": rate("|\t"), "symbols": rate("#$%&*@^~<>{}[]=+_\\/"), "word_bytes": size / len(words), "common": sum(w.lower() in common for w in re.findall("[A-Za-z]+", line)) / len(words),
            "echo": sum(a.lower() == b.lower() for a, b in itertools.pairwise(words)) / len(words), "again": again, "long_word": math.log1p(max(map(len, words))),
        }
        assert dict(zip(quality.NAMES, row, strict=True)) == pytest.approx(want)


# op6


def test_toxicity_features_by_a_plain_count():
    lexicon = vector.HashSet(vector.hash_words(["grumph"]), np.array([3.0]))
    texts = ["You IDIOT, you m0ron!! Grumph scum? ok", "calm words & a f.o.o 1 2", ""]
    got = toxicity.features(*brute._raw(texts), lexicon)
    every = set(toxicity.SEVERE) | set(toxicity.STRONG) | set(toxicity.MILD)
    for text, row in zip(texts, got, strict=True):
        f = dict(zip(toxicity.NAMES, row, strict=True))
        w = re.findall("[A-Za-z]+", text)
        low, n, n3, size = [x.lower() for x in w], max(1, len(w)), max(1, len(text.split())), max(1, len(text))
        hits = [x for x in low if x in every]
        assert f["log_bytes"] == pytest.approx(math.log1p(len(text))) and f["log_words"] == pytest.approx(math.log1p(n))
        for name, words in (("severe", toxicity.SEVERE), ("strong", toxicity.STRONG), ("mild", toxicity.MILD)):
            assert f[name] == pytest.approx(sum(x in words for x in low) / n)
        assert f["distinct_hits"] == len(set(hits)) and f["log_hits"] == pytest.approx(math.log1p(len(hits))) and f["any_hits"] == float(bool(hits))
        assert f["second_person"] == pytest.approx(sum(x in toxicity.SECOND_PERSON for x in low) / n) and f["learned"] == pytest.approx(low.count("grumph") / n) and f["learned_weight"] == (3.0 if "grumph" in low else 0.0)
        plain = [re.sub(r"[,?]", "", x).lower() for x in text.split()]
        undone = sum(any(c in toxicity.ALIKE for c in x) and "".join(toxicity.ALIKE.get(c, c) for c in x.rstrip("!")) in every for x in plain)
        assert f["undone"] == pytest.approx(undone / n) or "!!" in text  # a mark after a word is a look-alike too
        assert f["capitals"] == pytest.approx(sum(c.isupper() for c in text) / size) and f["exclaim"] == pytest.approx(text.count("!") / size) and f["question"] == pytest.approx(text.count("?") / size)
        assert f["digits"] == pytest.approx(sum(c.isdigit() for c in text) / size) and f["word_bytes"] == pytest.approx(len(text) / n3)


# defined results


def test_values_for_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "same words here again now"), (4, "same words here again now"), (None, "no id"), (5, prose(30000, 1))]
    d = spark.createDataFrame(rows, DOC).withColumns({"lang": F.lit("en"), "h": F.lit("x"), "d1": F.lit(1), "node": F.lit(2), "b": F.lit(3), "size": F.lit(0)})
    scored = {r["doc_id"]: r for r in ngram_lm.train_and_score(d).collect()}
    assert [scored[i]["n_tokens"] for i in (1, 2, 3, 4, None, 5)] == [1, 1, 1, 6, 3, 30001] and scored[1]["score"] == scored[2]["score"] == scored[3]["score"] and not scored[None]["held_out"]
    compared = sketch.compare(d).collect()
    by = {r["doc_id"]: r for r in compared}
    assert len(compared) == 7 and [by[i]["n_chars"] for i in (1, 2, 3, 4, None)] == [0, 0, 4, 25, 5] and by[1]["fingerprint"] == by[3]["fingerprint"] == "" and by[3]["near_next"] == 1.0
    assert by[None]["near_next"] == 0.0 and sorted(r["near_next"] for r in compared if r["doc_id"] == 4) == [0.0, 1.0]  # the second repeat is followed by a blank text
    one = sketch.compare(d.where("doc_id = 5")).first()
    assert one["near_next"] == 1.0 and sketch.compare(d.limit(0)).count() == 0
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    toxic = {r["doc_id"]: r["score"] for r in toxicity.score(d, toxicity.fit(d, labels)).collect()}
    assert toxic[1] == toxic[2] and len(toxic) == 6
    assert {r["score"] for r in quality.score(d, quality.fit(d, labels.limit(0))).collect()} == {0.5}
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(d, langid.fit(d)).collect()}
    assert found == {1: "und", 2: "und", 3: "und", 4: "en", None: "en", 5: "en"}
    assert {(r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(d).where("doc_id < 4").collect()} == {("0" * 16, 1)}
    assert [(r["n_words"], r["labels"], r["score"]) for r in licenses.scan(d).where("doc_id < 4").collect()] == [(0, "", 0.0)] * 3
    assert all(r["n_tokens"] == 0 and r["ids_sha256"] == r["decoded_sha256"] for r in bpe.digests(bpe.encode_documents(d)).where("doc_id < 3").collect())


def test_pipeline_on_an_empty_table_and_extra_columns(spark, tmp_path):
    sf = f"file://{tmp_path}"
    docs = spark.createDataFrame([(1, prose(40, 1), "en", "s", 1, "x", 2)], DOC + ", lang string, source string, n_chars long, d1 string, node int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for rows, n in ((docs, 1), (docs.limit(0), 0)):
        rows.write.mode("overwrite").parquet(f"{sf}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, sf).columns == rows.columns
        got = corpus_pipeline.run(spark, sf)
        assert got.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids", "decoded_sha256"] and got.count() == n


# op5


def test_full_notices_beside_partial_ones(spark):
    rows = [(1, "CC BY, CC BY-NC"), (2, "CC BY CC BY-ND"), (3, "BSD License BSD License"), (4, "CC BY-NC"), (5, "BSD here")]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {1: ("cc-by,cc-by-nc", 1.0), 2: ("cc-by,cc-by-nd", 1.0), 3: ("bsd", 1.0), 4: ("cc-by,cc-by-nc", 1.0), 5: ("", 0.0)}


# filters


def test_rows_that_are_gone_by_a_full_and_a_wide_filter(spark):
    keys = spark.range(0, 600, 3).select(F.xxhash64("id").alias("d1"), "id")
    gone = spark.createDataFrame(keys.toPandas())
    rows = spark.range(600).select(F.xxhash64("id").alias("d1"), "id", F.lit("x").alias("text"))
    for most in (1 << 28, 256):  # the second lets many strangers pass
        with pytest.MonkeyPatch.context() as m:
            m.setattr(common, "LARGEST", most)
            m.setattr(common, "SMALLEST", 64)
            found = common.bit_filter(gone, "d1")
            assert found.count() == 1 and passed_ids(rows, found) >= set(range(0, 600, 3)) and (most > 256) == (len(passed_ids(rows, found)) < 210)
            left = sorted(r["id"] for r in common.without(rows, gone, ["d1", "id"], "d1").collect())
            assert left == [i for i in range(600) if i % 3]
            assert common.without(rows, gone.limit(0), ["d1", "id"], "d1").count() == 600


def passed_ids(rows, found):
    return {r["id"] for r in common.passed(rows, found, "d1").collect()}
