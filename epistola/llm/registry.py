"""Queries and SQL of the training-data operators, by the names that __spark_entry__.py registers."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import url_reputation
from .common import crc_mod, prepared, table


def held_out(operator):
    """Whether a row is in an operator's held-out fold; a null id is in none."""
    return F.coalesce(crc_mod(F.col("doc_id"), operator.FOLDS) == operator.HELD_OUT, F.lit(False)).alias("held_out")


def op1_ngram_trie(spark, sf_dir):
    """Scores every text by a trie of all n-grams of the documents outside the held-out fold. Null and empty texts are their end token alone; repeated
    rows count, and are returned, as often as they occur; rows with a null id are learned from."""
    from . import ngram_lm

    return ngram_lm.train_and_score(table(spark, sf_dir, "documents"))


def op2_bottom_k_sketch(spark, sf_dir):
    """Sketches every text, its edited form and the next document's. Null texts are empty; rows of one id follow each other by text; a single row is its own next."""
    from . import sketch

    return sketch.compare(table(spark, sf_dir, "documents"))


def op3_url_reputation(spark, sf_dir):
    """Judges every page's url by the rules, else by its host's reputation. Null and malformed urls have an empty host; repeated pages stay repeated."""
    judged = url_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.withColumns({c: F.round(c, 9) for c in ("reputation", "upper_bound")})


def op4_simhash_gray(spark, sf_dir):
    """Links the fingerprints of all texts at four bits or fewer. Texts without words have fingerprint zero and are linked like others; repeated rows
    stay repeated; a component without any id has a null name."""
    from . import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_license_diagonals(spark, sf_dir):
    """Finds license phrases and notices in every text. Null and empty texts have no words and no labels; repeated rows are counted apart."""
    from . import licenses

    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_toxicity_trees(spark, sf_dir):
    """Scores every text, null and empty ones included; a row with a null id isn't held out; repeated rows stay repeated."""
    from . import toxicity

    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out(toxicity), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_spaced_seeds(spark, sf_dir):
    """Finds benchmark items in every text. Null and empty texts are clean; null, empty and wordless items match nothing; repeated rows stay repeated."""
    from . import decontam

    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_byte_bpe(spark, sf_dir):
    """Encodes and decodes every text. Null and empty texts have no ids, and the digests of no bytes; repeated rows stay repeated."""
    from . import bpe

    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents")))


def op9_language_crf(spark, sf_dir):
    """Predicts every text's language, `und` for null texts and those without a letter; a row with a null id isn't held out; repeated rows stay repeated."""
    from . import langid

    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs)).select("doc_id", held_out(langid), "lang_pred", "score", "n_switches")


def op10_quality_lines(spark, sf_dir):
    """Scores every text, blank ones by the share of label 1; a row with a null id isn't held out; repeated rows stay repeated."""
    from . import quality

    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(quality), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_lines")


QUERIES = {
    f.__name__: prepared(f)
    for f in (
        op1_ngram_trie, op2_bottom_k_sketch, op3_url_reputation, op4_simhash_gray, op5_license_diagonals, op6_toxicity_trees, op7_spaced_seeds, op8_byte_bpe, op9_language_crf,
        op10_quality_lines,
    )
}
SQL: dict[str, str] = {"op3_url_reputation": url_reputation.sql()}
