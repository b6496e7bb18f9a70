"""The corpus pipeline: toxicity, language, near-duplicates, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the shared folder and
hands it, read again, to the next. All stages but the last return the columns of documents. Stages decide on whole texts:

* toxicity drops the rows that the trees score 0.5 or more; a null or empty text is not toxic;
* language drops the rows without a letter (`und`), those of which no learned language covers MIN_SHARE, and those in a language that wasn't learned;
* near_duplicates keeps one row of each group of texts linked by a Jaccard similarity of 0.8 or more of their five-word shingles, that with the smallest doc_id;
* decontaminate drops the rows that hold a verified benchmark passage;
* encode returns the kept rows' ids, languages and token ids, and the SHA-256 of the bytes that these decode to.

An empty table passes through all stages; extra columns are kept up to the last one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from epistola.llm import bpe, decontam, langid, simhash, toxicity
from epistola.llm.common import prepared, settle, table

#: Share of a text, by length of words, that its language must have; low, as a text that switches between languages is clean.
MIN_SHARE = 0.3
ORACLE_SQL = None


@prepared
def remove_toxic(spark, docs, sf_dir):
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep(docs, model)


@prepared
def keep_languages(spark, docs, sf_dir):
    return langid.keep(docs, langid.fit(table(spark, sf_dir, "documents")), MIN_SHARE)


@prepared
def drop_near_duplicates(spark, docs, sf_dir):
    return simhash.keep_one(docs)


@prepared
def decontaminate(spark, docs, sf_dir):
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


@prepared
def encode(spark, docs, sf_dir):
    out = bpe.encode_documents(docs, keep=["lang", "source"])
    return out.select("doc_id", "lang", "source", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", remove_toxic),
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("encode", encode),
]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
