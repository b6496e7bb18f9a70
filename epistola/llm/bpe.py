"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

A long text is cut before encoding wherever a non-space character meets a following space character. No alternative of the
split pattern matches across such a place and none looks back, and the only look-ahead concerns the end of a run of spaces,
which cannot lie there; so the ids of the pieces, joined, are those of the whole text.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, texts

#: Characters of a piece, at least, before the next safe boundary ends it.
PIECE = 1 << 16
_CUT = re.compile(r"(?<=\S)(?=\s)")
_ENCODERS: dict = {}


def default_ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encoder(path: str, pattern: str):
    """One tiktoken encoding per worker process and rank file."""
    if (path, pattern) not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        _ENCODERS[path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path, pattern]


def pieces(text: str, least: int = PIECE):
    """Cuts a text at the first safe boundary after every `least` characters."""
    at = 0
    while len(text) - at > least:
        cut = _CUT.search(text, at + least)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(enc, text: str, least: int = PIECE) -> np.ndarray:
    if len(text) <= least:
        return np.asarray(enc.encode_ordinary(text), "<u4")
    return np.concatenate([np.asarray(enc.encode_ordinary(p), "<u4") for p in pieces(text, least)])


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, token_ids, decoded) for every row: ids as packed little-endian unsigned 32-bit integers, and the bytes they decode to.

    Null and empty texts have no ids; repeated rows stay repeated; other columns are ignored unless named in `keep`, which are carried along.
    The rank file is opened on the executors, so `path` must exist there.
    """
    default = default_ranks()
    path, pattern = path or default[0], pattern or default[1]
    keep = [c for c in keep or [] if c not in ("doc_id", "text", "token_ids", "decoded")]
    rows = texts(docs) if not keep else docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *keep)
    kinds = dict(docs.dtypes)
    schema = ", ".join(["doc_id long", "token_ids binary", "decoded binary", *(f"`{c}` {kinds[c]}" for c in keep)])

    def run(batches):
        enc = encoder(path, pattern)
        for batch in bounded_batches(batches):
            ids = [encode(enc, t) for t in batch.column(1).to_pylist()]
            back = [enc.decode_bytes(x.tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(back, pa.binary()), *batch.columns[2:]],
                names=["doc_id", "token_ids", "decoded", *keep],
            )

    return rows.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
