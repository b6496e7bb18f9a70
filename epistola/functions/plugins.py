"""Extraction plug-ins: a function from a text to a JSON answer, run in batches; the default needs no service."""

from __future__ import annotations

import email.header
import email.utils
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MAIL = re.compile(r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}")
_PHONE = re.compile(r"\+?[0-9][0-9()\-\s]{6,18}[0-9]")


def extract_contacts(text: str) -> str:
    """The default extractor: addresses, and the first number, as an answer in the agreed form."""
    phone = _PHONE.search(text or "")
    found = list(dict.fromkeys(_MAIL.findall(text or "")))
    contacts = [{"name": "", "email": m, "phone": phone.group(0).strip() if phone and not i else "", "organization": m.split("@")[1], "position": "", "city": "", "confidence": 0.5} for i, m in enumerate(found)]
    return json.dumps({"contacts": contacts, "business_context": "", "recommended_actions": ""})


def answer(rows: DataFrame, key: str, text: str, extractor=extract_contacts) -> DataFrame:
    """(key, answer) by any extractor; an extractor that fails leaves a null answer, not a failed job."""

    def run(frames):
        for frame in frames:
            out = []
            for t in frame["t"]:
                try:
                    out.append(extractor(t))
                except Exception:
                    out.append(None)
            yield pd.DataFrame({"k": frame["k"], "answer": out})

    kind = dict(rows.dtypes)[key]
    return rows.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, answer string").withColumnRenamed("k", key)


def _decode(value):
    if value is None or "=?" not in value:
        return value
    try:
        return str(email.header.make_header(email.header.decode_header(value)))
    except (LookupError, ValueError):
        return value


def _decode_series(s: pd.Series) -> pd.Series:
    return s.map(_decode)


def decoded(c: Column) -> Column:
    """A header with its encoded words decoded; only headers that have some reach Python."""
    decode = F.pandas_udf(_decode_series, "string")
    return F.when(c.contains("=?"), decode(F.when(c.contains("=?"), c))).otherwise(c)


def _address_lists(s: pd.Series) -> pd.Series:
    return s.map(lambda v: [a.strip().lower() for _, a in email.utils.getaddresses([v or ""]) if a.strip()])


def addresses(c: Column) -> Column:
    """The addresses of an RFC 2822 list, quoted names and comments understood; lower-case, empty ones left out."""
    return F.pandas_udf(_address_lists, "array<string>")(c)


def register_tables(spark) -> None:
    """Registers the table function explode_phones(text) for SQL: a row for each phone-like run of a text."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="phone string, position int")
    class ExplodePhones:
        def eval(self, text: str):
            for m in _PHONE.finditer(text or ""):
                yield m.group(0), m.start()

    spark.udtf.register("explode_phones", ExplodePhones)


def extract_offers(text: str) -> str:
    """The default offer extractor: the word for an offer with a number, and a total with its currency."""
    number = re.search(r"(?i)(?:offer|quotation|предложение)\s*(?:no\.?|№)?\s*([0-9][0-9/-]*)", text or "")
    total = re.search(r"([0-9][0-9 ]*[.,]?[0-9]*)\s*(RUB|EUR|USD)", text or "")
    return json.dumps({"commercial_offer_found": bool(number), "offer_number": number.group(1) if number else "", "total_cost": total.group(0) if total else "", "currency": total.group(2) if total else ""})
