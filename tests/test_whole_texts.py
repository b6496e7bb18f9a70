"""Queries over whole texts and whole tables, beside plain counts."""

import re

from epistola.functions import phones
from epistola.plans import catalogue

DOC = "doc_id long, text string"



def test_numbers_of_whole_texts_by_brute_force(spark, sf, tmp_path):
    far = "x " * 9000 + "tel 8 (916) 123-45-67"
    rows = [(1, far), (2, "+7 495 111-22-33, 84951112233 and 8-916-000-11-22"), (3, None)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) as long) AS n_chars")
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    for path in (f"file://{tmp_path}", sf):
        texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
        for r in catalogue.phones_extracted(spark, path).collect():
            found = re.findall(phones.NUMBER, texts[r["doc_id"]], re.ASCII)
            digits = [re.sub(r"[^0-9]", "", x)[-10:] for x in found]
            want = list(dict.fromkeys(f"+7 ({d[:3]}) {d[3:6]}-{d[6:8]}-{d[8:]}" for d in digits))  # none of these texts has an extension
            assert (r["n"], r["numbers"]) == (len(want), ",".join(want))


# spine


def test_every_order_has_its_day(spark, sf):
    rows = catalogue.date_spine_left_join(spark, sf).collect()
    assert sum(r["n"] or 0 for r in rows) == spark.read.parquet(f"{sf}/orders.parquet").count() and any(not r["found"] for r in rows)
