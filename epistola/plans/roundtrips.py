"""Queries of records, sources and sinks: what is written is read again, and set beside SQL over the tables that it came from.

Importing this module registers its queries in the catalogue.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..functions import plugins
from ..functions import text as tx
from ..operators import joins, mail, rollups
from ..operators.components import shared_path
from ..sources import config, files, mailbox, office, sinks
from . import bindings as b
from .catalogue import _DAYS, _DBL, Q, _day_stats

# records -----------------------------------------------------------------------------------------------------------------------------

_RAW = """raw AS (SELECT doc_id, source || '@' || lang || '.example.com' AS sender, doc_id % 28 + 1 AS d, lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || ' Jan 2024 20:30:00 +0000' AS date,
  list_transform(range(doc_id % 5 + 1), lambda i: 'to' || i || '_' || doc_id || '@own.example.com') AS tos, 'subject ' || doc_id AS subject, length(text) AS chars, doc_id % 3 AS a FROM documents)"""


@Q(f"""WITH {_RAW} SELECT doc_id, strftime(DATE '2024-01-01' + CAST(d AS INTEGER), '%Y%m%d') || '_' || replace(split_part(sender, '@', 2), '.', '_') || '_' || substr(md5(split_part(sender, '@', 2) || '_' || subject || '_' || substr(date, 1, 10)), 1, 8) AS thread_id,
CASE WHEN doc_id % 2 = 0 THEN '<' || doc_id || '@id>' ELSE 'generated_' || substr(md5(sender || 'Re: ' || subject || date), 1, 8) END AS message_id, sender AS "from", array_to_string(tos[1:3], ', ') || CASE WHEN len(tos) > 3 THEN '...' ELSE '' END AS "to", array_to_string(tos, ',') AS to_emails,
CAST(chars AS BIGINT) AS char_count, strftime(DATE '2024-01-01' + CAST(d AS INTEGER), '%Y-%m-%d') AS date_folder, CAST(a AS BIGINT) AS total, CAST(CASE WHEN a > 0 THEN 1 ELSE 0 END AS BIGINT) AS saved, CAST(CASE WHEN a > 1 THEN 1 ELSE 0 END AS BIGINT) AS excluded FROM raw""")
def mail_records(spark, sf):
    """Mail records from header strings: every second mail lacks an id, every subject is a reply, and the folder is a day later than the date."""
    d = b.table(spark, sf, "documents")
    sender = F.concat("source", F.lit("@"), "lang", F.lit(".example.com"))
    to = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("doc_id") % 5), lambda i: F.concat(F.lit("TO"), i.cast("string"), F.lit("_"), F.col("doc_id").cast("string"), F.lit("@own.example.com"))), ", ")
    attachments = F.slice(F.array(F.struct(F.lit("saved").alias("status"), F.lit(False).alias("is_inline")), F.struct(F.lit("excluded").alias("status"), F.lit(True).alias("is_inline"))), F.lit(1), (F.col("doc_id") % 3).cast("int"))
    number = F.col("doc_id").cast("string")
    raw = d.select(
        F.concat(F.lit("Some One <"), sender, F.lit(">")).alias("from"), to.alias("to"), F.lit(None).cast("string").alias("cc"), F.concat(F.lit("Re: subject "), number).alias("subject"),
        F.concat(F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit(" Jan 2024 20:30:00 +0000")).alias("date"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<"), number, F.lit("@id>"))).alias("message_id"),
        F.col("text").alias("body"), attachments.alias("attachments"), F.col("doc_id").alias("raw_size"),
    )
    r, stats = mail.records(raw), "attachments_stats"
    counts = [F.col(f"{stats}.{c}").cast("long").alias(c) for c in ("total", "saved", "excluded")]
    return r.select(F.col("raw_size").alias("doc_id"), "thread_id", "message_id", "from", "to", F.array_join("to_emails", ",").alias("to_emails"), F.col("char_count").cast("long").alias("char_count"), "date_folder", *counts)


@Q("""WITH p AS (SELECT conv_id, turn, role || turn || '.docx' AS f, CASE turn % 3 WHEN 0 THEN 'excluded' WHEN 1 THEN 'saved' ELSE 'unsupported' END AS status, CASE WHEN turn % 3 = 1 THEN text END AS t, CASE WHEN turn % 4 = 3 THEN 'unreadable' END AS e FROM conversations),
x AS (SELECT conv_id, 'conversation ' || conv_id AS body, string_agg(f || ': ' || status, chr(10) ORDER BY turn) FILTER (status <> 'saved') AS l, string_agg('[' || f || ']' || chr(10) || t, chr(10) ORDER BY turn) FILTER (length(t) > 0) AS r, string_agg(f || ': ' || e, chr(10) ORDER BY turn) FILTER (e IS NOT NULL) AS w FROM p GROUP BY conv_id)
SELECT conv_id, concat_ws(chr(10) || chr(10), '=== BODY ===' || chr(10) || body, '=== LEFT OUT ===' || chr(10) || l, '=== ATTACHMENTS ===' || chr(10) || r, '=== ERRORS ===' || chr(10) || w) AS sections FROM x""")
def sectioned_text(spark, sf):
    part = F.struct("turn", F.concat("role", "turn", F.lit(".docx")).alias("file_name"), F.expr("CASE turn % 3 WHEN 0 THEN 'excluded' WHEN 1 THEN 'saved' ELSE 'unsupported' END").alias("status"), F.expr("CASE WHEN turn % 3 = 1 THEN text END").alias("text"), F.expr("CASE WHEN turn % 4 = 3 THEN 'unreadable' END").alias("error"))
    g = b.table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return g.select("conv_id", mail.sectioned_text(F.concat(F.lit("conversation "), F.col("conv_id").cast("string")), F.col("parts")).alias("sections"))


@Q("""WITH x AS (SELECT o_orderkey, o_orderkey % 5 AS k, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_orderkey, CASE WHEN k = 4 THEN strftime(day, '%Y') || '-x-' || strftime(day, '%d') ELSE strftime(day, '%Y-%m-%d') END AS cached FROM x""")
def cache_dates(spark, sf):
    """The folder, the parsed date, two of the raw forms, and a raw date that can't be read."""
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 5
    iso = F.date_format(day, "yyyy-MM-dd")
    raw = F.when(k == 2, F.date_format(day, "dd.MM.yyyy HH")).when(k == 3, F.date_format(day, "yyyy.MM.dd")).when(k == 4, F.concat(F.date_format(day, "yyyy"), F.lit("/x."), F.date_format(day, "dd")))
    folder, parsed = F.when(k == 0, iso).otherwise(""), F.when(k == 1, F.concat(iso, F.lit("T10:00:00")))
    return b.table(spark, sf, "orders").select("o_orderkey", mail.cache_date(folder, parsed, raw).alias("cached"))


@Q("""SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN 'a/' || p_partkey WHEN p_partkey % 3 = 0 THEN 'r/' || p_partkey ELSE 'attachments/2024-01-01/' || p_partkey || '.pdf' END AS path FROM part WHERE p_partkey % 7 = 0 OR p_partkey % 3 = 0 OR p_partkey % 2 = 0""")
def attachment_paths(spark, sf):
    """The first of an attachment's possible places that there is a file at."""
    n = F.col("p_partkey").cast("string")
    a = b.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.struct(F.concat(F.lit("a/"), n).alias("file_path"), F.concat(F.lit("r/"), n).alias("relative_path"), F.concat(n, F.lit(".pdf")).alias("saved_filename")).alias("a"))
    there = [F.when(F.col("id") % 7 == 0, F.col("a.file_path")), F.when(F.col("id") % 3 == 0, F.col("a.relative_path")), F.when(F.col("id") % 2 == 0, F.concat(F.lit("attachments/2024-01-01/"), "a.saved_filename"))]
    stored = a.select(F.explode(F.array_compact(F.array(*there))).alias("path"))
    return mail.existing_paths(a, "id", mail.possible_paths(F.col("a"), F.lit("2024-01-01")), stored)


@Q("""SELECT c_custkey, c_name AS subject, 'a' || c_custkey || '@x.ru,b@y.ru' AS addresses, 'A' || c_custkey || '@X.ru' AS first FROM customer""")
def header_addresses(spark, sf):
    """Headers with encoded words, and address lists with quoted names and notes."""
    n = F.col("c_custkey").cast("string")
    one = F.concat(F.lit("<A"), n, F.lit("@X.ru>"))
    listed = F.concat(F.lit('"Doe, J. '), n, F.lit('" '), one, F.lit(", b@y.ru (note)"))
    subject = F.concat(F.lit("=?utf-8?B?"), F.base64(F.col("c_name").cast("binary")), F.lit("?="))
    return b.table(spark, sf, "customer").select("c_custkey", plugins.decoded(subject).alias("subject"), F.array_join(plugins.addresses(listed), ",").alias("addresses"), tx.address_of(one).alias("first"))


@Q(f"""WITH {b.CONTACTS} SELECT ord, phone, CAST(5 AS BIGINT) AS position FROM contacts WHERE phone LIKE '8-%' UNION ALL SELECT ord, phone, 5 FROM contacts WHERE phone LIKE '+7%'""")
def phone_rows(spark, sf):
    """The table function for SQL: a row for each phone-like run."""
    plugins.register_tables(spark)
    b.contacts(spark, sf).select("ord", F.concat(F.lit("call "), F.coalesce("phone", F.lit("nobody"))).alias("body")).createOrReplaceTempView("epistola_calls")
    return spark.sql("SELECT ord, p.phone, CAST(p.position AS BIGINT) AS position FROM epistola_calls, LATERAL explode_phones(body) p")


@Q("""SELECT o_orderkey, o_orderkey % 2 = 0 AS found, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey || '/1' ELSE '' END AS number, o_custkey || ' EUR' AS total FROM orders""")
def offer_answers(spark, sf):
    """The default offer extractor over every order's text."""
    text = F.concat(F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Offer No. "), F.col("o_orderkey").cast("string"), F.lit("/1"))).otherwise("Nothing"), F.lit(", total "), F.col("o_custkey").cast("string"), F.lit(" EUR"))
    a = plugins.answer(b.table(spark, sf, "orders").select("o_orderkey", text.alias("t")), "o_orderkey", "t", plugins.extract_offers)
    field = lambda name: F.get_json_object("answer", f"$.{name}")
    return a.select("o_orderkey", field("commercial_offer_found").cast("boolean").alias("found"), field("offer_number").alias("number"), field("total_cost").alias("total"))


# sources -----------------------------------------------------------------------------------------------------------------------------


def _generated(path: str, day: str):
    """As many messages as the day has units, the odd ones in html."""
    for i in range(int(day[-1])):
        kind, body = ("html", f"<p>hello number {i} of {day}</p>") if i % 2 else ("plain", f"hello number {i} of {day}")
        yield f"From: A <a{i}@x.ru>\r\nTo: b@y.ru\r\nSubject: s{i}\r\nContent-Type: text/{kind}\r\n\r\n{body}".encode()


class GeneratedMailbox(mailbox.MailboxSource):
    fetch = staticmethod(_generated)

    @classmethod
    def name(cls):
        return "generated_mailbox"


@Q("""WITH d AS (SELECT strftime(unnest(generate_series(DATE '2024-01-25', DATE '2024-02-07', INTERVAL 1 DAY)), '%Y-%m-%d') AS date_folder), m AS (SELECT date_folder, unnest(range(CAST(right(date_folder, 1) AS BIGINT))) AS i FROM d)
SELECT date_folder, 'A <a' || i || '@x.ru>' AS "from", 's' || i AS subject, 'hello number ' || i || ' of ' || date_folder AS body FROM m""")
def mailbox_range(spark, sf):
    """A range of days through the mailbox source; a reader of this module stands for the mail protocol."""
    b.table(spark, sf, "region")  # sends the package
    spark.dataSource.register(GeneratedMailbox)
    rows = spark.read.format("generated_mailbox").option("path", "").option("first", "2024-01-25").option("last", "2024-02-07").load()
    return rows.select("date_folder", "from", "subject", "body")


@Q("""WITH r AS (SELECT n_regionkey, string_agg(n_name, chr(10) ORDER BY n_nationkey) AS t, string_agg(n_name || ' | ' || CASE WHEN n_nationkey = 0 THEN '' ELSE CAST(n_nationkey AS VARCHAR) END, chr(10) ORDER BY n_nationkey) AS x FROM nation GROUP BY 1)
SELECT n_regionkey || '.docx' AS path, 'docx' AS method, t AS text, true AS success FROM r UNION ALL SELECT n_regionkey || '.xlsx', 'xlsx', x, true FROM r UNION ALL SELECT n_regionkey || '.pdf', 'pdf_plugin', '', false FROM r""")
def office_texts(spark, sf):
    """A document and a sheet for each region, a paragraph or row for each nation, and a file without a reader."""

    def pack(frames):
        for frame in frames:
            out = []
            for region, rows in zip(frame["n_regionkey"], frame["rows"], strict=True):
                paragraphs = "".join(f"<w:p><w:r><w:t>{r['n_name']}</w:t></w:r></w:p>" for r in rows)
                cells = "".join(f'<row><c t="inlineStr"><is><t>{r["n_name"]}</t></is></c><c><v>{r["n_nationkey"]}</v></c></row>' for r in rows)
                inside = {
                    "docx": ("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main">{paragraphs}</w:document>'),
                    "xlsx": ("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{cells}</worksheet>'),
                }
                for kind, (name, text) in inside.items():
                    held = io.BytesIO()
                    with zipfile.ZipFile(held, "w") as z:
                        z.writestr(name, text)
                    out.append((f"{region}.{kind}", held.getvalue()))
                out.append((f"{region}.pdf", b"%PDF"))
            yield pd.DataFrame(out, columns=["path", "content"])

    regions = b.table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("rows"))
    return office.extract(regions.mapInPandas(pack, "path string, content binary")).select("path", "method", "text", "success")


@Q("""SELECT DISTINCT lower(n_name) AS rule FROM nation WHERE n_nationkey % 2 = 0""")
def rule_file(spark, sf):
    """Rules from a text file that also has comments, blank lines and lines of asterisks."""
    path = shared_path(spark, "rules")
    n = b.table(spark, sf, "nation")
    n.select(F.expr("CASE WHEN n_nationkey % 2 = 0 THEN concat(' ', n_name, ' ') WHEN n_nationkey % 3 = 0 THEN concat('# ', n_name) WHEN n_nationkey % 5 = 0 THEN '****' ELSE '' END")).write.text(path)
    return spark.createDataFrame([(r,) for r in files.rules(spark, path)], "rule string")


@Q("""SELECT n_name AS provider, CASE WHEN n_nationkey % 3 = 0 THEN 25 - n_nationkey ELSE 26 END AS priority, n_nationkey % 2 = 0 AS active, n_nationkey % 2 = 0 AND n_nationkey % 5 < CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 3 END AS usable FROM nation""")
def provider_settings(spark, sf):
    """Providers of a settings file with a key for every second one, and which of them have failed too often."""
    n = b.table(spark, sf, "nation")
    path = shared_path(spark, "providers")
    named = F.map_from_entries(F.collect_list(F.when(F.col("n_nationkey") % 3 == 0, F.struct("n_name", F.struct((25 - F.col("n_nationkey")).alias("priority"), F.lit(2).alias("max_failures_before_skip"))))))
    n.coalesce(1).agg(F.to_json(F.struct(F.collect_list("n_name").alias("provider_order"), named.alias("provider_settings")))).write.text(path)
    keys = {r["n_name"]: "key" for r in n.where("n_nationkey % 2 = 0").collect()}  # a few dozen nations
    failures = n.select(F.col("n_name").alias("provider"), (F.col("n_nationkey") % 5).alias("failures"))
    return config.providers(spark, path, keys).join(failures, "provider").select("provider", "priority", "active", config.usable(F.col("failures")).alias("usable"))


# sinks -------------------------------------------------------------------------------------------------------------------------------


def _stored_mails(spark, sf):
    """Every mail, written twice to the store of mails by day, which holds it once."""
    path = shared_path(spark, "mails")
    m = b.mails(spark, sf).select(F.col("doc_id").cast("string").alias("thread_id"), "subject", "body", F.length("body").alias("char_count"), F.date_format("day", "yyyy-MM-dd").alias("date_folder"))
    for _ in range(2):
        sinks.write_mails(m, path)
    return path


@Q(f"""WITH {b.MAILS} SELECT CAST(doc_id AS VARCHAR) AS thread_id, day AS date_folder, md5(body) AS body_md5, CAST(length(body) AS BIGINT) AS char_count FROM mails WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def stored_mails_range(spark, sf):
    rows = files.mails(spark, _stored_mails(spark, sf), "2024-01-05", "2024-01-20", lines=True)
    return rows.select("thread_id", "date_folder", F.md5(F.col("body").cast("binary")).alias("body_md5"), F.col("char_count").cast("long").alias("char_count"))


@Q(f"WITH {b.MAILS} SELECT DISTINCT day AS date_folder FROM mails")
def stored_days(spark, sf):
    return files.days(spark, _stored_mails(spark, sf))


@Q("""SELECT CAST(DATE '2024-01-01' + CAST(p_partkey % 9 AS INTEGER) AS VARCHAR) AS date_folder, p_partkey || '.pdf' AS original_filename, md5(p_name) AS content_md5 FROM part WHERE p_partkey % 4 <> 0""")
def new_attachments_stored(spark, sf):
    """The attachments that a manifest lacks, read from where they were stored."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 9).cast("int")).cast("string")
    a = b.table(spark, sf, "part").select("p_partkey", day.alias("date_folder"), F.concat(F.col("p_partkey").cast("string"), F.lit(".pdf")).alias("original_filename"), F.col("p_name").cast("binary").alias("content"))
    path = shared_path(spark, "attachments")
    sinks.write_new_attachments(a.drop("p_partkey"), a.where("p_partkey % 4 = 0"), path)
    return spark.read.schema("original_filename string, content binary, date_folder string").parquet(path).select("date_folder", "original_filename", F.md5("content").alias("content_md5"))


@Q(f"WITH {_DAYS} SELECT CAST(day AS VARCHAR) AS day, CAST(contacts AS VARCHAR) AS contacts, CAST(errors AS VARCHAR) AS errors, 'now' AS exported_at FROM days")
def csv_and_envelope(spark, sf):
    """A day's figures through the CSV sink, beside the time of export from the JSON sink."""
    d, csv, envelope = _day_stats(spark, sf).select("day", "contacts", "errors"), shared_path(spark, "csv"), shared_path(spark, "envelope")
    sinks.write_csv(d, csv)
    sinks.write_envelope(d, envelope, "now")
    stamped = spark.read.schema("export_info struct<exported_at:string>, data struct<day:string,contacts:long,errors:long>").json(envelope).select("data.day", "export_info.exported_at")
    return spark.read.schema("day string, contacts string, errors string").csv(csv, header=True).join(stamped, "day")


@Q(f"WITH {b.REQUESTS} SELECT count(*) AS total, count(*) FILTER (ok) AS successful FROM requests")
def stats_file(spark, sf):
    path = shared_path(spark, "stats")
    sinks.write_stats(b.requests(spark, sf).agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("successful")), path)
    return spark.read.schema("total long, successful long").json(path)


@Q(f"""WITH {b.ORDERS}, d AS (SELECT CAST(unnest(generate_series(DATE '1994-12-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day), r AS (SELECT day, count(*) AS n FROM mailed GROUP BY day)
SELECT d.day, coalesce(r.n, 0) AS rows, r.n IS NOT NULL AS ok FROM d LEFT JOIN r USING (day)""")
def exported_range(spark, sf):
    return sinks.export_range(joins.date_spine(spark, "1994-12-01", "2001-12-31"), b.orders(spark, sf).select("day", "o_orderkey"), shared_path(spark, "export"))


@Q(f"""SELECT CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS VARCHAR) AS day, count(*) AS files, count(*) FILTER (length(trim(text)) > 0) AS successful, {_DBL(100)} * count(*) FILTER (length(trim(text)) > 0) / count(*) AS pct, avg({_DBL(1)}) FILTER (length(trim(text)) > 0) AS confidence FROM documents GROUP BY 1""")
def extracted_report(spark, sf):
    m = b.mails(spark, sf)
    texts = m.select(F.col("day").cast("string").alias("day"), F.col("doc_id").cast("string").alias("file_name"), F.lit("docx").alias("method"), F.lit(1.0).alias("confidence"), (F.length(F.trim("body")) > 0).alias("success"), F.col("body").alias("text"))
    return sinks.write_extracted(texts, shared_path(spark, "texts"))


@Q("""WITH t AS (SELECT 'nations' AS tab, CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation UNION ALL SELECT 'regions', CAST(r_regionkey AS VARCHAR), r_name FROM region) SELECT * FROM t UNION ALL SELECT * FROM t""")
def tabs_appended(spark, sf):
    """Two tabs, each appended to twice by the sink that works after one that fails."""
    path = shared_path(spark, "tabs")
    tabs = {"nations": b.table(spark, sf, "nation").select("n_nationkey", "n_name"), "regions": b.table(spark, sf, "region").select("r_regionkey", "r_name")}

    def unreachable(rows):
        raise ConnectionError

    for name, rows in [*tabs.items()] * 2:
        sinks.first_that_works(rows, unreachable, lambda r, name=name: sinks.write_tabs({name: r}, path))
    read = lambda name: spark.read.schema("key string, name string").csv(f"{path}/{name}", header=True).select(F.lit(name).alias("tab"), "key", "name")
    return read("nations").unionByName(read("regions"))


@Q("""SELECT '<html><head><title>Regions &amp; nations</title></head><body><table><tr><th>region</th><th>n</th></tr>' || string_agg('<tr><td>' || n_regionkey || '</td><td>' || n || '</td></tr>', '' ORDER BY n_regionkey) || '</table></body></html>' AS report FROM (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1)""")
def region_report(spark, sf):
    counts = rollups.per_day(b.table(spark, sf, "nation").withColumnRenamed("n_regionkey", "region"), "region").orderBy("region")
    return spark.createDataFrame([(sinks.html_report(counts, "Regions & nations"),)], "report string")
