"""Named queries over the driver's tables, each beside the SQL that gives the same rows.

Q(name, sql) registers a query; sql is None where SQL can't say it, and the tests compare with another way then.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import phones, plugins
from ..functions import text as tx
from ..operators import contacts as ct
from ..operators import filters as fl
from ..operators import joins, mail, rollups, scoring, state
from ..operators.components import shared_path
from . import bindings as b

QUERIES: dict = {}
SQL: dict[str, str] = {}
EMAIL = tx.EMAIL


def Q(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# texts -------------------------------------------------------------------------------------------------------------------------------


@Q(f"""WITH {b.MAILS}, found AS (SELECT lower(trim(unnest(regexp_extract_all(body, '({EMAIL})', 1)))) AS a FROM mails WHERE NOT contains(lower(subject), 'unsubscribe'))
SELECT lower(split_part(regexp_extract(a, '@([^@]*)$', 1), '>', 1)) AS domain, count(*) AS n FROM found GROUP BY 1 ORDER BY n DESC, domain LIMIT 10""")
def email_domain_topk(spark, sf):
    rows = b.mails(spark, sf).where(fl.subject_rule(F.col("subject"), ["unsubscribe"]).isNull())
    found = rows.select(F.explode(tx.recipients(F.col("body"))).alias("a")).select(tx.normalize_email(F.col("a")).alias("a"))
    return rollups.top(rollups.domain_counts(found, "a"), 10, F.desc("n"), "domain")


@Q(f"""SELECT doc_id, CAST(len(regexp_extract_all(text, '({EMAIL})', 1)) AS BIGINT) AS n, array_to_string(regexp_extract_all(text, '({EMAIL})', 1), ',') AS addresses,
array_to_string(list_slice(regexp_extract_all(text, '({EMAIL})', 1), 1, 3), ', ') || CASE WHEN len(regexp_extract_all(text, '({EMAIL})', 1)) > 3 THEN '...' ELSE '' END AS preview FROM documents""")
def recipients_extract(spark, sf):
    a = tx.recipients(F.col("text"))
    return b.table(spark, sf, "documents").select("doc_id", F.size(a).cast("long").alias("n"), F.array_join(a, ",").alias("addresses"), tx.recipient_preview(a).alias("preview"))


@Q("SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&[a-z]+;', ' ', 'g') AS plain FROM pages")
def html_strip(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", tx.strip_html(F.col("html")).alias("plain"))


@Q(f"""WITH {b.MAILS}, p AS (SELECT doc_id, day, subject, regexp_extract(sender, '@([^>\\s]+)', 1) AS d, 'Mon, ' || strftime(day, '%d %b') AS raw FROM mails)
SELECT doc_id, strftime(day, '%Y%m%d') || '_' || replace(d, '.', '_') || '_' || substr(md5(d || '_' || regexp_replace(subject, '^(?i)(Re|Fwd|Fw):\\s*', '') || '_' || substr(raw, 1, 10)), 1, 8) AS thread_id,
'generated_' || substr(md5('x@' || d || subject || raw), 1, 8) AS message_id FROM p""")
def thread_key(spark, sf):
    m = b.mails(spark, sf).withColumn("raw", F.concat(F.lit("Mon, "), F.date_format("day", "dd MMM")))
    d = F.regexp_extract("sender", r"@([^>\s]+)", 1)
    return m.select("doc_id", tx.thread_id(F.col("sender"), F.col("subject"), F.col("raw"), F.col("day")).alias("thread_id"), tx.generated_message_id(F.concat(F.lit("x@"), d), F.col("subject"), F.col("raw")).alias("message_id"))


@Q(r"SELECT doc_id, regexp_replace(text, '[^\p{L}\p{M}\p{Nd}\p{Pc}\s\-\.]', '_', 'g') AS name FROM documents")
def safe_filename(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", tx.safe_filename(F.col("text")).alias("name"))


@Q(f"""WITH {b.MAILS} SELECT count(*) AS mails, CAST(sum(length(body)) AS BIGINT) AS chars, CAST(floor(sum(length(body)) / 3.0) AS BIGINT) AS tokens,
CAST(count(*) FILTER (length(body) > 12000) AS BIGINT) AS long_mails FROM mails""")
def token_estimate(spark, sf):
    return rollups.corpus_totals(b.mails(spark, sf))


_CHUNKS = f"""WITH {b.MAILS}, c AS (SELECT doc_id, body, length(body) AS len, CASE WHEN length(body) > 12000 THEN CAST(ceil((length(body) - 1000) / 9000.0) AS BIGINT) ELSE 1 END AS total FROM mails),
r AS (SELECT doc_id, body, len, total, unnest(range(total)) AS i FROM c),
x AS (SELECT doc_id, i + 1 AS n, total, i * 9000 AS start, CASE WHEN total > 1 THEN least(i * 9000 + 10000, len) ELSE len END AS stop, body FROM r)"""


@Q(f"{_CHUNKS} SELECT doc_id, n, total, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM x")
def chunk_plan(spark, sf):
    return mail.chunks(b.mails(spark, sf), "doc_id", "body").drop("text")


@Q(f"""{_CHUNKS} SELECT doc_id, n, total, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop,
(CASE WHEN total > 1 THEN '[PART ' || n || ', CHARACTERS ' || start || '-' || stop || ']' || chr(10) ELSE '' END) || substr(body, start + 1, stop - start) AS text FROM x""")
def chunk_text(spark, sf):
    return mail.chunks(b.mails(spark, sf), "doc_id", "body")


@Q(f"""{_CHUNKS} SELECT doc_id, string_agg('Part ' || n || ': ' || (stop - start), ' | ' ORDER BY n) AS context, CAST(sum(n) AS BIGINT) AS contacts FROM x GROUP BY doc_id""")
def chunk_merge(spark, sf):
    parts = mail.chunks(b.mails(spark, sf), "doc_id", "body").select("doc_id", "n", (F.col("stop") - F.col("start")).cast("string").alias("context"), F.col("n").alias("contacts"))
    return mail.merge_chunk_contexts(parts, "doc_id")


@Q("""SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1""")
def json_props(spark, sf):
    return b.table(spark, sf, "events").select(F.from_json("props", "k bigint")["k"].alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@Q("""SELECT event_id, json_extract_string(regexp_extract('Sure: ' || props || ' done', '(?s)(\\{.*\\})', 1), '$.k') AS k FROM events""")
def json_from_text(spark, sf):
    answer = F.concat(F.lit("<think>{a}</think>Sure: "), "props", F.lit(" done"))
    return b.table(spark, sf, "events").select("event_id", F.get_json_object(tx.clean_answer(answer), "$.k").alias("k"))


@Q(r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '[.!?]+([.!?])', '\1', 'g')) AS clean FROM documents")
def ocr_cleanup(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", tx.clean_ocr(F.col("text")).alias("clean"))


_QUALITY = r"""quality AS (SELECT doc_id, lang AS file_type, CASE doc_id % 3 WHEN 0 THEN 'ocr' WHEN 1 THEN 'description' ELSE 'direct' END AS method, text, length(trim(text)) AS len,
  regexp_matches(text, '\+7[0-9]{10}|[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}|[0-9]+[.,][0-9]+|[А-Я][а-я]+ [А-Я][а-я]+') AS useful FROM documents),
scored AS (SELECT *, CAST(1.0 AS DOUBLE) - CASE WHEN len < 50 THEN CAST(0.3 AS DOUBLE) ELSE 0 END - CASE method WHEN 'ocr' THEN CAST(0.5 AS DOUBLE) WHEN 'description' THEN CAST(0.4 AS DOUBLE) ELSE 0 END + CASE WHEN useful THEN CAST(0.2 AS DOUBLE) ELSE 0 END AS s FROM quality)"""


def _quality(spark, sf):
    d = b.table(spark, sf, "documents").withColumn("method", F.expr("CASE doc_id % 3 WHEN 0 THEN 'ocr' WHEN 1 THEN 'description' ELSE 'direct' END"))
    return d.select("doc_id", F.col("lang").alias("file_type"), "method", scoring.text_quality(F.col("text"), F.col("method")).alias("q"))


@Q(f"""WITH {_QUALITY} SELECT doc_id, method, round(s, 2) AS score, CASE WHEN s >= CAST(0.8 AS DOUBLE) THEN 'excellent' WHEN s >= CAST(0.6 AS DOUBLE) THEN 'good' WHEN s >= CAST(0.4 AS DOUBLE) THEN 'fair' WHEN s >= CAST(0.2 AS DOUBLE) THEN 'poor' ELSE 'failed' END AS level,
CAST(len AS BIGINT) AS length, useful FROM scored""")
def text_quality(spark, sf):
    return _quality(spark, sf).select("doc_id", "method", "q.score", "q.level", F.col("q.length").cast("long").alias("length"), "q.useful")


@Q(f"""WITH {_QUALITY}, r AS (SELECT file_type, method, s >= CAST(0.6 AS DOUBLE) AS ok FROM scored)
SELECT file_type, method, count(*) AS total, count(*) FILTER (ok) AS successful, CAST(count(*) FILTER (ok) AS DOUBLE) * CAST(100.0 AS DOUBLE) / count(*) AS pct FROM r GROUP BY GROUPING SETS ((file_type), (method), ())""")
def quality_by_type_method(spark, sf):
    return rollups.quality_by_type_and_method(_quality(spark, sf).select("file_type", "method", F.col("q.level").isin("excellent", "good").alias("ok")))


@Q(r"""WITH p AS (SELECT event_id, ts, strftime(ts, '%d %b %Y %H:%M:%S') AS raw FROM events)
SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS at, strftime(date_trunc('second', ts) + INTERVAL 7 HOUR, '%Y.%m.%d %H:%M') AS logged, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d') AS date_folder FROM p""")
def mail_dates(spark, sf):
    e = b.table(spark, sf, "events").select("event_id", F.concat(F.lit("Mon, "), F.date_format("ts", "d MMM yyyy HH:mm:ss"), F.lit(" +0000")).alias("raw"))
    at = tx.parse_mail_date(F.col("raw"))
    return e.select("event_id", at.cast("timestamp_ntz").alias("at"), tx.log_date(at).alias("logged"), tx.date_folder(at).alias("date_folder"))


@Q(r"""SELECT p_partkey, round_even(p_retailprice * 1000 / 1048576.0, 2) AS mb, CASE WHEN length(p_type) > 12 THEN substr(p_type, 1, 12) || '...' ELSE p_type END AS short FROM part""")
def sizes_and_previews(spark, sf):
    return b.table(spark, sf, "part").select("p_partkey", tx.size_mb(F.col("p_retailprice") * 1000).alias("mb"), tx.preview(F.col("p_type"), 12).alias("short"))


@Q(f"""WITH {b.CONTACTS}, p AS (SELECT ord, CASE WHEN ord % 2 = 0 THEN '+7 (495) ' ELSE '+7 (916) ' END || lpad(CAST(ord % 1000 AS VARCHAR), 3, '0') AS head, CAST(ord % 1000 AS VARCHAR) AS ext FROM contacts)
SELECT ord, head || '-12-34' || CASE WHEN ord % 2 = 0 THEN ' (доб. ' || ext || '),' || head || '-12-07 (доб. ' || ext || ')' ELSE '' END AS found, ord % 2 = 1 AS mobile, 'доб. ' || ext AS extension,
'+7 (382) 22' || (ord % 10) || '-43-63,+7 (382) 22' || (ord % 10) || '-43-65' AS pair FROM p""")
def phone_grammar(spark, sf):
    """Numbers with an extension and a variant of the last pair, which only landline numbers keep, and pairs with a comma."""
    c = b.contacts(spark, sf).select("ord", F.concat(F.expr("CASE WHEN ord % 2 = 0 THEN '+7 (495) ' ELSE '+7 (916) ' END"), F.lpad((F.col("ord") % 1000).cast("string"), 3, "0"), F.lit("-12-34 (7)")).alias("raw"))
    text = F.concat(F.lit("tel "), "raw", F.lit(" доб. "), (F.col("ord") % 1000).cast("string"))
    pair = F.concat(F.lit("+7(38222) "), (F.col("ord") % 10).cast("string"), F.lit("-43-63, "), (F.col("ord") % 10).cast("string"), F.lit("-43-65"))
    c = c.select("ord", phones.extract_phones(text).alias("found"), text.alias("text"), pair.alias("pair"))
    return c.select("ord", F.array_join("found", ",").alias("found"), phones.is_mobile(F.get("found", F.lit(0))).alias("mobile"), F.array_join(phones.extensions(F.col("text")), ",").alias("extension"), F.array_join(phones.comma_pairs(F.col("pair")), ",").alias("pair"))


@Q()
def phones_extracted(spark, sf):
    found = phones.extract_phones(F.col("body"))
    return b.mails(spark, sf).select("doc_id", F.size(found).cast("long").alias("n"), F.array_join(found, ",").alias("numbers"))


@Q(f"""WITH {b.CONTACTS}, f AS (SELECT ord, ord % 20 AS day, '+7 (495) ' || right(phone, 9) AS p FROM contacts), d AS (SELECT day, count(*) AS mails, count(p) AS mails_with, count(DISTINCT p) AS phones FROM f GROUP BY day)
SELECT *, (SELECT count(DISTINCT p) FROM f) AS all_phones FROM d""")
def phone_counts(spark, sf):
    c = b.contacts(spark, sf).select("ord", (F.col("ord") % 20).alias("day"), F.concat(F.lit("call "), F.coalesce("phone", F.lit("nobody")), F.lit(" before noon")).alias("body"))
    return phones.counts_by_day(c, "day", "ord", "body")


# filters -----------------------------------------------------------------------------------------------------------------------------

_SUBJECT = "CASE WHEN contains(lower(subject), 'der ') THEN 'der ' WHEN contains(lower(subject), 'licensed') THEN 'licensed' WHEN contains(lower(subject), 'the ') THEN 'the ' END"
_SENDER = "CASE WHEN ends_with(lower(trim(sender)), '@fr.example.com') THEN '*@fr.example.com' WHEN starts_with(lower(trim(sender)), 'src1@') THEN 'src1@*' WHEN lower(trim(sender)) = 'src2@de.example.com' THEN 'src2@de.example.com' END"


@Q(f"WITH {b.MAILS} SELECT doc_id, {_SUBJECT} AS rule FROM mails")
def subject_filter(spark, sf):
    return b.mails(spark, sf).select("doc_id", fl.subject_rule(F.col("subject"), b.SUBJECT_RULES).alias("rule"))


@Q(f"WITH {b.MAILS} SELECT doc_id, sender, {_SENDER} AS rule FROM mails")
def sender_blacklist(spark, sf):
    return b.mails(spark, sf).select("doc_id", "sender", fl.blacklist_rule(F.col("sender"), b.SENDER_RULES).alias("rule"))


@Q(f"""WITH {b.MAILS}, r AS (SELECT CASE WHEN doc_id % 19 = 0 THEN 'already_saved' WHEN {_SUBJECT} IS NOT NULL THEN 'subject' WHEN {_SENDER} IS NOT NULL THEN 'blacklist' WHEN doc_id % 13 = 0 AND sender LIKE 'src3@%' THEN 'internal_mass' WHEN n_chars * 10000 > 100000000 THEN 'too_large' END AS reason FROM mails)
SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM r GROUP BY 1""")
def filter_reason_counts(spark, sf):
    m = b.mails(spark, sf)
    mass = (F.col("doc_id") % 13 == 0) & F.col("sender").startswith("src3@")
    reason = fl.filter_reason(F.col("doc_id") % 19 == 0, fl.subject_rule(F.col("subject"), b.SUBJECT_RULES), fl.blacklist_rule(F.col("sender"), b.SENDER_RULES), mass, F.col("n_chars") * 10000)
    return rollups.reason_counts(m.select(reason.alias("reason")))


@Q("""WITH t AS (SELECT conv_id, list(role || turn || CASE WHEN turn % 2 = 0 THEN '@own.example.com' ELSE '@example.org' END ORDER BY turn) AS to_emails FROM conversations GROUP BY conv_id)
SELECT conv_id, conv_id % 2 = 0 AND 3 * len(list_filter(to_emails, lambda a: contains(lower(a), '@own.example.com'))) >= 10 AS mass FROM t""")
def mass_mailing(spark, sf):
    c = b.table(spark, sf, "conversations")
    address = F.concat("role", "turn", F.expr("CASE WHEN turn % 2 = 0 THEN '@own.example.com' ELSE '@example.org' END"))
    t = c.groupBy("conv_id").agg(F.collect_list(address).alias("a"))
    sender = F.expr("CASE WHEN conv_id % 2 = 0 THEN 'Boss <boss@OWN.example.com>' ELSE 'x@example.org' END")
    return t.select("conv_id", fl.is_mass_mailing(sender, F.concat("a", "a"), F.col("a"), "own.example.com").alias("mass"))


_RULED = "(regexp_matches(lower(name), '^draft-.*$') OR regexp_matches(lower(name), '^scan 00[1-5]\\..*$') OR lower(name) = 'report 007.docx')"
_EXT = "lower(regexp_extract(name, '(\\.[^.]*)$', 1))"
_IMG = f"(inline OR {_EXT} IN ('.png', '.jpg', '.jpeg', '.gif', '.bmp', '.tiff', '.webp'))"
_STATUS = f"""statuses AS (SELECT id, mail_id, name, size, inline, CASE
  WHEN name IN ('image001.png', 'image002.png') THEN 'excluded_by_name'
  WHEN regexp_replace(name, '^[~.]', '') IN ('image001.png', 'image002.png') THEN 'excluded_by_base_name'
  WHEN {_RULED} THEN 'excluded_by_filter'
  WHEN {_IMG} AND ((starts_with(lower(name), 'image') AND size < 50000) OR (starts_with(lower(name), 'logo') AND size < 30000) OR (starts_with(lower(name), 'signature') AND size < 30000) OR (starts_with(lower(name), 'icon') AND size < 20000) OR size = 83509 OR coalesce(shape, '') = '416x250') THEN 'excluded_by_size'
  WHEN {_EXT} IN ('.zip', '.gif') THEN 'excluded' WHEN {_EXT} NOT IN ('.pdf', '.docx', '.xlsx', '.jpg', '.png') THEN 'unsupported' WHEN known THEN 'already_exists' ELSE 'saved' END AS status FROM attachments)"""


def _statuses(spark, sf):
    a = b.attachments(spark, sf)
    return a.withColumn("status", fl.attachment_status(F.col("name"), F.col("size"), F.col("inline"), F.col("shape"), F.col("known"), b.NAME_RULES))


@Q(f"WITH {b.ATTACHMENTS} SELECT id, name, {_RULED} AS excluded FROM attachments")
def filename_rules(spark, sf):
    return b.attachments(spark, sf).select("id", "name", fl.name_excluded(F.col("name"), b.NAME_RULES).alias("excluded"))


@Q(f"WITH {b.ATTACHMENTS}, {_STATUS} SELECT id, name, status FROM statuses")
def attachment_status(spark, sf):
    return _statuses(spark, sf).select("id", "name", "status")


@Q(f"""WITH {b.ATTACHMENTS}, {_STATUS} SELECT mail_id, count(*) AS total, count(*) FILTER (status = 'saved') AS saved, count(*) FILTER (status IN ('excluded_by_name', 'excluded_by_base_name', 'excluded_by_filter')) AS excluded_filenames,
count(*) FILTER (status = 'excluded_by_size') AS excluded_by_size, count(*) FILTER (status = 'excluded') AS excluded, count(*) FILTER (status = 'unsupported') AS unsupported, count(*) FILTER (inline) AS inline_images FROM statuses GROUP BY mail_id""")
def attachment_stats(spark, sf):
    return mail.stats_by_mail(_statuses(spark, sf), "mail_id")


@Q(f"""WITH {b.ATTACHMENTS}, {_STATUS} SELECT mail_id, count(*) FILTER (status = 'saved') AS saved, count(*) FILTER (status = 'already_exists') AS already_exists, count(*) FILTER (status = 'unsupported') AS unsupported FROM statuses GROUP BY mail_id""")
def status_pivot(spark, sf):
    p = mail.status_counts(_statuses(spark, sf), "mail_id")
    return p.select("mail_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("saved", "already_exists", "unsupported")])


@Q(f"""WITH {b.ATTACHMENTS}, {_STATUS} SELECT count(*) AS total, count(*) FILTER (status = 'saved') AS saved, count(*) FILTER (status IN ('excluded_by_name', 'excluded_by_base_name', 'excluded_by_filter')) AS excluded_filenames,
count(*) FILTER (status = 'excluded_by_size') AS excluded_by_size, count(*) FILTER (status = 'excluded') AS excluded, count(*) FILTER (status = 'unsupported') AS unsupported, CAST(100.0 AS DOUBLE) * count(*) FILTER (status = 'saved') / count(*) AS saved_pct FROM statuses""")
def fetch_counters(spark, sf):
    return rollups.fetch_counters(_statuses(spark, sf))


@Q(f"""WITH {b.MAILS}, {b.ATTACHMENTS}, {_STATUS}, r AS (SELECT CASE WHEN doc_id % 19 = 0 THEN 'already_saved' WHEN {_SUBJECT} IS NOT NULL THEN 'subject' WHEN {_SENDER} IS NOT NULL THEN 'blacklist' WHEN doc_id % 13 = 0 THEN 'internal_mass' WHEN n_chars > 10000 THEN 'too_large' END AS reason,
  doc_id % 17 = 0 AS failed, CASE doc_id % 23 WHEN 0 THEN 'successful' WHEN 1 THEN 'failed' END AS retry FROM mails),
m AS (SELECT count(*) AS processed, count(*) FILTER (reason IS NULL AND NOT failed) AS saved, count(*) FILTER (reason = 'already_saved') AS already_exists, count(*) FILTER (reason = 'subject') AS filtered_subject, count(*) FILTER (reason = 'blacklist') AS filtered_blacklist,
  count(*) FILTER (reason = 'internal_mass') AS filtered_mass_mailing, count(*) FILTER (reason = 'too_large') AS skipped_large_emails, count(*) FILTER (failed) AS errors, count(*) FILTER (retry = 'successful') AS retry_successful, count(*) FILTER (retry = 'failed') AS retry_failed,
  count(*) FILTER (reason = 'too_large') AS total_skipped FROM r),
x AS (SELECT s.*, coalesce(a.shape = '416x250', false) AS by_shape FROM statuses s JOIN attachments a USING (id)),
f AS (SELECT count(*) FILTER (status = 'saved' AND NOT inline) AS saved_attachments, count(*) FILTER (status = 'saved' AND inline) AS saved_inline_images, count(*) FILTER (status = 'excluded') AS excluded_attachments, count(*) FILTER (status IN ('excluded_by_name', 'excluded_by_base_name', 'excluded_by_filter')) AS excluded_filenames,
  count(*) FILTER (status = 'excluded_by_size' AND NOT by_shape) AS excluded_by_size, count(*) FILTER (status = 'excluded_by_size' AND by_shape) AS excluded_by_image_dimensions, count(*) FILTER (status = 'unsupported') AS unsupported_attachments FROM x)
SELECT *, filtered_subject + filtered_blacklist + filtered_mass_mailing AS total_filtered, CAST(100.0 AS DOUBLE) * (saved_attachments + saved_inline_images) / (saved_attachments + saved_inline_images + excluded_attachments + excluded_filenames + excluded_by_size + excluded_by_image_dimensions + unsupported_attachments) AS efficiency_pct,
CAST(100.0 AS DOUBLE) * saved / processed AS save_pct FROM m, f""")
def fetch_totals(spark, sf):
    m = b.mails(spark, sf)
    by_rule = fl.subject_rule(F.col("subject"), b.SUBJECT_RULES), fl.blacklist_rule(F.col("sender"), b.SENDER_RULES)
    reason = fl.filter_reason(F.col("doc_id") % 19 == 0, *by_rule, F.col("doc_id") % 13 == 0, F.col("n_chars") * 10000)
    m = m.select(reason.alias("reason"), (F.col("doc_id") % 17 == 0).alias("failed"), F.expr("CASE doc_id % 23 WHEN 0 THEN 'successful' WHEN 1 THEN 'failed' END").alias("retry"))
    return rollups.fetch_totals(m, _statuses(spark, sf).withColumn("by_shape", F.col("shape") == fl.BANNER_SHAPE))


@Q(f"""WITH {b.MAILS}, {b.ATTACHMENTS}, {_STATUS}, t AS (SELECT count(*) AS mails, CAST(sum(length(body)) AS BIGINT) AS chars, CAST(floor(sum(length(body)) / 3.0) AS BIGINT) AS tokens, count(*) FILTER (length(body) > 12000) AS long_mails FROM mails)
SELECT t.*, (SELECT count(DISTINCT mail_id) FROM statuses WHERE status = 'saved' AND id % 2 = 0) AS mails_with_attachments, (SELECT count(*) FROM statuses WHERE status = 'saved') AS saved_attachments FROM t""")
def corpus_totals(spark, sf):
    a = _statuses(spark, sf).withColumn("file_path", F.when(F.col("id") % 2 == 0, F.col("name")))
    return rollups.corpus_totals(b.mails(spark, sf), a)


@Q(f"""WITH {b.ATTACHMENTS}, {_STATUS} SELECT mail_id, bool_or(status = 'saved' AND id % 2 = 0) AS kept FROM statuses GROUP BY mail_id""")
def mails_with_saved(spark, sf):
    a = _statuses(spark, sf).withColumn("file_path", F.when(F.col("id") % 2 == 0, F.col("name")))
    return a.groupBy("mail_id").agg(F.bool_or(fl.has_saved_attachment(F.array(F.struct("status", "file_path")))).alias("kept"))


@Q(f"""WITH {b.ATTACHMENTS}, s AS (SELECT id, CASE WHEN id % 4 = 0 THEN -1 ELSE size * 2000 END AS size, lower(name) || CASE id % 3 WHEN 0 THEN ' ATTACHMENT ' || (size * 1000) WHEN 1 THEN ' application/zip' ELSE '' END AS st FROM attachments)
SELECT id, (size = -1 OR size >= 50000000) AND (contains(lower(st), 'attachment') OR contains(lower(st), 'application')) AND (contains(lower(st), 'application/zip') OR len(list_filter(regexp_extract_all(lower(st), '\\d+'), lambda n: CAST(n AS BIGINT) BETWEEN 20000001 AND 200000000)) > 0) AS text_only FROM s""")
def text_only_gate(spark, sf):
    a = b.attachments(spark, sf).selectExpr("id", "CASE WHEN id % 4 = 0 THEN -1 ELSE size * 2000 END AS size", "concat(lower(name), CASE id % 3 WHEN 0 THEN concat(' ATTACHMENT ', size * 1000) WHEN 1 THEN ' application/zip' ELSE '' END) AS st")
    return a.select("id", fl.needs_text_only(F.col("size"), F.col("st")).alias("text_only"))


# contacts ----------------------------------------------------------------------------------------------------------------------------

_E, _P = "lower(trim(coalesce(email, '')))", "regexp_replace(coalesce(phone, ''), '[^0-9+]', '', 'g')"
_PHONE_SQL = f"CASE WHEN starts_with({_P}, '8') AND length({_P}) = 11 THEN '+7' || substr({_P}, 2) ELSE {_P} END"
_D = "regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g')"
_STRICT = f"CASE WHEN length({_D}) = 11 AND starts_with({_D}, '8') THEN '7' || substr({_D}, 2) WHEN length({_D}) = 10 THEN '7' || {_D} ELSE {_D} END"
_N, _O = (f"trim(regexp_replace(lower(coalesce({c}, '')), '\\s+', ' ', 'g'))" for c in ("name", "organization"))


@Q(f"""WITH {b.CONTACTS} SELECT ord, coalesce(name, '') AS name, CASE WHEN regexp_matches(trim(email), '^{EMAIL}$') THEN trim(email) ELSE '' END AS email,
CASE WHEN regexp_matches({_P}, '^\\+?[0-9]{{7,15}}$') THEN trim(phone) ELSE '' END AS phone, coalesce(conf, CAST(0 AS DOUBLE)) AS confidence FROM contacts
WHERE trim(coalesce(name, '')) <> '' OR trim(coalesce(email, '')) <> '' OR trim(coalesce(phone, '')) <> ''""")
def contact_validate(spark, sf):
    return ct.validate(b.contacts(spark, sf)).select("ord", "name", "email", "phone", "confidence")


@Q(f"WITH {b.CONTACTS} SELECT ord, {_PHONE_SQL} AS live, {_STRICT} AS strict, {_E} AS email, CASE WHEN length(regexp_replace(coalesce(phone, ''), '[\\s\\-()+]', '', 'g')) > 6 THEN regexp_replace(phone, '[\\s\\-()+]', '', 'g') END AS chunk_key, {_N} AS name FROM contacts")
def phone_normalise(spark, sf):
    return b.contacts(spark, sf).select("ord", tx.normalize_phone(F.col("phone")).alias("live"), tx.normalize_phone_strict(F.col("phone")).alias("strict"), tx.normalize_email(F.col("email")).alias("email"), tx.phone_key(F.col("phone")).alias("chunk_key"), tx.normalize_name(F.col("name")).alias("name"))


@Q(f"WITH {b.CONTACTS} SELECT ord, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), bal / CAST(5000.0 AS DOUBLE))) AS confidence FROM contacts")
def confidence_clamp(spark, sf):
    return b.contacts(spark, sf).select("ord", scoring.confidence(F.col("bal") / 5000.0).alias("confidence"))


_KEYED = f"""keyed AS (SELECT *, CASE WHEN {_E} <> '' THEN 'e:' || {_E} WHEN {_PHONE_SQL} <> '' THEN 'p:' || ({_PHONE_SQL}) WHEN {_N} <> '' AND {_O} <> '' THEN 'n:' || {_N} || '|' || {_O} ELSE 'r:' || ord END AS key FROM contacts)"""


@Q(f"WITH {b.CONTACTS}, {_KEYED} SELECT key, count(*) AS n, min(ord) AS ord FROM keyed GROUP BY key")
def contacts_tiered_dedup(spark, sf):
    c = b.contacts(spark, sf)
    return c.withColumn("key", ct.tier_key(F.col("email"), F.col("phone"), F.col("name"), F.col("organization"), F.col("ord"))).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("ord"))


_LONGEST = ", ".join(f"arg_max(coalesce({c}, '\x01'), (length(coalesce({c}, '')), -ord)) AS {c}" for c in ("name", "organization", "position", "city"))


@Q(f"""WITH {b.CONTACTS}, {_KEYED}, num AS (SELECT key, phone, min(ord) AS first_at FROM keyed WHERE phone <> '' GROUP BY key, phone), nums AS (SELECT key, list(phone ORDER BY first_at) AS ps FROM num GROUP BY key),
m AS (SELECT key, {_LONGEST}, arg_min(email, ord) FILTER (email <> '') AS email, max(coalesce(conf, CAST(0 AS DOUBLE))) AS confidence, min(ord) AS ord, count(*) AS n FROM keyed GROUP BY key)
SELECT m.key, nullif(name, '\x01') AS name, organization, position, city, email, confidence, ord, n, ps[1] AS phone, array_to_string(ps[2:], ',') AS other_phones FROM m LEFT JOIN nums USING (key)""")
def contacts_merge(spark, sf):
    return ct.tiered(b.contacts(spark, sf).withColumn("confidence", scoring.confidence(F.col("confidence"))))


@Q(f"""WITH RECURSIVE {b.CONTACTS}, g AS (SELECT ord, ord % 60 AS doc, nullif({_E}, '') AS e, CASE WHEN length(regexp_replace(coalesce(phone, ''), '[\\s\\-()+]', '', 'g')) > 6 THEN regexp_replace(phone, '[\\s\\-()+]', '', 'g') END AS p, row_number() OVER (PARTITION BY ord % 60 ORDER BY ord) AS rn FROM contacts),
f AS (SELECT DISTINCT doc, CAST(0 AS BIGINT) AS rn, CAST([] AS VARCHAR[]) AS es, CAST([] AS VARCHAR[]) AS ps, CAST(NULL AS BIGINT) AS kept FROM g
 UNION ALL SELECT g.doc, g.rn, CASE WHEN seen OR g.e IS NULL THEN f.es ELSE list_append(f.es, g.e) END, CASE WHEN seen OR g.p IS NULL THEN f.ps ELSE list_append(f.ps, g.p) END, CASE WHEN seen THEN NULL ELSE g.ord END
 FROM f JOIN g ON g.doc = f.doc AND g.rn = f.rn + 1, LATERAL (SELECT coalesce(list_contains(f.es, g.e), false) OR coalesce(list_contains(f.ps, g.p), false) AS seen) s)
SELECT DISTINCT doc, kept AS ord FROM f WHERE kept IS NOT NULL""")
def contacts_greedy_dedup(spark, sf):
    return ct.greedy(b.contacts(spark, sf).withColumn("doc", F.col("ord") % 60), "doc")


@Q(f"""WITH RECURSIVE {b.CONTACTS}, c AS (SELECT ord, nullif({_E}, '') AS e, nullif({_STRICT}, '') AS p, CASE WHEN {_N} <> '' AND {_O} <> '' THEN {_N} || '|' || {_O} END AS n FROM contacts),
k AS (SELECT ord, 'e:' || e AS key FROM c WHERE e IS NOT NULL UNION ALL SELECT ord, 'p:' || p FROM c WHERE p IS NOT NULL UNION ALL SELECT ord, 'n:' || n FROM c WHERE n IS NOT NULL),
fst AS (SELECT key, min(ord) AS first FROM k GROUP BY key), l AS (SELECT DISTINCT ord AS a, first AS b FROM k JOIN fst USING (key) WHERE ord <> first), u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT ord AS a, ord AS r FROM c UNION SELECT u.b, reach.r FROM reach JOIN u ON u.a = reach.a)
SELECT a AS ord, min(r) AS root FROM reach GROUP BY a""")
def contacts_transitive_dedup(spark, sf):
    return ct.transitive(b.contacts(spark, sf))


_ROOTS = SQL["contacts_transitive_dedup"].split("SELECT a AS ord", 1)[0]


@Q(f"""{_ROOTS}, keyed AS (SELECT contacts.*, r.key FROM contacts JOIN (SELECT a AS ord, min(r) AS key FROM reach GROUP BY a) r USING (ord)),
num AS (SELECT key, phone, min(ord) AS first_at FROM keyed WHERE phone <> '' GROUP BY key, phone), nums AS (SELECT key, list(phone ORDER BY first_at) AS ps FROM num GROUP BY key),
m AS (SELECT key, {_LONGEST}, arg_min(email, ord) FILTER (email <> '') AS email, max(coalesce(conf, CAST(0 AS DOUBLE))) AS confidence, min(ord) AS ord, count(*) AS n FROM keyed GROUP BY key)
SELECT m.key, nullif(name, '\x01') AS name, organization, position, city, email, confidence, ord, n, ps[1] AS phone, array_to_string(ps[2:], ',') AS other_phones FROM m LEFT JOIN nums USING (key)""")
def contacts_transitive_merge(spark, sf):
    return ct.transitive_merged(b.contacts(spark, sf).withColumn("confidence", scoring.confidence(F.col("confidence"))))


# scores ------------------------------------------------------------------------------------------------------------------------------

_DBL = lambda x: f"CAST({x} AS DOUBLE)"
_HAS = lambda c, words: "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{w}')" for w in words) + ")"
_IF = lambda test, x: f"CASE WHEN {test} THEN {_DBL(x)} ELSE {_DBL(0)} END"
_BAND = f"CASE WHEN score >= {_DBL(0.8)} THEN 'high' WHEN score >= {_DBL(0.6)} THEN 'medium' ELSE 'low' END"


def _scored(spark, sf):
    c = b.contacts(spark, sf).withColumns({"conf": scoring.confidence(F.col("confidence")), "urgency": F.expr("CASE WHEN ord % 4 = 0 THEN 'HIGH now' END"), "product": F.expr("CASE WHEN ord % 9 = 0 THEN 'an Analyzer' END")})
    return c.withColumn("p", scoring.contact_priority(*[F.col(x) for x in ("city", "position", "organization", "urgency", "product", "email", "phone", "conf")]))


@Q(f"""WITH {b.CONTACTS}, x AS (SELECT ord, name, city, position, organization, coalesce(conf, {_DBL(0)}) AS conf, CASE WHEN ord % 4 = 0 THEN 'HIGH now' END AS urgency, CASE WHEN ord % 9 = 0 THEN 'an Analyzer' END AS product, coalesce(email, '') <> '' AS e, coalesce(phone, '') <> '' AS p FROM contacts),
t AS (SELECT *, {_HAS('city', scoring.REGIONS)} AS t1, {_HAS('position', scoring.POSITIONS)} AS t2, {_HAS('organization', scoring.INDUSTRIES)} AS t3, {_HAS('urgency', ['high'])} AS t4, {_HAS('product', ['analyzer'])} AS t5 FROM x),
s AS (SELECT *, greatest({_DBL(0)}, least({_DBL(1)}, {_DBL(0.5)} + {_IF('t1', 0.15)} + {_IF('t2', 0.2)} + {_IF('t3', 0.15)} + {_IF('t4', 0.1)} + {_IF('t5', 0.2)} + {_IF('e', 0.05)} + {_IF('e AND p', 0.05)} + CASE WHEN conf > {_DBL(0.9)} THEN {_DBL(0.05)} WHEN conf < {_DBL(0.7)} THEN -{_DBL(0.1)} ELSE {_DBL(0)} END)) AS score FROM t)
SELECT ord, score, {_BAND} AS level, concat_ws('; ', CASE WHEN t1 THEN 'priority region: ' || city END, CASE WHEN t2 THEN 'important position: ' || position END, CASE WHEN t3 THEN 'priority industry: ' || organization END, CASE WHEN t4 THEN 'high urgency' END, CASE WHEN t5 THEN 'interest in the key product' END, CASE WHEN e AND p THEN 'complete contact data' END, CASE WHEN conf > {_DBL(0.9)} THEN 'high confidence' WHEN conf < {_DBL(0.7)} THEN 'low confidence' END) AS reasons FROM s""")
def contact_priority(spark, sf):
    return _scored(spark, sf).select("ord", "p.score", "p.level", F.array_join("p.reasons", "; ").alias("reasons"))


def _region_case(field: dict) -> str:
    out = [f"WHEN contains(lower(n_name), '{n}') THEN {field[level]}" if isinstance(field, dict) and level in field else f"WHEN contains(lower(n_name), '{n}') THEN '{n.title()}'" for level, (_, names) in scoring.REGION_LEVELS.items() for n in names]
    return "CASE " + " ".join(out)


@Q(f"""SELECT n_nationkey, {_region_case({k: _DBL(v[0]) for k, v in scoring.REGION_LEVELS.items()})} ELSE {_DBL(0.1)} END AS score, {_region_case({k: repr(k) for k in scoring.REGION_LEVELS})} ELSE 'very low' END AS level, {_region_case({})} ELSE n_name END AS region FROM nation""")
def region_priority(spark, sf):
    return b.table(spark, sf, "nation").select("n_nationkey", scoring.region_priority(F.col("n_name")).alias("r")).select("n_nationkey", "r.score", "r.level", "r.region")


@Q(f"""WITH x AS (SELECT c_custkey, {_region_case({k: _DBL(v[0]) for k, v in scoring.REGION_LEVELS.items()})} ELSE {_DBL(0.1)} END AS rs, c_mktsegment = 'MACHINERY' AS rel, c_custkey % 3 = 0 AS paid, CASE c_custkey % 4 WHEN 0 THEN 'Urgent' WHEN 1 THEN 'normal' ELSE 'later' END AS u FROM customer JOIN nation ON n_nationkey = c_nationkey),
s AS (SELECT *, rs * {_DBL(0.4)} + {_IF('rel', 0.3)} + {_IF('paid', 0.15)} + CASE u WHEN 'Urgent' THEN {_DBL(0.15)} WHEN 'normal' THEN {_DBL(0.08)} ELSE {_DBL(0)} END AS score FROM x)
SELECT c_custkey, least(score, {_DBL(1)}) AS score, CASE WHEN score >= {_DBL(0.8)} THEN 'critical' WHEN score >= {_DBL(0.6)} THEN 'high' WHEN score >= {_DBL(0.4)} THEN 'medium' WHEN score >= {_DBL(0.2)} THEN 'low' ELSE 'minimal' END AS level FROM s""")
def regional_contact_priority(spark, sf):
    c = b.table(spark, sf, "customer").join(b.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    r = scoring.regional_contact_priority(F.col("n_name"), F.expr("CASE WHEN c_mktsegment = 'MACHINERY' THEN 'lab KIT' END"), F.col("c_custkey") % 3 == 0, F.expr("CASE c_custkey % 4 WHEN 0 THEN 'Urgent' WHEN 1 THEN 'normal' ELSE 'later' END"))
    return c.select("c_custkey", r.alias("r")).select("c_custkey", "r.score", "r.level")


@Q(f"""WITH {b.ORDERS} SELECT day, count(*) AS total, count(*) FILTER (score >= {_DBL(0.8)}) AS high, count(*) FILTER (score >= {_DBL(0.6)} AND score < {_DBL(0.8)}) AS medium, count(*) FILTER (score < {_DBL(0.6)}) AS low FROM mailed GROUP BY day""")
def priority_bands(spark, sf):
    return rollups.bands_by_day(b.orders(spark, sf), "day", "score")


# days --------------------------------------------------------------------------------------------------------------------------------


def _day_stats(spark, sf):
    return b.orders(spark, sf).groupBy("day").agg(F.count(F.lit(1)).alias("emails_processed"), F.countDistinct("o_custkey").alias("contacts"), F.count_if(~F.col("ok")).cast("long").alias("errors"), F.count_if(F.col("o_orderkey") % 7 == 0).cast("long").alias("offers"), F.sum("amount").cast("double").alias("amount"))


_DAYS = f"""{b.ORDERS}, days AS (SELECT day, count(*) AS emails_processed, count(DISTINCT o_custkey) AS contacts, count(*) FILTER (NOT ok) AS errors, count(*) FILTER (o_orderkey % 7 = 0) AS offers, CAST(sum(amount) AS DOUBLE) AS amount FROM mailed GROUP BY day)"""


@Q(f"WITH {_DAYS} SELECT * FROM days")
def day_rollup(spark, sf):
    return _day_stats(spark, sf)


@Q(f"WITH {_DAYS} SELECT day, emails_processed, errors, CAST(sum(emails_processed) OVER w AS BIGINT) AS emails_processed_so_far, CAST(sum(errors) OVER w AS BIGINT) AS errors_so_far FROM days WINDOW w AS (ORDER BY day ROWS UNBOUNDED PRECEDING)")
def day_cumulative(spark, sf):
    return rollups.running(_day_stats(spark, sf).select("day", "emails_processed", "errors"), "day", "emails_processed", "errors")


@Q(f"WITH {b.ORDERS} SELECT day, count(*) AS n FROM mailed GROUP BY day ORDER BY n DESC, day LIMIT 1")
def busiest_day(spark, sf):
    return rollups.busiest(b.orders(spark, sf), "day")


@Q(f"WITH {b.ORDERS} SELECT day, count(*) AS n FROM mailed GROUP BY day ORDER BY day DESC LIMIT 10")
def last_days(spark, sf):
    return rollups.top(rollups.per_day(b.orders(spark, sf), "day"), 10, F.desc("day"))


@Q(f"WITH {b.ORDERS} SELECT day, count(*) AS total, count(*) FILTER (ok) AS successful, {_DBL(100.0)} * count(*) FILTER (ok) / count(*) AS pct FROM mailed GROUP BY ROLLUP (day)")
def success_rate_rollup(spark, sf):
    return rollups.success_rollup(b.orders(spark, sf), "day")


@Q(f"WITH {b.ORDERS} SELECT o_orderkey, day, row_number() OVER (PARTITION BY day ORDER BY o_orderkey) AS n FROM mailed QUALIFY n <= 3")
def per_day_limit(spark, sf):
    return joins.limited(b.orders(spark, sf).select("o_orderkey", "day"), "day", 3, "o_orderkey")


@Q(f"WITH {b.ORDERS} SELECT o_orderkey, day, row_number() OVER (PARTITION BY day ORDER BY o_orderkey) AS n FROM mailed")
def ordinal_in_day(spark, sf):
    return joins.numbered(b.orders(spark, sf).select("o_orderkey", "day"), "day", "o_orderkey")


@Q(f"WITH {b.ORDERS} SELECT o_orderkey, day FROM mailed WHERE day BETWEEN DATE '1995-03-01' AND DATE '1995-05-31'")
def range_scan(spark, sf):
    return b.orders(spark, sf).select("o_orderkey", "day").where(F.col("day").between(F.lit("1995-03-01").cast("date"), F.lit("1995-05-31").cast("date")))


@Q(f"""WITH {b.ORDERS}, d AS (SELECT CAST(unnest(generate_series(DATE '1994-12-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day), r AS (SELECT day, count(*) AS n FROM mailed GROUP BY day)
SELECT d.day, r.n, r.n IS NOT NULL AS found FROM d LEFT JOIN r USING (day)""")
def date_spine_left_join(spark, sf):
    return joins.on_spine(joins.date_spine(spark, "1994-12-01", "2001-12-31"), rollups.per_day(b.orders(spark, sf), "day"))


@Q("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unseen_anti_join(spark, sf):
    return joins.unseen(b.table(spark, sf, "documents").select("doc_id", "lang"), b.table(spark, sf, "labels"), "doc_id")


@Q("SELECT doc_id, quality, quality IS NOT NULL AS hit FROM documents LEFT JOIN labels USING (doc_id)")
def cache_left_join(spark, sf):
    return joins.with_cache(b.table(spark, sf, "documents").select("doc_id"), b.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


@Q("""WITH l AS (SELECT doc_id, doc_id % 50 AS i, doc_id % 7 AS stem FROM documents), r AS (SELECT doc_id AS rid, doc_id % 50 AS i, doc_id % 11 AS stem FROM labels),
m AS (SELECT l.doc_id, r.rid, 0 AS rule FROM l JOIN r ON l.i = r.i AND l.stem = r.stem UNION ALL SELECT l.doc_id, r.rid, 1 FROM l JOIN r ON l.i = r.i)
SELECT doc_id, rule, rid FROM m QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rule, rid) = 1""")
def priority_match(spark, sf):
    left = b.table(spark, sf, "documents").selectExpr("doc_id", "doc_id % 50 AS i", "doc_id % 7 AS stem")
    right = b.table(spark, sf, "labels").selectExpr("doc_id AS rid", "doc_id % 50 AS i", "doc_id % 11 AS stem")
    best = joins.best_by(right, ["i", "stem"], "rid"), joins.best_by(right, ["i"], "rid")
    return joins.first_of(left, best, [["i", "stem"], ["i"]], "rid").select("doc_id", "rule", "rid")


@Q("""SELECT conv_id, 'THREAD: ' || conv_id || chr(10) || 'FROM: ' || arg_min(role, turn) || chr(10) || 'TO: ' || chr(10) || 'SUBJECT: s' || chr(10) || 'DATE: ' || chr(10) || repeat('=', 50) || chr(10) || arg_min(text, turn)
|| coalesce(chr(10) || string_agg('--- ATTACHMENT ' || (turn + 1) || ': ' || role || '.docx (docx, 50.00%) ---' || chr(10) || text, chr(10) || chr(10) ORDER BY turn) FILTER (turn % 2 = 1), '') AS combined FROM conversations GROUP BY conv_id""")
def combined_text(spark, sf):
    c = b.table(spark, sf, "conversations")
    part = F.struct("turn", F.concat("role", F.lit(".docx")).alias("file_name"), F.lit("docx").alias("method"), F.lit(0.5).alias("confidence"), (F.col("turn") % 2 == 1).alias("success"), "text")
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.min_by("text", "turn").alias("body"), F.min_by("role", "turn").alias("who"))
    head = mail.header_block(F.col("conv_id").cast("string"), F.col("who"), F.lit(None).cast("string"), F.lit("s"), F.lit(None).cast("string"))
    return g.select("conv_id", mail.combined_text(head, F.col("body"), F.col("parts")).alias("combined"))


# requests ----------------------------------------------------------------------------------------------------------------------------


@Q(f"WITH {b.REQUESTS} SELECT event_id, avg(CASE WHEN ok THEN {_DBL(1)} ELSE {_DBL(0)} END) OVER (PARTITION BY provider ORDER BY ts, event_id ROWS 9 PRECEDING) AS rate FROM requests")
def last10_success_rate(spark, sf):
    return rollups.last_rates(b.requests(spark, sf), "provider").select("event_id", "rate")


@Q(f"""WITH {b.REQUESTS}, t AS (SELECT *, CASE WHEN ok IS NOT DISTINCT FROM lag(ok) OVER w THEN 0 ELSE 1 END AS c FROM requests WINDOW w AS (PARTITION BY provider ORDER BY ts, event_id)), r AS (SELECT *, sum(c) OVER (PARTITION BY provider ORDER BY ts, event_id) AS run FROM t)
SELECT event_id, ok, row_number() OVER (PARTITION BY provider, run ORDER BY ts, event_id) AS streak FROM r""")
def error_streaks(spark, sf):
    return rollups.streaks(b.requests(spark, sf), "provider").select("event_id", "ok", "streak")


@Q(f"""WITH RECURSIVE {b.REQUESTS}, o AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY ts, event_id) AS rn FROM requests),
s AS (SELECT provider, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, '' AS outcome, {_DBL(0)} AS delay_used, {_DBL(30)} AS delay, 0 AS errors, 0 AS calm FROM (SELECT DISTINCT provider FROM o) p
 UNION ALL SELECT o.provider, o.rn, o.event_id, o.outcome, s.delay, CASE o.outcome WHEN 'success' THEN CASE WHEN s.calm + 1 >= 5 THEN {_DBL(30)} ELSE greatest({_DBL(10)}, s.delay * {_DBL(0.8)}) END
  WHEN 'rate_limit_error' THEN least({_DBL(120)}, s.delay * power({_DBL(1.5)}, least(s.errors + 1, 3))) ELSE CASE WHEN s.errors + 1 >= 2 THEN least({_DBL(120)}, s.delay * {_DBL(1.2)}) ELSE s.delay END END,
  CASE WHEN o.outcome = 'success' THEN 0 ELSE s.errors + 1 END, CASE WHEN o.outcome = 'success' THEN CASE WHEN s.calm + 1 >= 5 THEN 0 ELSE s.calm + 1 END ELSE 0 END FROM s JOIN o ON o.provider = s.provider AND o.rn = s.rn + 1)
SELECT provider, event_id, outcome, delay_used, delay FROM s WHERE rn > 0""")
def rate_limit_replay(spark, sf):
    return state.delays(b.requests(spark, sf))


@Q(f"""WITH RECURSIVE {b.REQUESTS}, o AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY ts, event_id) AS rn FROM requests),
s AS (SELECT provider, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, false AS ok, '' AS state, 0 AS failures, {_DBL(-1)} AS until FROM (SELECT DISTINCT provider FROM o) p
 UNION ALL SELECT o.provider, o.rn, o.event_id, o.ok, CASE WHEN o.ts < s.until THEN 'open' WHEN NOT o.ok AND s.failures + 1 >= 3 THEN 'tripped' ELSE 'closed' END,
  CASE WHEN o.ts < s.until THEN s.failures WHEN o.ok OR s.failures + 1 >= 3 THEN 0 ELSE s.failures + 1 END, CASE WHEN o.ts < s.until THEN s.until WHEN NOT o.ok AND s.failures + 1 >= 3 THEN o.ts + 300 ELSE {_DBL(-1)} END FROM s JOIN o ON o.provider = s.provider AND o.rn = s.rn + 1)
SELECT provider, event_id, ok, state FROM s WHERE rn > 0""")
def circuit_breaker_replay(spark, sf):
    return state.breaker(b.requests(spark, sf))


@Q(f"""WITH {b.REQUESTS}, m AS (SELECT event_id % 997 AS message, event_id, ts, ok, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY event_id % 997 ORDER BY ts, event_id) AS part FROM requests),
r AS (SELECT message, part, count(*) FILTER (NOT ok) AS failures FROM m GROUP BY ALL), x AS (SELECT message, arg_max(failures, part) AS last, max(failures) >= 3 AS dead FROM r GROUP BY message)
SELECT message, CAST(CASE WHEN dead THEN 3 ELSE last END AS BIGINT) AS attempts, dead FROM x""")
def retry_dead_letter(spark, sf):
    return state.retry_queue(b.requests(spark, sf).withColumn("message", F.col("event_id") % 997))


def _streamed(spark, sf, machine, name, **columns):
    from ..streaming import state as streaming

    log = spark.readStream.option("maxFilesPerTrigger", 1).schema(b.table(spark, sf, "events").schema).parquet(f"{sf}/events.parquet*")
    outcome = F.expr("CASE event_type WHEN 'error' THEN 'rate_limit_error' WHEN 'click' THEN 'timeout' WHEN 'signup' THEN 'other_error' ELSE 'success' END")
    requests = log.select((F.col("user_id") % 50).alias("provider"), (F.col("event_id") % 997).alias("message"), "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("ts"), outcome.alias("outcome")).withColumn("ok", F.col("outcome") == "success")
    return streaming.run_once(getattr(streaming, machine)(requests), shared_path(spark, name), shared_path(spark, f"{name}-state"))


@Q()
def rate_limit_stream(spark, sf):
    return _streamed(spark, sf, "delays", "delays")


@Q()
def circuit_breaker_stream(spark, sf):
    return _streamed(spark, sf, "breakers", "breakers")


@Q()
def retry_stream(spark, sf):
    return _streamed(spark, sf, "retries", "retries")


@Q(f"""WITH {b.REQUESTS}, p AS (SELECT provider, provider % 7 <> 0 AS active, provider % 5 <> 0 AS has_key, count(*) FILTER (NOT ok) % 6 AS failures FROM requests GROUP BY ALL), u AS (SELECT count(*) FILTER (active AND has_key) AS usable FROM p)
SELECT provider, CASE WHEN NOT active THEN 'disabled' WHEN NOT has_key THEN 'no_api_key' WHEN failures > 3 THEN 'unhealthy' WHEN failures > 0 THEN 'degraded' ELSE 'healthy' END AS status, CASE WHEN usable = 0 THEN 'critical' WHEN usable = 1 THEN 'warning' ELSE 'healthy' END AS system FROM p, u""")
def provider_health(spark, sf):
    p = b.requests(spark, sf).groupBy("provider").agg((F.count_if(~F.col("ok")) % 6).alias("failures")).withColumns({"active": F.col("provider") % 7 != 0, "has_key": F.col("provider") % 5 != 0})
    return rollups.provider_health(p)


@Q("""SELECT method, count(*) AS total, count(*) FILTER (length(trim(text)) > 0 AND doc_id % 17 <> 0) AS successful, avg(CASE WHEN doc_id % 17 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END) AS confidence FROM (SELECT *, CASE doc_id % 3 WHEN 0 THEN 'ocr' WHEN 1 THEN 'docx_cached' ELSE 'xlsx' END AS method FROM documents) GROUP BY method""")
def ocr_methods(spark, sf):
    d = b.table(spark, sf, "documents").withColumn("method", F.expr("CASE doc_id % 3 WHEN 0 THEN 'ocr' WHEN 1 THEN 'docx_cached' ELSE 'xlsx' END"))
    failed = F.col("doc_id") % 17 == 0
    return d.groupBy("method").agg(F.count(F.lit(1)).alias("total"), F.count_if((F.length(F.trim("text")) > 0) & ~failed).cast("long").alias("successful"), F.coalesce(F.avg(F.when(failed, 0.0).otherwise(1.0)), F.lit(0.0)).alias("confidence"))


# exports -----------------------------------------------------------------------------------------------------------------------------


@Q(f"""WITH {b.CONTACTS} SELECT coalesce(nullif(name, ''), 'unknown') AS name, coalesce(nullif(email, ''), 'unknown') AS email, coalesce(nullif(phone, ''), 'unknown') AS phone, organization, position, city, coalesce(conf, {_DBL(0)}) AS confidence, CAST(ord AS VARCHAR) AS thread_id, 'x@example.com' AS "from", 's' AS subject FROM contacts""")
def export_contacts_flat(spark, sf):
    c = b.contacts(spark, sf).withColumn("confidence", scoring.confidence(F.col("confidence")))
    one = F.array(F.struct("name", "email", "phone", "organization", "position", "city", "confidence"))
    return mail.contact_rows(c.select(F.col("ord").cast("string").alias("thread_id"), F.lit("x@example.com").alias("from"), F.lit("s").alias("subject"), one.alias("contacts")))


@Q("""SELECT CAST(o_orderdate AS DATE) AS day, 'c' || o_custkey AS "from", CASE WHEN o_orderkey % 2 = 0 THEN 'n/a' ELSE 'No ' || o_orderkey END AS offer_number, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS offer_date, 'c' || o_custkey AS end_user, '' AS end_user_city, '' AS intermediary,
o_orderpriority AS payment_terms, '' AS delivery_time, '' AS delivery_terms, '' AS valid_until, o_orderstatus AS issued_by, o_custkey || ',50 EUR' AS total_cost, CASE WHEN o_orderkey % 3 = 0 THEN 'RUB' ELSE 'EUR' END AS currency, CAST(o_orderkey AS VARCHAR) AS thread_id, CAST(o_custkey || '.50' AS DECIMAL(18,2)) AS total_value
FROM orders WHERE o_orderkey % 5 = 0""")
def export_offers(spark, sf):
    o = b.table(spark, sf, "orders")
    empty = lambda name: F.lit(None).cast("string").alias(name)
    day, who = F.to_date("o_orderdate"), F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    offer = F.struct(
        (F.col("o_orderkey") % 5 == 0).alias("commercial_offer_found"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE concat('No ', o_orderkey) END").alias("offer_number"), day.cast("string").alias("offer_date"), who.alias("end_user"),
        *map(empty, ("end_user_city", "intermediary", "delivery_time", "delivery_terms", "valid_until")), F.col("o_orderpriority").alias("payment_terms"), F.col("o_orderstatus").alias("issued_by"),
        F.concat("o_custkey", F.lit(",50 EUR")).alias("total_cost"), F.expr("CASE WHEN o_orderkey % 3 <> 0 THEN 'EUR' END").alias("currency"),
    )
    return mail.offer_rows(o.select(day.alias("day"), who.alias("from"), F.col("o_orderkey").cast("string").alias("thread_id"), offer.alias("offer")))


@Q(f"""WITH {b.CONTACTS} SELECT CAST(DATE '2024-01-01' + CAST(ord % 20 AS INTEGER) AS DATE) AS day, coalesce(name, '') AS name, coalesce(email, '') AS email, coalesce(phone, '') AS phone, organization, position, city, coalesce(conf, {_DBL(0)}) AS confidence,
CASE WHEN ord % 3 = 0 THEN 'high' ELSE 'low' END AS level, 'unknown' AS subject, CAST(ord AS VARCHAR) AS thread_id FROM contacts""")
def export_contact_table(spark, sf):
    c = b.contacts(spark, sf).withColumns({"confidence": scoring.confidence(F.col("confidence")), "level": F.expr("CASE WHEN ord % 3 = 0 THEN 'high' END")})
    one = F.array(F.struct("name", "email", "phone", "organization", "position", "city", "confidence", "level"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("ord") % 20).cast("int"))
    return mail.contact_table(c.select(day.alias("day"), F.col("ord").cast("string").alias("thread_id"), F.lit(None).cast("string").alias("subject"), one.alias("contacts")))


@Q(f"""WITH {b.MAILS}, x AS (SELECT day, doc_id, doc_id % 4 AS k, (doc_id % 101) / {_DBL(100)} AS s FROM mails)
SELECT day, CAST(sum(k) AS BIGINT) AS total_contacts, CAST(sum(CASE WHEN s >= {_DBL(0.8)} THEN k ELSE 0 END) AS BIGINT) AS high, CAST(sum(CASE WHEN s >= {_DBL(0.6)} AND s < {_DBL(0.8)} THEN k ELSE 0 END) AS BIGINT) AS medium,
CAST(sum(CASE WHEN s < {_DBL(0.6)} THEN k ELSE 0 END) AS BIGINT) AS low, CAST(sum(doc_id % 3) AS BIGINT) AS total_action_items, count(*) FILTER (doc_id % 5 > 0) AS total_business_contexts, count(*) FILTER (doc_id % 6 = 0) AS total_commercial_offers FROM x GROUP BY day""")
def day_summary(spark, sf):
    m = b.mails(spark, sf)
    contact = F.struct(F.expr("(doc_id % 101) / 100.0D").alias("score"))
    times = lambda x, n: F.array_repeat(x, (F.col("doc_id") % n).cast("int"))
    return mail.day_summary(m.select("day", times(contact, 4).alias("contacts"), times(F.lit("call"), 3).alias("actions"), F.when(F.col("doc_id") % 5 > 0, "c").otherwise("").alias("context"), (F.col("doc_id") % 6 == 0).alias("offer_found")))


@Q(f"""WITH {b.REQUESTS} SELECT event_id, CASE provider % 3 WHEN 0 THEN CASE WHEN event_id % 2 = 0 THEN 'b' ELSE 'c' END WHEN 1 THEN 'c' END AS next, CASE WHEN event_id % 7 = 0 THEN CASE WHEN event_id % 14 = 0 THEN {_DBL(9)} ELSE {_DBL(60)} END
ELSE least(power({_DBL(2)}, event_id % 12), {_DBL(300)}) + least(power({_DBL(2)}, event_id % 12), {_DBL(300)}) * ({_DBL(0.1)} + {_DBL(0.4)} * {_DBL(0.5)}) END AS wait FROM requests""")
def provider_fallback(spark, sf):
    r = b.requests(spark, sf)
    order = F.array(*map(F.lit, "abc"))
    usable = F.expr("CASE WHEN event_id % 2 = 0 THEN array('a', 'b', 'c') ELSE array('c') END")
    current = F.expr("CASE provider % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END")
    wait = state.retry_wait(F.col("event_id") % 12, F.lit(0.5), F.expr("CASE WHEN event_id % 7 = 0 THEN 429 ELSE 500 END"), F.expr("CASE WHEN event_id % 14 = 0 THEN ' 9' ELSE 'soon' END"))
    return r.select("event_id", state.fallback(order, usable, current).alias("next"), wait.alias("wait"))


@Q(r"""SELECT page_id, length(trim(x)) AS n, x AS body FROM (SELECT page_id, CASE WHEN length(trim(p)) > 10 THEN p ELSE '' END || CASE WHEN length(trim(p)) > 10 THEN chr(10) ELSE '' END || 'a plain part ' || page_id AS x FROM (SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&[a-z]+;', ' ', 'g') AS p FROM pages) y) z""")
def body_extraction(spark, sf):
    p = b.table(spark, sf, "pages")
    part = lambda text, kind, how: F.struct(text.alias("text"), F.lit(kind).alias("kind"), F.lit(how).alias("disposition"))
    plain = F.concat(F.lit("a plain part "), F.col("page_id").cast("string"))
    parts = F.array(part(F.col("html"), "text/html", ""), part(plain, "text/plain", ""), part(F.lit("an attached text"), "text/plain", "attachment"), part(F.lit("short"), "text/plain", ""))
    return p.select("page_id", tx.join_body(parts).alias("body")).select("page_id", F.length(F.trim("body")).cast("long").alias("n"), "body")


@Q(r"""SELECT p_partkey, 't' || p_partkey || '_' || strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(p_partkey % 86400 AS INTEGER)), '%H%M%S') || '_' || CASE WHEN p_partkey % 2 = 0 THEN 'inline' ELSE 'attach' END || '_' || regexp_replace(p_name, '[^\p{L}\p{M}\p{Nd}\p{Pc}\s\-\.]', '_', 'g') AS stored,
regexp_replace(p_name, '[^\p{L}\p{M}\p{N} ._]', '', 'g') AS report, contains(lower(p_name), 'green') AS mentioned FROM part""")
def stored_names(spark, sf):
    p = b.table(spark, sf, "part")
    at = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp")) + F.col("p_partkey") % 86400)
    return p.select("p_partkey", tx.stored_filename(F.concat(F.lit("t"), F.col("p_partkey").cast("string")), at, F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("stored"), tx.report_name(F.col("p_name")).alias("report"), tx.mentions(F.col("p_name"), "GREEN").alias("mentioned"))


@Q(f"""WITH {b.ATTACHMENTS} SELECT id, CASE WHEN id % 4 = 0 THEN 'attachment' WHEN id % 4 = 1 AND {_IMG.replace("inline OR ", "")} THEN 'inline' WHEN id % 4 = 2 AND {_IMG.replace("inline OR ", "")} THEN 'attachment' ELSE 'body' END AS role FROM attachments""")
def part_roles(spark, sf):
    a = b.attachments(spark, sf)
    how = F.expr("CASE id % 4 WHEN 0 THEN 'ATTACHMENT; x' WHEN 1 THEN 'inline' WHEN 2 THEN NULL ELSE 'other' END")
    return a.select("id", fl.part_role(how, F.when(fl.is_image(F.col("name")), "image/png").otherwise("text/plain"), F.col("name")).alias("role"))


@Q(f"WITH {b.CONTACTS} SELECT ord, email FROM contacts WHERE NOT ends_with(lower(coalesce(email, '')), '@example.com')")
def external_contacts(spark, sf):
    return fl.external_only(b.contacts(spark, sf), "EXAMPLE.com").select("ord", "email")


@Q(f"WITH {_DAYS} SELECT day, emails_processed, contacts, offers, errors, {_DBL(100.0)} * (emails_processed - errors) / emails_processed AS success_pct FROM days")
def export_statistics(spark, sf):
    d = _day_stats(spark, sf)
    return d.select("day", "emails_processed", "contacts", "offers", "errors", rollups.rate(F.col("emails_processed") - F.col("errors"), F.col("emails_processed")).alias("success_pct"))


@Q(f"""WITH {b.MAILS}, a AS (SELECT doc_id, regexp_extract_all(body, '({EMAIL})', 1) AS found FROM mails)
SELECT CAST(m.doc_id AS VARCHAR) AS thread_id, sender AS "from", subject, CAST(len(found) AS BIGINT) AS contacts, CAST(m.doc_id % 3 AS BIGINT) AS attachments, m.doc_id % 3 > 0 AS has_attachments, CAST(length(body) AS BIGINT) AS chars FROM mails m JOIN a USING (doc_id)""")
def export_details(spark, sf):
    m = b.mails(spark, sf).select(F.col("doc_id").cast("string").alias("thread_id"), F.col("sender").alias("from"), "subject", "body", tx.recipients(F.col("body")).alias("contacts"), F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), (F.col("doc_id") % 3).cast("int")).alias("attachments"))
    return mail.detail_rows(m).select("thread_id", "from", "subject", *[F.col(c).cast("long").alias(c) for c in ("contacts", "attachments")], "has_attachments", F.col("chars").cast("long").alias("chars"))


@Q(f"""WITH {b.MAILS} SELECT doc_id, CAST(len(list_distinct(regexp_extract_all(body, '({EMAIL})', 1))) AS BIGINT) AS contacts FROM mails""")
def plugin_answers(spark, sf):
    """Runs the default extraction plug-in over every mail and reads its answers."""
    answers = plugins.answer(b.mails(spark, sf), "doc_id", "body")
    return answers.select("doc_id", ct.parse_answer(F.col("answer")).alias("a")).select("doc_id", F.size("a.contacts").cast("long").alias("contacts"))


@Q(f"""WITH {b.CONTACTS}, x AS (SELECT CAST(DATE '2024-01-01' + CAST(ord % 20 AS INTEGER) AS DATE) AS day, ord, coalesce(conf, {_DBL(0)}) AS score, ord % 4 = 0 AS is_offer, row_number() OVER (PARTITION BY ord % 20, ord % 4 = 0 ORDER BY ord) AS nth FROM contacts)
SELECT day, count(*) AS contacts, count(*) FILTER (score >= {_DBL(0.8)}) AS high, coalesce(string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) FILTER (NOT is_offer AND nth <= 5), '') AS top_contacts, coalesce(string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) FILTER (is_offer AND nth <= 3), '') AS top_offers FROM x GROUP BY day""")
def day_results(spark, sf):
    c = b.contacts(spark, sf).withColumns({"confidence": scoring.confidence(F.col("confidence")), "day": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("ord") % 20).cast("int")), "is_offer": F.col("ord") % 4 == 0})
    ids = lambda x: F.array_join(F.transform(x, lambda s: s["ord"].cast("string")), ",").alias(x)
    return mail.day_results(c.withColumn("score", F.col("confidence"))).select("day", "contacts", "high", ids("top_contacts"), ids("top_offers"))


@Q(f"""WITH {b.REQUESTS}, d AS ({SQL["rate_limit_replay"]}), r AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY event_id DESC) AS back FROM d)
SELECT provider, count(*) AS total, avg(CASE WHEN outcome = 'success' THEN {_DBL(1)} ELSE {_DBL(0)} END) FILTER (back <= 10) AS success_rate, round(avg(delay_used) FILTER (back <= 10), 9) AS mean_delay FROM r WHERE back <= 50 GROUP BY provider""")
def request_stats(spark, sf):
    return rollups.request_stats(state.delays(b.requests(spark, sf)), "provider").withColumn("mean_delay", F.round("mean_delay", 9))


_ANSWERS = """CASE event_id % 4 WHEN 0 THEN '{"contacts":[{"name":"a"}],"business_context":{"urgency":"x"},"action_items":"y"}' WHEN 1 THEN 'text {"contacts":[]}' WHEN 2 THEN 'none' ELSE '{"contacts":[{"city":"x"}],"business_context":"c","recommended_actions":"y"}' END"""


@Q(f"""WITH raw AS (SELECT event_id, CAST(nullif(regexp_extract({_ANSWERS}, '(?s)(\\{{.*\\}})', 1), '') AS JSON) AS j FROM events),
a AS (SELECT event_id, j->'$.contacts' AS c, coalesce(j->>'$.business_context', '') AS context, coalesce(j->>'$.action_items', j->>'$.recommended_actions', '') AS actions FROM raw),
e AS (SELECT *, len(list_filter(CAST(c AS JSON[]), lambda x: coalesce(x->>'$.name', '') = '' AND coalesce(x->>'$.email', '') = '' AND coalesce(x->>'$.phone', '') = '')) > 0 AS hollow FROM a)
SELECT event_id, concat_ws(',', CASE WHEN c IS NULL THEN 'no contacts' END, CASE WHEN context = '' THEN 'no business_context' END, CASE WHEN actions = '' THEN 'no actions' END, CASE WHEN hollow THEN 'empty contact' END) AS errors FROM e""")
def answer_validation(spark, sf):
    raw = F.expr(_ANSWERS)
    e = b.table(spark, sf, "events").select("event_id", ct.parse_answer(raw).alias("a"))
    return e.select("event_id", F.array_join(ct.answer_errors(F.col("a")), ",").alias("errors"))


@Q(f"""WITH {b.MAILS}, a AS (SELECT DISTINCT lower(unnest(regexp_extract_all(body, '({EMAIL})', 1))) AS address FROM mails UNION SELECT DISTINCT sender FROM mails), s AS (SELECT DISTINCT sender AS address FROM mails WHERE doc_id % 2 = 0)
SELECT address FROM a EXCEPT SELECT address FROM s""")
def new_addresses(spark, sf):
    m = b.mails(spark, sf)
    found = m.select(F.explode(tx.recipients(F.col("body"))).alias("a")).select(F.lower("a").alias("address")).union(m.select("sender")).distinct()
    return joins.unseen(found, m.where("doc_id % 2 = 0").select(F.col("sender").alias("address")), "address")


@Q("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'pdf' WHEN doc_id % 5 = 1 THEN 'excel' WHEN doc_id % 5 = 2 THEN 'word' WHEN doc_id % 5 = 3 THEN 'ocr' ELSE 'text' END AS method, length(trim(text)) <= 100 AS needs_ocr,
CASE WHEN doc_id % 3 = 0 THEN 'a.docx' WHEN doc_id % 3 = 1 THEN 'b.PDF' ELSE 'c.xlsm' END AS file, CASE doc_id % 3 WHEN 0 THEN 'docx' WHEN 1 THEN 'pdf_plugin' ELSE 'unsupported' END AS by_name FROM documents""")
def extraction_dispatch(spark, sf):
    mime = F.expr("CASE doc_id % 5 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/vnd.ms-excel' WHEN 2 THEN 'application/msword' WHEN 3 THEN 'image/png' ELSE 'text/plain' END")
    file = F.expr("CASE doc_id % 3 WHEN 0 THEN 'a.docx' WHEN 1 THEN 'b.PDF' ELSE 'c.xlsm' END")
    return b.table(spark, sf, "documents").select("doc_id", mail.method_by_mime(mime).alias("method"), mail.needs_ocr(F.col("text")).alias("needs_ocr"), file.alias("file"), mail.extraction_method(file).alias("by_name"))
