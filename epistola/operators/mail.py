"""Mail records, attachments, combined texts, and flat rows for the sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

UNKNOWN = "unknown"
NAME_STATUSES = ["excluded_by_name", "excluded_by_base_name", "excluded_by_filter"]
STATUSES = ["saved", "already_exists", "excluded", "unsupported", "excluded_by_name", "excluded_by_base_name", "excluded_by_filter", "excluded_by_size"]


def records(raw: DataFrame) -> DataFrame:
    """The mail record from header strings and a body: addresses, dates, thread and message ids, preview of recipients."""
    sent = tx.parse_mail_date(F.col("date"))
    sender = tx.address_of(F.col("from"))
    to = F.transform(tx.recipients(F.col("to")), lambda a: F.lower(a))
    return raw.select(
        tx.thread_id(sender, F.col("subject"), F.col("date"), tx.local_time(sent)).alias("thread_id"),
        F.coalesce(F.nullif(F.trim("message_id"), F.lit("")), tx.generated_message_id(sender, F.col("subject"), F.col("date"))).alias("message_id"),
        sender.alias("from"), tx.recipient_preview(to).alias("to"), to.alias("to_emails"), F.transform(tx.recipients(F.col("cc")), lambda a: F.lower(a)).alias("cc_emails"),
        "subject", "date", sent.alias("parsed_date"), "body", F.length("body").alias("char_count"), "attachments", attachment_stats(F.col("attachments")).alias("attachments_stats"),
        "raw_size", tx.date_folder(sent).alias("date_folder"),
    )


def attachment_stats(attachments: Column) -> Column:
    """Counts of a mail's attachments by status, without a shuffle."""
    n = lambda test: F.size(F.filter(attachments, test))
    return F.struct(
        F.size(attachments).alias("total"), n(lambda a: a["status"] == "saved").alias("saved"), n(lambda a: a["status"] == "excluded").alias("excluded"),
        n(lambda a: a["status"].isin(NAME_STATUSES)).alias("excluded_filenames"), n(lambda a: a["status"] == "excluded_by_size").alias("excluded_by_size"),
        n(lambda a: a["status"] == "unsupported").alias("unsupported"), n(lambda a: a["is_inline"]).alias("inline_images"),
    )


def stats_by_mail(attachments: DataFrame, by: str) -> DataFrame:
    """The counts of `attachment_stats` from a row for each attachment (by, status, inline), summed before they are shuffled."""
    s = F.col("status")
    n = lambda test: F.count_if(test).cast("long")
    return attachments.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"), n(s == "saved").alias("saved"), n(s.isin(NAME_STATUSES)).alias("excluded_filenames"), n(s == "excluded_by_size").alias("excluded_by_size"),
        n(s == "excluded").alias("excluded"), n(s == "unsupported").alias("unsupported"), n(F.col("inline")).alias("inline_images"),
    )


def status_counts(attachments: DataFrame, by: str) -> DataFrame:
    """The same from rows: a column for each status."""
    return attachments.groupBy(by).pivot("status", STATUSES).agg(F.count(F.lit(1)))


def combined_text(header: Column, body: Column, parts: Column) -> Column:
    """Header lines, a rule, the body, and each successful non-empty attachment text with its own number, method and confidence."""
    numbered = F.transform(parts, lambda p, i: F.struct((i + 1).alias("i"), p.alias("p")))
    shown = F.filter(numbered, lambda x: x["p"]["success"] & (F.length(F.coalesce(x["p"]["text"], F.lit(""))) > 0))
    sections = F.transform(shown, lambda x: F.concat(F.lit("--- ATTACHMENT "), x["i"].cast("string"), F.lit(": "), x["p"]["file_name"], F.lit(" ("), x["p"]["method"], F.lit(", "), F.format_string("%.2f%%", x["p"]["confidence"] * 100), F.lit(") ---\n"), x["p"]["text"]))
    return F.concat_ws("\n", header, F.lit("=" * 50), body, F.nullif(F.array_join(sections, "\n\n"), F.lit("")))


def header_block(thread: Column, sender: Column, to: Column, subject: Column, date: Column) -> Column:
    line = lambda label, c: F.concat(F.lit(f"{label}: "), F.coalesce(c, F.lit("")))
    return F.concat_ws("\n", line("THREAD", thread), line("FROM", sender), line("TO", to), line("SUBJECT", subject), line("DATE", date))


def cache_date(folder: Column, parsed: Column, raw: Column) -> Column:
    """The day that a mail's extracted texts are kept under: its folder, its parsed date, or the raw date in one of four forms."""
    head = F.substring(raw, 1, 10)
    read = [F.date_format(F.try_to_timestamp(head, F.lit(f)), "yyyy-MM-dd") for f in ("yyyy-MM-dd", "dd.MM.yyyy", "yyyy.MM.dd", "dd/MM/yyyy")]
    return F.coalesce(F.nullif(folder, F.lit("")), F.nullif(F.split_part(parsed, F.lit("T"), F.lit(1)), F.lit("")), *read, F.regexp_replace(head, r"[./]", "-"))


def possible_paths(a: Column, day: Column) -> Column:
    """Where an attachment may be, likeliest first: its path, its relative path, and the place that its day and stored name give."""
    return F.array_compact(F.array(a["file_path"], a["relative_path"], F.concat(F.lit("attachments/"), day, F.lit("/"), a["saved_filename"])))


def file_path(a: Column, day: Column) -> Column:
    return F.get(possible_paths(a, day), F.lit(0))


def existing_paths(attachments: DataFrame, key: str, places: Column, stored: DataFrame) -> DataFrame:
    """(key, path): the first of each attachment's places that stored (path) has; attachments without a file are left out."""
    tried = attachments.select(key, F.posexplode(places).alias("at", "path"))
    return tried.join(stored.select("path").distinct(), "path", "left_semi").groupBy(key).agg(F.min_by("path", "at").alias("path"))


def extraction_method(name: Column) -> Column:
    """How a file's text is got, by extension."""
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    return F.when(ext == ".docx", "docx").when(ext == ".xlsx", "xlsx").when(ext == ".doc", "doc_plugin").when(ext == ".xls", "xls_plugin").when(ext == ".pdf", "pdf_plugin").when(ext.isin(".png", ".jpg", ".jpeg", ".tiff"), "image_plugin").otherwise("unsupported")


def contact_rows(mails: DataFrame) -> DataFrame:
    """A row for each contact of each mail, with the mail's thread, sender and subject."""
    said = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit(UNKNOWN))
    c = F.col("contact")
    return mails.select("thread_id", "from", "subject", F.explode("contacts").alias("contact")).select(
        *[said(c[f]).alias(f) for f in ("name", "email", "phone", "organization", "position", "city")], c["confidence"].alias("confidence"), "thread_id", "from", "subject"
    )


def offer_rows(mails: DataFrame) -> DataFrame:
    """Found offers (day, from, thread_id, offer) as the fifteen columns of the offers' table with their defaults, and the price as a decimal where it can be read."""
    o = F.col("offer")
    said = lambda name, default="": F.coalesce(F.nullif(o[name], F.lit("")), F.lit(default)).alias(name)
    return mails.where(F.coalesce(o["commercial_offer_found"], F.lit(False))).select(
        "day", F.coalesce("from", F.lit(UNKNOWN)).alias("from"), said("offer_number", "n/a"), *map(said, ("offer_date", "end_user", "end_user_city", "intermediary", "payment_terms", "delivery_time")),
        *map(said, ("delivery_terms", "valid_until", "issued_by", "total_cost")), said("currency", "RUB"), F.coalesce("thread_id", F.lit(UNKNOWN)).alias("thread_id"),
        F.regexp_replace(F.regexp_replace(o["total_cost"], r"[^0-9.,]", ""), ",", ".").try_cast("decimal(18,2)").alias("total_value"),
    )


def contact_table(mails: DataFrame, low: str = "low") -> DataFrame:
    """The eleven columns of the contacts' table, of mails (day, thread_id, subject, contacts with a priority's level)."""
    c = F.col("contact")
    text = lambda name: F.coalesce(c[name], F.lit("")).alias(name)
    return mails.select("day", "thread_id", "subject", F.explode("contacts").alias("contact")).select(
        "day", *map(text, ("name", "email", "phone", "organization", "position", "city")), F.coalesce(c["confidence"], F.lit(0.0)).alias("confidence"), F.coalesce(c["level"], F.lit(low)).alias("level"),
        F.coalesce("subject", F.lit(UNKNOWN)).alias("subject"), F.coalesce("thread_id", F.lit(UNKNOWN)).alias("thread_id"),
    )


def detail_rows(mails: DataFrame) -> DataFrame:
    return mails.select("thread_id", "from", "subject", F.size("contacts").alias("contacts"), F.size("attachments").alias("attachments"), (F.size("attachments") > 0).alias("has_attachments"), F.length("body").alias("chars"))


def chunks(mails: DataFrame, key: str, body: str) -> DataFrame:
    """(key, n, total, from, to, text): overlapping chunks with a heading where there are several."""
    length = F.length(body)
    cut = mails.select(key, F.col(body).alias("body"), tx.chunk_starts(length).alias("starts"))
    rows = cut.select(key, "body", F.size("starts").alias("total"), F.posexplode("starts").alias("n", "start"))
    size = F.when(F.col("total") > 1, F.lit(tx.CHUNK)).otherwise(F.length("body"))
    text = F.expr("substring(body, start + 1, CASE WHEN total > 1 THEN 10000 ELSE length(body) END)")
    end = F.least(F.col("start") + size, F.length("body"))
    head = F.when(F.col("total") > 1, F.concat(F.lit("[PART "), (F.col("n") + 1).cast("string"), F.lit(", CHARACTERS "), F.col("start").cast("string"), F.lit("-"), end.cast("string"), F.lit("]\n"))).otherwise("")
    return rows.select(key, (F.col("n") + 1).cast("long").alias("n"), F.col("total").cast("long").alias("total"), F.col("start").cast("long").alias("start"), end.cast("long").alias("stop"), F.concat(head, text).alias("text"))


def merge_chunk_contexts(parts: DataFrame, key: str) -> DataFrame:
    """The contexts of a document's chunks in order, as one text, and the number of contacts."""
    piece = F.concat(F.lit("Part "), F.col("n").cast("string"), F.lit(": "), F.col("context"))
    return parts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", piece.alias("t")))), lambda s: s["t"]), " | ").alias("context"), F.sum("contacts").alias("contacts"))


def sectioned_text(body: Column, parts: Column) -> Column:
    """The older layout: body, notes on what was left out, texts, errors. parts: struct of file_name, status, text, error."""
    lines = lambda test, shown: F.array_join(F.transform(F.filter(parts, test), shown), "\n")
    left_out = lines(lambda p: p["status"].isin("excluded", "unsupported"), lambda p: F.concat(p["file_name"], F.lit(": "), p["status"]))
    read = lines(lambda p: F.length(F.coalesce(p["text"], F.lit(""))) > 0, lambda p: F.concat(F.lit("["), p["file_name"], F.lit("]\n"), p["text"]))
    failed = lines(lambda p: p["error"].isNotNull(), lambda p: F.concat(p["file_name"], F.lit(": "), p["error"]))
    section = lambda title, c: F.when(F.length(c) > 0, F.concat(F.lit(f"=== {title} ===\n"), c))
    return F.concat_ws("\n\n", section("BODY", body), section("LEFT OUT", left_out), section("ATTACHMENTS", read), section("ERRORS", failed))


def method_by_mime(mime: Column) -> Column:
    """The older dispatch, by MIME type."""
    m = F.lower(F.coalesce(mime, F.lit("")))
    return (
        F.when(m == "application/pdf", "pdf").when(m.contains("spreadsheet") | m.contains("excel"), "excel").when(m.contains("word"), "word")
        .when(m.startswith("image/"), "ocr").when(m.startswith("text/"), "text").otherwise("unsupported")
    )


def needs_ocr(layer: Column, least: int = 100) -> Column:
    """Whether a PDF's text layer is too short to be used alone; a page's is by 50 characters."""
    return F.length(F.trim(F.coalesce(layer, F.lit("")))) <= least


def day_summary(mails: DataFrame) -> DataFrame:
    """A row for each day of mails (day, contacts with a score, context, actions, offer_found): contacts by band, and how many actions, contexts and offers.

    The flattened rows themselves are `explode`s of the mails; a day's lists are never gathered in one row.
    """
    band = lambda test: F.sum(F.size(F.filter("contacts", test))).cast("long")
    score = lambda c: F.coalesce(c["score"], F.lit(0.0))
    return mails.groupBy("day").agg(
        F.sum(F.size("contacts")).cast("long").alias("total_contacts"), band(lambda c: score(c) >= 0.8).alias("high"), band(lambda c: (score(c) >= 0.6) & (score(c) < 0.8)).alias("medium"),
        band(lambda c: score(c) < 0.6).alias("low"), F.sum(F.size("actions")).cast("long").alias("total_action_items"), F.count_if(F.length("context") > 0).cast("long").alias("total_business_contexts"),
        F.count_if("offer_found").cast("long").alias("total_commercial_offers"),
    )


def day_results(mails: DataFrame) -> DataFrame:
    """A row for each day: counts, and the previews of the first five contacts and three offers in order of arrival, not of score."""
    c = mails.select("day", "ord", F.struct("ord", "name", "organization", "city", "confidence", "score").alias("c"), "is_offer", "score")
    first = lambda n, test: F.slice(F.array_sort(F.collect_list(F.when(test, F.col("c")))), 1, n)
    ranked = c.withColumn("nth", F.row_number().over(Window.partitionBy("day", "is_offer").orderBy("ord")))
    return ranked.groupBy("day").agg(
        F.count(F.lit(1)).alias("contacts"), F.count_if(F.col("score") >= 0.8).cast("long").alias("high"),
        first(5, ~F.col("is_offer") & (F.col("nth") <= 5)).alias("top_contacts"), first(3, F.col("is_offer") & (F.col("nth") <= 3)).alias("top_offers"),
    )
