"""Scalar text functions of the mail engine, each a Column built from JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An e-mail address inside a text.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
#: Mail is dated in a zone seven hours ahead of UTC.
ZONE = "+07:00"
#: Chunk size, overlap and the length from which a text is cut.
CHUNK, OVERLAP, CUT_FROM = 10_000, 1_000, 12_000


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def normalize_email(c: Column) -> Column:
    return F.lower(F.trim(_blank(c)))


def normalize_phone(c: Column) -> Column:
    """Digits and plus signs; a leading 8 of an 11-character number becomes +7. 7XXXXXXXXXX without a plus stays as it is."""
    d = F.regexp_replace(_blank(c), r"[^0-9+]", "")
    return F.when(d.startswith("8") & (F.length(d) == 11), F.concat(F.lit("+7"), F.substring(d, 2, 10))).otherwise(d)


def normalize_phone_strict(c: Column) -> Column:
    """Digits only, in the 7XXXXXXXXXX form: 8 becomes 7 in 11 digits, and 10 digits get a 7."""
    d = F.regexp_replace(_blank(c), r"[^0-9]", "")
    return F.when((F.length(d) == 11) & d.startswith("8"), F.concat(F.lit("7"), F.substring(d, 2, 10))).when(F.length(d) == 10, F.concat(F.lit("7"), d)).otherwise(d)


def phone_key(c: Column) -> Column:
    """The key by which chunks are deduplicated; null unless it is longer than six characters."""
    k = F.regexp_replace(_blank(c), r"[\s\-()+]", "")
    return F.when(F.length(k) > 6, k)


def normalize_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(_blank(c)), r"\s+", " "))


def recipients(c: Column) -> Column:
    """All addresses of a header, in order; only texts with an @ are searched."""
    return F.when(_blank(c).contains("@"), F.regexp_extract_all(c, F.lit(f"({EMAIL})"), F.lit(1))).otherwise(F.array().cast("array<string>"))


def address_of(c: Column) -> Column:
    """What stands in angle brackets, else the first address, else the trimmed text."""
    inside = F.nullif(F.regexp_extract(_blank(c), r"<([^>]+)>", 1), F.lit(""))
    first = F.nullif(F.regexp_extract(_blank(c), f"({EMAIL})", 1), F.lit(""))
    return F.coalesce(inside, first, F.trim(_blank(c)))


def domain(c: Column) -> Column:
    """The lower-case text after the last @, up to a closing bracket; null without an @."""
    return F.when(_blank(c).contains("@"), F.lower(F.split_part(F.substring_index(c, "@", -1), F.lit(">"), F.lit(1))))


def recipient_preview(addresses: Column) -> Column:
    return F.concat(F.array_join(F.slice(addresses, 1, 3), ", "), F.when(F.size(addresses) > 3, F.lit("...")).otherwise(F.lit("")))


def parse_mail_date(c: Column) -> Column:
    """An RFC 2822 date as a timestamp; without a zone it is UTC; null if it can't be read."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(_blank(c), r"^\s*[A-Za-z]{3},\s*", ""), r"\s*\([^)]*\)\s*$", ""))
    zoned = F.when(bare.rlike(r"[+-]\d{4}$"), bare).otherwise(F.concat(F.regexp_replace(bare, r"\s+(GMT|UTC|UT|Z)$", ""), F.lit(" +0000")))
    return F.coalesce(F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm Z")))


def local_time(ts: Column) -> Column:
    """A timestamp's wall clock seven hours ahead of UTC, whatever the session's zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(ZONE), ts.cast("timestamp_ntz"))


def log_date(ts: Column) -> Column:
    return F.date_format(local_time(ts), "yyyy.MM.dd HH:mm")


def date_folder(ts: Column) -> Column:
    return F.date_format(local_time(ts), "yyyy-MM-dd")


def thread_id(sender: Column, subject: Column, raw_date: Column, day: Column) -> Column:
    """day as yyyymmdd, the sender's domain, and a hash of domain, subject without one reply prefix, and the date header's first ten characters."""
    at = F.coalesce(F.nullif(F.regexp_extract(_blank(sender), r"@([^>\s]+)", 1), F.lit("")), F.lit("unknown"))
    bare = F.regexp_replace(_blank(subject), r"(?i)^(Re|Fwd|Fw):\s*", "")
    digest = F.substring(F.md5(F.concat_ws("_", at, bare, F.substring(_blank(raw_date), 1, 10)).cast("binary")), 1, 8)
    return F.concat_ws("_", F.date_format(day, "yyyyMMdd"), F.regexp_replace(at, r"\.", "_"), digest)


def generated_message_id(sender: Column, subject: Column, raw_date: Column) -> Column:
    return F.concat(F.lit("generated_"), F.substring(F.md5(F.concat(_blank(sender), _blank(subject), _blank(raw_date)).cast("binary")), 1, 8))


def strip_html(c: Column) -> Column:
    """Tags go, named entities become a space; numeric entities and script text stay."""
    return F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", ""), r"&[a-z]+;", " ")


def join_body(parts: Column, limit: int | None = None) -> Column:
    """Text parts (struct of text, kind, disposition) of more than ten characters, html stripped, attachments left out; cut only where a limit is given."""
    kept = F.filter(parts, lambda p: ~F.lower(_blank(p["disposition"])).contains("attachment") & p["kind"].isin("text/plain", "text/html"))
    plain = F.transform(kept, lambda p: F.when(p["kind"] == "text/html", strip_html(p["text"])).otherwise(p["text"]))
    body = F.array_join(F.filter(plain, lambda t: F.length(F.trim(t)) > 10), "\n")
    return body if limit is None else F.substring(body, 1, limit)


def safe_filename(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[^\w\s\-\.]", "_")


def stored_filename(thread: Column, at: Column, inline: Column, name: Column) -> Column:
    return F.concat_ws("_", thread, F.date_format(at, "HHmmss"), F.when(inline, "inline").otherwise("attach"), safe_filename(name))


def clean_ocr(c: Column) -> Column:
    """White space collapses first, then repeated sentence ends become the last of them."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"([.!?]){2,}", "$1"))


def report_name(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[^\p{Alnum} ._]", "")


def preview(c: Column, n: int = 300) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def json_in_text(c: Column) -> Column:
    """From the first brace to the last; null if there is none."""
    return F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))


def clean_answer(c: Column) -> Column:
    """A model's answer without its thinking, tags and code fences, cut to the JSON in it."""
    bare = F.regexp_replace(c, r"(?s)<think>.*?</think>", "")
    return json_in_text(F.trim(F.regexp_replace(F.regexp_replace(bare, r"<[^>]+>", ""), r"```(json)?", "")))


def chunk_starts(length: Column) -> Column:
    """Starts of overlapping chunks; the last chunk reaches the end, and short texts are one chunk."""
    step = CHUNK - OVERLAP
    return F.when(length > CUT_FROM, F.transform(F.sequence(F.lit(0), F.ceil((length - CHUNK) / step).cast("int")), lambda i: i * step)).otherwise(F.array(F.lit(0)))


def token_estimate(chars: Column) -> Column:
    return F.floor(chars / 3).cast("long")


def size_mb(size: Column) -> Column:
    return F.bround(size / F.lit(1048576.0), 2)


def mentions(c: Column, word: str) -> Column:
    return F.lower(_blank(c)).contains(word.lower())
