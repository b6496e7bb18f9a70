"""Mail and attachment filters: first-match-wins `when` chains that stay inside code generation."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LARGE_MAIL, GATE = 100_000_000, 50_000_000
MASS = 10
#: Names never saved, short names, image suffixes, size limits of small images by name, extensions.
SPECIAL_NAMES = ["WRD0004.jpg", "~WRD0004.jpg", "_.jpg", "blocked.gif", "image001.png", "image002.png"]
SHORT_NAMES = ["_", "__", "___", "____", "_____", "-", "--", "---", "----", "...."]
IMAGES = [".png", ".jpg", ".jpeg", ".gif", ".bmp", ".tiff", ".webp"]
SMALL = [("image", 50_000), ("logo", 30_000), ("signature", 30_000), ("stamp", 30_000), ("icon", 20_000)]
DENIED = [".zip", ".rar", ".7z", ".pptx", ".ppt", ".rt", ".rtf", ".trt", ".tr", ".r96", ".exe", ".msi", ".dmg", ".iso", ".img", ".gif"]
ALLOWED = [".pdf", ".doc", ".docx", ".txt", ".xls", ".xlsx", ".xlsm", ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".tif", ".webp"]
HUGE_IMAGE, BANNER_BYTES, BANNER_SHAPE = 10_000_000, 83_509, "416x250"
LARGE_KINDS = ["application/vnd.ms-powerpoint", "application/vnd.openxmlformats-officedocument.presentationml.presentation", "application/zip", "application/x-zip-compressed", "video/", "audio/"]


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def subject_rule(subject: Column, rules: list[str]) -> Column:
    """The first rule, in order of spelling, that the lower-case subject contains; null if it passes."""
    s = F.lower(_text(subject))
    return F.coalesce(*[F.when(s.contains(r), F.lit(r)) for r in sorted({r.lower() for r in rules})], F.lit(None).cast("string"))


def blacklist_rule(sender: Column, rules: list[str]) -> Column:
    """The first rule, in order of spelling, that the sender meets: `x*` by prefix, else `*@d` by suffix, else by equality."""
    s = F.lower(F.trim(_text(sender)))
    found = []
    for r in sorted({r.strip().lower() for r in rules}):
        fits = s.startswith(r[:-1]) if r.endswith("*") else s.endswith(r[1:]) if r.startswith("*@") else s == r
        found.append(F.when(fits, F.lit(r)))
    return F.coalesce(*found, F.lit(None).cast("string"))


def glob_to_regex(glob: str) -> str:
    """A file-name glob (*, ?, [seq], [!seq]) as an anchored regular expression."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        close = glob.find("]", i + 2) if c == "[" else -1
        if c == "[" and close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\")
            out.append("[" + ("^" + body[1:] if body[0] == "!" else body) + "]")
            i = close
        else:
            out.append({"*": ".*", "?": "."}.get(c, re.escape(c)))
        i += 1
    return "(?s)^" + "".join(out) + "$"


def bare_name(name: Column) -> Column:
    return F.regexp_replace(name, r"^[~.]", "")


def name_excluded(name: Column, rules: list[str]) -> Column:
    """Short names, globs on the lower-case name with and without its leading ~ or dot, and whole names whatever their case. Nothing without rules."""
    if not rules:
        return F.lit(False)
    low = F.lower(_text(name))
    hit = name.isin(SHORT_NAMES) | low.isin([r.lower() for r in rules if "*" not in r])
    for r in rules:
        if "*" in r:
            rx = glob_to_regex(r.lower())
            hit = hit | low.rlike(rx) | bare_name(low).rlike(rx)
    return F.coalesce(hit, F.lit(False))


def is_mass_mailing(sender: Column, to: Column, cc: Column, own_domain: str) -> Column:
    mark = f"@{own_domain.lower()}"
    everyone = F.concat(F.coalesce(to, F.array()), F.coalesce(cc, F.array()))
    return F.lower(_text(sender)).contains(mark) & (F.size(F.filter(everyone, lambda a: F.lower(a).contains(mark))) >= MASS)


def too_large(size: Column) -> Column:
    return size > LARGE_MAIL


def needs_text_only(size: Column, structure: Column) -> Column:
    """Mail of unknown or large size whose structure shows a large part: only its text is fetched."""
    s = F.lower(_text(structure))
    marked = s.contains("attachment") | s.contains("application")
    numbers = F.transform(F.regexp_extract_all(s, F.lit(r"(\d+)"), F.lit(1)), lambda n: n)
    big = F.exists(numbers, lambda n: ~((F.length(n) == 8) & s.contains("boundary")) & n.try_cast("decimal(38,0)").between(20_000_001, 200_000_000))
    kind = F.coalesce(*[F.when(s.contains(k), F.lit(True)) for k in LARGE_KINDS], F.lit(False))
    return ((size == -1) | (size >= GATE)) & marked & (kind | F.coalesce(big, F.lit(False)))


def filter_reason(known: Column, subject: Column, blacklist: Column, mass: Column, size: Column) -> Column:
    """Why a mail is left out, in the order in which the checks get dearer; null for a mail that is kept."""
    return F.when(known, "already_saved").when(subject.isNotNull(), "subject").when(blacklist.isNotNull(), "blacklist").when(mass, "internal_mass").when(too_large(size), "too_large")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(_text(name), r"(\.[^.]*)$", 1))


def is_image(name: Column) -> Column:
    return extension(name).isin(IMAGES)


def small_image(name: Column, size: Column, inline: Column) -> Column:
    low, kind = F.lower(_text(name)), None
    for prefix, limit in SMALL:
        kind = F.when(low.startswith(prefix), size < limit) if kind is None else kind.when(low.startswith(prefix), size < limit)
    return (inline | is_image(name)) & F.coalesce(kind, F.lit(False))


def attachment_status(name: Column, size: Column, inline: Column, shape: Column, exists: Column, rules: list[str]) -> Column:
    """saved, or why not: special name, special name once bare, rule, size, denied type, unknown type, already there."""
    image = inline | is_image(name)
    by_size = small_image(name, size, inline) | (image & ((size > HUGE_IMAGE) | (size == BANNER_BYTES) | (F.coalesce(shape, F.lit("")) == BANNER_SHAPE)))
    return (
        F.when(name.isin(SPECIAL_NAMES), "excluded_by_name")
        .when(bare_name(name).isin(SPECIAL_NAMES), "excluded_by_base_name")
        .when(name_excluded(name, rules), "excluded_by_filter")
        .when(by_size, "excluded_by_size")
        .when(extension(name).isin(DENIED), "excluded")
        .when(~extension(name).isin(ALLOWED), "unsupported")
        .when(exists, "already_exists")
        .otherwise("saved")
    )


def part_role(disposition: Column, kind: Column, name: Column) -> Column:
    """attachment, inline or body of a message part."""
    d, picture, named = F.lower(_text(disposition)), _text(kind).startswith("image/"), F.length(_text(name)) > 0
    return F.when(d.contains("attachment"), "attachment").when(d.contains("inline") & picture & named, "inline").when((d == "") & picture & named, "attachment").otherwise("body")


def has_saved_attachment(attachments: Column) -> Column:
    return F.exists(attachments, lambda a: (a["status"] == "saved") & a["file_path"].isNotNull())


def external_only(contacts: DataFrame, own_domain: str) -> DataFrame:
    """An extension: contacts outside the own domain."""
    return contacts.where(~F.lower(F.coalesce("email", F.lit(""))).endswith(f"@{own_domain.lower()}"))
