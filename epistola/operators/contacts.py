"""Contacts: validation, tiered, greedy and transitive deduplication, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .components import components
from .scoring import confidence

FIELDS = ["name", "organization", "position", "city"]
CONTACT = "name string, email string, phone string, organization string, position string, city string, confidence string"
#: Both shapes of a model's answer: a context that is an object or a string, and either name of the action list.
ANSWER = f"contacts array<struct<{CONTACT.replace(' string', ':string')}>>, business_context string, recommended_actions string, action_items string"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def valid_email(c: Column) -> Column:
    """The trimmed address, or '' where it isn't one."""
    t = F.trim(_text(c))
    return F.when(t.rlike(f"^{tx.EMAIL}$"), t).otherwise(F.lit(""))


def valid_phone(c: Column) -> Column:
    """The trimmed number, or '' where its digits, after one plus, aren't 7 to 15."""
    return F.when(F.regexp_replace(_text(c), r"[^0-9+]", "").rlike(r"^\+?[0-9]{7,15}$"), F.trim(c)).otherwise(F.lit(""))


def validate(contacts: DataFrame) -> DataFrame:
    """Rows with a name, an address or a number; fields as trimmed strings, invalid addresses and numbers blank, confidence within [0, 1]."""
    kept = contacts.where((F.trim(_text(F.col("name"))) != "") | (F.trim(_text(F.col("email"))) != "") | (F.trim(_text(F.col("phone"))) != ""))
    return kept.withColumns({f: _text(F.col(f).cast("string")) for f in FIELDS} | {"email": valid_email(F.col("email")), "phone": valid_phone(F.col("phone")), "confidence": confidence(F.col("confidence"))})


def parse_answer(answer: Column) -> Column:
    """struct(ok, contacts, context, context_is_object, actions) of a model's answer."""
    body = tx.clean_answer(answer)
    value = F.from_json(body, ANSWER)
    context = value["business_context"]
    return F.struct(
        value["contacts"].isNotNull().alias("ok"), F.coalesce(value["contacts"], F.from_json(F.lit("[]"), f"array<struct<{CONTACT.replace(' string', ':string')}>>")).alias("contacts"),
        context.alias("context"), F.coalesce(F.ltrim(context).startswith("{"), F.lit(False)).alias("context_is_object"), F.coalesce(value["recommended_actions"], value["action_items"]).alias("actions"),
    )


def tier_key(email: Column, phone: Column, name: Column, organization: Column, row: Column) -> Column:
    """The group of a contact: its address, else its number, else name and organization, else itself."""
    e, p = tx.normalize_email(email), tx.normalize_phone(phone)
    n, o = tx.normalize_name(name), tx.normalize_name(organization)
    return (
        F.when(e != "", F.concat(F.lit("e:"), e)).when(p != "", F.concat(F.lit("p:"), p))
        .when((n != "") & (o != ""), F.concat(F.lit("n:"), n, F.lit("|"), o)).otherwise(F.concat(F.lit("r:"), row.cast("string")))
    )


def merge(contacts: DataFrame, key: str) -> DataFrame:
    """One row for each value of `key`: the longest texts (ties: the earliest), first address, distinct numbers in order, greatest confidence.

    `ord` gives the order of rows. All columns are aggregates with partial forms, but the list of numbers, which holds a group's distinct ones.
    """
    longest = lambda c: F.max_by(c, F.struct(F.length(_text(F.col(c))), -F.col("ord"))).alias(c)
    named = lambda c: F.when(F.length(_text(F.col(c))) > 0, F.col("ord"))
    numbers = contacts.where(F.length(_text(F.col("phone"))) > 0).groupBy(key, "phone").agg(F.min("ord").alias("at"))
    numbers = numbers.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "phone"))), lambda s: s["phone"]).alias("phones"))
    merged = contacts.groupBy(key).agg(*map(longest, FIELDS), F.min_by("email", named("email")).alias("email"), F.greatest(F.lit(0.0), F.max("confidence")).alias("confidence"), F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n"))
    return merged.join(numbers, key, "left").withColumns({"phone": F.get("phones", F.lit(0)), "other_phones": F.array_join(F.slice("phones", F.lit(2), F.size("phones")), ",")}).drop("phones")


def tiered(contacts: DataFrame) -> DataFrame:
    """Production deduplication: not transitive across tiers; one shuffle, no self-join."""
    keyed = contacts.withColumn("key", tier_key(F.col("email"), F.col("phone"), F.col("name"), F.col("organization"), F.col("ord")))
    return merge(keyed, "key")


def greedy(contacts: DataFrame, by: str) -> DataFrame:
    """In the order of `ord` within a document: a row goes if a kept row already holds its address or its number; a row that goes holds nothing.

    An ordered fold over the rows of one document's chunks, which a document bounds.
    """
    row = F.struct("ord", F.when(tx.normalize_email(F.col("email")) != "", tx.normalize_email(F.col("email"))).alias("e"), tx.phone_key(F.col("phone")).alias("p"))
    grouped = contacts.groupBy(by).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("e"), none.alias("p"), F.array().cast("array<bigint>").alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        seen = F.coalesce(F.array_contains(acc["e"], x["e"]), F.lit(False)) | F.coalesce(F.array_contains(acc["p"], x["p"]), F.lit(False))
        add = lambda a, v: F.when(seen | v.isNull(), a).otherwise(F.array_append(a, v))
        return F.struct(add(acc["e"], x["e"]).alias("e"), add(acc["p"], x["p"]).alias("p"), F.when(seen, acc["kept"]).otherwise(F.array_append(acc["kept"], x["ord"])).alias("kept"))

    return grouped.select(by, F.explode(F.aggregate("rows", start, step)["kept"]).alias("ord"))


def transitive(contacts: DataFrame) -> DataFrame:
    """(ord, root): contacts joined by an equal address, number, or name and organization, over any number of steps.

    Each key links its rows to the key's first row only, so a key with many rows gives as many links, not their square.
    """
    c = contacts.select(
        F.col("ord").cast("long").alias("ord"), tx.normalize_email(F.col("email")).alias("e"), tx.normalize_phone_strict(F.col("phone")).alias("p"),
        F.when((tx.normalize_name(F.col("name")) != "") & (tx.normalize_name(F.col("organization")) != ""), F.concat_ws("|", tx.normalize_name(F.col("name")), tx.normalize_name(F.col("organization")))).alias("n"),
    )
    keys = c.select("ord", F.explode(F.array(*[F.when(F.length(k) > 0, F.concat(F.lit(f"{k}:"), F.col(k))) for k in ("e", "p", "n")])).alias("key")).where("key is not null")
    first = keys.groupBy("key").agg(F.min("ord").alias("first"))
    links = keys.join(first, "key").where("ord != first").select(F.col("ord").alias("a"), F.col("first").alias("b")).distinct()
    roots = components(links)
    return c.select("ord").join(roots, c["ord"] == roots["node"], "left").select("ord", F.coalesce("root", "ord").alias("root"))


def transitive_merged(contacts: DataFrame) -> DataFrame:
    """One merged row for each group of `transitive`, keyed by the group's first row, which is the base that ties go to."""
    return merge(contacts.join(transitive(contacts).withColumnRenamed("root", "key"), "ord"), "key")


def answer_errors(parsed: Column) -> Column:
    """What an answer lacks, as a list; empty for a valid one. parsed: as parse_answer gives it."""
    checks = [
        F.when(~parsed["ok"], F.lit("no contacts")),
        F.when(parsed["context"].isNull(), F.lit("no business_context")),
        F.when(parsed["actions"].isNull(), F.lit("no actions")),
        F.when(F.exists(parsed["contacts"], lambda c: c["email"].isNull() & c["phone"].isNull() & c["name"].isNull()), F.lit("empty contact")),
    ]
    return F.filter(F.array(*checks), lambda e: e.isNotNull())
