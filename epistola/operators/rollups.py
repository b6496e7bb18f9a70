"""Counts, rates and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from . import ordinals
from .scoring import band


def rate(part: Column, whole: Column) -> Column:
    """Per cent, null over nothing."""
    return F.try_divide(part * F.lit(100.0), whole)


def domain_counts(addresses: DataFrame, column: str) -> DataFrame:
    return addresses.select(tx.domain(F.col(column)).alias("domain")).where("domain is not null").groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


def top(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)


def reason_counts(mails: DataFrame) -> DataFrame:
    return mails.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def corpus_totals(mails: DataFrame, attachments: DataFrame | None = None) -> DataFrame:
    """Mails, characters, estimated tokens and long mails; with attachments (mail_id, status, file_path) also the mails with a saved one and the saved ones."""
    totals = _mail_totals(mails)
    if attachments is None:
        return totals
    saved = F.col("status") == "saved"
    files = attachments.agg(F.countDistinct(F.when(saved & F.col("file_path").isNotNull(), F.col("mail_id"))).alias("mails_with_attachments"), F.count_if(saved).cast("long").alias("saved_attachments"))
    return totals.crossJoin(F.broadcast(files))  # one row beside one row


def _mail_totals(mails: DataFrame) -> DataFrame:
    return mails.agg(F.count(F.lit(1)).alias("mails"), F.sum(F.length("body").cast("long")).alias("chars"), tx.token_estimate(F.sum(F.length("body").cast("long"))).alias("tokens"), F.count_if(F.length("body") > 12000).cast("long").alias("long_mails"))


def fetch_totals(mails: DataFrame, attachments: DataFrame) -> DataFrame:
    """One row of all counters of a fetch, the mails left out by rules, and the rates of saved mails and of saved attachments.

    mails: (reason, failed, retry), reason as `filters.filter_reason` gives it, retry successful, failed or null; attachments: (status, inline, by_shape).
    """
    r, s = F.col("reason"), F.col("status")
    n = lambda test: F.count_if(F.coalesce(test, F.lit(False))).cast("long")
    by_rule = {"filtered_subject": "subject", "filtered_blacklist": "blacklist", "filtered_mass_mailing": "internal_mass"}
    taken = F.coalesce(r, F.lit("")) == ""
    of_mails = mails.agg(
        F.count(F.lit(1)).alias("processed"), n(taken & ~F.col("failed")).alias("saved"), n(r == "already_saved").alias("already_exists"), *[n(r == why).alias(name) for name, why in by_rule.items()],
        n(r == "too_large").alias("skipped_large_emails"), n(F.col("failed")).alias("errors"), n(F.col("retry") == "successful").alias("retry_successful"), n(F.col("retry") == "failed").alias("retry_failed"),
        n(r == "too_large").alias("total_skipped"),
    )
    shape = F.coalesce(F.col("by_shape"), F.lit(False))
    of_files = attachments.agg(
        n((s == "saved") & ~F.col("inline")).alias("saved_attachments"), n((s == "saved") & F.col("inline")).alias("saved_inline_images"), n(s == "excluded").alias("excluded_attachments"),
        n(s.isin("excluded_by_name", "excluded_by_base_name", "excluded_by_filter")).alias("excluded_filenames"), n((s == "excluded_by_size") & ~shape).alias("excluded_by_size"),
        n((s == "excluded_by_size") & shape).alias("excluded_by_image_dimensions"), n(s == "unsupported").alias("unsupported_attachments"),
    )
    both = of_mails.crossJoin(F.broadcast(of_files))  # one row beside one row
    kept = F.col("saved_attachments") + F.col("saved_inline_images")
    outcomes = kept + F.col("excluded_attachments") + F.col("excluded_filenames") + F.col("excluded_by_size") + F.col("excluded_by_image_dimensions") + F.col("unsupported_attachments")
    return both.withColumns({"total_filtered": sum((F.col(c) for c in list(by_rule)[1:]), F.col("filtered_subject")), "efficiency_pct": rate(kept, outcomes), "save_pct": rate(F.col("saved"), F.col("processed"))})


def fetch_counters(attachments: DataFrame) -> DataFrame:
    s = F.col("status")
    saved, total = F.count_if(s == "saved").cast("long"), F.count(F.lit(1))
    return attachments.agg(total.alias("total"), saved.alias("saved"), F.count_if(s.isin("excluded_by_name", "excluded_by_base_name", "excluded_by_filter")).cast("long").alias("excluded_filenames"), F.count_if(s == "excluded_by_size").cast("long").alias("excluded_by_size"), F.count_if(s == "excluded").cast("long").alias("excluded"), F.count_if(s == "unsupported").cast("long").alias("unsupported"), rate(saved, total).alias("saved_pct"))


def per_day(rows: DataFrame, day: str) -> DataFrame:
    return rows.groupBy(day).agg(F.count(F.lit(1)).alias("n"))


def busiest(rows: DataFrame, day: str) -> DataFrame:
    """The day with most rows, the first of equal ones."""
    return per_day(rows, day).agg(F.max_by(day, F.struct("n", F.negative(F.unix_date(day)))).alias(day), F.max("n").alias("n"))


def bands_by_day(rows: DataFrame, day: str, score: str) -> DataFrame:
    b = band(F.col(score))
    return rows.groupBy(day).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(b == x).cast("long").alias(x) for x in ("high", "medium", "low")])


def running(daily: DataFrame, day: str, *columns: str) -> DataFrame:
    """Running sums over days. The input is a rollup with a row for each day, so one ordered window holds few rows."""
    w = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumns({f"{c}_so_far": F.sum(c).over(w) for c in columns})


def quality_by_type_and_method(rows: DataFrame) -> DataFrame:
    """Totals by file type, by method, and over all, in one pass."""
    kind, method = F.col("file_type"), F.col("method")
    ok = F.count_if("ok").cast("long")
    return rows.groupingSets([[kind], [method], []], kind, method).agg(F.count(F.lit(1)).alias("total"), ok.alias("successful"), rate(ok.cast("double"), F.count(F.lit(1))).alias("pct"))


def success_rollup(rows: DataFrame, day: str) -> DataFrame:
    ok = F.count_if("ok").cast("long")
    return rows.rollup(day).agg(F.count(F.lit(1)).alias("total"), ok.alias("successful"), rate(ok, F.count(F.lit(1))).alias("pct"))


def provider_health(providers: DataFrame) -> DataFrame:
    """A status for each provider (provider, active, has_key, failures), and the system's from the number that can be used."""
    status = F.when(~F.col("active"), "disabled").when(~F.col("has_key"), "no_api_key").when(F.col("failures") > 3, "unhealthy").when(F.col("failures") > 0, "degraded").otherwise("healthy")
    usable = providers.agg(F.count_if(F.col("active") & F.col("has_key")).alias("usable"))
    system = F.when(F.col("usable") == 0, "critical").when(F.col("usable") == 1, "warning").otherwise("healthy")
    return providers.crossJoin(F.broadcast(usable)).select("provider", status.alias("status"), system.alias("system"))  # one row


def last_rates(events: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Success rate over the last n requests of each key, this one included."""
    return ordinals.over_last(events, key, ("ts", "event_id"), "rate", F.avg(F.col("ok").cast("double")), n)


def streaks(events: DataFrame, key: str) -> DataFrame:
    """Place of each request in its run of equal outcomes."""
    return ordinals.run_places(events, key, ("ts", "event_id"), "streak", "ok")


def request_stats(delays: DataFrame, key: str, n: int = 10, kept: int = 50) -> DataFrame:
    """Of each key's last `kept` requests: how many, and success rate and mean delay of the last n. delays: (key, event_id, outcome, delay_used), ids in order."""
    w = Window.partitionBy(key).orderBy(F.desc("event_id"))
    last = delays.withColumn("back", F.row_number().over(w)).where(F.col("back") <= kept)
    recent = F.col("back") <= n
    return last.groupBy(key).agg(F.count(F.lit(1)).alias("total"), F.avg(F.when(recent, (F.col("outcome") == "success").cast("double"))).alias("success_rate"), F.avg(F.when(recent, F.col("delay_used"))).alias("mean_delay"))
