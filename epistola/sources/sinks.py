"""Sinks: mails by day, flat CSV tables, JSON envelopes, HTML reports, and a chain of sinks."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import settle


def by_folder(rows: DataFrame, column: str) -> DataFrame:
    """Rows brought together by a folder's column, so that a folder isn't given a file by every task; AQE splits a folder that is too large for one."""
    return rows.hint("rebalance", column)


def write_mails(mails: DataFrame, path: str) -> None:
    """Mails by day. The days of this run replace what was there of them, so that a run which is repeated leaves no mail twice."""
    by_folder(mails, "date_folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_folder").json(path)


def write_extracted(texts: DataFrame, path: str) -> DataFrame:
    """Writes the extracted texts (day, file_name, method, confidence, success, text) by day, and returns the report of each day: files, successes, their share and mean confidence."""
    texts = settle(texts, "extracted")
    by_folder(texts.where("success"), "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").json(path)
    ok = F.count_if("success").cast("long")
    return texts.groupBy("day").agg(F.count(F.lit(1)).alias("files"), ok.alias("successful"), F.try_divide(ok * F.lit(100.0), F.count(F.lit(1))).alias("pct"), F.avg(F.when(F.col("success"), F.col("confidence"))).alias("confidence"))


def write_new_attachments(files: DataFrame, manifest: DataFrame, path: str) -> DataFrame:
    """Stores the files (date_folder, original_filename, content) that the manifest lacks, and returns what was stored."""
    new = files.join(manifest.select("date_folder", "original_filename").distinct(), ["date_folder", "original_filename"], "left_anti")
    new = settle(new, "new-attachments")  # worked out once, for the store and for the list
    by_folder(new, "date_folder").write.mode("append").partitionBy("date_folder").parquet(path)
    return new.select("date_folder", "original_filename")


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True)


def write_envelope(rows: DataFrame, path: str, exported: str) -> None:
    """A JSON line {export_info, data} for each row, so that a large export isn't one document."""
    rows.select(F.to_json(F.struct(F.struct(F.lit(exported).alias("exported_at")).alias("export_info"), F.struct(*rows.columns).alias("data"))).alias("value")).write.mode("overwrite").text(path)


def html_report(summary: DataFrame, title: str, most: int = 10_000) -> str:
    """A table of a small aggregate, which is collected; one of more than `most` rows is an error, as a report that leaves rows out would mislead."""
    rows = summary.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    cells = lambda tag, row: "".join(f"<{tag}>{html.escape(str(x))}</{tag}>" for x in row)
    body = "".join(f"<tr>{cells('td', r)}</tr>" for r in rows)
    return f"<html><head><title>{html.escape(title)}</title></head><body><table><tr>{cells('th', summary.columns)}</tr>{body}</table></body></html>"


def first_that_works(rows: DataFrame, *sinks) -> int:
    """Writes rows to the first sink that doesn't fail, and tells which; the last failure is raised."""
    for at, sink in enumerate(sinks):
        try:
            sink(rows)
            return at
        except Exception:
            if at == len(sinks) - 1:
                raise
    raise ValueError("no sink given")


def write_stats(counters: DataFrame, path: str) -> None:
    """A one-row aggregate as one JSON line."""
    counters.coalesce(1).write.mode("overwrite").json(path)


def write_tabs(tabs: dict[str, DataFrame], path: str) -> None:
    """Each tab as a CSV table of its own; runs append, as rows of a spreadsheet would."""
    for name, rows in tabs.items():
        rows.write.mode("append").csv(f"{path}/{name}", header=True)


def export_range(spine: DataFrame, results: DataFrame, path: str) -> DataFrame:
    """Writes the results of a range of days, by day, and tells for each day whether there were any."""
    wanted = settle(results.join(spine, "day", "left_semi"), "export-range")
    by_folder(wanted, "day").write.mode("overwrite").partitionBy("day").json(path)
    found = wanted.groupBy("day").agg(F.count(F.lit(1)).alias("rows"))
    return spine.join(found, "day", "left").select("day", F.coalesce("rows", F.lit(0)).alias("rows"), F.col("rows").isNotNull().alias("ok"))
