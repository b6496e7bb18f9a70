"""Sources: dated mail folders, rule files, extracted texts, results, attachment files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import MAIL

EXTENSIONS = "*.{pdf,doc,docx,xls,xlsx,png,jpg,jpeg,tiff}"


def mails(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, lines: bool = False) -> DataFrame:
    """Mail records below path/date_folder=YYYY-MM-DD; a range prunes folders. Files that aren't JSON are left out.

    A file is one mail, or with `lines` what `sinks.write_mails` writes, a mail in each line.
    """
    reader = spark.read.schema(f"{MAIL}, date_folder date").option("multiLine", not lines).option("mode", "DROPMALFORMED")
    rows = reader.json(path, pathGlobFilter="*.json" if lines else "email_*.json")
    if first is not None:
        rows = rows.where(F.col("date_folder") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("date_folder") <= F.lit(last).cast("date"))
    return rows.withColumn("json_file_path", F.col("_metadata.file_path"))


def days(spark: SparkSession, path: str) -> DataFrame:
    """The days that there are mails of, in order, from the listing alone: no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return listed.select(F.col("date_folder").cast("date").alias("date_folder")).distinct().orderBy("date_folder")


def rules(spark: SparkSession, path: str, lower: bool = True) -> list[str]:
    """The rules of a text file, which people write: blank lines, comments and **** go."""
    lines = spark.read.text(path).select(F.trim("value").alias("r")).where("r != '' and not startswith(r, '#') and r != '****'")
    return sorted({r["r"].lower() if lower else r["r"] for r in lines.collect()})


def attachments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", EXTENSIONS).option("recursiveFileLookup", True).load(path)


def audit(spark: SparkSession, path: str) -> DataFrame:
    """Number and bytes of all files; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def cached_texts(spark: SparkSession, path: str) -> DataFrame:
    """(stem, method, text, confidence) from files `stem___method.txt`; a header ends with a line of `# ===`."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*___*.txt").select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.txt$", 1).alias("name"), F.col("value").alias("raw"))
    return files.select(F.regexp_extract("name", r"^(.*)___", 1).alias("stem"), F.concat(F.regexp_extract("name", r"___(.*)$", 1), F.lit("_cached")).alias("method"), F.regexp_replace("raw", r"(?s)^.*?# ===[^\n]*\n\n?", "").alias("text"), F.lit(1.0).alias("confidence"))


def results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path, pathGlobFilter="llm_analysis_*.json")
