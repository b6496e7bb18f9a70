"""The engine's logical tables over the driver's tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mails(spark, sf_dir) -> DataFrame:
    """documents as mails: subject, sender, and a day by id."""
    d = table(spark, sf_dir, "documents")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    return d.select("doc_id", F.col("text").alias("body"), F.substring("text", 1, 60).alias("subject"), F.concat("source", F.lit("@"), "lang", F.lit(".example.com")).alias("sender"), day.alias("day"), "lang", "source", "n_chars")


MAILS = """mails AS (SELECT doc_id, text AS body, substr(text, 1, 60) AS subject, source || '@' || lang || '.example.com' AS sender,
  CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS day, lang, source, n_chars FROM documents)"""


def contacts(spark, sf_dir) -> DataFrame:
    """customer and supplier as contacts with repeated and missing keys; ord gives their order."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("city"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").alias("ord"), F.col("c_nationkey").alias("nk"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), (F.col("s_suppkey") + 1000000000).alias("ord"), F.col("s_nationkey").alias("nk"), F.col("s_acctbal").alias("bal"), F.lit("SUPPLY").alias("seg"))
    return c.unionByName(s).join(n, "nk").selectExpr(
        "ord",
        "CASE WHEN k % 11 = 0 THEN NULL ELSE concat('Name ', CASE WHEN k % 2 = 0 THEN ' ' ELSE '' END, k % 900) END AS name",
        "CASE WHEN k % 5 = 0 THEN '' WHEN k % 17 = 0 THEN 'not an address' ELSE concat(lower(replace(seg, ' ', '')), k % 300, '@example.com') END AS email",
        "CASE WHEN k % 3 = 0 THEN NULL WHEN k % 2 = 0 THEN concat('8-495-', lpad(k % 500, 3, '0'), '-12-34') ELSE concat('+7 (495) ', lpad(k % 500, 3, '0'), '-12-34') END AS phone",
        "CASE WHEN k % 7 = 0 THEN concat('Org ', k % 40, ' International') ELSE concat('Org ', k % 40) END AS organization",
        "CASE WHEN k % 6 = 0 THEN 'Sales Manager' WHEN k % 6 = 1 THEN 'Director' ELSE 'clerk' END AS position",
        "city",
        "CASE WHEN k % 13 = 0 THEN 'n/a' ELSE cast((k % 101) / 100.0D AS string) END AS confidence",
        "bal", "nk",
    )


CONTACTS = """base AS (SELECT c_custkey AS k, c_custkey AS ord, c_nationkey AS nk, c_acctbal AS bal, c_mktsegment AS seg FROM customer
  UNION ALL SELECT s_suppkey, s_suppkey + 1000000000, s_nationkey, s_acctbal, 'SUPPLY' FROM supplier),
contacts AS (SELECT ord,
  CASE WHEN k % 11 = 0 THEN NULL ELSE 'Name ' || CASE WHEN k % 2 = 0 THEN ' ' ELSE '' END || (k % 900) END AS name,
  CASE WHEN k % 5 = 0 THEN '' WHEN k % 17 = 0 THEN 'not an address' ELSE lower(replace(seg, ' ', '')) || (k % 300) || '@example.com' END AS email,
  CASE WHEN k % 3 = 0 THEN NULL WHEN k % 2 = 0 THEN '8-495-' || lpad(CAST(k % 500 AS VARCHAR), 3, '0') || '-12-34' ELSE '+7 (495) ' || lpad(CAST(k % 500 AS VARCHAR), 3, '0') || '-12-34' END AS phone,
  CASE WHEN k % 7 = 0 THEN 'Org ' || (k % 40) || ' International' ELSE 'Org ' || (k % 40) END AS organization,
  CASE WHEN k % 6 = 0 THEN 'Sales Manager' WHEN k % 6 = 1 THEN 'Director' ELSE 'clerk' END AS position,
  n_name AS city, CASE WHEN k % 13 = 0 THEN NULL ELSE (k % 101) / CAST(100.0 AS DOUBLE) END AS conf, bal, nk
  FROM base JOIN nation ON nk = n_nationkey)"""


def attachments(spark, sf_dir) -> DataFrame:
    """part as attachments: names that meet every rule, sizes around every threshold."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_partkey % 97 AS mail_id",
        """concat(CASE p_partkey % 9 WHEN 0 THEN 'image' WHEN 1 THEN 'logo' WHEN 2 THEN '~image' WHEN 3 THEN 'Scan ' WHEN 4 THEN 'contract_' WHEN 5 THEN 'signature' WHEN 6 THEN 'draft-' WHEN 7 THEN 'icon' ELSE 'report ' END,
           lpad(p_partkey % 30, 3, '0'), CASE p_partkey % 8 WHEN 0 THEN '.png' WHEN 1 THEN '.PDF' WHEN 2 THEN '.docx' WHEN 3 THEN '.gif' WHEN 4 THEN '.zip' WHEN 5 THEN '.jpg' WHEN 6 THEN '.xlsx' ELSE '.dat' END) AS name""",
        "CASE WHEN p_partkey % 50 = 0 THEN 83509L ELSE p_size * 1000L + p_partkey % 7 END AS size",
        "p_partkey % 10 = 3 AS inline", "CASE WHEN p_partkey % 77 = 0 THEN '416x250' END AS shape", "p_partkey % 23 = 0 AS known",
    )


ATTACHMENTS = """attachments AS (SELECT p_partkey AS id, p_partkey % 97 AS mail_id,
  (CASE p_partkey % 9 WHEN 0 THEN 'image' WHEN 1 THEN 'logo' WHEN 2 THEN '~image' WHEN 3 THEN 'Scan ' WHEN 4 THEN 'contract_' WHEN 5 THEN 'signature' WHEN 6 THEN 'draft-' WHEN 7 THEN 'icon' ELSE 'report ' END)
  || lpad(CAST(p_partkey % 30 AS VARCHAR), 3, '0') || (CASE p_partkey % 8 WHEN 0 THEN '.png' WHEN 1 THEN '.PDF' WHEN 2 THEN '.docx' WHEN 3 THEN '.gif' WHEN 4 THEN '.zip' WHEN 5 THEN '.jpg' WHEN 6 THEN '.xlsx' ELSE '.dat' END) AS name,
  CASE WHEN p_partkey % 50 = 0 THEN 83509 ELSE p_size * 1000 + p_partkey % 7 END AS size, p_partkey % 10 = 3 AS inline,
  CASE WHEN p_partkey % 77 = 0 THEN '416x250' END AS shape, p_partkey % 23 = 0 AS known FROM part)"""
#: Sample rules of the queries.
NAME_RULES, SUBJECT_RULES, SENDER_RULES = ["draft-*", "Scan 00[1-5].*", "report 007.docx"], ["the ", "der ", "licensed"], ["src1@*", "*@fr.example.com", "src2@de.example.com"]


def requests(spark, sf_dir) -> DataFrame:
    """events as a request log: a provider by user, seconds, outcome."""
    e = table(spark, sf_dir, "events")
    return e.select((F.col("user_id") % 50).alias("provider"), "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.expr("CASE event_type WHEN 'error' THEN 'rate_limit_error' WHEN 'click' THEN 'timeout' WHEN 'signup' THEN 'other_error' ELSE 'success' END").alias("outcome")).withColumns({"ok": F.col("outcome") == "success", "ts": F.col("us") / F.lit(1e6)})


REQUESTS = """requests AS (SELECT user_id % 50 AS provider, event_id, epoch_us(ts) AS us, CASE event_type WHEN 'error' THEN 'rate_limit_error' WHEN 'click' THEN 'timeout' WHEN 'signup' THEN 'other_error' ELSE 'success' END AS outcome,
  event_type NOT IN ('error', 'click', 'signup') AS ok, epoch_us(ts) / CAST(1e6 AS DOUBLE) AS ts FROM events)"""


def orders(spark, sf_dir) -> DataFrame:
    """orders as processed mails: a day, a score within [0, 1], whether it went well."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), F.expr("(o_orderkey % 101) / 100.0D").alias("score"), (F.col("o_orderstatus") != "P").alias("ok"), "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))


ORDERS = """mailed AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, (o_orderkey % 101) / CAST(100.0 AS DOUBLE) AS score, o_orderstatus <> 'P' AS ok, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders)"""
