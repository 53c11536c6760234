"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import LOWER, UPPER, ascii_lower, require

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
RULE_SCHEMA = "verdict string, host string, path string"
#: Hex digits of a digest that the join compares; the full digest is compared after it.
PREFIX_DIGITS = 8
#: Rules up to this number go to every task; more are joined by a shuffle.
FEW_RULES = 100_000
DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(found), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A host holds no slash, so the joined text is one to one.
    return F.sha2(F.concat(host, F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/\n"), path))), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` with host, path, rule and verdict, from ``rules`` (verdict, host, path).

    A rule fits its host and all subdomains when the path starts with its path. The longest rule
    (host and path together) decides, of equally long ones that with the longer host, and of one
    rule given twice the block. Without a rule the verdict is ``default`` and the rule null.

    Each distinct (host, path) is expanded once: host suffixes by numbers of labels, and path
    prefixes by lengths, that occur among the rules, so an expression list is bounded by the rules'
    own shapes. Expressions meet rules by an equi-join on the first digits of their digests alone: a row of
    that table has all rules whose digests begin so, and among these the full digest confirms. Up to FEW_RULES
    rules, counted first, are broadcast, so that expressions without a rule never leave their task.

    Nulls: a null url, or one without ``://``, has empty host and path. Rules with a null host,
    path or verdict never fit. Empty tables give no rows; without rules all take the default.
    Repeated pages stay. Extra columns stay; those named like a result are refused.
    """
    names = {"host", "path", "rule", "verdict"}
    if clash := [c for c in pages.columns if c.lower() in names or c.lower().startswith("_url_")]:
        raise ValueError(f"columns clash with the result: {clash}")
    parted = pages.withColumns({"host": url_host(pages["url"]), "path": url_path(pages["url"])})
    clean = rules.select("verdict", ascii_lower(F.col("host")).alias("host"), "path").where(
        F.col("verdict").isNotNull() & F.col("host").isNotNull() & F.col("path").isNotNull())
    listed = clean.groupBy("host", "path").agg(F.max("verdict").alias("_url_verdict")).select(
        "_url_verdict", F.concat("host", "path").alias("_url_rule"),
        F.length("host").alias("_url_host"),
        _digest(F.col("host"), F.col("path")).alias("_url_full"),
    )
    # Rules are distinct, and a short digest of eight digits is shared by a few of them at most.
    listed = listed.groupBy(F.substring("_url_full", 1, PREFIX_DIGITS).alias("_url_short")).agg(
        F.collect_list(F.struct("_url_full", "_url_rule", "_url_host", "_url_verdict")).alias("_url_listed"))
    # The shapes of rules: as many numbers as the longest rule has labels and code points, at most.
    shapes = clean.agg(
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    listed = F.broadcast(listed) if shapes["n"] <= FEW_RULES else listed
    labels = F.array(*[F.lit(n) for n in sorted(shapes["labels"] or [])]).cast("array<int>")
    lengths = F.array(*[F.lit(n) for n in sorted(shapes["lengths"] or [])]).cast("array<int>")
    n_labels = F.size(F.split("host", r"\."))
    suffixes = F.transform(
        F.filter(labels, lambda n: n <= n_labels),
        lambda n: F.when(n == n_labels, F.col("host")).otherwise(
            F.concat_ws(".", F.slice(F.split("host", r"\."), n_labels - n + 1, n))))
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    distinct = parted.select("host", "path").distinct()
    expressions = distinct.withColumn("_url_suffix", F.explode(suffixes)).withColumn(
        "_url_prefix", F.explode(prefixes)
    ).withColumn("_url_own", _digest(F.col("_url_suffix"), F.col("_url_prefix"))).select(
        "host", "path", "_url_own", F.substring("_url_own", 1, PREFIX_DIGITS).alias("_url_short"))
    hits = expressions.join(listed, "_url_short").select(
        "host", "path", F.explode(F.filter("_url_listed", lambda x: x["_url_full"] == F.col("_url_own"))).alias("_url_hit"))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        F.length("_url_hit._url_rule").alias("n"), F.col("_url_hit._url_host").alias("h"),
        F.col("_url_hit._url_rule").alias("rule"), F.col("_url_hit._url_verdict").alias("verdict"))).alias("_url_best"))
    judged = parted.join(best, ["host", "path"], "left")
    return judged.select(
        *[judged[c] for c in pages.columns], "host", "path",
        F.col("_url_best.rule").alias("rule"),
        F.coalesce("_url_best.verdict", F.lit(default)).alias("verdict"),
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages judged: page_id, host, path, rule, verdict."""
    pages = require(spark.read.parquet(f"{sf_dir}/pages.parquet"), ["page_id", "url"])
    rules = spark.createDataFrame([tuple(r) for r in RULES], RULE_SCHEMA)
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = f"""
WITH rules(verdict, host, path) AS (VALUES {", ".join(str(r) for r in RULES)}),
parted AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
urls AS (SELECT DISTINCT host, path FROM parted),
ranked AS (
  SELECT u.host, u.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY u.host, u.path ORDER BY length(r.host || r.path) DESC) AS place
  FROM urls u JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT p.page_id, p.host, p.path, k.rule, coalesce(k.verdict, '{DEFAULT_VERDICT}') AS verdict
FROM parted p LEFT JOIN ranked k ON p.host = k.host AND p.path = k.path AND k.place = 1
"""
