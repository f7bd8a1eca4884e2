"""URL filter: sort-merge range join of urls with prefix rules (DataFrame functions only).

A rule (host, path, verdict) becomes the interval of all keys that begin with
its key ``reversed host + path``; a url becomes one key for its host and one
for each parent domain.  One sorted sweep over rule openings, urls and rule
closings keeps the stack of active rules: the running depth names the stack's
height, and the last rule opened at that height is its top.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import ascii_lower, stage_table

#: (host, path, verdict); fixed values
DEFAULT_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT_VERDICT = "allow"
RULE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "verdict")])

_OPEN, _URL, _CLOSE = 0, 1, 2


def rules_table(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], RULE_SCHEMA)


def url_parts(url):
    """(host, path) of a url: both empty where it is null or has no ``://``; A-Z of the host in lower case."""
    rest = F.when(F.locate("://", url) > 0, F.expr("1")).isNotNull()
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(after, r"^([^/?#]*)", 1))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return (F.when(rest, host).otherwise(F.lit("")), F.when(rest, path).otherwise(F.lit("")))


def _reversed(labels):
    return F.array_join(F.reverse(labels), ".")


def _events(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (key, kind, rid, delta, rule): openings and closings of rules, and the urls' keys."""
    labels = F.split("host", r"\.", -1)
    opened = rules.select(F.concat(_reversed(labels), F.col("path")).cast("binary").alias("key"),
                          F.struct("host", "path", "verdict").alias("rule"))
    start = opened.select("key", F.lit(_OPEN).alias("kind"), F.lit(-1).cast("long").alias("rid"),
                          F.lit(1).cast("long").alias("delta"), "rule")
    none = F.lit(None).cast(start.schema["rule"].dataType)
    # 0xFF is in no UTF-8 text: it closes an interval after every key that begins with the rule's
    stop = opened.select(F.concat("key", F.lit(b"\xff")).alias("key"), F.lit(_CLOSE).alias("kind"),
                         F.lit(-1).cast("long").alias("rid"), F.lit(-1).cast("long").alias("delta"), none.alias("rule"))
    deepest = rules.agg(F.max(F.size(labels))).first()[0] or 1
    n = F.size("labels")
    keys = (urls.select("rid", "path", F.split("host", r"\.", -1).alias("labels"))
            .select("rid", "path", "labels", F.explode(F.sequence(F.lit(1), F.least(n, F.lit(deepest)))).alias("k"))
            .select(F.concat(_reversed(F.slice("labels", n - F.col("k") + 1, F.col("k"))), F.col("path"))
                    .cast("binary").alias("key"),
                    F.lit(_URL).alias("kind"), "rid", F.lit(0).cast("long").alias("delta"), none.alias("rule")))
    return start.unionByName(stop).unionByName(keys)


def _sweep(events: DataFrame) -> DataFrame:
    """(rid, rule) of every url key: the top of the rule stack where the key stands in sorted order.

    Rows are range-partitioned on (key, kind, rid), so many rows of one key
    spread over parts; each part sweeps its rows, and what is open when a part
    begins comes from one row per part and depth.
    """
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "kind", "rid"]
    dealt = stage_table(events.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "sweep")
    sums = dealt.groupBy("part").agg(F.sum("delta").alias("d"))
    carried = F.sum("d").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))  # one row per part
    before = sums.select("part", carried.alias("__c_below"))
    run = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    deep = (dealt.join(before, "part")
            .withColumn("depth", F.coalesce("__c_below", F.lit(0)) + F.sum("delta").over(run)))
    at = W.partitionBy("part", "depth").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    top = deep.withColumn("top", F.last("rule", ignorenulls=True).over(at))
    opened = deep.filter(F.col("kind") == _OPEN).groupBy("part", "depth").agg(
        F.max_by("rule", F.struct(*order)).alias("last"))
    asked = deep.select("part", "depth").distinct()
    carry = asked.join(opened, ["part", "depth"], "left").select("part", "depth", F.last("last", ignorenulls=True).over(
        W.partitionBy("depth").orderBy("part").rowsBetween(W.unboundedPreceding, -1)).alias("carry"))
    return (top.filter(F.col("kind") == _URL).join(carry, ["part", "depth"])
            .select("rid", F.when(F.col("depth") > 0, F.coalesce("top", "carry")).alias("rule")))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains where the url's path starts with
    the rule's path; the longest rule (host and path together, then host) wins;
    without one the verdict is ``default`` and the rule null.  Of rules with
    equal host and path ``block`` counts.  Null urls and urls without ``://``
    have empty host and path and fit no rule; repeated rows are judged each;
    no pages give no rows, no rules the default for all; other columns are not
    read.
    """
    rules = rules.filter("host is not null and path is not null").select(
        ascii_lower(F.col("host")).alias("host"), "path", "verdict").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    host, path = url_parts(F.col(url_col))
    urls = stage_table(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                                    F.monotonically_increasing_id().alias("rid")), "urls")
    found = _sweep(_events(urls.filter("host <> '' or path <> ''"), rules)).filter("rule is not null")
    size = F.length("rule.host") + F.length("rule.path")
    best = found.groupBy("rid").agg(F.max(F.struct(size.alias("n"), F.length("rule.host").alias("h"), "rule")).alias("best"))
    return urls.join(best, "rid", "left").select(
        "page_id", "host", "path", F.concat("best.rule.host", "best.rule.path").alias("rule"),
        F.coalesce("best.rule.verdict", F.lit(default)).alias("verdict"))
