"""URL allow and block rules as a sort-merge range join, in DataFrame functions only.

A host is written as its labels in reverse order, each followed by a dot:
``blog.example.net`` becomes ``net.example.blog.``. The hosts a rule fits (its
own and all subdomains) are then exactly the keys with the rule's key as a
prefix, which is the interval [``net.example.``, ``net.example/``) of the byte
order, as "/" follows "." directly. Intervals of rules nest or are disjoint.

1. Rules: each boundary (start or end of an interval) gets the stack of rules
   that are active from there on: the rule itself and the rules around it at a
   start, only the rules around it at an end.
2. Sweep: the distinct host keys and the boundaries are dealt to sorted ranges
   (``repartitionByRange``); within a range a running ``last`` carries the stack
   of the latest boundary forward, and ranges hand their last stack on.
3. Each url looks up its host's stack, keeps the rules whose path starts its own
   path, and takes the longest.

Only distinct hosts are swept, so a host that holds a third of all urls is one
row there. The final join is by host and left to Spark, which splits a hot key.
No rule is broadcast by hand, so the rule table may grow too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windlass.llm.common import width, write_table

HOSTS_PER_RANGE = 500_000
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEFAULT_VERDICT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """(verdict, rule) pairs as a DataFrame."""
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, rule string")


def host_of(url):
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    rest = F.coalesce(F.substring_index(_after_scheme(url), "/", 1), F.lit(""))
    return F.translate(F.substring_index(F.substring_index(rest, "?", 1), "#", 1), _UPPER, _LOWER)


def path_of(url):
    """From the end of the host up to "?", "#" or the end."""
    before = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    slash = F.locate("/", before)
    return F.coalesce(F.when(slash > 0, before.substr(slash, F.length(before))), F.lit(""))


def _after_scheme(url):
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_key(host):
    """Labels in reverse order, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def interval_end(key):
    """The smallest string above all keys with this prefix."""
    return F.concat(key.substr(F.lit(1), F.length(key) - 1), F.lit("/"))


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, stack): from ``key`` on, the rules of ``stack`` are active.

    A rule's host has a bounded number of labels, so the rules around it are
    found by joining its label prefixes, and no group of rules is collected
    beyond one host's nesting.
    """
    slash = F.locate("/", "rule")
    r = rules.select("rule", "verdict", F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER).alias("host"),
                     F.when(slash > 0, F.col("rule").substr(slash, F.length("rule"))).otherwise(F.lit("")).alias("path"))
    r = r.filter(F.col("rule").isNotNull()).withColumn("key", host_key(F.col("host")))
    entry = F.struct(F.length("rule").alias("size"), "rule", "path", "verdict")
    at_host = r.groupBy("key").agg(F.collect_set(entry).alias("own"))
    labels = F.split("key", r"\.", -1)  # the last one is empty
    prefix = F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                         lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit(".")))
    around = (at_host.select("key", F.explode(prefix).alias("outer"))
              .join(at_host.select(F.col("key").alias("outer"), "own"), "outer"))
    stacks = around.groupBy("key").agg(
        F.flatten(F.collect_list("own")).alias("inside"),
        F.flatten(F.collect_list(F.when(F.col("outer") != F.col("key"), F.col("own")))).alias("outside"))
    starts = stacks.select("key", F.lit(1).alias("kind"), F.col("inside").alias("stack"))
    ends = stacks.select(interval_end(F.col("key")).alias("key"), F.lit(0).alias("kind"), F.col("outside").alias("stack"))
    return starts.unionByName(ends)


def host_stacks(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, stack) for distinct hosts: the sweep over the sorted keys."""
    spark = hosts.sparkSession
    edges = boundaries(rules)
    points = hosts.select(host_key(F.col("host")).alias("key"), F.lit(2).alias("kind"), "host")
    events = edges.withColumn("host", F.lit(None).cast("string")).unionByName(points, allowMissingColumns=True)
    ranges = width(spark, hosts.count(), HOSTS_PER_RANGE)
    # the copy fixes which range a row is in before the ranges are read twice
    swept = write_table(events.repartitionByRange(ranges, "key").withColumn("rng", F.spark_partition_id()), "url-sweep")
    # one row per range; the window over them holds as many rows as there are ranges
    last = swept.filter("kind < 2").groupBy("rng").agg(F.max_by("stack", F.struct("key", "kind")).alias("stack"))
    edge = (swept.select("rng").distinct().join(last, "rng", "left")
            .select("rng", F.last("stack", ignorenulls=True).over(
                Window.orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)).alias("carried")))
    running = F.last("stack", ignorenulls=True).over(
        Window.partitionBy("rng").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0))
    return (swept.withColumn("active", running).filter("kind = 2").join(edge, "rng", "left")
            .select("host", F.coalesce("active", "carried").alias("stack")).filter("size(stack) > 0"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict.

    A rule ``host/path`` fits its host and all subdomains if the url's path
    starts with the rule's; the longest fitting rule decides (ties: the smaller
    string), else ``default`` with a null rule. A null url, or one without
    "://", has an empty host and path and no rule. A host with a port, user or
    trailing dot is taken as written. Repeated rows are judged each; ids may be
    null; other columns are not read; an empty table gives an empty result, and
    without rules every url gets the default.
    """
    url = F.col(url_col).cast("string")
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    stacks = host_stacks(urls.select("host").distinct(), rules)
    joined = urls.join(stacks, "host", "left")
    fits = F.filter(F.col("stack"), lambda r: F.col("path").startswith(r["path"]))
    best = F.sort_array(F.transform(fits, lambda r: F.struct((-r["size"]).alias("size"), r["rule"].alias("rule"),
                                                             r["verdict"].alias("verdict")))).getItem(0)
    return (joined.withColumn("best", F.when(F.size(fits) > 0, best))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


ORACLE_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u
), r(verdict, rule, host, path) AS (VALUES
  ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), f AS (
  SELECT p.page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN f USING (page_id)
"""
