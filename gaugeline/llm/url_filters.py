"""URL filters as a sort-merge range join, in DataFrame operations only.

A rule (host, path) fits its host and all subdomains when the url's path starts with the rule's.
Under the reversed host, ``org.example/es/``, everything a rule fits below one host is an interval of
keys, and the intervals of nested rules nest.  A url has one key for each of its host's parents that carries
a rule, so a rule of a parent is met there.

The keys of urls and rules are sorted together, range by range.  The sweep's stack of active rules is
carried by the rules themselves: every rule holds the rules that enclose it, innermost first.  At a url's key the
stack on top is that of the last rule started before it; the rules that have ended are those that the key does not start
with, and the first that is left is the longest fit.

A host that many urls share is dealt into ``lanes`` sorted ranges by a hash of the path, with its rules in each of them; there
are as many lanes as shuffle partitions, and ``LANES`` at least.
"""

from pyspark.sql import Column, DataFrame, functions as F, Window

#: Fixed values of the query: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
LANES = 32


def rule_table(spark, rules) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def url_host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for a null url or one without ://."""
    at = F.locate("://", url)
    host = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def url_path(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    at = F.locate("://", url)
    rest = F.regexp_replace(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", "")
    return F.when(at > 0, F.regexp_extract(rest, r"^[^?#]*", 0)).otherwise("")


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _stacks(rules: DataFrame) -> DataFrame:
    """Rules with the rules of the same host that enclose them, themselves first: found by their path's prefixes."""
    lengths = F.sequence(F.lit(0), F.length("path"))
    prefixes = rules.select("host", "path", F.explode(lengths).alias("k")).select("host", "path", F.expr("substring(path, 1, k)").alias("prefix"))
    outer = rules.select("host", F.col("path").alias("prefix"), "verdict")
    stack = F.reverse(F.array_sort(F.collect_list(F.struct(F.length("prefix").alias("n"), F.col("prefix").alias("path"), "verdict"))))
    return prefixes.join(outer, ["host", "prefix"]).groupBy("host", "path").agg(stack.alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", lanes: int | None = None, keep=("page_id",)) -> DataFrame:
    """Per row of ``pages``: the ``keep`` columns, host, path, rule, verdict.

    The longest fitting rule (host and path together) decides, ``default`` where none fits.  Of rules with equal host and path
    block wins; a rule with a null part is left out.  A null or malformed url has an empty host and path and no rule.  Host and path
    of repeated urls are judged once.  A kept column may not be named host, path, rule or verdict.
    """
    lanes = lanes or max(LANES, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    given = pages.select(*keep, url_host(F.col("url").cast("string")).alias("host"), url_path(F.col("url").cast("string")).alias("path"))
    rules = rules.dropna().groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    stacks = _stacks(rules)
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    urls = given.select("host", "path").where("host <> ''").distinct()
    below = urls.select(F.col("host").alias("url_host"), "path", F.explode(parents).alias("host"))
    below = below.join(rules.select("host").distinct(), "host", "left_semi")
    lane = F.pmod(F.xxhash64("path"), F.lit(lanes))
    points = below.select(_reversed(F.col("host")).alias("top"), "host", "path", "url_host", lane.alias("lane"), F.lit(1).alias("kind"), F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"))
    starts = stacks.select(_reversed(F.col("host")).alias("top"), "host", "path", F.lit(None).cast("string").alias("url_host"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"), F.lit(0).alias("kind"), "stack")
    sweep = Window.partitionBy("top", "lane").orderBy("path", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = points.unionByName(starts).withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    fit = F.get(F.filter("active", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    hit = at.select("url_host", "path", "host", fit.alias("fit")).where("fit IS NOT NULL")
    best = hit.groupBy(F.col("url_host").alias("host"), "path").agg(
        F.max(F.struct((F.length("host") + F.length("fit.path")).alias("n"), F.concat("host", "fit.path").alias("rule"), F.col("fit.verdict").alias("verdict"))).alias("best"))
    return given.join(best, ["host", "path"], "left").select(*keep, "host", "path", F.col("best.rule").alias("rule"),
                                                             F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
