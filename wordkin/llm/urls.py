"""URL filters as a sort-merge range join over reversed-host keys. DataFrame operations only.

The canonical key of a host is its labels in reverse order, each ended by a dot: ``a.example.net`` is
``net.example.a.``. A rule for a host then covers one interval of keys, and the intervals of two rules
are nested or apart. Rules and hosts are sorted together; sweeping along the sorted keys, each rule row
carries the stack of the rules around it, and a host takes over the stack of the last rule before
it, without those whose interval has ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordkin.operators.skew import broadcast_if_small
from wordkin.storage import pin

#: what a url gets that no rule fits
DEFAULT_VERDICT = "allow"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse order, each ended by a dot; the empty host has the key ``.``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """``key, stack`` of each host that has a rule: the rules of the host and of the hosts around it.

    ``rules`` has ``host, path, verdict``. A host has few hosts around it, one per label, so that they
    are found by an equi-join on the shorter keys. Of two rules with equal host and path, ``block`` counts.
    """
    rules = rules.groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    own = rules.withColumn("key", host_key(F.col("host"))).withColumn(
        "rule", F.struct(F.length(F.concat("host", "path")).alias("size"), F.concat("host", "path").alias("name"), "path", "verdict", "key"))
    own = pin(own.groupBy("key").agg(F.collect_list("rule").alias("own")), "url-rules")
    labels = F.split(F.col("key"), r"\.")
    around = own.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))).alias("outer"))
    found = around.join(own.select(F.col("key").alias("outer"), "own"), "outer")
    return found.groupBy("key").agg(F.flatten(F.collect_list("own")).alias("stack"))


def sweep_hosts(keys: DataFrame, stacks: DataFrame) -> DataFrame:
    """``key, stack`` of each key in ``keys`` that lies within a rule's interval.

    Range partitions of the sorted keys are swept side by side. What the sweep would bring along from the
    partitions before is one stack per partition.
    """
    events = keys.select("key", F.lit(1).alias("is_host"), F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack")).unionByName(
        stacks.select("key", F.lit(0).alias("is_host"), "stack"))
    placed = pin(events.repartitionByRange("key", "is_host").sortWithinPartitions("key", "is_host")
                 .withColumn("block", F.shiftright(F.monotonically_increasing_id(), 33)), "url-sweep")
    # a row per partition that has a rule at all
    ends = placed.where("is_host = 0").groupBy("block").agg(F.max_by("stack", "key").alias("end"))
    blocks = placed.select("block").distinct().join(ends, "block", "left")
    carried = blocks.select("block", F.last("end", ignorenulls=True).over(
        W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))
    here = F.last("stack", ignorenulls=True).over(W.partitionBy("block").orderBy("key", "is_host").rowsBetween(W.unboundedPreceding, W.currentRow))
    swept = placed.withColumn("last", here).where("is_host = 1")
    swept = swept.join(broadcast_if_small(pin(carried, "url-carried")), "block", "left")
    active = F.filter(F.coalesce("last", "carried"), lambda r: F.col("key").startswith(r["key"]))
    return swept.select("key", active.alias("stack")).where(F.size("stack") > 0)


def filter_urls(pages: DataFrame, rules: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep, host, path, rule, verdict`` of every row of ``pages`` (``url``) under ``rules`` (``host, path, verdict``).

    A rule fits its host and all subdomains if the path starts with the rule's; the longest of
    them gives the verdict, else ``DEFAULT_VERDICT``. Null urls and those without ``://`` have an empty host and
    path, which only a rule with an empty host fits. Equal urls are judged alike. Each host is looked up
    once, however many pages it has, and hot hosts are split when the pages get their host's rules.
    """
    parsed = pages.select(*keep, url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    hosts = parsed.select("host").distinct().withColumn("key", host_key(F.col("host")))
    hosts = pin(hosts, "url-hosts")
    stacks = pin(sweep_hosts(hosts.select("key").distinct(), pin(rule_stacks(rules), "url-stacks")), "url-stacks-of-hosts")
    of_host = hosts.join(stacks, "key").select(F.col("host").alias("_host"), "stack")
    of_host = broadcast_if_small(pin(of_host, "url-stack-of-host").withColumn("stack", F.col("stack")))
    fits = F.filter("stack", lambda r: F.col("path").startswith(r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["size"].alias("size"), r["verdict"].alias("verdict"), r["name"].alias("name"))))
    return parsed.join(of_host, F.col("host") == F.col("_host"), "left").withColumn("_best", best).select(
        *keep, "host", "path", F.col("_best.name").alias("rule"), F.coalesce("_best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))
