"""URL filters: a sort-merge range join of hosts with nested rules. DataFrame functions only.

A host becomes its labels in reverse order, each closed by a dot (``www.example.com`` -> ``com.example.www.``),
so that "this host and all its subdomains" is the interval from ``com.example.`` up to ``com.example/`` ('/'
follows '.' in byte order). Intervals of rules are nested or apart.

1. Sweep over the rule boundaries in sorted order: at each boundary the stack of open rules is known.
2. Merge: the distinct hosts and the boundaries are range-partitioned and sorted by key; every host takes the stack of
   the last boundary at or before it. What crosses a partition is one boundary each.
3. A url takes its host's stack and, among the rules whose path its path starts with, the longest.

Hosts are reduced to distinct ones before the sort, so a host with a third of all pages is one row there; the join back
is an equi-join that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.operators.positions import SLOT, place

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a url; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _boundaries(rules: DataFrame) -> DataFrame:
    """Every point where the set of open rule hosts changes, with the rules open from there on.

    Columns: key, stack (array of rule structs, outermost host first). Sized by the rules, never by the pages.
    """
    nodes = rules.groupBy(reversed_key(F.col("host")).alias("start")).agg(
        F.collect_list(F.struct("verdict", "host", "path")).alias("own")
    )
    nodes = nodes.withColumn("stop", F.concat(F.expr("left(start, length(start) - 1)"), F.lit("/")))
    points = nodes.select(F.col("start").alias("key")).union(nodes.select(F.col("stop").alias("key"))).distinct()
    # Ancestors of a point are found by its own prefixes: an equi-join per label, no pairing of rules with rules.
    label = F.split(F.regexp_replace("key", r"[./]$", ""), r"\.", -1)
    at = points.withColumn("label", label).withColumn("closes", F.col("key").endswith("/"))
    depth = F.size("label") - F.col("closes").cast("int")  # a closing point lies behind its own subtree
    prefixes = at.select(
        "key", F.explode(F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>"))).alias("n"), "label"
    ).withColumn("start", F.concat(F.array_join(F.slice("label", 1, F.col("n")), "."), F.lit(".")))
    open_rules = prefixes.join(nodes.select("start", "own"), "start").groupBy("key").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n", "own"))), lambda x: x["own"])).alias("stack")
    )
    return points.join(open_rules, "key", "left")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to ``page_id``.

    pages: columns page_id, url (others, whatever their names, are not read). rules: verdict, host, path.
    A null url, an empty one or one without ``://`` has empty host and path, no rule and the default verdict. Repeated rows each
    get their result; no pages give no rows. The longest rule (host and path together) wins, the longer host in a tie.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", F.col("url").cast("string").alias("url")).select(
        "page_id", host.alias("host"), path.alias("path")
    )
    hosts = urls.select("host").distinct()
    events = (
        hosts.select(reversed_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "host")
        .unionByName(_boundaries(rules).select("key", F.lit(0).alias("kind"), "stack"), allowMissingColumns=True)
        .withColumn("point", F.when(F.col("kind") == 0, F.struct("stack")))
    )
    swept = place(events, F.col("key"), F.col("kind"), F.col("host"))
    upto = W.partitionBy(SLOT).orderBy("key", "kind", "host").rowsBetween(W.unboundedPreceding, 0)
    local = swept.select(SLOT, "kind", "host", F.last("point", ignorenulls=True).over(upto).alias("near"))
    last = swept.groupBy(SLOT).agg(F.max_by("point", F.when(F.col("kind") == 0, F.col("key"))).alias("point"))
    earlier = W.orderBy(SLOT).rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    carried = last.select(SLOT, F.last("point", ignorenulls=True).over(earlier).alias("carried"))
    of_host = (
        local.filter("kind = 1")
        .join(carried, SLOT)
        .select("host", F.coalesce("near", "carried")["stack"].alias("stack"))
        .filter("size(stack) > 0")
    )
    fits = F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"]))
    ranked = F.transform(
        fits, lambda r: F.struct((F.length(r["host"]) + F.length(r["path"])).alias("n"), F.length(r["host"]).alias("h"), r.alias("r"))
    )
    best = F.array_max(ranked)["r"]
    judged = urls.join(of_host, "host", "left").withColumn("best", best)
    return judged.select(
        "page_id",
        "host",
        "path",
        F.concat(F.col("best.host"), F.col("best.path")).alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )


def rule_frame(spark, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


_VALUES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
ORACLE = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(verdict, rule_host, rule_path) AS (VALUES {_VALUES}),
fits AS (
  SELECT row_number() OVER () AS n, u.* FROM urls u
)
SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host) + length(rule_path)) AS rule,
       coalesce(arg_max(verdict, length(rule_host) + length(rule_path)), '{DEFAULT}') AS verdict
FROM fits LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY n, page_id, host, path
"""
