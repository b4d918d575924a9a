"""URL filtering: a blocked Bloom filter in front of an exact hash join.

Lists hold keys: a *rule* key is a (host, path prefix) with an action, a
*listed* key is a canonical URL that is blocked. Both kinds are folded into
one blocked Bloom filter, a table of 512-bit blocks (eight 64-bit words): a
key's first hash names its block, the second sets one bit in each word. A
URL's candidate keys (each host suffix x each rule path length, and its
canonical form) probe the filter by an equi-join on the block; what passes is
joined exactly with the lists, so false positives change no result.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. A rule fits its
host and all subdomains if the path starts with the rule's; the longest rule
wins, else a listed canonical URL is blocked and any other allowed.

Canonical form: lower-cased host without ``www.`` and default port, the path
without a trailing slash, the query's parameters sorted without tracking ones
(``utm_*``, ``ref``, ``fbclid``, ``gclid``), no scheme, no fragment.

Defined cases: a null url or one without ``://`` has an empty host and path
and no canonical form, fits no rule and is allowed. Equal urls get equal rows
(a row per page, repeated rows included). Empty tables or lists: nothing is
blocked. All expressions are built in; a hot url or block is met once, as
lookups run on distinct urls.

Scale: the filter costs ``bits_per_key`` bits a key and is broadcast only
while its measured size is at most ``broadcast_blocks`` blocks; beyond that
it is a shuffled join on the block number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import table
from skuflow.session import materialize

# The rules of the registered query, as (host, path prefix, action).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_KEY = 16
WORDS = 8
BROADCAST_BLOCKS = 1 << 15  # 2 MB of filter


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"(?s)\A[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"(?s)\A[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"\Awww\.", ""), r":(?:80|443)\z", "")
    query = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"(?s)\A[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"\A(?:utm_[a-z]+|ref|fbclid|gclid)(?:=|\z)"))
    tail = F.array_join(F.array_sort(kept), "&")
    return F.when(F.instr(url, "://") > 0,
                  F.concat(host, F.regexp_replace(path_of(url), r"/+\z", ""),
                           F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(F.lit(""))))


def rule_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("r:"), host, path)


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(n_blocks))


def _masks(key: Column) -> list[Column]:
    h = F.xxhash64(F.lit(2), key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def blocked_bloom(keys: DataFrame, n_keys: int, bits_per_key: int = BITS_PER_KEY) -> tuple[DataFrame, int]:
    """``keys`` (key) -> (filter table: block, w0..w7; number of blocks)."""
    n_blocks = max(1, math.ceil(n_keys * bits_per_key / (64 * WORDS)))
    own = keys.select(_block(F.col("key"), n_blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("key")))])
    return own.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]), n_blocks


def bloom_hits(keys: DataFrame, bloom: DataFrame, n_blocks: int, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """Rows of ``keys`` (with a column key) that the filter may hold."""
    probe = keys.withColumn("__block", _block(F.col("key"), n_blocks))
    side = bloom.withColumnRenamed("block", "__block")
    if n_blocks <= broadcast_blocks:
        side = F.broadcast(side)
    hit = F.lit(True)
    for i, m in enumerate(_masks(F.col("key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) == m)
    return probe.join(side, "__block").where(hit).drop("__block", *[f"w{i}" for i in range(WORDS)])


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """``pages`` (page_id, url), ``rules`` (host, path, action), ``listed`` (canonical)
    -> page_id, url, host, path, canonical, rule (host and path of the rule that won,
    without its first slash kept as written), listed (boolean), verdict."""
    rules = rules.select(rule_key(F.col("host"), F.col("path")).alias("key"), F.concat("host", "path").alias("rule"),
                         "action", (F.length("host") + F.length("path")).alias("rule_length"), F.length("path").alias("path_length"))
    listed = listed.where("canonical is not null").select(F.concat(F.lit("u:"), "canonical").alias("key")).distinct()
    entries = materialize(
        rules.select("key", "rule", "action", "rule_length", "path_length")
        .unionByName(listed.select("key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("action"),
                                   F.lit(None).cast("int").alias("rule_length"), F.lit(None).cast("int").alias("path_length"))),
        "url-entries")
    facts = entries.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("path_length")).alias("lengths")).first()
    bloom, n_blocks = blocked_bloom(entries.select("key"), facts["n"])

    urls = pages.select(F.col("url").cast("string").alias("url")).where("url is not null").distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("canonical"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    by_rule = F.flatten(F.transform(suffixes, lambda s: F.filter(
        F.array(*[F.when(F.length("path") >= n, rule_key(s, F.substring("path", 1, n))) for n in facts["lengths"]]).cast("array<string>"),
        lambda k: k.isNotNull())))
    keys = F.concat(by_rule, F.filter(F.array(F.concat(F.lit("u:"), "canonical")), lambda k: k.isNotNull()))
    hits = bloom_hits(urls.select("url", F.explode(keys).alias("key")), bloom, n_blocks, broadcast_blocks)
    small = facts["n"] <= broadcast_blocks
    exact = hits.join(F.broadcast(entries) if small else entries, "key")
    best = exact.groupBy("url").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct("rule_length", "rule", "action"))).alias("best"),
        F.max(F.col("rule").isNull()).alias("on_list"))
    out = (pages.select(F.col("page_id").alias("page_id"), F.col("url").cast("string").alias("url")).join(best, "url", "left"))
    return out.select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        canonical(F.col("url")).alias("canonical"), F.col("best.rule").alias("rule"), F.coalesce("on_list", F.lit(False)).alias("listed"),
        F.coalesce(F.col("best.action"), F.when(F.col("on_list"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def refetched(pages: DataFrame) -> DataFrame:
    """The list of the registered query: canonical URLs that more than one page row carries."""
    return (pages.select(canonical(F.col("url").cast("string")).alias("canonical")).where("canonical is not null")
            .groupBy("canonical").count().where("count > 1").select("canonical"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(list(RULES), "host string, path string, action string")
    return filter_urls(pages, rules, refetched(pages)).select("page_id", "host", "path", "rule", "verdict", "listed")


def _oracle() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
    return rf"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (
  SELECT page_id, contains(coalesce(url, ''), '://') AS good, coalesce(rest, '') AS rest,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
canon AS (
  SELECT *, CASE WHEN good THEN
    regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') ||
    coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&'), ''), '') END AS canonical FROM cut),
rules(rhost, rpath, action) AS (VALUES {rules}),
won AS (
  SELECT c.page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(action, length(rhost || rpath)) AS action
  FROM canon c JOIN rules r ON (c.host = rhost OR c.host LIKE '%.' || rhost) AND starts_with(c.path, rpath) GROUP BY ALL),
many AS (SELECT canonical FROM canon WHERE canonical IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT c.page_id, c.host, c.path, w.rule, m.canonical IS NOT NULL AS listed,
  coalesce(w.action, CASE WHEN m.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM canon c LEFT JOIN won w USING (page_id) LEFT JOIN many m USING (canonical)"""


ORACLE_OP7 = _oracle()
