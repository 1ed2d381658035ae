"""URL verdicts: host and path rules first, then a list of blocked URLs.

The listed canonical URLs are hashed into a blocked Bloom filter: a table of
512-bit blocks, one row per block that has bits.  A page looks at one block
only; pages whose bits are all set go on to an exact join with the list,
which removes the filter's false positives.  The filter is broadcast only
when its size, known from its block count, is within ``broadcast_bytes``;
beyond that both joins shuffle on their keys.

Null URLs and URLs without ``://`` have an empty host and path, match no rule
and are allowed.  Repeated pages are judged alike.

An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, written

WORDS = 8       # 64-bit words in a block
PROBES = 8      # bits set for each URL, one in each word
URLS_PER_BLOCK = 40

TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without its last slash, query without tracking parameters, sorted.

    Scheme and fragment are dropped; a URL without a host has no canonical form (null).
    """
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    text = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), r"/$", ""),
                    F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return F.when(host_of(url) != "", text)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as struct(length, rule, verdict); null when none fits.

    ``rules`` is a short list of (verdict, ``host/path``).
    """
    fits = []
    for verdict, rule in rules:
        rule_host, _, rest = rule.partition("/")
        own = (host == rule_host) | host.endswith("." + rule_host)
        fits.append(F.when(own & path.startswith("/" + rest),
                           F.struct(F.lit(len(rule)).alias("len"), F.lit(rule).alias("rule"),
                                    F.lit(verdict).alias("verdict"))))
    if not fits:
        return F.lit(None).cast("struct<len:int,rule:string,verdict:string>")
    return F.array_max(F.array(*fits))


def bloom_words(canon: Column) -> list[Column]:
    """The bit that a URL sets in each 64-bit word of its block: six bits of a second hash for each."""
    h = F.xxhash64(canon, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def bloom_block(canon: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(canon), F.lit(blocks))


def build_bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """One row (block, w0..w7) for each block with a listed URL; partial sums of bits combine before the shuffle."""
    bits = bloom_words(F.col("canon"))
    rows = listed.select(bloom_block(F.col("canon"), blocks).alias("block"),
                         *[b.alias(f"w{i}") for i, b in enumerate(bits)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge_urls(pages: DataFrame, listed_urls: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id",
               url: str = "url", listed_col: str = "url", broadcast_bytes: int = 8 << 20) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, listed) for all ``pages``."""
    spark = pages.sparkSession
    listed = written(listed_urls.select(canonical(F.col(listed_col)).alias("canon"))
                     .where(F.col("canon").isNotNull()).distinct(), "listed-urls")
    blocks = max(1, -(-listed.count() // URLS_PER_BLOCK))
    bloom = build_bloom(listed, blocks)
    if blocks * 8 * (WORDS + 1) <= broadcast_bytes:
        bloom = F.broadcast(bloom)
    u = F.col(url)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(u).alias("host"), path_of(u).alias("path"),
                        canonical(u).alias("canon"))
    rows = rows.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules)) \
        .withColumn("block", bloom_block(F.col("canon"), blocks))
    all_set = F.lit(True)
    for i, b in enumerate(bloom_words(F.col("canon"))):
        all_set = all_set & (F.col(f"w{i}").bitwiseAND(b) == b)
    probed = rows.join(bloom, "block", "left").select(
        "page_id", "host", "path", "fit", "canon", F.coalesce(all_set, F.lit(False)).alias("possible"))
    probed = written(probed, "probed-urls")
    hits = probed.where("possible").join(listed.select("canon", F.lit(True).alias("listed")), "canon", "left")
    rest = probed.where("not possible").withColumn("listed", F.lit(False))
    both = hits.unionByName(rest).withColumn("listed", F.coalesce("listed", F.lit(False)))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return both.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "listed")


# Fixed values of the registered query: its rules, and the sites whose pages make up its list.
PAGE_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
              ("allow", "com/fr/"), ("block", "com/de/")]
LISTED_SITES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def listed_pages(pages: DataFrame, url: str = "url") -> DataFrame:
    """The list of the registered query: URLs of pages on the listed sites."""
    site = r"(^|\.)(" + "|".join(LISTED_SITES) + r")\."
    return pages.where(host_of(F.col(url)).rlike(site)).select(url)


PAGES_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                           THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, rest,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
          lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS q FROM u),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '') ||
        CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS canon FROM p),
l AS (SELECT DISTINCT canon FROM c WHERE regexp_matches(host,
        '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.')),
r(verdict, rule) AS (VALUES ('allow','org/'), ('block','example.org/es/'), ('block','example.org/en/1'),
        ('allow','com/fr/'), ('block','com/de/')),
s AS (SELECT verdict, rule, regexp_extract(rule, '^[^/]*') AS rh, regexp_extract(rule, '/.*$') AS rp FROM r),
f AS (SELECT page_id, rest, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS rv
      FROM (SELECT DISTINCT c.page_id, c.rest, s.rule, s.verdict FROM c JOIN s
            ON (c.host = s.rh OR ends_with(c.host, '.' || s.rh)) AND starts_with(c.path, s.rp)) GROUP BY ALL)
SELECT c.page_id, c.host, c.path, f.rule, coalesce(rv, CASE WHEN l.canon IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       l.canon IS NOT NULL AS listed
FROM c LEFT JOIN f ON c.page_id IS NOT DISTINCT FROM f.page_id AND c.rest = f.rest LEFT JOIN l ON c.canon = l.canon
"""
