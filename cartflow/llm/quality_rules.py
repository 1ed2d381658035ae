"""Quality rules on documents and, through shrunk failure rates, on their hosts.

Each document gets its rule counts from column expressions.  Rule failures
are summed per host (``source``), every host's rate is shrunk towards the
corpus with an empirical beta prior, and a host whose shrunk rate passes
``max_rate`` under any rule takes its documents with it.

Null or empty texts have no words and fail the length rule.  Null hosts form
one host of their own.  Repeated rows are judged alike and all returned;
other columns of the input are ignored.

An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, words, written

RULES = ("short", "repetitive", "symbols", "dup_lines")


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the rule counts of ``text``.

    A word lies in a repeated window when the 64-bit hashes of some three-word
    window over it occur twice in the document.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    plain = F.length(F.regexp_replace(t, SPACES, ""))
    out = docs.select(
        "*", words(t).alias("_w"), plain.cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("_lines"))
    windows = F.transform(
        F.slice("_w", F.lit(1), F.greatest(F.size("_w") - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("p")))
    out = out.select("*", F.array_sort(windows).alias("_s"))
    again = F.filter("_s", lambda x, i: (x["h"] == F.get("_s", i - 1)["h"]) | (x["h"] == F.get("_s", i + 1)["h"]))
    out = out.select("*", F.array_sort(F.transform(again, lambda x: x["p"])).alias("_p"))
    covered = F.transform("_p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_p", i + 1) - p, F.lit(3))))
    return out.select(
        "*", F.size("_w").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"),
    ).drop("_w", "_lines", "_s", "_p")


def rule_failures() -> dict:
    n = F.col("n_words")
    return {
        "short": n < 50,
        "repetitive": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
    }


def host_rates(counts: DataFrame) -> DataFrame:
    """Rule failures per host and their rates under the fitted prior.

    The beta prior of a rule is fitted to the hosts' raw rates by their mean
    and variance; hosts that do not differ are all shrunk to the mean.
    """
    fails = rule_failures()
    hosts = counts.groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"),
        *[F.sum(fails[r].cast("long")).alias(f"{r}_fails") for r in RULES])
    hosts = written(hosts, "host-failures")
    rate = {r: F.col(f"{r}_fails") / F.col("host_docs") for r in RULES}
    prior = hosts.agg(*[f(rate[r]).alias(f"{r}_{k}") for r in RULES
                        for k, f in (("mean", F.avg), ("var", F.var_pop))]).first()
    shrunk = []
    for r in RULES:
        mean, var = prior[f"{r}_mean"] or 0.0, prior[f"{r}_var"] or 0.0
        if var <= 1e-12 or mean * (1 - mean) <= var:
            value = F.lit(float(mean)) if var <= 1e-12 else rate[r]
        else:
            strength = mean * (1 - mean) / var - 1
            value = (F.col(f"{r}_fails") + F.lit(mean * strength)) / (F.col("host_docs") + F.lit(strength))
        shrunk.append(value.alias(f"{r}_rate"))
    return hosts.select("host", "host_docs", *shrunk)


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
          max_rate: float = 0.5) -> DataFrame:
    """Counts, base verdict, host verdict and ``kept`` per document."""
    counts = text_counts(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"),
                                     F.col(host).alias("host"))).drop("text")
    counts = written(counts, "rule-counts")
    hosts = host_rates(counts).select(
        F.col("host").alias("_host"),
        F.greatest(*[F.col(f"{r}_rate") for r in RULES]).alias("host_rate"))
    hosts = written(hosts, "host-verdicts")
    fails = rule_failures()
    base = fails["short"] | fails["repetitive"]
    bad = F.coalesce(F.col("host_rate"), F.lit(0.0)) > max_rate
    # Hosts with nulls meet by their null flag and text, so that one plain equi-join serves all.
    joined = counts.join(hosts, (F.coalesce("host", F.lit("")) == F.coalesce("_host", F.lit("")))
                         & (F.isnull("host") == F.isnull("_host")), "left")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base.alias("base_failed"), bad.alias("host_failed"), (~base & ~bad).alias("kept"))


JUDGE_SQL = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
c AS (
  SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         row_number() OVER () AS rn FROM d),
win AS (
  SELECT rn, p, w[p] AS a, w[p+1] AS b, w[p+2] AS e
  FROM (SELECT rn, w, unnest(range(1, len(w) - 1)) AS p FROM c WHERE len(w) >= 3)),
rep AS (SELECT rn, p FROM (SELECT rn, p, count(*) OVER (PARTITION BY rn, a, b, e) AS n FROM win) WHERE n > 1),
cov AS (SELECT rn, count(DISTINCT q) AS n_repeat FROM (SELECT rn, unnest([p, p+1, p+2]) AS q FROM rep) GROUP BY rn),
k AS (
  SELECT c.doc_id, c.host, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words
  FROM c LEFT JOIN cov USING (rn)),
f AS (
  SELECT *, (n_words < 50)::INT AS f1, (100 * n_repeat_words > 50 * n_words)::INT AS f2,
         (10 * n_symbols > word_chars)::INT AS f3, (100 * n_dup_lines > 30 * n_lines)::INT AS f4 FROM k),
h AS (SELECT host, count(*) AS n, sum(f1) AS k1, sum(f2) AS k2, sum(f3) AS k3, sum(f4) AS k4 FROM f GROUP BY host),
r AS (SELECT host, n, unnest([k1, k2, k3, k4]) AS k, unnest([1, 2, 3, 4]) AS rule FROM h),
m AS (SELECT rule, avg(k / n) AS mean, var_pop(k / n) AS var FROM r GROUP BY rule),
s AS (
  SELECT host, max(CASE WHEN var <= 1e-12 THEN mean WHEN mean * (1 - mean) <= var THEN k / n
    ELSE (k + mean * (mean * (1 - mean) / var - 1)) / (n + mean * (1 - mean) / var - 1) END) AS rate
  FROM r JOIN m USING (rule) GROUP BY host)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, f1 + f2 > 0 AS base_failed,
       rate > 0.5 AS host_failed, f1 + f2 = 0 AND NOT rate > 0.5 AS kept
FROM f JOIN s ON f.host IS NOT DISTINCT FROM s.host
"""
