"""Operator 9: URL rules by host-suffix and path-prefix expressions.

Every distinct URL is expanded into its host suffixes (at label borders) times
its path prefixes, both only of lengths that some rule has: an expression of
another length cannot equal a rule. Expressions meet rules in an equi-join on
the first eight hex digits of their SHA-256; the full digest then confirms the
match, and the longest rule wins. Only built-in functions are used.

Defined results: a null URL or one without ``://`` has empty host and path; a
URL that no rule fits gets no rule and the verdict ``default``; equal rules
with both verdicts count as ``block``; rules with a null part never fit.
Repeated pages are judged once per distinct URL and all come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stash

PREFIX_HEX = 8
# Letters of the contract's lower-casing (ASCII only).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url):
    """(host, path) columns of a URL column, as the module text defines them."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict``; a path begins with ``/``.
    """
    usable = rules.filter("host is not null and path is not null and verdict is not null")
    keyed = usable.groupBy("host", "path").agg(F.max("verdict").alias("__verdict")).select(
        F.concat("host", "path").alias("__rule"), "__verdict",
        F.length("host").alias("__hlen"), F.length("path").alias("__plen"),
        F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("__digest"))
    keyed = stash(keyed.withColumn("__prefix", F.substring("__digest", 1, PREFIX_HEX)), "url-rules")
    lengths = keyed.agg(F.sort_array(F.collect_set("__hlen")), F.sort_array(F.collect_set("__plen"))).first()
    h_lens = F.array(*[F.lit(n) for n in lengths[0]]).cast("array<int>")
    p_lens = F.array(*[F.lit(n) for n in lengths[1]]).cast("array<int>")

    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    # The verdict depends on the URL alone: every distinct one is expanded once.
    distinct = rows.filter("host <> '' or path <> ''").select("url", "host", "path").distinct()
    size = F.length("host")
    suffixes = F.filter(h_lens, lambda n: (n == size) | ((n < size) & (F.substr("host", size - n, F.lit(1)) == ".")))
    prefixes = F.filter(p_lens, lambda n: n <= F.length("path"))
    expressions = (distinct
                   .withColumn("__h", F.explode(F.transform(suffixes, lambda n: F.substr("host", size - n + 1, n))))
                   .withColumn("__p", F.explode(F.transform(prefixes, lambda n: F.substr("path", F.lit(1), n))))
                   .withColumn("__full", F.sha2(F.concat_ws("\n", "__h", "__p"), 256))
                   .withColumn("__prefix", F.substring("__full", 1, PREFIX_HEX)))
    hits = expressions.join(keyed, "__prefix").filter("__full = __digest")
    best = hits.groupBy("url").agg(F.max(F.struct(F.length("__rule").alias("n"), F.col("__hlen").alias("h"),
                                                  F.col("__rule").alias("rule"), F.col("__verdict").alias("verdict"))).alias("__best"))
    best = stash(best.select(F.col("url").alias("__url"), F.col("__best.rule").alias("rule"),
                             F.col("__best.verdict").alias("verdict")), "url-verdicts")
    # Rows without a URL meet nothing and stay out of the join.
    # The verdicts grow with the distinct URLs: both sides are sorted, a hot URL is split by adaptive execution.
    some = rows.filter("url is not null").join(best.hint("merge"), F.col("url") == F.col("__url"), "left").drop("__url")
    none = rows.filter("url is null").withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    return some.unionByName(none).withColumn("verdict", F.coalesce("verdict", F.lit(default)))
