"""URL filter: host-suffix and path-prefix expressions, short-hash equi-join.

Every URL is expanded into (host suffix, path prefix) expressions, the first
four bytes of the SHA-256 of each expression are joined with those of the
rules, and a candidate counts only if the full digests agree. The fitting
rule with the longest expression decides (ties: block over allow); a URL
that no rule fits gets the method's default verdict.

Only expressions of a shape that a rule has are made: a shape is a number of
host labels with a number of path slashes (rules that end in ``/``) or with a
path length (others), so a URL of any length costs one digest a shape. URLs
that are equal are judged once, so a hot URL is one row before the join; a hot host only
repeats expressions, each of which meets at most the few rules that share
its digest.

Edge cases: a null URL, or one without ``://``, has empty host and path and
gets the default verdict; repeated rows stay repeated; an empty table gives
an empty result; extra columns of the input are not carried (the result has
the key column, url, host, path, rule, verdict).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules beyond this many are joined by shuffle instead of broadcast.
BROADCAST_RULES = 100_000
PREFIX_BYTES = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _split(df: DataFrame, url: str) -> DataFrame:
    """Adds __h (host, A-Z lower-cased) and __p (path) of a URL column."""
    df = df.withColumn("__u", F.coalesce(F.col(url).cast("string"), F.lit("")))
    df = df.withColumn("__at", F.instr("__u", "://"))
    df = df.withColumn("__rest", F.when(F.col("__at") > 0, F.expr("substring(__u, __at + 3)")).otherwise(F.lit("")))
    df = df.withColumn("__h", F.regexp_extract("__rest", r"^([^/?#]*)", 1))
    df = df.withColumn("__p", F.expr("regexp_extract(substring(__rest, char_length(__h) + 1), '^([^?#]*)', 1)"))
    return df.withColumn("__h", F.translate("__h", _UPPER, _LOWER))


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """(prefix, digest, size, rule, verdict) of (host, path, verdict) rules."""
    return (rules.where("host is not null and path is not null and verdict in ('allow', 'block')")
            .select(_digest(F.col("host"), F.col("path")).alias("__digest"),
                    (F.char_length("host") + F.char_length("path")).alias("__size"),
                    F.concat("host", "path").alias("rule"), "verdict",
                    F.struct(F.size(F.split("host", r"\.")).alias("labels"), F.col("path").endswith("/").alias("slash"),
                             F.when(F.col("path").endswith("/"), F.size(F.split("path", "/")) - 1)
                              .otherwise(F.char_length("path")).alias("n")).alias("__shape"))
            .withColumn("__key", F.substring("__digest", 1, 2 * PREFIX_BYTES)).distinct())


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
                default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: key, url, host, path, rule, verdict."""
    table = rule_table(rules)
    stats = table.agg(F.count("*").alias("n"), F.collect_set("__shape").alias("shapes")).first()
    base = _split(pages.select(F.col(key).alias("__k"), F.col(url).alias("__url")), "__url")
    rows = (base.groupBy("__k", "__url").agg(F.count("*").alias("__n"),
                                             F.first("__h").alias("__h"), F.first("__p").alias("__p")))
    labels, parts = F.split("__h", r"\."), F.split("__p", "/")

    def expression(shape):
        n = shape["n"]
        host = F.array_join(F.slice(labels, F.greatest(F.size(labels) - shape["labels"] + 1, F.lit(1)), shape["labels"]), ".")
        path = F.when(~shape["slash"] & (F.char_length("__p") >= n), F.substring("__p", F.lit(1), n)).when(
            shape["slash"] & (F.size(parts) > n), F.concat(F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/")))
        return F.when(F.size(labels) >= shape["labels"], _digest(host, path))

    shapes = [F.struct(F.lit(s["labels"]).alias("labels"), F.lit(s["slash"]).alias("slash"), F.lit(s["n"]).alias("n"))
              for s in sorted(stats["shapes"])]
    exprs = F.array_compact(F.transform(F.array(*shapes), expression)) if shapes else F.array().cast("array<string>")
    wide = (rows.withColumn("__digest", F.explode_outer(exprs))
            .withColumn("__key", F.substring("__digest", 1, 2 * PREFIX_BYTES)))
    right = table.select("__key", F.col("__digest").alias("__full"), "__size", "rule", "verdict")
    if stats["n"] <= BROADCAST_RULES:
        right = F.broadcast(right)
    found = (wide.join(right, "__key", "left")
             .withColumn("__hit", F.when(F.col("__digest") == F.col("__full"),
                                         F.struct("__size", (F.col("verdict") == "block").alias("b"), "rule",
                                                  "verdict")))
             .groupBy("__k", "__url", "__h", "__p", "__n").agg(F.max("__hit").alias("__best")))
    return found.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(
        F.col("__k").alias(key), F.col("__url").alias(url), F.col("__h").alias("host"), F.col("__p").alias("path"),
        F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict"))
