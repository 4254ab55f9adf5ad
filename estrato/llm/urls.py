"""URL verdicts by host-suffix and path-prefix expressions.

Every rule and every URL becomes short text expressions ``host suffix + path prefix``. An expression is known by its
SHA-256 digest. The join runs on the first bytes of the digest; the full digest, the whole path of the rule and the
precedence of rules are settled afterwards. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import ascii_lower

PREFIX_HEX = 8  # hex digits of the digest that the join runs on: 4 bytes


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(rest, F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _directory(path: Column) -> Column:
    """``path`` up to and including its last slash."""
    return F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)))


def _host_suffixes(host: Column, most: Column) -> Column:
    """Every suffix of ``host`` that starts at a label, of at most ``most`` labels; none for an empty host."""
    labels = F.split(host, r"\.")
    count = F.least(F.size(labels), most)
    suffixes = F.transform(F.sequence(F.lit(1), count), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    return F.when((host != "") & (count >= 1), suffixes).otherwise(F.array().cast("array<string>"))


def _path_prefixes(path: Column, most: Column) -> Column:
    """The empty prefix and every prefix of ``path`` that ends in a slash, of at most ``most`` slashes."""
    pieces = F.split(path, "/")
    count = F.least(F.size(pieces) - 1, most)
    prefixes = F.transform(
        F.sequence(F.lit(1), count), lambda n: F.concat(F.array_join(F.slice(pieces, F.lit(1), n), "/"), F.lit("/"))
    )
    empty = F.array(F.lit(""))
    return F.when(count >= 1, F.concat(empty, prefixes)).otherwise(empty)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, the longest fitting rule as text, and the verdict.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains when the URL's path
    starts with the rule's path. The longest rule text wins, then the longer host, then ``block`` before other verdicts.
    Without a fitting rule ``rule`` is null and the verdict ``default``. A null URL or one without ``://`` has an
    empty host and path, which no rule fits. Repeated rows are judged each; other columns of ``pages`` are not read.
    An empty ``pages`` gives an empty result; without rules every page gets ``default``.

    URLs are first counted per (id, host, path), which a hot URL does not outgrow. Expressions are made only up to the
    depth that some rule has. The rules meet them in an equi-join: a small rule table is broadcast by Spark behind its
    size threshold; a larger one is shuffled, each rule copied to the slices over which a hot expression is spread.
    """
    rules = rules.select(
        ascii_lower(F.col("host")).alias("rule_host"),
        F.coalesce(F.col("path"), F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    ).where("rule_host != ''")
    depth = rules.agg(
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.max(F.size(F.split(_directory(F.col("rule_path")), "/")) - 1).alias("slashes"),
    ).first()
    labels, slashes = F.lit(depth.labels or 0), F.lit(depth.slashes or 0)

    url = F.col(url_column)
    urls = (
        pages.select(F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
        .groupBy("id", "host", "path")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    expressions = F.flatten(
        F.transform(
            _host_suffixes(F.col("host"), labels),
            lambda host: F.transform(_path_prefixes(F.col("path"), slashes), lambda path: _digest(host, path)),
        )
    )
    slices = F.sequence(F.lit(0), F.lit(15))
    asked = (
        urls.withColumn("digest", F.explode_outer(expressions))
        .withColumn("slice", F.pmod(F.xxhash64("id", "path"), F.lit(16)).cast("int"))
        .withColumn("short", F.left("digest", F.lit(PREFIX_HEX)))
    )
    known = (
        rules.withColumn("rule_digest", _digest(F.col("rule_host"), _directory(F.col("rule_path"))))
        .withColumn("short", F.left("rule_digest", F.lit(PREFIX_HEX)))
        .withColumn("slice", F.explode(slices))
    )
    fits = (F.col("digest") == F.col("rule_digest")) & F.startswith(F.col("path"), F.col("rule_path"))
    text = F.concat("rule_host", "rule_path")
    rank = F.struct(
        F.length(text).alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("rule_verdict") == "block").alias("blocks"),
        text.alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = (
        asked.join(known, ["short", "slice"], "left")
        .groupBy("id", "host", "path", "copies")
        .agg(F.max(F.when(fits, rank)).alias("best"))
    )
    return best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
