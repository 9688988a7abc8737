"""Allow and block rules for URLs by hashed host-suffix and path-prefix expressions.

A rule is a host and a path, like ``example.com/de/``. It fits its host and all subdomains if the URL's path starts
with the rule's path.

1. Each distinct (host, path) is expanded into expressions: every suffix of the host that begins at a label, with every
   prefix of the path that ends in a slash, and with the empty one. Suffixes and prefixes deeper than any rule's are left out; they fit none.
2. The expressions are joined with the rules on the first four bytes of their SHA-256, which is short and cheap to
   compare; the full digests of the few that meet are then compared, and what a rule's path has after its last slash.
3. Of the rules that fit a URL the longest (host and path together) wins; then the longer host, then block before
   allow. The winners go back to the rows by (host, path).

All in DataFrame functions. Rules are broadcast only if there are few enough; a URL that makes up a third of all rows is
expanded once, and the join that takes the winners back is one that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import Scratch, broadcast_if_small, col

#: The letters of host names.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of the digest that expressions and rules are joined on.
PREFIX_BYTES = 4


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url.cast("string"), "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url.cast("string"), "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _folder(path: Column) -> Column:
    """A path up to its last slash."""
    return F.regexp_extract(path, "(?s)^(.*/)?", 0)


def _hash(host: Column, folder: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), folder), 256))


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, PREFIX_BYTES)


def rule_table(rules: DataFrame, host: str = "host", path: str = "path", verdict: str = "verdict") -> DataFrame:
    """Rules ready to be joined. Rules without a host or verdict fit nothing; a null path counts as empty; repeated rules as one."""
    host, path = F.translate(col(host), UPPER, LOWER), F.coalesce(col(path), F.lit(""))
    own = rules.select(host.alias("rule_host"), path.alias("rule_path"), F.lower(col(verdict)).alias("rule_verdict")).filter("rule_host is not null and rule_host != '' and rule_verdict is not null").distinct()
    own = own.withColumn("digest", _hash(F.col("rule_host"), _folder(F.col("rule_path")))).withColumn("prefix", _prefix(F.col("digest")))
    return own.withColumn("labels", F.size(F.split("rule_host", "\\."))).withColumn("slashes", F.size(F.split("rule_path", "/")) - 1)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of these names are replaced.

    ``rule`` is the winning rule's host and path, null where none fits; the verdict is then ``default``. Null
    URLs and those without ``://`` have empty host and path, which no rule fits. Rows are neither dropped nor folded.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    known = scratch.stage(rule_table(rules))
    count, labels, slashes = known.agg(F.count(F.lit(1)), F.coalesce(F.max("labels"), F.lit(0)), F.coalesce(F.max("slashes"), F.lit(0))).first()
    rest = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    own = pages.select(*[col(c) for c in rest], url_host(col(url)).alias("host"), url_path(col(url)).alias("path"))

    hosts = F.split("host", "\\.")
    folders = F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(hosts), F.lit(max(labels, 1)))), lambda n: F.array_join(F.slice(hosts, F.size(hosts) - n + 1, n), "."))
    deepest = F.least(F.size(folders) - 1, F.lit(slashes))
    prefixes = F.transform(F.sequence(F.lit(0), deepest), lambda n: F.when(n == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(folders, 1, F.greatest(n, F.lit(1))), "/"), F.lit("/"))))
    distinct = own.select("host", "path").filter("host != ''").distinct()
    expressions = (
        distinct.withColumn("suffix", F.explode(suffixes))
        .withColumn("folder", F.explode(prefixes))
        .withColumn("url_digest", _hash(F.col("suffix"), F.col("folder")))
        .withColumn("prefix", _prefix(F.col("url_digest")))
    )
    met = expressions.join(broadcast_if_small(known.drop("labels", "slashes"), count, 512), "prefix")
    fits = met.filter((F.col("digest") == F.col("url_digest")) & F.col("path").startswith(F.col("rule_path")))
    rank = F.struct(
        (F.char_length("rule_host") + F.char_length("rule_path")).alias("size"),
        F.char_length("rule_host").alias("host_size"),
        (F.col("rule_verdict") == "block").alias("is_block"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    winners = scratch.stage(fits.groupBy("host", "path").agg(F.max(rank).alias("best")).select("host", "path", "best.rule", "best.verdict"))
    judged = own.join(winners, ["host", "path"], "left")
    return judged.select(*[col(c) for c in rest], "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The allowed rows of ``pages``, judged as in :func:`judge_urls`."""
    return judge_urls(pages, rules, url, default).filter("verdict = 'allow'")
