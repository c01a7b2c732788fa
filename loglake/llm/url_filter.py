"""URL filters: rules by host and path, and a list of canonical URLs behind a blocked Bloom filter.

The filter has blocks of eight 64-bit words; a URL sets one bit of each word of one block, so a test
reads one row. Its size has a fixed bound, so it goes to every task whatever the list's length. URLs
that pass it are possible hits, and only they meet the list in an exact hash join, which removes the
false ones. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.bloom import with_possible
from loglake.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that only tell where a visitor came from.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def url_host(url: Column) -> Column:
    """What stands after the first ``://``, up to a slash, question mark or hash, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to a question mark or hash."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without closing slashes, query sorted and without tracking.

    Scheme and fragment do not count. Null where there is no host.
    """
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^www\.", ""), r":(80|443)$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.sort_array(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    path = F.regexp_replace(url_path(url), "/+$", "")
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def listed_urls(urls: DataFrame, listed: DataFrame, max_blocks: int = 1 << 17) -> DataFrame:
    """``urls`` (with ``canonical``) and ``listed`` boolean: whether the list has it.

    A null ``canonical`` is not listed. A listed URL that makes up a large part of ``urls`` is split
    by AQE's skew join.
    """
    listed = stored(listed.select("canonical").filter(F.col("canonical").isNotNull()).distinct(), "listed")
    tested = with_possible(urls, listed, "canonical", max_blocks)
    exact = tested.filter("possible").join(listed.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left")
    return (
        exact.select(*urls.columns, F.coalesce("listed", F.lit(False)).alias("listed"))
        .unionByName(tested.filter(~F.col("possible")).select(*urls.columns, F.lit(False).alias("listed")))
    )


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, else null.

    ``rules`` are ``(verdict, "host/path")``. A rule fits its host and all subdomains where the path
    starts with its own. Of equally long rules the first counts.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], max_blocks: int = 1 << 17) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, listed`` of every page.

    The verdict is the rule's; without one, a listed URL is blocked and any other allowed. A null url
    or one without ``://`` has empty host and path, no rule, and is allowed. Repeated rows stay; other
    columns are ignored; an empty table gives no rows, an empty list blocks nothing.
    """
    parts = pages.select(
        "page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
        canonical_url(F.col("url")).alias("canonical"))
    judged = listed_urls(parts, listed, max_blocks).withColumn("by", rule_for(F.col("host"), F.col("path"), rules))
    return judged.select(
        "page_id", "url", "host", "path", F.col("by.rule").alias("rule"),
        F.coalesce(F.col("by.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
