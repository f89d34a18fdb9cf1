"""URL filters: host and path rules, and a list of blocked URLs.

Method: listed URLs are canonical strings.  A blocked Bloom filter (one 512-bit
block per hash, eight bits set in it) of the list passes possible hits to an
exact hash join, which removes the false positives.

Scale: the filter has at most ``MAX_BLOCKS`` blocks of 64 bytes whatever the
list's size -- a longer list lets more rows through to the exact join, it never
grows the broadcast.  Only possible hits are shuffled.  Rules are a short list
given by the caller and become one ordered expression.

Defined cases: a url that is null or has no ``://`` has empty host and path,
fits no rule, has no canonical form and is allowed; repeated urls are judged
alike; an empty list or table is fine; extra columns don't take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.bloom import bloom_filter, with_possible
from churnspark.llm.common import ascii_lower
from churnspark.session import materialize

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: First host labels whose pages make up the blocked list of the query.
BAD_SITES = ("ads-track", "casino-win", "spam-farm", "adult-x", "cheap-pills", "free-bets")


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: Column, host: Column, path: Column) -> Column:
    """host without ``www.`` or ``m.``, path without closing ``/`` or
    ``.html``; scheme, query and fragment don't count.  Null without a host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"(\.html|/)$", "")))


def site_of(host: Column) -> Column:
    """First label of the host, after ``www.``, ``m.`` or ``blog.``."""
    return F.regexp_extract(host, r"^(?:(?:www|m|blog)\.)?([^.]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as ``host/path``, verdict) of the longest rule that fits."""
    name = says = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = (F.when if name is None else name.when)(fits, F.lit(h + p))
        says = (F.when if says is None else says.when)(fits, F.lit(v))
    none = F.lit(None).cast("string")
    return (none if name is None else name), (none if says is None else says)


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, canonical, listed, possible (passed the
    Bloom filter).  ``listed`` has one column ``canonical``."""
    url = F.col(url_col)
    parsed = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    keyed = parsed.withColumn("canonical", canonical(F.col("url"), F.col("host"), F.col("path"))).drop("url")
    wanted = materialize(listed.select("canonical").where("canonical IS NOT NULL").distinct(), "listed_urls")
    blocks, n_blocks = bloom_filter(wanted, "canonical")
    tested = with_possible(keyed, F.col("canonical"), blocks, n_blocks)
    exact = tested.where("possible").join(wanted.withColumn("listed", F.lit(True)), "canonical", "left")
    both = exact.withColumn("listed", F.coalesce("listed", F.lit(False))).unionByName(
        tested.where("NOT possible").withColumn("listed", F.lit(False)))
    name, says = matching_rule(F.col("host"), F.col("path"), rules)
    return both.select("page_id", "host", "path", name.alias("rule"),
                       F.coalesce(says, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
                       "canonical", "listed", "possible")


def blocked_list(pages: DataFrame, sites=BAD_SITES, url_col: str = "url") -> DataFrame:
    """Canonical URLs of the pages on bad sites."""
    url = F.col(url_col)
    parts = pages.select(url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    return (parts.where(site_of(F.col("host")).isin(*sites))
            .select(canonical(F.col("url"), F.col("host"), F.col("path")).alias("canonical")))
