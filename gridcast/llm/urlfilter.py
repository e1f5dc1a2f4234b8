"""URL filter: host and path rules, then a list of canonical URLs.

The list is checked in two steps.  A blocked Bloom filter, one row of eight
32-bit words per block, where a URL sets one bit in each word of its block,
is joined by block number and passes the URLs that may be listed; an exact
join by canonical URL removes the false positives.  The filter has at most
``MAX_BLOCKS`` rows whatever the list's size (a fuller filter passes more,
the exact join keeps the result right), so it is broadcast; the list itself
is joined as large as it is.

A rule is an action, a host and a path prefix; it fits its host and all
subdomains.  The longest fitting rule (host and path together) decides;
without one the list does: a listed URL is blocked.

Canonical form: scheme, ``www.``, default port, fragment, tracking
parameters and a trailing slash go, the host is lowered, the other
parameters are sorted.

Cases: a null url, or one without ``://``, has an empty host and path, fits
no rule and is never listed; repeated rows are judged alike; an empty table
or list gives no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

WORDS = 8
#: 2**16 rows of 40 bytes: below 8 MB as a broadcast table.
MAX_BLOCKS = 1 << 16
#: One block of 256 bits for so many URLs: about 0.4 % false positives.
URLS_PER_BLOCK = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Canonical form; null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Text and action of the longest fitting rule, null without one."""
    name = action = F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, action = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(act)).otherwise(action)
    return name, action


def _bits(url: Column) -> list[Column]:
    """The bit each word of the block gets."""
    h = F.xxhash64(F.lit(1), url)
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(h, 5 * i).bitwiseAND(31).cast("int")) for i in range(WORDS)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks)).cast("int")


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of the column ``canon``: ``block, w0 .. w7``."""
    words = listed.select(_block(F.col("canon"), blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col("canon")))])
    return words.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def blocks_for(count: int) -> int:
    return min(MAX_BLOCKS, 1 << max(0, math.ceil(math.log2(max(count, 1) / URLS_PER_BLOCK))))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every page row;
    ``listed`` has the canonical URLs to block in its column ``canon``."""
    listed = staged(listed.select("canon").where("canon is not null").distinct(), "url-list")
    blocks = blocks_for(listed.count())
    filt = staged(bloom(listed, blocks), "url-bloom")
    url = pages["url"]
    rows = pages.select(pages["page_id"].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canon"))
    name, action = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("action", action)
    # the filter has MAX_BLOCKS rows at most
    probed = rows.withColumn("b", _block(F.col("canon"), blocks)).join(F.broadcast(filt), F.col("b") == F.col("block"), "left")
    maybe = F.lit(True)
    for i, bit in enumerate(_bits(F.col("canon"))):
        maybe = maybe & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    probed = probed.select("page_id", "host", "path", "canon", "rule", "action", F.coalesce(maybe, F.lit(False)).alias("maybe"))
    clear = probed.where(~F.col("maybe")).select("page_id", "host", "path", "rule", "action", F.lit(False).alias("listed"))
    hits = probed.where("maybe").join(listed.select(F.col("canon").alias("c"), F.lit(True).alias("on")), F.col("canon") == F.col("c"), "left")
    hits = hits.select("page_id", "host", "path", "rule", "action", F.coalesce("on", F.lit(False)).alias("listed"))
    verdict = F.coalesce("action", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return clear.union(hits).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")
