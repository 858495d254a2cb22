"""URL filter: site rules first, then a list of canonical URLs behind a blocked Bloom filter.

Only DataFrame functions. The Bloom filter is a table of 256-bit blocks; a key sets eight bits
of one block. Its size follows the list up to ``MAX_BLOCKS`` (16 MB of bits), so it is always
safe to broadcast; beyond that the share of false hits rises and only costs work. URLs that pass
go to an exact join with the list, all others skip that join.

Defined cases: a NULL URL or one without ``://`` has an empty host and path, fits no rule and is
allowed. Repeated rows are judged one by one. An empty list allows whatever no rule blocks. NULLs
in the list are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored

BITS_PER_KEY = 12
BLOCK_WORDS = 4
MAX_BLOCKS = 1 << 19
#: Rules are configuration and become one expression; a longer list belongs in ``listed``.
MAX_RULES = 500

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_MEANING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


class SiteRule(NamedTuple):
    """``action`` is allow or block, for a host with its subdomains and a start of the path."""

    action: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """One spelling per page: no scheme, user, port, ``www.``/``m.``, fragment or tracking."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^.*@|:\d*$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(/index)?\.html?$|/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(NO_MEANING))
    text = F.array_join(F.array_sort(parts), "&")
    full = F.concat(host, path, F.when(text != "", F.concat(F.lit("?"), text)).otherwise(""))
    return F.when(F.coalesce(host_of(url), F.lit("")) != "", full)


def rule_of(host: Column, path: Column, rules: Sequence[SiteRule]) -> Column:
    """Struct (rule, action) of the longest rule that fits, NULL if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules: put URLs into the list instead")
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.action).alias("action"))
        found = F.when(fits, value).otherwise(found)
    return found


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(key, F.lit(1))
    place = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(2 * BLOCK_WORDS)]
    bit = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in place]
    return [bit[2 * i].bitwiseOR(bit[2 * i + 1]) for i in range(BLOCK_WORDS)]


def bloom_blocks(keys: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, int]:
    """Table (block, w0..w3) of the filter over a column, and its number of blocks."""
    n = min(MAX_BLOCKS, max(1, -(-n_keys * BITS_PER_KEY // (64 * BLOCK_WORDS))))
    block = F.pmod(F.xxhash64(F.col(key)), F.lit(n)).alias("block")
    cols = [m.alias(f"m{i}") for i, m in enumerate(_masks(F.col(key)))]
    words = [F.bit_or(f"m{i}").alias(f"w{i}") for i in range(BLOCK_WORDS)]
    return keys.filter(F.col(key).isNotNull()).select(block, *cols).groupBy("block").agg(*words), n


def probe(df: DataFrame, key: str, blocks: DataFrame, n: int, flag: str) -> DataFrame:
    """Add a boolean: false means that the key is certainly not in the filter."""
    block = F.pmod(F.xxhash64(F.col(key)), F.lit(n))
    masks = _masks(F.col(key))
    hit = F.lit(True)
    for i, m in enumerate(masks):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) == m)
    joined = df.withColumn("block", block).join(F.broadcast(blocks), "block", "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(hit & F.col(key).isNotNull(), F.lit(False)).alias(flag))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[SiteRule] = (), id_col: str = "page_id", url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """Per page: id, host, path, rule, verdict (allow or block), canonical, listed."""
    entries = stored(listed.select(canonical_url(F.col(listed_col)).alias("canonical")).filter("canonical IS NOT NULL").distinct())
    blocks, n = bloom_blocks(entries, "canonical", entries.count())
    url = F.col(url_col)
    base = pages.select(
        F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"), canonical_url(url).alias("canonical")
    )
    probed = probe(base, "canonical", blocks, n, "possible")
    exact = entries.select("canonical", F.lit(True).alias("listed"))
    hits = probed.filter("possible").join(exact, "canonical", "left")
    both = hits.unionByName(probed.filter("NOT possible").withColumn("listed", F.lit(False)))
    found = rule_of(F.col("host"), F.col("path"), rules)
    is_listed = F.coalesce("listed", F.lit(False))
    return both.withColumn("found", found).select(
        id_col,
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.action"), F.when(is_listed, "block").otherwise("allow")).alias("verdict"),
        "canonical",
        is_listed.alias("listed"),
    )
