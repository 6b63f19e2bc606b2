"""URL verdicts: allow and block rules first, then a list of canonical URLs behind a blocked Bloom filter.

All in DataFrame expressions. A listed URL sets one bit in each of the eight 32-bit words of the block that its hash names. Blocks are
rows (block, eight words); a page reads one of them. Pages whose bits are all set are possible hits, and only
these go to an exact hash join with the list, which removes the false positives.
The blocks are broadcast while they take at most BROADCAST_BYTES, by the size computed from the list's count;
beyond that they are joined by block number, and the possible hits are as few. The list is written down once; only possible hits are
shuffled with it, in a hash join whose tables hold distinct listed URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut

WORDS = 8
#: Bits of the filter for each listed URL: about 1 in 200 unlisted ones pass.
BITS_PER_URL = 16
BROADCAST_BYTES = 8 << 20
_ROW_BYTES = 8 + 8 * WORDS
#: Odd multipliers that pick the bit of each word.
_SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


#: One sign for each ending that goes, and how these signs are written where a path holds them itself.
_ENDINGS = (("\x01", ".html"), ("\x02", ".htm"))
_ESCAPED = (("\x03", "\x03c"), ("\x01", "\x03a"), ("\x02", "\x03b"))


def trimmed(path_: Column) -> Column:
    """The path without the ``.html``, ``.htm`` and slashes at its end, however many, in linear time.

    A pattern with a repeated group would recurse for each repetition, so every ending becomes one sign and the signs are trimmed.
    """
    out = path_
    for sign, written in (*_ESCAPED, *((ending, sign) for sign, ending in _ENDINGS)):
        out = F.replace(out, F.lit(sign), F.lit(written))
    out = F.rtrim(out, F.lit("/" + "".join(sign for sign, _ in _ENDINGS)))
    for sign, written in (*_ENDINGS, *((written, sign) for sign, written in reversed(_ESCAPED))):
        out = F.replace(out, F.lit(sign), F.lit(written))
    return out


def canonical(url: Column) -> Column:
    """One spelling for a page: no scheme, ``www.`` or ``m.``, query, fragment, ``.html`` or slashes at the end. Empty if no URL."""
    bare = F.regexp_replace(host(url), r"^(www|m)\.", "")
    tail = trimmed(path(url))
    return F.when(host(url) == "", F.lit("")).otherwise(F.concat(bare, tail))


def fitting_rule(host_: Column, path_: Column, rules: tuple = RULES) -> Column:
    """The struct (rule, verdict) of the longest rule that fits, or null. The rules become one expression, so they are meant to be few."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host_ == h) | F.endswith(host_, F.lit("." + h))) & F.startswith(path_, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _bits(key: Column) -> Column:
    """The eight words' bits of a hash, as longs with one bit of 32."""
    low = key.bitwiseAND(F.lit(0x7FFFFFFF))  # 31 bits, so that the products stay in a long
    ones = F.array(*(F.lit(1 << i) for i in range(32))).cast("array<long>")
    return F.array(*(F.element_at(ones, F.pmod(F.shiftright(low * F.lit(salt), 27), F.lit(32)).cast("int") + 1) for salt in _SALTS))


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter's rows ``block, w0 .. w7`` for the distinct ``key`` strings of ``listed``."""
    h = F.xxhash64("key")
    rows = listed.select(F.pmod(F.shiftright(h, 32), F.lit(blocks)).alias("block"), _bits(h).alias("bits"))
    return rows.groupBy("block").agg(*(F.bit_or(F.col("bits")[i]).alias(f"w{i}") for i in range(WORDS)))


def judge(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url", rules: tuple = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every row of ``pages``.

    The verdict is the longest fitting rule's; without one it is block if the page's canonical URL is that of some URL in ``listed``, else
    allow. A null or malformed URL has an empty host and path, no rule, and is never listed. Null and malformed list entries and
    repeated ones count for nothing. Repeated pages stay; other columns aren't read. Empty tables give no rows, or no hits.
    """
    keys = cut(listed.select(canonical(F.col(listed_col)).alias("key")).where("key <> ''").distinct())
    count = keys.count()
    blocks = max(1, -(-count * BITS_PER_URL // (32 * WORDS)))
    filter_ = bloom(keys, blocks)
    if blocks * _ROW_BYTES <= BROADCAST_BYTES:
        filter_ = F.broadcast(filter_)
    url = F.col(url_col)
    seen = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"), canonical(url).alias("key"))
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    seen = seen.withColumn("fit", fit).withColumn("h", F.xxhash64("key"))
    # a page that a rule decides, or that has no URL, asks for no block; it gets a number that no block has, by its hash
    asks = F.col("fit").isNull() & (F.col("key") != "")
    seen = seen.withColumn("asked", F.when(asks, F.pmod(F.shiftright("h", 32), F.lit(blocks))).otherwise(-1 - F.pmod(F.xxhash64("page_id", "key", "path"), F.lit(1 << 20))))
    probed = seen.join(filter_, seen["asked"] == filter_["block"], "left")
    bits = _bits(F.col("h"))
    passes = F.lit(True)
    for i in range(WORDS):
        passes = passes & (F.col(f"w{i}").bitwiseAND(bits[i]) != 0)
    probed = probed.withColumn("maybe", F.coalesce(asks & passes, F.lit(False))).select("page_id", "host", "path", "key", "fit", "maybe")
    sure = probed.where(~F.col("maybe")).select("page_id", "host", "path", "fit", F.lit(False).alias("listed"))
    exact = keys.select(F.col("key").alias("k"), F.lit(True).alias("hit")).hint("shuffle_hash")  # distinct keys, so no hash table is a hot one
    possible = probed.where("maybe")
    checked = possible.join(exact, possible["key"] == exact["k"], "left").select("page_id", "host", "path", "fit", F.coalesce("hit", F.lit(False)).alias("listed"))
    verdict = F.coalesce(F.col("fit")["verdict"], F.when(F.col("listed"), "block").otherwise("allow"))
    return sure.union(checked).select("page_id", "host", "path", F.col("fit")["rule"].alias("rule"), verdict.alias("verdict"), "listed")
