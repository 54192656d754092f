"""URL filters: host and path rules, and a long list of URLs behind a blocked
Bloom filter; DataFrame functions only.

Rules come first.  A rule is (verdict, host, path): it fits its host and all
subdomains if the url's path starts with the rule's path, the longest rule
(host and path together) wins, then the one with the longer host, then a
blocking one.  Rules are a configured list and travel in the plan.

URLs that no rule fits are looked up in the list by canonical form
(``canonical``).  The list is hashed into a blocked Bloom filter: a URL's first
hash names one block of 8 words of 64 bits, its second hash one bit in each
word, so a lookup reads one row.  The filter has ``BITS_PER_KEY`` bits a listed
URL, up to ``MOST_BLOCKS`` blocks of 64 bytes, which bounds the broadcast
(16 MB of bits) however long the list is; a list beyond that makes the filter
fuller and lets more pass, never less.  Pages that the filter lets through are
reduced to distinct URLs and joined with the list itself (a shuffled hash
join), which removes the false positives.  What is confirmed goes back to the
pages by (url, salt), so one URL on a third of all pages is spread over
``SALTS`` tasks.  Pages that the filter stops are never shuffled.

Defined cases: a null url or one without ``://`` has an empty host and path, fits
no rule, is in no list and is allowed; null and repeated listed URLs are
ignored; rows that repeat are rows of their own; an empty list blocks nothing.
Columns of the input called host, path, rule or verdict are replaced.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, fresh

WORDS = 8                        # of 64 bits: a block is a cache line
BITS_PER_KEY = 16
MOST_BLOCKS = 1 << 18            # bound of the broadcast: 2**18 blocks of 64 bytes
SALTS = 32
#: query parameters that don't change what a URL names
TRACKING = "^(utm_[^=]*|ref|gclid|fbclid)(=|$)"


def _after(url: Column) -> Column:
    """What follows the first ``://`` (null where there is none)."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(_after(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without trailing slashes, the
    query's parameters sorted and without tracking; no scheme, no fragment.
    Null where the url is null or has no ``://``."""
    host = F.regexp_replace(host_of(url), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    found = F.split(F.regexp_extract(_after(url), r"^[^?#]*\?([^#]*)", 1), "&")
    query = F.array_join(F.array_sort(F.filter(found, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(F.locate("://", url) > 0, F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits as a struct (.., text, verdict), null if none does."""
    if not rules:
        return F.lit(None).cast("struct<text:string,verdict:string>")
    fitting = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                      F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(len(h)).alias("host_size"),
                               F.lit(v == "block").alias("blocks"), F.lit(h + p).alias("text"), F.lit(v).alias("verdict")))
               for v, h, p in ((v, h.lower(), p) for v, h, p in rules)]
    return F.array_max(F.array(*fitting))


def _places(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key, and its mask in each of the block's words."""
    bits = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    masks = [F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int"))
             for i in range(WORDS)]
    return F.pmod(F.xxhash64(key), F.lit(blocks)), masks


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row for each block that has a bit: ``block`` and its words ``w0..w7``."""
    block, masks = _places(F.col(key), blocks)
    rows = listed.select(block.alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def blocks_for(keys: int) -> int:
    return max(1, min(MOST_BLOCKS, -(-keys * BITS_PER_KEY // (64 * WORDS))))


def may_be_listed(frame: DataFrame, key: str, bloom: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``flag``: the filter has all bits of the key (false for a null key)."""
    names = {c: fresh(frame.columns, f"bloom_{c}") for c in bloom.columns}
    words = F.broadcast(bloom.select(*[F.col(c).alias(n) for c, n in names.items()]))      # at most MOST_BLOCKS rows
    block, masks = _places(F.col(key), blocks)
    joined = frame.join(words, (block == F.col(names["block"])) & F.col(key).isNotNull(), "left")
    has = reduce(Column.__and__, [F.col(names[f"w{i}"]).bitwiseAND(m) == m for i, m in enumerate(masks)])
    return joined.withColumn(flag, F.coalesce(has, F.lit(False))).drop(*names.values())


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]], url_col: str = "url",
          listed_col: str = "url") -> DataFrame:
    """All columns plus host, path, rule (text, null if none fits) and verdict (allow or
    block): the rule's; else block for a listed URL, allow for any other."""
    keys = listed.select(canonical(F.col(f"`{listed_col}`").cast("string")).alias("key")).filter("key is not null").distinct()
    keys = cut_lineage(keys)
    blocks = blocks_for(keys.count())
    bloom = bloom_filter(keys, "key", blocks)

    given = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    best, key, hit, salt = (fresh([*pages.columns, "host", "path"], n) for n in ("best", "key", "hit", "salt"))
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(*[F.col(f"`{c}`") for c in given], host_of(url).alias("host"), path_of(url).alias("path"),
                        canonical(url).alias(key))
    rows = rows.withColumn(best, best_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn(key, F.when(F.col(best).isNull(), F.col(key)))
    marked = may_be_listed(rows, key, bloom, blocks, hit)

    possible = marked.filter(F.col(hit))
    confirmed = keys.join(possible.select(F.col(key).alias("key")).distinct().hint("shuffle_hash"), "key", "left_semi")
    confirmed = confirmed.select(F.col("key").alias("sure"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("sure_salt"))
    possible = possible.withColumn(salt, F.floor(F.rand(11) * SALTS).cast("int"))
    looked_up = possible.join(confirmed.hint("shuffle_hash"),
                              (F.col(key) == F.col("sure")) & (F.col(salt) == F.col("sure_salt")), "left")
    rule = F.col(best)["text"].alias("rule")
    by_rule = F.col(best)["verdict"]
    out = [*[F.col(f"`{c}`") for c in given], F.col("host"), F.col("path"), rule]
    stopped = marked.filter(~F.col(hit)).select(*out, F.coalesce(by_rule, F.lit("allow")).alias("verdict"))
    return stopped.unionAll(looked_up.select(
        *out, F.when(F.col("sure").isNotNull(), F.lit("block")).otherwise("allow").alias("verdict")))
