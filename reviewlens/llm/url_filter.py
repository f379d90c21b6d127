"""URL filters: allow and block rules by host and path, and a list of URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import free_names, without
from reviewlens.session import stage

#: Filter bits for each listed URL; four are set, in one 64-bit word.
BITS_PER_URL, SET_BITS = 16, 4
#: Bound on the broadcast filter: 2 million words. A longer list fills it more, and more pages go to the exact
#: join; the result stays the same.
MAX_FILTER_BITS = 2**27
RESULT = ("host", "path", "rule", "verdict")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host, its subdomains, and paths that start with the rule's."""

    verdict: str
    host: str
    path: str = "/"

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """The form in which URLs are listed and compared; null where there is no host.

    Host in lower case without ``www.`` and without the ports 80 and 443, path without ``index.html`` and
    slashes at its end, query without ``utm_`` and ``ref`` parameters; no scheme and no fragment.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"\Awww\.", ""), r":(80|443)\z", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?\z", ""), r"/+\z", "")
    query = F.coalesce(F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_") & ~p.startswith("ref=")))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """The filter word of a hash, and its mask of up to ``SET_BITS`` bits."""
    word = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(words))
    mask = F.lit(0).cast("long")
    for i in range(SET_BITS):
        bit = F.shiftrightunsigned(key, 6 * i).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return word, mask


def listed_urls(pages: DataFrame, listed: DataFrame, url_col: str, listed_col: str, max_filter_bits: int) -> tuple[DataFrame, str]:
    """``pages`` with a boolean column, whose name is returned: whether the page's canonical URL is listed.

    A Bloom filter of the list, whose size is bounded, is broadcast and passes the possible hits on to an exact
    join with the list by canonical URL, which removes false positives. All other pages stay where they are.
    """
    form, word, mask, of, bits, hit, exact = free_names(pages, "form", "word", "mask", "of", "bits", "hit", "exact")
    urls = stage(listed.select(canonical(F.col(listed_col)).alias("url")).filter("url is not null").distinct(), "listed")
    count = urls.count()
    words = 2**10
    while words * 64 < min(count * BITS_PER_URL, max_filter_bits):
        words *= 2
    place, set_bits = _place(F.xxhash64("url"), words)
    bloom = stage(urls.groupBy(place.alias(of)).agg(F.bit_or(set_bits).alias(bits)), "url-filter")

    formed = pages.withColumn(form, canonical(F.col(url_col)))
    place, set_bits = _place(F.xxhash64(form), words)
    tested = (
        formed.withColumn(word, place)
        .withColumn(mask, set_bits)
        .join(F.broadcast(bloom), F.col(word) == F.col(of), "left")
        .withColumn(hit, F.coalesce(F.col(bits).bitwiseAND(F.col(mask)) == F.col(mask), F.lit(False)) & F.col(form).isNotNull())
        .drop(word, mask, of, bits)
    )
    passed = tested.filter(~F.col(hit)).drop(form)
    possible = stage(tested.filter(F.col(hit)).drop(hit), "possible")
    found = possible.join(urls.select(F.col("url").alias(exact)), F.col(form) == F.col(exact), "left")
    return passed.unionByName(found.withColumn(hit, F.col(exact).isNotNull()).drop(form, exact)), hit


def url_filter(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed: DataFrame,
    url_col: str = "url",
    listed_col: str = "url",
    max_filter_bits: int = MAX_FILTER_BITS,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, the ``rule`` that fits as ``host/path``, and ``verdict``.

    The longest rule that fits (of equal length, the first) decides. Where none fits, pages whose canonical
    URL is in ``listed`` are blocked and all others allowed. Null URLs and those without ``://`` have an empty
    host and path, fit no rule and are never listed. Repeated pages get the same verdict each; columns with the
    names of result columns are replaced; an empty list blocks nothing, and an empty table gives an empty result.
    """
    pages, hit = listed_urls(without(pages, *RESULT), listed, url_col, listed_col, max_filter_bits)
    longest = sorted(rules, key=lambda r: -len(r.host + r.path))
    judged = pages.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    host, path = F.col("host"), F.col("path")
    rule = F.coalesce(*(F.when(r.fits(host, path), F.lit(r.host + r.path)) for r in longest), F.lit(None).cast("string"))
    by_rule = F.coalesce(*(F.when(r.fits(host, path), F.lit(r.verdict)) for r in longest), F.lit(None).cast("string"))
    by_list = F.when(F.col(hit), "block").otherwise("allow")
    return judged.withColumn("rule", rule).withColumn("verdict", F.coalesce(by_rule, by_list)).drop(hit)
