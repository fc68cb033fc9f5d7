"""URL verdicts: ordered host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

A URL that no rule fits is blocked when its canonical form is listed. The Bloom filter (of
bounded size, broadcast) passes possible hits in the scan; only these are shuffled to the exact hash
join with the list, which removes the false positives. All other rows are never moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.bloom import BloomFilter
from tillstar.llm.storage import materialise

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Parameters that tell where a visitor came from, not which page it is.
TRACKING = r"^(ref|utm_[^=]*|fbclid|gclid)(=|$)"

Rule = tuple[str, str, str]  # verdict, host, path


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, ASCII in lower case; empty for null or no ``://``."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, CAPITALS, SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without final slashes, the parameters that matter in order.
    Scheme and fragment are dropped. Null without a host."""
    rest = F.regexp_replace(_after_scheme(url), r"(?s)#.*$", "")
    host = F.regexp_replace(host_of(url), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, by its text ``host + path``; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for decision, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def repeated_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """A list to filter by: the canonical URLs under which more than one row stands (mirrors and tracking variants), each with
    its smallest id, the page to keep."""
    canonical = pages.select(canonical_url(F.col(url_col)).alias("canonical"), F.col(id_col).alias("keep")).filter("canonical is not null")
    return canonical.groupBy("canonical").agg(F.count("*").alias("n"), F.min("keep").alias("keep")).filter("n > 1").select("canonical", "keep")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (or null), verdict, listed.

    ``listed`` has canonical URLs (nulls and repeats are ignored) and, if it has a second column, the id of the page that
    stays although its URL is listed (null: none; of several the smallest). A rule's verdict
    wins; without a rule a listed URL is blocked and any other allowed. Null URLs and those without
    ``://`` have an empty host and path, fit no rule and are allowed. Rows may repeat, ids may be null,
    extra columns are ignored; an empty table gives an empty result, an empty list blocks nothing.
    """
    first, *keep = listed.columns
    keep = F.col(keep[0]) if keep else F.lit(None)
    id_type = pages.schema[id_col].dataType
    listed = listed.filter(F.col(first).isNotNull()).groupBy(F.col(first).alias("canonical")).agg(F.min(keep.cast(id_type)).alias("keep"))
    listed = materialise(listed.withColumn("k", F.xxhash64("canonical")), "url-list", narrow=True)
    bloom = BloomFilter(listed, "k")
    url = F.col(url_col).cast("string")
    host, path = host_of(url), path_of(url)
    rule, verdict = rule_for(host, path, rules)
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("by_rule"),
                        canonical_url(url).alias("canonical"))
    may = F.col("canonical").isNotNull() & bloom.column(F.xxhash64("canonical"))
    rows = materialise(rows.withColumn("may", may), "url-rows")
    exact = listed.select("canonical", "keep", F.lit(True).alias("hit"))
    out = (rows.filter("may").join(exact, "canonical", "left").withColumn("listed", F.coalesce("hit", F.lit(False)))
           .unionByName(rows.filter("not may").withColumn("listed", F.lit(False)), allowMissingColumns=True))
    kept = F.coalesce(F.col("id") == F.col("keep"), F.lit(False))
    method = F.when(F.col("listed") & ~kept, "block").otherwise("allow")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "listed")
