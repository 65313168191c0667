"""URL filters: temporal join of captures with dated list entries.

A list is a log of dated entries, ``add`` or ``remove``, for domains.  The
entries of a domain become validity intervals ``[valid_from, valid_to)``.  A
capture is tested, as of its fetch day, against the intervals of its host and
of every parent domain, so an entry added or removed later does not change
it.

Defined results: hosts are lower-cased, without user, port and trailing dot;
a url without a host, or a null one, matches nothing; a capture without a
fetch day matches nothing; of several entries of a domain and day ``remove``
wins; a second ``add`` in a row does not start a new interval; null domains or days
are ignored; copies of a capture each get their row; empty tables give empty
results or no match.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsim.llm.common import split_join, store


def host_of(url: str = "url") -> Column:
    h = F.regexp_extract(F.lower(F.col(url)), "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.nullif(F.regexp_replace(h, "[.]+$", ""), F.lit(""))


def domains_of(host: str = "host") -> Column:
    """The host and its parent domains of two labels or more."""
    parts = F.split(F.col(host), "[.]")
    n = F.size(parts)
    many = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i, n), "."))
    return F.when(F.col(host).isNotNull(), many).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``(domain, spans)`` from ``entries(domain, day, action)``: ascending
    ``(valid_from, valid_to)``, the last one open (null) if never removed."""
    e = (entries.filter(F.col("domain").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove"))
                .groupBy(F.lower("domain").alias("domain"), "day").agg(F.max("action").alias("action")))
    w = Window.partitionBy("domain").orderBy("day")
    e = e.withColumn("_p", F.lag("action").over(w)).filter(F.col("_p").isNull() | (F.col("_p") != F.col("action")))
    e = e.withColumn("valid_to", F.lead("day").over(w)).filter("action = 'add'")
    return e.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct(F.col("day").alias("valid_from"), "valid_to"))).alias("spans"))


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures(page_id, url, fetch_day)`` with ``host``, ``blocked`` and,
    of the longest domain that blocks, ``rule, valid_from, valid_to``."""
    # a page_id may repeat: rows are told apart by all that is read of them
    c = captures.select("page_id", "url", "fetch_day").withColumn("host", host_of())
    each = c.filter(F.col("fetch_day").isNotNull()).select("host", "fetch_day").distinct()
    each = each.select("host", "fetch_day", F.explode(domains_of()).alias("domain"))
    lists = intervals(entries)
    seen = each.groupBy("domain").agg(F.count("*").alias("seen"))
    lists = store(lists.join(seen, "domain"), "intervals")
    total = lists.agg(F.sum("seen").alias("n")).first()["n"] or 0
    hits = split_join(each, lists, "domain", "seen", total, "inner", F.xxhash64("host", "fetch_day"))
    day = F.col("fetch_day")
    live = F.filter("spans", lambda s: (s["valid_from"] <= day) & (s["valid_to"].isNull() | (s["valid_to"] > day)))
    hits = hits.withColumn("_s", F.try_element_at(live, F.lit(1))).filter(F.col("_s").isNotNull())
    best = hits.groupBy("host", "fetch_day").agg(
        F.max(F.struct(F.length("domain").alias("l"), "domain", "_s")).alias("b"))
    best = best.select(F.concat_ws("|", "host", "fetch_day").alias("_k"), F.col("b.domain").alias("rule"), "b._s.valid_from", "b._s.valid_to")
    sizes = c.groupBy(F.concat_ws("|", "host", "fetch_day").alias("_k")).agg(F.count("*").alias("_n"))
    best = store(best.join(sizes, "_k"), "verdicts")
    n = best.agg(F.sum("_n").alias("n")).first()["n"] or 0
    keyed = c.withColumn("_k", F.when(F.col("host").isNotNull() & F.col("fetch_day").isNotNull(), F.concat_ws("|", "host", "fetch_day"))
                                .otherwise(F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))))
    out = split_join(keyed, best, "_k", "_n", n, "left", F.xxhash64("page_id"))
    return out.select("page_id", "url", "host", "fetch_day", F.col("rule").isNotNull().alias("blocked"), "rule", "valid_from", "valid_to")
