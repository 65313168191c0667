"""Print the physical-plan shape of the key operators.

Usage: python scripts/show_plans.py [sf_dir] [--full]
For each plan: exchanges (shuffles), broadcasts, nested-loop joins,
partial top-k (WindowGroupLimit / TakeOrderedAndProject), scans with
their ReadSchema.  ``--full`` prints the formatted plans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from reelsim.plans import catalogue, evaluate  # noqa: E402
from reelsim.plans.model import Recommender  # noqa: E402
from reelsim.session import get_spark  # noqa: E402
from reelsim.sources.tables import films  # noqa: E402


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summary(name: str, df, full: bool) -> None:
    p = plan_text(df)
    count = lambda pat: len(re.findall(pat, p))
    print(f"## {name}")
    print(f"shuffle exchanges: {count(r'Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin')}"
          f"  broadcasts: {count(r'BroadcastExchange')}  nested-loop joins: {count(r'BroadcastNestedLoopJoin|CartesianProduct')}"
          f"  WindowGroupLimit: {count(r'WindowGroupLimit')}  TakeOrdered: {count(r'TakeOrderedAndProject')}")
    for m in sorted(set(re.findall(r"ReadSchema: (\S+)", p))):
        print("  ReadSchema:", m)
    for m in sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", p))):
        if m != "[]":
            print("  PushedFilters:", m)
    if full:
        df.explain("formatted")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 and not sys.argv[1].startswith("--") else "/root/testdata/sf0.01"
    full = "--full" in sys.argv
    spark = get_spark("local[8]", 8)
    lazy = Recommender.fit(films(spark, sf))
    summary("fit: postings (lazy, from the parquet scans)", lazy.model.postings, full)
    summary("fit: vocabulary", lazy.model.vocabulary, full)
    rec = catalogue._rec(spark, sf)
    q = catalogue._first_title(rec)
    summary("by_title (one request, stored model)", rec.by_title(q, 5, bounded=True), full)
    summary("by_title batch (50 sampled titles)", rec.by_title(evaluate.sample_queries(rec), 5, bounded=True), full)
    summary("by_description (50 whole descriptions)", catalogue.q_recommend_by_description(spark, sf), full)
    summary("by_description + genre regex", catalogue.q_recommend_by_description_genre(spark, sf), full)
    summary("by_genre (every genre)", catalogue.q_recommend_by_genre(spark, sf), full)
    summary("resolve_titles (4 variants of every title)", catalogue.q_resolve_titles(spark, sf), full)
    summary("title_suggestions (every title word)", catalogue.q_title_suggestions(spark, sf), full)
    summary("intra-list similarity", catalogue.q_intra_list_similarity(spark, sf), full)
    summary("dedupe titles", catalogue.q_dedupe_titles(spark, sf), full)
    summary("genre counts top 12", catalogue.q_genre_counts_top12(spark, sf), full)
    _ = F


if __name__ == "__main__":
    main()
