"""Print the physical plans of the headline jobs (long literal lists shortened).

usage: python tools/show_plans.py [SF_DIR] > docs/plans.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def short(plan: str) -> str:
    plan = re.sub(r"(INSET|IN \(|In\(term, \[)([^\]\)]{120})[^\]\)]*", lambda m: m.group(1) + m.group(2) + " ...", plan)
    plan = re.sub(r"#\d+L?", "", plan)
    return "\n".join(line[:220] for line in plan.splitlines())


def main() -> None:
    from pyspark.sql import functions as F

    from trawl.operators import crawlplan as cp
    from trawl.operators import index as ix
    from trawl.operators import rank as rk
    from trawl.plans import inputs as inp
    from trawl.plans.catalog import _robots_rules
    from trawl.session import build_session, scratch_path

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]", 8)
    corpus = inp.corpus(spark, sf)
    path = scratch_path(spark, "plans-index")
    index = ix.build_index(corpus, unique_ids=True)
    index.write(path)
    opened = ix.Index.read(spark, path)
    index.write(path + "-blocks", layout="blocks")
    blocked = ix.Index.read(spark, path + "-blocks")
    q = inp.bench_queries(spark, sf)
    pages = inp.pages(spark, sf)
    seeds = pages.select(F.concat(F.regexp_extract("url", r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1),
                                  F.lit("/")).alias("url"))
    jobs = {
        "Postings as written (before the Parquet writer)":
            index.postings.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id"),
        "BM25 top-10 for a query batch over the written index": rk.search(q, opened, "bm25", 10),
        "BM25 top-10 with the upper-bound cut over posting blocks (last step)": rk.search(q, blocked, "bm25", 10, prune=True),
        "All-terms match over posting blocks (last step)": rk.search(q, blocked, "bm25", 10, match="all"),
        "One crawl round (frontier, robots rules, fetch plan)":
            cp.next_fetch_list(pages, seeds, pages, _robots_rules(spark, pages)),
        "Request gaps per domain (skew-safe predecessor)":
            cp.politeness_violations(inp.events(spark, sf), 600.0, domain_col="user_id"),
    }
    print("# Physical plans\n")
    print("Generated by `python tools/show_plans.py` (sf0.01, local[4]); literal lists shortened.\n")
    for title, df in jobs.items():
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {title}\n\n```\n{short(plan)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
