"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

from gleaner.catalog import load
from gleaner.session import local_session

HEADLINE = [
    "general_digest", "special_digest", "site_digest", "issue_report",
    "normalize_url", "dedupe_url_title", "dedupe_title", "dedupe_greedy_or", "dedupe_best_body",
    "top_per_medium", "rank_with_ties", "budget_across_groups", "first_n_per_group", "batch_number",
    "body_metrics", "validate_body", "clean_body_lines", "chunk_text", "rule_score", "match_rules", "topic_score",
    "split_existing", "resolve_page_id", "upsert_store", "translation_lookup",
    "parse_flexible_datetime", "extract_datetime_by_rule", "window_decision", "decision_rollup",
    "page_links", "paragraph_text", "select_one", "stream_counts",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="gleaner-bench")
    known, _ = load()
    times: dict[str, float] = {}
    for name in names or [n for n in HEADLINE if n in known]:
        start = time.time()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main(sys.argv[1:])
