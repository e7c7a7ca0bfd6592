"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from attestra.catalog import QUERIES  # noqa: E402
from attestra.session import local_session  # noqa: E402

HEADLINE = (
    "dimension_scores", "triage_empirical", "evidence_scores_empirical", "category_scores", "rubric_scores_articles", "composite_articles",
    "relevance_overrides", "material_distinct", "evidence_units", "citation_numbers", "split_headings", "sliding_windows", "pack_paragraphs",
    "borrow_citations", "context_window", "ledger_merge", "top_k", "concat_budget", "number_rows", "overlap_join", "html_to_text", "dedupe_sections",
    "source_rollup", "status_changes", "model_map", "merge_articles",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session("bench")
    QUERIES[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warms up the JVM
    took: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        took[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
