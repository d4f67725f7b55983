"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS, BENCH_QUERIES (comma list) and BENCH_BUDGET (seconds, no query starts later) are read
from the environment. Tables handed over between phases are written before a query's own clock starts.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = ("corpus_density", "read_corpus", "html_to_markdown", "page_links", "segment_units", "heading_context", "pack_chunks", "sections_from_units", "plan_batches",
             "ingest_responses", "validate_nodes", "coverage_fallback", "assemble_graph", "dedupe_edges", "concept_index", "reconcile_concepts", "materialize_gaps",
             "validate_graph", "merge_variants", "apply_density_scores", "apply_decomposition", "triage_definitions", "resolve_external", "annotate_document",
             "section_edges", "build_teaching_records", "expand_prerequisites", "prune_reachable", "topological_order", "dense_paragraphs", "split_dense_prose",
             "audit_sections")


def main() -> None:
    from pyspark.sql import SparkSession

    from docloom.plans import QUERIES
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",") if n in QUERIES]
    budget = float(os.environ.get("BENCH_BUDGET", "900"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    began, times, staging = time.time(), {}, 0.0
    for name in names:
        if time.time() - began > budget:
            break
        start = time.time()
        df = QUERIES[name](spark, sf_dir)  # writes missing hand-over tables; iterative queries do their rounds here
        built = time.time()
        df.write.format("noop").mode("overwrite").save()
        first = time.time()
        if name in ("prune_reachable", "topological_order", "dependency_levels", "expansion_frontier"):
            again = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - again, 3)
        else:
            times[name] = round(first - built, 3)
        staging += built - start
    print(json.dumps({"metric": "docloom_headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "hand_over_sec": round(staging, 3), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
