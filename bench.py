"""Headline queries at one scale, timed; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default the headline set).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from answerloom.registry import QUERIES  # noqa: E402
from answerloom.session import local_session  # noqa: E402

HEADLINE = [
    "clean_newlines", "dedup_articles", "canonical_map", "chunk_passages", "dedup_passages",
    "repair_article_id", "chunk_qa", "assign_passage_id", "generation_needed", "train_split",
    "normalize_answer", "token_f1", "squad_metrics", "encode_pairs", "trim_batches",
    "easy_batches", "hard_batches", "embed_passages", "topk_retrieval", "gold_rank",
    "precision_at_k", "retrieved_passages", "bm25_topk", "hybrid_rerank", "ann_retrieval",
    "inbatch_loss", "corpus_contrastive_loss", "queue_loss",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session("bench", cpus, shuffle_partitions=int(cpus))
    # One untimed query starts the JVM, the Python workers and the code caches.
    QUERIES["gold_rank"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    # Each query runs twice and the faster run counts: the first one also pays for
    # compiling its generated code.
    spent = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        spent[name] = round(min(runs), 3)
        sys.stderr.write(f"\n{name} {runs[0]:.2f} {runs[1]:.2f}\n")
    print(json.dumps({"metric": "headline_total", "value": round(sum(spent.values()), 3),
                      "unit": "sec", "queries": spent, "sf": os.path.basename(sf_dir)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
