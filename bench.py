"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewlens.session import clear_staged, local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "scan_csv_reviews",
    "clean_reviews",
    "row_counts",
    "word_count_stats_exact",
    "top_keywords",
    "embed_clean_tokens",
    "vocab_document_freq",
    "tfidf",
    "text_features",
    "tfidf_bigram_l2",
    "pretrained_doc_vectors",
    "batch_encode_text",
    "classification_report",
    "auc_roc",
    "threshold_sweep",
    "dataset_payload",
    "smote_oversample",
    "lr_weighted",
    "dt_weighted",
    "threshold_moving",
    "rf_weighted",
    "gbt_plain",
    "word2vec_fit_transform",
    "lr_on_embeddings",
    "smote_lr",
    "pseudo_label",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf}/labels.parquet").count()  # start-up is not measured
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        clear_staged(spark)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
