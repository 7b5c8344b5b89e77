"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from cohortlens.queries import load
from cohortlens.queries.registry import QUERIES
from cohortlens.session import local_session

HEADLINE = (
    "flagship_eligible_composition",
    "c2_cell_qc_metrics",
    "c6_tail_severity",
    "c10_qc_verdicts",
    "d2_log1p_cp10k",
    "d6_hvg_clipped_variance",
    "e1_pca_scores",
    "f1_knn_graph",
    "f9_cluster_markers",
    "g2_partition_agreement",
    "g6_cluster_artifact_audit",
    "h4_consensus_labels",
    "i1_score_genes",
    "i4_activity_ulm",
    "j1_pseudobulk",
    "j5_pseudobulk_de_paired",
    "j11_proportion_ttest_paired",
    "j25_depth_audit",
    "k2_bh_fdr",
    "l3_gsea_es",
    "l5_ora",
    "m1_lr_scores",
    "m9_topology",
    "n1_gene_correlation",
    "o3_graph_pseudotime",
    "o7_pseudotime_profile",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    load()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before timing
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
