"""Registered queries of the subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from trunkline.llm import (
    alignment,
    best_fit,
    decontamination,
    exact_dedup,
    html_text,
    jaccard_join,
    licenses,
    packing,
    periodic_runs,
    substring_dedup,
    suffix_dedup,
    token_files,
    toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        token_files.op1_token_files,
        licenses.op2_license_scan,
        jaccard_join.op3_jaccard_join,
        html_text.op4_html_text,
        suffix_dedup.op5_suffix_dedup,
        exact_dedup.op6_exact_dedup,
        packing.op7_packing,
        decontamination.op8_decontamination,
        substring_dedup.op9_substring_dedup,
        toxicity.op10_toxicity,
        best_fit.op11_best_fit_packing,
        alignment.op12_token_alignment,
        periodic_runs.op13_periodic_runs,
    ]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """Statements by query; the pipeline and what hashes, codes or learns has none."""
    return {"op2_license_scan": licenses.OP2_SQL, "op6_exact_dedup": exact_dedup.OP6_SQL}
