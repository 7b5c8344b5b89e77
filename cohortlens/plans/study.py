"""Chains of operators users run end to end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import compare, quality
from ..session import materialise


def graded_quality(
    metrics: DataFrame, tails: Mapping[str, quality.Tail], axes: Sequence[quality.Axis], group: Sequence[str]
) -> DataFrame:
    """Severities inside groups, evidence families, verdicts and eligibility masks of every cell."""
    scored = quality.tail_severity(metrics, tails, group)
    verdicts = quality.adjudicate_qc(quality.evidence_families(scored, axes))
    return quality.eligibility_masks(materialise(verdicts, "verdicts"))


def eligible_composition(
    cells: DataFrame, cell_type: str, donor: str, condition: str, case: str, control: str
) -> DataFrame:
    """Paired composition contrast over the cells that may enter composition inference."""
    ok = cells.filter(F.col("qc_inference_composition") & F.col(condition).isin(case, control))
    counts = materialise(compare.celltype_counts(ok, [donor, condition], cell_type), "counts")
    return compare.proportion_ttest(counts, cell_type, donor, condition, case, control)
